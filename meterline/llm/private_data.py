"""Personal data in texts: fixed patterns, and a character-level tagger that adds what they miss.

The patterns give the base spans, which always stay. The tagger is a bidirectional LSTM over characters with a CRF on
top, trained in numpy on windows of documents whose base spans are the labels, some of them rewritten in forms the
patterns do not know. Every kind has a digit or an at sign, so only windows with one are read. Windows overlap; the
scores of a character from all windows that see it are averaged by its distance from their edges, and the best tag
sequence is then found over the whole stretch of windows, not per window. An added span must have the shape of its kind
and touch no base span.

Positions count code points, ends are exclusive. A null or empty text has no span. Without any base span to learn from
there is no tagger, and the base spans are the result. An empty table gives an empty result. Rows may repeat.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.storage import hashed_sample, made_in_one_task

KINDS = ("email", "ip", "card", "phone")

WINDOW = 128
STRIDE = 64
EMBEDDING = 16
HIDDEN = 24
# Steps of training, and passes over the windows at most.
UPDATES, MOST_EPOCHS = 380, 60
BATCH_WINDOWS = 48
STEP = 0.04
SEED = 7

# Training reads at most so many documents that hold a digit or an at sign, of any length, in the order of a hash of the
# text, until they have given so many windows. Scanning has no such bounds.
TRAINING_DOCUMENTS = 1500
TRAINING_WINDOWS = 3000
# One training span in so many is rewritten in a form the patterns do not know.
REWRITTEN = 5

BATCH_BYTES = 2_000_000

# What counts as personal data without the tagger.
EMAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A run of digits that fails from its start fails from within as well, hence the look behind.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_TRIGGER = re.compile("[0-9@]")
_DIGITS = re.compile("[0-9]")

Span = tuple[str, int, int]


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if place % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    end = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        match = EMAIL_DOMAIN.match(text, at) if start < at else None
        if match:
            end = match.end()
            yield "email", start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str | None) -> list[Span]:
    """Spans of the fixed patterns, by kind and then start; a match that fails its check is dropped whole."""
    if not text or not _TRIGGER.search(text):
        return []
    spans = list(_emails(text))
    for match in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in match[0].split(".")):
            spans.append(("ip", *match.span()))
    for match in CARD.finditer(text):
        digits = "".join(_DIGITS.findall(match[0]))
        if 16 <= len(digits) <= 19 and _luhn(digits):
            spans.append(("card", *match.span()))
    for match in PHONE.finditer(text):
        if 8 <= len(_DIGITS.findall(match[0])) <= 15:
            spans.append(("phone", *match.span()))
    return spans


def fits(kind: str, found: str) -> bool:
    """Whether an added span has the shape of its kind."""
    digits = len(_DIGITS.findall(found))
    if kind == "email":
        name, mark, host = found.partition("@")
        return bool(mark) and "@" not in host and len(name.strip()) > 0 and "." in host.strip(" .") and len(found) <= 100
    if len(found) > 40 or re.search(r"[A-Za-z@\n]", found):
        return False
    if kind == "ip":
        parts = re.findall("[0-9]+", found)
        return len(parts) == 4 and all(int(part[:4]) <= 255 and len(part) <= 3 for part in parts)
    return 13 <= digits <= 19 if kind == "card" else 10 <= digits <= 15


# Characters the tagger tells apart: signs one by one, letters and digits by class.
_SIGNS = " @.+-()_%,;:/\\#*$&|<>[]{}=\"'!?\n\t"
_CLASSES = 6 + len(_SIGNS)


def _class_table():
    import numpy as np

    table = np.full(128, 1, dtype=np.int64)
    table[ord("a") : ord("z") + 1] = 2
    table[ord("A") : ord("Z") + 1] = 3
    table[ord("0") : ord("9") + 1] = 4
    for number, sign in enumerate(_SIGNS):
        table[ord(sign)] = 6 + number
    return table


def char_classes(text: str):
    """The class of each character; 0 is kept for what lies outside a text, 5 for all but ASCII."""
    import numpy as np

    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out = np.full(len(points), 5, dtype=np.int64)
    plain = points < 128
    out[plain] = _class_table()[points[plain]]
    return out


TAGS = 1 + 2 * len(KINDS)


def tags_of(length: int, spans: list[Span]):
    """Tag of each character: 0 outside, then a first and an inner tag per kind; earlier kinds win an overlap."""
    import numpy as np

    tags = np.zeros(length, dtype=np.int64)
    for kind, start, end in reversed(spans):
        number = 1 + 2 * KINDS.index(kind)
        tags[start] = number
        tags[start + 1 : end] = number + 1
    return tags


def spans_of(tags) -> list[Span]:
    spans, start, kind = [], 0, 0
    for place, tag in enumerate([*tags, 0]):
        if kind and tag != kind + 1:
            spans.append((KINDS[(kind - 1) // 2], start, place))
            kind = 0
        if tag % 2 == 1:
            start, kind = place, int(tag)
    return spans


def _transitions_allowed():
    """Inner tags follow the first or inner tag of their kind only."""
    import numpy as np

    allowed = np.ones((TAGS, TAGS), dtype=bool)
    for inner in range(2, TAGS, 2):
        allowed[:, inner] = False
        allowed[[inner - 1, inner], inner] = True
    return allowed


FORBIDDEN = -1e4


@dataclass
class Tagger:
    """Weights: character embeddings, one LSTM per direction, output layer and transitions."""

    embedding: object
    input: list
    recurrent: list
    bias: list
    output: object
    output_bias: object
    transitions: object

    def _run(self, classes, direction: int, keep: bool = False):
        """Hidden states of one direction for rows of classes, and what the way back needs."""
        import numpy as np

        rows, length = classes.shape
        table = self.embedding @ self.input[direction] + self.bias[direction]
        hidden = np.zeros((rows, HIDDEN), dtype=np.float32)
        cell = np.zeros((rows, HIDDEN), dtype=np.float32)
        states = np.zeros((length, rows, HIDDEN), dtype=np.float32)
        saved = []
        order = range(length) if direction == 0 else range(length - 1, -1, -1)
        for place in order:
            gates = table[classes[:, place]] + hidden @ self.recurrent[direction]
            opened = 1 / (1 + np.exp(-gates[:, : 3 * HIDDEN]))
            fresh = np.tanh(gates[:, 3 * HIDDEN :])
            into, forget, out = opened[:, :HIDDEN], opened[:, HIDDEN : 2 * HIDDEN], opened[:, 2 * HIDDEN :]
            before, previous = cell, hidden
            cell = forget * cell + into * fresh
            bent = np.tanh(cell)
            hidden = out * bent
            states[place] = hidden
            if keep:
                saved.append((place, into, forget, out, fresh, before, previous, bent))
        return states, saved

    def emissions(self, classes):
        """Scores of every tag for every character of each row."""
        import numpy as np

        both = np.concatenate([self._run(classes, 0)[0], self._run(classes, 1)[0]], axis=2)
        return (both @ self.output + self.output_bias).transpose(1, 0, 2)

    def best(self, emissions):
        """The best tag sequence over one stretch of characters."""
        import numpy as np

        score = emissions[0].copy()
        score[2::2] = FORBIDDEN
        back = np.zeros((len(emissions), TAGS), dtype=np.int8)
        for place in range(1, len(emissions)):
            options = score[:, None] + self.transitions
            back[place] = options.argmax(axis=0)
            score = options.max(axis=0) + emissions[place]
        tags = np.zeros(len(emissions), dtype=np.int64)
        tags[-1] = score.argmax()
        for place in range(len(emissions) - 1, 0, -1):
            tags[place - 1] = back[place][tags[place]]
        return tags


def _log_sum(values, axis: int):
    import numpy as np

    top = values.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(values - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _crf_gradients(emissions, tags, mask, transitions):
    """Loss gradients for emissions (place, row, tag) and transitions, by the forward and backward sums."""
    import numpy as np

    length, rows, _ = emissions.shape
    forward = np.zeros_like(emissions)
    forward[0] = emissions[0]
    for place in range(1, length):
        forward[place] = _log_sum(forward[place - 1][:, :, None] + transitions, 1) + emissions[place]
    backward = np.zeros_like(emissions)
    for place in range(length - 2, -1, -1):
        backward[place] = _log_sum(transitions + (emissions[place + 1] + backward[place + 1])[:, None, :], 2)
    total = _log_sum(forward[-1], 1)
    marginal = np.exp(forward + backward - total[:, None])
    by_emission = marginal.copy()
    by_transition = np.zeros_like(transitions)
    index = np.arange(rows)
    for place in range(length):
        by_emission[place, index, tags[:, place]] -= 1
        if place:
            pair = np.exp(
                forward[place - 1][:, :, None] + transitions + (emissions[place] + backward[place])[:, None, :] - total[:, None, None]
            )
            by_transition += pair.sum(axis=0)
            np.add.at(by_transition, (tags[:, place - 1], tags[:, place]), -1)
    return by_emission * mask.T[:, :, None], by_transition


def train_tagger(classes, tags) -> Tagger:
    """Fits a tagger to rows of character classes and tags, with Adagrad."""
    import numpy as np

    draw = np.random.default_rng(SEED)

    def weights(*shape):
        return draw.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

    bias = [np.zeros(4 * HIDDEN, dtype=np.float32) for _ in (0, 1)]
    for one in bias:
        one[HIDDEN : 2 * HIDDEN] = 1
    allowed = _transitions_allowed()
    tagger = Tagger(
        weights(_CLASSES, EMBEDDING), [weights(EMBEDDING, 4 * HIDDEN) for _ in (0, 1)], [weights(HIDDEN, 4 * HIDDEN) for _ in (0, 1)],
        bias, weights(2 * HIDDEN, TAGS), np.zeros(TAGS, dtype=np.float32),
        np.where(allowed, 0, FORBIDDEN).astype(np.float32),
    )
    parameters = [tagger.embedding, *tagger.input, *tagger.recurrent, *tagger.bias, tagger.output, tagger.output_bias, tagger.transitions]
    squares = [np.full_like(one, 1e-2) for one in parameters]
    order = np.arange(len(classes))
    batches = -(-len(order) // BATCH_WINDOWS)
    for _ in range(min(MOST_EPOCHS, -(-UPDATES // batches))):
        draw.shuffle(order)
        for at in range(0, len(order), BATCH_WINDOWS):
            own, wanted = classes[order[at : at + BATCH_WINDOWS]], tags[order[at : at + BATCH_WINDOWS]]
            runs = [tagger._run(own, direction, keep=True) for direction in (0, 1)]
            both = np.concatenate([runs[0][0], runs[1][0]], axis=2)
            emissions = both @ tagger.output + tagger.output_bias
            down, by_transition = _crf_gradients(emissions, wanted, (own > 0).astype(np.float32), tagger.transitions)
            down /= len(own)
            by_transition /= len(own)
            grad_output = np.einsum("prh,prt->ht", both, down)
            hidden_down = down @ tagger.output.T
            grad_embedding = np.zeros_like(tagger.embedding)
            grad_input, grad_recurrent, grad_bias = [], [], []
            for direction, (_, saved) in enumerate(runs):
                part = hidden_down[:, :, direction * HIDDEN : (direction + 1) * HIDDEN]
                table_grad = np.zeros((_CLASSES, 4 * HIDDEN), dtype=np.float32)
                recurrent_grad = np.zeros_like(tagger.recurrent[direction])
                carried = np.zeros((len(own), HIDDEN), dtype=np.float32)
                cell_down = np.zeros((len(own), HIDDEN), dtype=np.float32)
                for place, into, forget, out, fresh, before, previous, bent in reversed(saved):
                    total = part[place] + carried
                    cell_down = cell_down + total * out * (1 - bent * bent)
                    gates = np.concatenate(
                        [
                            cell_down * fresh * into * (1 - into), cell_down * before * forget * (1 - forget),
                            total * bent * out * (1 - out), cell_down * into * (1 - fresh * fresh),
                        ],
                        axis=1,
                    )
                    np.add.at(table_grad, own[:, place], gates)
                    recurrent_grad += previous.T @ gates
                    carried = gates @ tagger.recurrent[direction].T
                    cell_down = cell_down * forget
                grad_embedding += table_grad @ tagger.input[direction].T
                grad_input.append(tagger.embedding.T @ table_grad)
                grad_recurrent.append(recurrent_grad)
                grad_bias.append(table_grad.sum(axis=0))
            gradients = [grad_embedding, *grad_input, *grad_recurrent, *grad_bias, grad_output, down.sum(axis=(0, 1)), by_transition]
            for one, square, gradient in zip(parameters, squares, gradients):
                gradient = np.clip(gradient, -1, 1)
                square += gradient * gradient
                one -= STEP * gradient / np.sqrt(square)
            tagger.transitions[~allowed] = FORBIDDEN
    return tagger


def _rewritten(kind: str, found: str, turn: int) -> str:
    """A labelled span in a form that the patterns do not know."""
    digits = "".join(_DIGITS.findall(found))
    if kind == "email":
        return found.replace("@", " @ " if turn % 2 else "@ ")
    if kind == "phone":
        return f"({digits[1:4]}) {digits[4:7]}-{digits[7:]}" if turn % 2 else f"{digits[1:4]}-{digits[4:7]}-{digits[7:]}"
    if kind == "card":
        return ".".join(digits[k : k + 4] for k in range(0, len(digits), 4))
    return found


def training_windows(texts: Iterable[str]):
    """Classes and tags of windows around the places of interest in the texts, at most TRAINING_WINDOWS."""
    import numpy as np

    classes, tags = [], []
    turn = 0
    for text in texts:
        spans = base_spans(text)
        # Overlapping spans of several kinds are left to the patterns.
        shown, at = [], 0
        out = ""
        for kind, start, end in sorted(spans, key=lambda span: span[1]):
            if start < at:
                continue
            turn += 1
            new = _rewritten(kind, text[start:end], turn) if turn % REWRITTEN == 0 else text[start:end]
            out += text[at:start]
            shown.append((kind, len(out), len(out) + len(new)))
            out += new
            at = end
        out += text[at:]
        coded, wanted = char_classes(out), tags_of(len(out), shown)
        places = [(start + end) // 2 for _, start, end in shown]
        places += [match.start() for match in re.finditer("[0-9@]+", out)][:: 7]
        places += [len(out) // 2]
        for place in places:
            start = max(0, place - WINDOW // 2 + (place * 37) % 48 - 24)
            row, goal = np.zeros(WINDOW, dtype=np.int64), np.zeros(WINDOW, dtype=np.int64)
            piece = coded[start : start + WINDOW]
            row[: len(piece)] = piece
            goal[: len(piece)] = wanted[start : start + WINDOW]
            # What a window cuts at its left edge has no first tag there.
            if len(piece) and goal[0] and goal[0] % 2 == 0:
                goal[0] -= 1
            classes.append(row)
            tags.append(goal)
            if len(classes) >= TRAINING_WINDOWS:
                return np.stack(classes), np.stack(tags)
    if not classes:
        return np.zeros((0, WINDOW), dtype=np.int64), np.zeros((0, WINDOW), dtype=np.int64)
    return np.stack(classes), np.stack(tags)


def _train_on_batches(batches: Iterator) -> Tagger | None:
    classes, tags = training_windows(text.as_py() for batch in batches for text in batch.column(0))
    return train_tagger(classes, tags) if (tags > 0).any() else None


def train(docs: DataFrame, text: str = "text") -> Tagger | None:
    """A tagger, trained in one task, from documents that hold a digit or an at sign; None without spans."""
    interesting = docs.select(F.col(text).alias("text")).where(F.col("text").rlike("[0-9@]"))
    rows = hashed_sample(interesting, F.xxhash64("text"), TRAINING_DOCUMENTS)
    return made_in_one_task(rows, [F.xxhash64("text"), F.col("text")], _train_on_batches)


def _stretches(text: str) -> list[tuple[int, int]]:
    """Runs of grid windows that hold a trigger: first window and how many."""
    wanted = sorted({window for match in _TRIGGER.finditer(text) for window in (match.start() // STRIDE - 1, match.start() // STRIDE)})
    runs: list[list[int]] = []
    for window in wanted:
        if window < 0:
            continue
        if runs and window == runs[-1][0] + runs[-1][1]:
            runs[-1][1] += 1
        else:
            runs.append([window, 1])
    return [tuple(run) for run in runs]


def tagged_spans(tagger: Tagger, texts: list[str]) -> list[list[Span]]:
    """What the tagger finds in each text, from all windows together."""
    import numpy as np

    # A character counts more, the farther it is from a window's edges.
    weight = np.minimum(np.arange(WINDOW), np.arange(WINDOW)[::-1]).astype(np.float32)[:, None] + 1
    jobs, rows, coded = [], [], []
    for number, text in enumerate(texts):
        classes = char_classes(text)
        coded.append(classes)
        for first, count in _stretches(text):
            jobs.append((number, first, count, len(rows)))
            for window in range(first, first + count):
                row = np.zeros(WINDOW, dtype=np.int64)
                piece = classes[window * STRIDE : window * STRIDE + WINDOW]
                row[: len(piece)] = piece
                rows.append(row)
    found: list[list[Span]] = [[] for _ in texts]
    if not rows:
        return found
    stacked = np.stack(rows)
    emissions = np.concatenate([tagger.emissions(stacked[at : at + 512]) for at in range(0, len(stacked), 512)])
    for number, first, count, at in jobs:
        start = first * STRIDE
        length = min(len(coded[number]) - start, (count - 1) * STRIDE + WINDOW)
        total = np.zeros(((count - 1) * STRIDE + WINDOW, TAGS), dtype=np.float32)
        share = np.zeros((len(total), 1), dtype=np.float32)
        for step in range(count):
            total[step * STRIDE : step * STRIDE + WINDOW] += emissions[at + step] * weight
            share[step * STRIDE : step * STRIDE + WINDOW] += weight
        tags = tagger.best((total / share)[:length])
        found[number] += [(kind, start + a, start + b) for kind, a, b in spans_of(tags)]
    return found


def _trimmed(text: str, span: Span) -> Span:
    kind, start, end = span
    while start < end and text[start] in " \n\t,;:":
        start += 1
    while end > start and text[end - 1] in " \n\t,;:.":
        end -= 1
    return kind, start, end


def all_spans(texts: list[str], tagger: Tagger | None) -> list[tuple[list[Span], list[Span]]]:
    """Base and added spans of each text."""
    base = [base_spans(text) for text in texts]
    if tagger is None:
        return [(spans, []) for spans in base]
    wanted = [number for number, text in enumerate(texts) if _TRIGGER.search(text)]
    out = [(spans, []) for spans in base]
    for number, tagged in zip(wanted, tagged_spans(tagger, [texts[number] for number in wanted])):
        text, added = texts[number], []
        for span in tagged:
            kind, start, end = _trimmed(text, span)
            free = all(end <= a or start >= b for _, a, b in base[number])
            if free and start < end and fits(kind, text[start:end]):
                added.append((kind, start, end))
        out[number] = base[number], added
    return out


def _listed(spans: list[Span]) -> str:
    ordered = sorted(spans, key=lambda span: (KINDS.index(span[0]), span[1], span[2]))
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in ordered)


def _runs(texts) -> Iterator[tuple[int, int]]:
    """Runs of rows with about BATCH_BYTES of text each."""
    import pyarrow.compute as pc

    start = total = 0
    for position, size in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        total += size
        if total >= BATCH_BYTES:
            yield start, position + 1
            start, total = position + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _scanned(texts, tagger: Tagger | None) -> Iterator[tuple[int, str, list[Span], list[Span]]]:
    """Position, text, base and added spans of the texts of an Arrow array that have a digit or an at sign."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    for start, stop in _runs(texts):
        run = pc.fill_null(texts.slice(start, stop - start), "")
        places = np.flatnonzero(pc.match_substring_regex(run, "[0-9@]").to_numpy(zero_copy_only=False))
        values = run.take(pa.array(places, pa.int64())).to_pylist()
        for place, value, (base, added) in zip(places, values, all_spans(values, tagger)):
            yield start + int(place), value, base, added


def find_private(docs: DataFrame, tagger: Tagger | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, the base spans of each kind (``n_<kind>``), ``base_spans``, ``spans`` and ``n_added``.

    Spans are listed as ``kind:start:end``, by kind and then start, joined by commas; ``spans`` has base and added ones.
    """

    def work(batches):
        import pyarrow as pa

        names = ["doc_id", *[f"n_{kind}" for kind in KINDS], "base_spans", "spans", "n_added"]
        for batch in batches:
            counts = [[0] * len(batch) for _ in KINDS]
            listed, every, extra = [""] * len(batch), [""] * len(batch), [0] * len(batch)
            for place, _, base, added in _scanned(batch.column(1), tagger):
                for number, kind in enumerate(KINDS):
                    counts[number][place] = sum(span[0] == kind for span in base)
                listed[place], every[place], extra[place] = _listed(base), _listed([*base, *added]), len(added)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), *[pa.array(values, pa.int64()) for values in counts],
                    pa.array(listed, pa.string()), pa.array(every, pa.string()), pa.array(extra, pa.int64()),
                ],
                names=names,
            )

    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{one} bigint" for one in KINDS)
    return chosen.mapInArrow(work, f"doc_id {kind}, {counts}, base_spans string, spans string, n_added bigint")


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; of spans that overlap the first names the whole stretch."""
    out, at = [], 0
    stretches: list[list] = []
    for kind, start, end in sorted(spans, key=lambda span: (span[1], -span[2])):
        if stretches and start < stretches[-1][2]:
            stretches[-1][2] = max(stretches[-1][2], end)
        else:
            stretches.append([kind, start, end])
    for kind, start, end in stretches:
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def redactor(tagger: Tagger | None):
    """Column function: a text without its personal data; null stays null."""

    @F.arrow_udf("string")
    def redact(texts):
        import pyarrow as pa
        import pyarrow.compute as pc

        changed = {place: redacted(value, [*base, *added]) for place, value, base, added in _scanned(texts, tagger) if base or added}
        if not changed:
            return texts
        places = sorted(changed)
        mask = [False] * len(texts)
        for place in places:
            mask[place] = True
        return pc.replace_with_mask(texts, pa.array(mask), pa.array([changed[place] for place in places], texts.type))

    return redact
