"""Document quality by weak supervision: rules vote or abstain, and what their votes are worth is estimated.

Each rule says good, bad or nothing about a document. A document's votes are one of a bounded number of patterns, and
only the patterns are counted (three to the power of the number of rules at most). Expectation-maximisation on those
counts estimates how often each rule is right and what share of documents is good; a document is kept if the
probability that it is good, given its votes, is at least one half and the two fixed base checks hold.

Everything is built-in functions; the loop of the estimation runs over the patterns only.

Words are runs of characters other than U+0020 and U+0009 to U+000D. A null text counts as an empty one, has no word and
fails the base checks. Texts of any length are taken whole. Rows may repeat; each is judged on its own, and an empty
table gives an empty result. Columns of any name may come along and are not passed on, the id excepted.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterline.llm.exact_copies import normalised
from meterline.llm.storage import stored

# Signs that count as symbols, and the base checks.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50

GOOD, BAD, SILENT = "g", "b", "-"

ROUNDS = 50
# Before any vote is counted: how often a rule that votes calls good and bad documents bad, and the weight of that in
# times the number of documents. Rules are written to spare good documents, and a bad one is bad in one way, so most rules find
# nothing wrong with it; the first is believed far more firmly than the second.
PRIOR = (0.004, 0.4)
PRIOR_WEIGHTS = (5.0, 0.05)
LEAST_SHARE, MOST_SHARE = 0.05, 0.95


def _without(text: Column, characters: str) -> Column:
    for character in characters:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def measures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and the counts that base checks and rules read."""
    taken = docs.select(F.col(doc_id).alias("doc_id"), _text(text).alias("text"))
    words = taken.select(
        "*",
        F.filter(F.split("text", "[ \t\n\x0b\x0c\r]+"), lambda word: word != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike("[^ \t\n\x0b\x0c\r]")).alias("lines"),
    )
    counted = words.select(
        "doc_id",
        F.size("words").cast("bigint").alias("n_words"),
        F.length(normalised(F.col("text"))).cast("bigint").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("bigint").alias("n_symbols"),
        (F.length("text") - F.length(_without(F.col("text"), "!"))).cast("bigint").alias("n_marks"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.size("lines").cast("bigint").alias("n_lines"),
        F.transform("words", lambda word: F.xxhash64(word)).alias("hashes"),
    )
    # Hashes of three words each; every array is a column of its own, so none is worked out more than once.
    size = F.size("hashes")
    threes = counted.select(
        "*",
        F.size(F.array_distinct("hashes")).cast("bigint").alias("n_distinct_words"),
        F.when(
            size >= 3,
            F.zip_with(
                F.zip_with(F.slice("hashes", 1, size - 2), F.slice("hashes", 2, size - 2), lambda a, b: F.xxhash64(a, b)),
                F.slice("hashes", 3, size - 2),
                lambda ab, c: F.xxhash64(ab, c),
            ),
        ).alias("threes"),
    ).drop("hashes")
    repeats = threes.select(
        "*",
        F.when(
            F.size(F.array_distinct("threes")) < F.size("threes"),
            F.sort_array(F.transform("threes", lambda key, place: F.struct(key.alias("key"), place.alias("place")))),
        ).alias("ordered"),
    ).drop("threes")
    last = F.size("ordered") - 1
    same = repeats.select(
        "*",
        F.when(
            F.col("ordered").isNotNull(),
            F.zip_with(F.slice("ordered", 1, last), F.slice("ordered", 2, last), lambda a, b: a["key"] == b["key"]),
        ).alias("as_next"),
    )
    no = F.array(F.lit(False))
    places = same.select(
        "*",
        F.sort_array(
            F.filter(
                F.zip_with(
                    "ordered",
                    F.zip_with(F.concat(no, F.col("as_next")), F.concat(F.col("as_next"), no), lambda a, b: a | b),
                    lambda one, repeated: F.when(repeated, one["place"]),
                ),
                lambda place: place.isNotNull(),
            )
        ).alias("places"),
    ).drop("ordered", "as_next")
    steps = F.size("places") - 1
    # A repeated window covers its three words, less what the next one covers as well.
    covered = F.aggregate(
        F.zip_with(F.slice("places", 1, steps), F.slice("places", 2, steps), lambda a, b: F.least(b - a, F.lit(3))),
        F.lit(3), lambda total, step: total + step,
    )
    return places.withColumn(
        "n_repeat_words", F.when(F.col("places").isNull(), 0).otherwise(covered).cast("bigint")
    ).drop("places")


def rules() -> dict[str, Column]:
    """The vote of each rule; a document with too few words to tell gets none."""
    n_words, word_chars = F.col("n_words"), F.col("word_chars")

    def vote(can_tell: Column, bad: Column) -> Column:
        return F.when((n_words >= 5) & can_tell, F.when(bad, BAD).otherwise(GOOD)).otherwise(SILENT)

    signs = F.col("n_symbols") + F.col("n_marks")
    different = F.col("n_distinct_words").cast("double") / F.sqrt(n_words.cast("double"))
    return {
        "signs": vote(F.lit(True), signs * 4 > n_words),
        "lines": vote(F.col("n_lines") >= 3, F.col("n_dup_lines") * 3 > F.col("n_lines")),
        "repeats": vote(F.lit(True), F.col("n_repeat_words") * 5 > 2 * n_words),
        "variety": vote(n_words >= 50, different < 2),
        "word_length": vote(F.lit(True), (word_chars < 2 * n_words) | (word_chars > 15 * n_words)),
    }


@dataclass(frozen=True)
class Estimate:
    """For each rule how often it calls good and bad documents bad, when it votes; and the share of good ones."""

    calls_bad: dict[str, tuple[float, float]]
    share: float

    def weight(self, name: str, vote: str) -> float:
        """What a vote adds to the log odds that a document is good; a silent rule adds nothing."""
        of_good, of_bad = self.calls_bad[name]
        if vote == SILENT:
            return 0.0
        return math.log(of_good / of_bad) if vote == BAD else math.log((1 - of_good) / (1 - of_bad))

    def log_odds(self) -> float:
        return math.log(self.share / (1 - self.share))

    def posterior(self, pattern: str) -> float:
        """Probability that a document with these votes, one letter per rule, is good."""
        odds = self.log_odds() + sum(self.weight(name, vote) for name, vote in zip(self.calls_bad, pattern))
        return 1 / (1 + math.exp(-odds))


def estimate(patterns: dict[str, int], names: list[str]) -> Estimate:
    """Expectation-maximisation over counted vote patterns. It starts from documents without a bad vote as good ones."""
    total = sum(patterns.values())
    good = {pattern: 0.1 if BAD in pattern else 0.9 for pattern in patterns}
    found = Estimate(dict.fromkeys(names, PRIOR), 0.5)
    for _ in range(ROUNDS if total else 0):
        # Bad votes and all votes, of good and of bad documents.
        seen = {name: [[rate * weight * total, weight * total] for rate, weight in zip(PRIOR, PRIOR_WEIGHTS)] for name in names}
        for pattern, count in sorted(patterns.items()):
            for name, vote in zip(names, pattern):
                if vote != SILENT:
                    for kind, part in enumerate((good[pattern], 1 - good[pattern])):
                        seen[name][kind][0] += count * part * (vote == BAD)
                        seen[name][kind][1] += count * part
        share = (sum(good[pattern] * count for pattern, count in sorted(patterns.items())) + 0.5) / (total + 1)
        found = Estimate(
            {name: tuple(bad / votes for bad, votes in both) for name, both in seen.items()}, min(max(share, LEAST_SHARE), MOST_SHARE)
        )
        good = {pattern: found.posterior(pattern) for pattern in patterns}
    return found


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts, ``base_failed``, ``quality`` (the probability that a document is good) and ``kept`` per document."""
    votes = rules()
    names = list(votes)
    measured = stored(
        measures(docs, doc_id, text).withColumn("votes", F.concat(*[votes[name] for name in names])), "quality-measures"
    )
    # At most three to the power of the number of rules.
    patterns = {row["votes"]: row["count"] for row in measured.groupBy("votes").count().collect()}
    found = estimate(patterns, names)
    logit = F.lit(found.log_odds())
    for place, name in enumerate(names, 1):
        vote = F.substring("votes", place, 1)
        logit = logit + F.when(vote == GOOD, found.weight(name, GOOD)).when(vote == BAD, found.weight(name, BAD)).otherwise(0.0)
    n_words = F.col("n_words")
    failed = (n_words < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * n_words)
    return (
        measured.withColumn("quality", 1 / (1 + F.exp(-logit)))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))
    )
