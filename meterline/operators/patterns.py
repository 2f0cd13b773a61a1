"""Routing rules as documents: each names the fields of an event it looks at and what they may hold.

A pattern is a JSON object shaped like the event. Its innermost values are lists of alternatives, of which one must hold:
a text, number or boolean (the field has it), null (the field is absent or null), ``{"prefix": text}``,
``{"anything-but": [texts]}`` (present, and none of these) or ``{"exists": true or false}``. All fields must hold.

The rules are an index over one of their fields each: the value a rule needs there leads from an event to the rule. An
event is compared only with rules it meets in the index, however many there are; what they ask of other fields is verified
then. Rules that need no value anywhere are met by every event.

Field values are compared as text, so the number 5 and the text "5" are equal. A field that holds a list or an object has
its JSON text as value. A body that is no JSON matches nothing.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.config import FAILURE_STATES, GOLD_JOB, STAGE_EVENT_SOURCE, STAGE_EVENT_TYPE, SUCCESS_STATES

Path = tuple[str, ...]

# Rules of at most so many characters of JSON are broadcast; more are joined by a shuffle.
MOST_BROADCAST = 16_000_000

# The field number of rules that need no value anywhere.
_EVERY = -1
_CONDITION = "struct<field: int, values: array<string>, prefixes: array<string>, others: array<array<string>>, present: boolean, absent: boolean>"
_INDEX = f"rule_field int, rule_value string, rule string, conditions array<{_CONDITION}>"

_STAGE = {"source": [STAGE_EVENT_SOURCE], "detail-type": [STAGE_EVENT_TYPE]}
STAGE_PATTERNS = {
    "success": {**_STAGE, "detail": {"state": list(SUCCESS_STATES)}},
    "failure": {**_STAGE, "detail": {"state": list(FAILURE_STATES)}},
    "complete": {**_STAGE, "detail": {"jobName": [GOLD_JOB], "state": list(SUCCESS_STATES)}},
}


class BadPattern(ValueError):
    """A rule's document is no pattern."""


@dataclass
class _Condition:
    """What one field of an event must hold: any of these."""

    path: Path
    values: list[str] = field(default_factory=list)
    prefixes: list[str] = field(default_factory=list)
    others: list[list[str]] = field(default_factory=list)
    present: bool = False
    absent: bool = False

    def needs_value(self) -> bool:
        return bool(self.values) and not (self.prefixes or self.others or self.present or self.absent)


def _as_text(value: object) -> str:
    """A JSON scalar the way an event's field is compared."""
    return value if isinstance(value, str) else json.dumps(value)


def _add_alternative(condition: _Condition, rule: str, wanted: object) -> None:
    match wanted:
        case None:
            condition.absent = True
        case str() | bool() | int() | float():
            condition.values.append(_as_text(wanted))
        case {"prefix": str(start), **rest} if not rest:
            condition.prefixes.append(start)
        case {"exists": bool(exists), **rest} if not rest:
            condition.present |= exists
            condition.absent |= not exists
        case {"anything-but": refused, **rest} if not rest and not isinstance(refused, dict):
            refused = refused if isinstance(refused, list) else [refused]
            condition.others.append([_as_text(value) for value in refused])
        case _:
            raise BadPattern(f"{rule}: {'.'.join(condition.path)} cannot be compared with {wanted!r}")


def _conditions(rule: str, pattern: object, path: Path = ()) -> Iterator[_Condition]:
    if isinstance(pattern, dict) and pattern:
        for name, inner in pattern.items():
            yield from _conditions(rule, inner, (*path, name))
    elif isinstance(pattern, list) and pattern and path:
        condition = _Condition(path)
        for wanted in pattern:
            _add_alternative(condition, rule, wanted)
        yield condition
    else:
        raise BadPattern(f"{rule}: {'.'.join(path) or 'the pattern'} must be an object or a list of alternatives, and not empty")


def _json_path(path: Path) -> str:
    if any('"' in name and "'" in name for name in path):
        raise BadPattern(f"{'.'.join(path)}: a field name with both kinds of quotes")
    return "$" + "".join(f"['{name}']" if '"' in name else f'["{name}"]' for name in path)


@dataclass(frozen=True)
class Rules:
    """Compiled patterns: the fields they look at, and the index of the rules as rows."""

    paths: tuple[Path, ...]
    rows: tuple[tuple, ...]
    characters: int

    @classmethod
    def compiled(cls, patterns: Mapping[str, Mapping | str]) -> Rules:
        """From documents by rule name, as objects or JSON text."""
        documents = {rule: json.loads(text) if isinstance(text, str) else text for rule, text in patterns.items()}
        by_rule = {rule: list(_conditions(rule, document)) for rule, document in documents.items()}
        paths = tuple(dict.fromkeys(condition.path for conditions in by_rule.values() for condition in conditions))
        places = {path: place for place, path in enumerate(paths)}
        # A rule is found by the field whose values fewest rules share.
        shared = Counter(
            (condition.path, value) for conditions in by_rule.values() for condition in conditions for value in set(condition.values)
        )
        rows = []
        for rule, conditions in by_rule.items():
            stored = [
                (places[one.path], one.values, one.prefixes, one.others, one.present, one.absent) for one in conditions
            ]
            exact = [one for one in conditions if one.needs_value()]
            if not exact:
                rows.append((_EVERY, "", rule, stored))
                continue
            anchor = min(exact, key=lambda one: sum(shared[one.path, value] for value in set(one.values)))
            rows.extend((places[anchor.path], value, rule, stored) for value in dict.fromkeys(anchor.values))
        return cls(paths, tuple(rows), sum(len(json.dumps(row)) for row in rows))

    def index(self, spark: SparkSession) -> DataFrame:
        rules = spark.createDataFrame(list(self.rows), _INDEX)
        return F.broadcast(rules) if self.characters <= MOST_BROADCAST else rules


def _holds(condition: Column, values: Column) -> Column:
    """Whether the event's field holds one of the condition's alternatives."""
    value = F.get(values, condition["field"])
    found = (
        F.array_contains(condition["values"], value)
        | F.exists(condition["prefixes"], lambda start: F.startswith(value, start))
        | F.exists(condition["others"], lambda refused: ~F.array_contains(refused, value))
        | condition["present"]
    )
    return F.when(value.isNull(), condition["absent"]).otherwise(found)


def route_by_patterns(events: DataFrame, patterns: Mapping[str, Mapping | str], body: str = "body") -> DataFrame:
    """One row per event and rule whose pattern it matches, with the name in ``rule``; nothing is shuffled.

    Each body is parsed once. An event meets a rule at one value of one field, so no pair comes twice. Without rules
    there are no rows. Works on streams. Columns named ``rule`` and those that start with ``rule_`` are taken.
    """
    rules = Rules.compiled(patterns)
    taken = [name for name in events.columns if name == "rule" or name.startswith("rule_")]
    if taken:
        raise ValueError(f"columns {taken} of the events would be hidden")
    carried = events.columns
    parsed = events.withColumn("rule_body", F.try_parse_json(body))
    read = [F.try_variant_get("rule_body", _json_path(path), "string") for path in rules.paths]
    values = F.array(*read) if read else F.array().cast("array<string>")
    # The event's values are rows of the index before anything else looks at the parsed body, so it is parsed once.
    opened = parsed.select(*[F.col(f"`{name}`") for name in carried], F.when(F.col("rule_body").isNotNull(), values).alias("rule_values"))
    at = {_EVERY: F.when(F.col("rule_values").isNotNull(), F.lit(""))}
    indexed = sorted({row[0] for row in rules.rows}) or [_EVERY]
    entries = [
        F.struct(F.lit(place).alias("rule_field"), at.get(place, F.get("rule_values", F.lit(place))).alias("rule_value"))
        for place in indexed
    ]
    met = opened.select("*", F.inline(F.array(*entries))).join(rules.index(events.sparkSession), ["rule_field", "rule_value"])
    matched = met.where(F.forall("conditions", lambda condition: _holds(condition, F.col("rule_values"))))
    return matched.select(*[F.col(f"`{name}`") for name in carried], "rule")
