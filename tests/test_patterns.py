from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from meterline.checks.queries import run_events
from meterline.operators import patterns, routing
from meterline.operators.patterns import STAGE_PATTERNS, BadPattern, route_by_patterns


def _routed(spark, bodies, rules):
    events = spark.createDataFrame(list(enumerate(bodies)), "id int, body string")
    return sorted(tuple(row) for row in route_by_patterns(events, rules).select("id", "rule").collect())


def test_the_stage_rules_as_documents_route_as_the_fixed_ones(spark, sf_dir):
    events = run_events(spark, sf_dir)
    fixed = routing.route_events(routing.open_events(events)).select("event_id", "rule")
    found = route_by_patterns(events, {name: json.dumps(one) for name, one in STAGE_PATTERNS.items()}).select("event_id", "rule")
    assert sorted(found.collect()) == sorted(fixed.collect()) != []


@pytest.mark.parametrize(
    ("alternatives", "matching"),
    [
        (["x"], {"x"}),
        (["x", "y", "x"], {"x", "y"}),
        ([5], {"5"}),
        ([True], {"true"}),
        ([None], {"null", "absent"}),
        ([{"exists": False}], {"null", "absent"}),
        ([{"exists": True}], {"x", "xy", "y", "5", "true", "empty"}),
        ([{"prefix": "x"}], {"x", "xy"}),
        ([{"anything-but": ["x", 5]}], {"xy", "y", "true", "empty"}),
        ([{"anything-but": "x"}, "x"], {"x", "xy", "y", "5", "true", "empty"}),
        ([{"prefix": "xy"}, "y", None], {"xy", "y", "null", "absent"}),
        ([""], {"empty"}),
    ],
)
def test_alternatives(spark, alternatives, matching):
    values = {"x": "x", "xy": "xy", "y": "y", "5": 5, "true": True, "null": None, "empty": ""}
    bodies = {name: json.dumps({"a": {"b-c": value}, "more": 1}) for name, value in values.items()}
    bodies["absent"] = json.dumps({"a": "text"})
    found = _routed(spark, bodies.values(), {"r": {"a": {"b-c": alternatives}}})
    assert {list(bodies)[number] for number, _ in found} == matching and len(found) == len(matching)


def test_bodies_that_are_no_json_match_nothing(spark):
    rules = {"needs": {"a": ["x"]}, "lacks": {"a": [None]}}
    assert _routed(spark, [None, "", "{", '{"a": "x"}', "{}", "[1]"], rules) == [(3, "needs"), (4, "lacks"), (5, "lacks")]
    assert _routed(spark, ['{"a": "x"}'], {}) == []


@pytest.mark.parametrize("pattern", [{}, [], {"a": []}, {"a": {}}, {"a": "x"}, {"a": [["x"]]}, {"a": [{"other": 1}]}, {"a": [{"prefix": "x", "exists": True}]}])
def test_what_is_no_pattern_is_refused(spark, pattern):
    with pytest.raises(BadPattern):
        patterns.Rules.compiled({"r": pattern})


def test_field_names_are_taken_as_they_are(spark):
    body = json.dumps({"a.b": "1", "a": {"b": "2", "it's": "3", 'say "x"': "4"}})
    rules = {"dotted": {"a.b": ["1"]}, "nested": {"a": {"b": ["2"]}}, "quote": {"a": {"it's": ["3"]}}, "double": {"a": {'say "x"': ["4"]}}, "no": {"a.b": ["2"]}}
    assert [rule for _, rule in _routed(spark, [body], rules)] == ["dotted", "double", "nested", "quote"]


def _plain(event, pattern):
    """A pattern against an event, by its definition."""
    if isinstance(pattern, dict):
        return all(_plain(event.get(name) if isinstance(event, dict) else None, inner) for name, inner in pattern.items())

    def one(wanted):
        if wanted is None:
            return event is None
        if not isinstance(wanted, dict):
            return event == wanted
        (kind, of), = wanted.items()
        if kind == "exists":
            return (event is not None) == of
        return event is not None and (event.startswith(of) if kind == "prefix" else event not in of)

    return any(one(wanted) for wanted in pattern)


def test_many_rules_against_a_plain_version_in_either_join(spark, monkeypatch):
    draw = random.Random(3)
    word = lambda: draw.choice("abcd") + draw.choice(["", "1", "2"])

    def alternatives():
        kinds = [word, word, word, lambda: None, lambda: {"prefix": draw.choice("abcd")}, lambda: {"anything-but": [word(), word()]}, lambda: {"exists": draw.random() < 0.5}]
        return [draw.choice(kinds)() for _ in range(draw.randint(1, 3))]

    def rule():
        chosen = {name: alternatives() for name in draw.sample("pqr", draw.randint(1, 3))}
        return {**chosen, "in": {"s": alternatives()}} if draw.random() < 0.5 else chosen

    events = [{**{name: word() for name in "pqr" if draw.random() < 0.8}, "in": {"s": word()} if draw.random() < 0.8 else {}} for _ in range(60)]
    rules = {f"r{number}": rule() for number in range(300)}
    expected = sorted((number, name) for number, event in enumerate(events) for name, one in rules.items() if _plain(event, one))
    assert _routed(spark, map(json.dumps, events), rules) == expected
    monkeypatch.setattr(patterns, "MOST_BROADCAST", 0)
    assert _routed(spark, map(json.dumps, events), rules) == expected


def test_a_thousand_rules_take_one_scan_one_parse_and_no_shuffle(spark, sf_dir, tmp_path):
    run_events(spark, sf_dir).write.parquet(str(tmp_path / "events"))
    rules = {f"r{number}": {"detail": {"jobRunId": [str(number)], "state": ["FAILED"]}} for number in range(1000)}
    routed = route_by_patterns(spark.read.parquet(str(tmp_path / "events")), rules)
    plan = routed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("parseJson") == 1
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    # Each event meets the one rule of its run, not all rules with its state.
    assert {row[0] for row in patterns.Rules.compiled(rules).rows} == {0}


def test_columns_of_the_events_are_kept_and_not_hidden(spark):
    events = spark.createDataFrame([(1, '{"a": "x"}', "kept")], "id int, body string, `odd.name` string")
    assert route_by_patterns(events, {"r": {"a": ["x"]}}).columns == ["id", "body", "odd.name", "rule"]
    with pytest.raises(ValueError):
        route_by_patterns(events.withColumn("rule", F.lit(1)), {"r": {"a": ["x"]}})


def test_rules_on_a_stream(spark, sf_dir, tmp_path):
    from meterline.streaming.landing import run_available, to_table

    events = run_events(spark, sf_dir)
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    run_available(to_table(route_by_patterns(stream, STAGE_PATTERNS).select("event_id", "rule"), str(tmp_path / "out"), str(tmp_path / "p")))
    expected = route_by_patterns(events, STAGE_PATTERNS).select("event_id", "rule").collect()
    assert sorted(spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(expected)
