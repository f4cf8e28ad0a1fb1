"""Patterns from a table, and log layouts from the files' own headers."""

import json
import random

import pytest
from pyspark.sql import functions as F

from skyledger.operators import events as ev
from skyledger.operators import logs, patterns

EVENT = "id string, source string, detail_type string, detail string"


def random_patterns(rng, count):
    words = ["alpha", "alp", "beta", "bet", "b", "gamma", "delta", "ALPHA", "é"]
    out = {}
    for n in range(count):
        paths = rng.sample(["source", "detail_type", "detail.a", "detail.b.c", "detail.b.d"], rng.randint(1, 4))
        out[f"rule-{n}"] = {
            p: [rng.choice([w, {"prefix": w}, {"prefix": w[:2]}]) for w in rng.sample(words, rng.randint(1, 3))] for p in paths
        }
    return out, words


def test_a_thousand_patterns_equal_one_predicate_each(spark):
    rng = random.Random(3)
    rules, words = random_patterns(rng, 1000)
    rows = []
    for i in range(120):
        detail = {"a": rng.choice(words), "b": {"c": rng.choice(words), "d": rng.choice([*words, None])}}
        text = rng.choice([json.dumps(detail), json.dumps(detail), json.dumps({"a": detail["a"]}), "no json", None])
        rows.append((f"e{i}", rng.choice([*words, None]), rng.choice(words), text))
    rows += rows[:5]
    events = spark.createDataFrame(rows, EVENT)
    routed = patterns.route_by_table(events, patterns.pattern_table(spark, rules))
    got = sorted((r.id, r.route) for r in routed.collect())
    want = []
    for i, source, kind, text in rows:
        try:
            detail = json.loads(text)
        except (TypeError, ValueError):
            detail = {}
        at = {"source": source, "detail_type": kind, "detail.a": detail.get("a"), "detail.b.c": detail.get("b", {}).get("c"), "detail.b.d": detail.get("b", {}).get("d")}
        for name, paths in rules.items():
            if all(at[p] is not None and any(at[p] == a if isinstance(a, str) else at[p].startswith(a["prefix"]) for a in accepted) for p, accepted in paths.items()):
                want.append((i, name))
    assert got == sorted(want) and len(got) > 100
    few = {k: rules[k] for k in list(rules)[:40]}
    one_each = sorted((r.id, r.route) for r in ev.route_events(events, few).collect())
    assert one_each == [x for x in got if x[1] in few]
    plan = routed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1 and plan.count("Join ") == 1


def test_pattern_tables_at_their_edges(spark):
    events = spark.createDataFrame([("1", "s", "t", '{"x":{"y":5},"z":[1]}'), ("2", "s", "t", '{"x":"text"}')], EVENT)

    def routes(rows):
        return sorted((r.id, r.route) for r in patterns.route_by_table(events, spark.createDataFrame(rows, patterns.CONDITIONS)).collect())

    assert routes([]) == []
    assert routes([("r", "source", None, False)]) == []
    # a path without an accepted value accepts nothing, whatever the others say
    assert routes([("r", "source", "s", False), ("r", "detail_type", None, False)]) == []
    assert routes([("r", "source", "s", False), ("r", "source", "s", False), ("r", "source", "", True)]) == [("1", "r"), ("2", "r")]
    # an unexpected type at one path leaves the others as they are
    assert routes([("n", "detail.x.y", "5", False), ("m", "detail.x", "text", False)]) == [("1", "n"), ("2", "m")]


def test_layouts_without_a_shuffle_of_the_log(spark):
    rows = [("a", "#Version: 1.0"), ("a", "#Fields: date  time c-ip"), ("b", "#Fields: c-ip date time"), ("c", "2024-01-01 00:00:00 9.9.9.9")]
    rows += [("a", f"2024-01-01 00:00:{i:02d} 1.1.1.{i}") for i in range(30)] + [("b", f"2.2.2.{i} 2024-01-02 00:00:01 more") for i in range(30)] + [("b", "3.3.3.3 2024-01-03")]
    log = spark.createDataFrame(rows, "path string, line string").repartition(4).cache()
    out = logs.parse_cdn_by_header(log)
    got = {(r.path, r.fields["c-ip"]) for r in out.collect()}
    assert got == {("a", f"1.1.1.{i}") for i in range(30)} | {("b", f"2.2.2.{i}") for i in range(30)} | {("b", "3.3.3.3")}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan.split("InMemoryTableScan")[0] and "BroadcastHashJoin" in plan
    assert logs.parse_cdn_by_header(log.where(~F.col("line").startswith("#"))).count() == 0


@pytest.mark.parametrize("limit", ["MAP_BYTES", "LAYOUTS"])
def test_layouts_beyond_the_bounds(spark, monkeypatch, limit):
    monkeypatch.setattr(logs, limit, 0)
    rows = [(p, f"#Fields: x{p} y{p}") for p in "abc"] + [(p, f"value-{p}-{i} other") for p in "abc" for i in range(3)]
    out = logs.parse_cdn_by_header(spark.createDataFrame(rows, "path string, line string"))
    assert sorted((r.path, r.fields[f"x{r.path}"]) for r in out.collect()) == [(p, f"value-{p}-{i}") for p in "abc" for i in range(3)]


def test_unexpected_types_cost_no_other_column(spark, tmp_path):
    from skyledger.sources import readers

    folder = tmp_path / "AWSLogs" / "CloudTrail"
    folder.mkdir(parents=True)
    sound = {"eventTime": "t1", "eventName": "A", "userIdentity": {"type": "IAMUser", "userName": "u"}, "sourceIPAddress": "1.1.1.1"}
    odd = {"eventTime": 5, "eventName": "B", "userIdentity": "root", "sourceIPAddress": None, "new": {"x": [1]}}
    (folder / "one.json").write_text(json.dumps({"Records": [sound, odd]}, indent=1))
    (folder / "two.json").write_text(json.dumps({"Records": "none"}))
    (folder / "three.json").write_text("{ no json")
    got = sorted((r.event_time, r.event_name, r.user_type, r.user_name, r.source_ip) for r in readers.read_audit_variant(spark, str(tmp_path)).drop("record").collect())
    assert got == [("5", "B", None, None, None), ("t1", "A", "IAMUser", "u", "1.1.1.1")]


def test_details_are_parsed_once(spark):
    events = spark.createDataFrame([("1", "a", "r", "2024-01-01T00:00:00Z", '{"status":"FAILED","executionArn":7,"userIdentity":"x","eventName":"CreateX"}')], "id string, account string, region string, time string, detail string")
    for step in (ev.workflow_failures, ev.distribution_changes, ev.database_changes):
        plan = step(events)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parseJson") == 1
    assert ev.workflow_failures(events).first().execution == "7"
    row = ev.distribution_changes(events).first()
    assert (row.operation, row.identity_type, row.domain_name) == ("created", None, "")
