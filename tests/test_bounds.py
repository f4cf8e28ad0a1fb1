"""What a task, the driver and a shuffle take stays bounded as tables grow."""

from __future__ import annotations

import glob
import os

import pytest
from pyspark.sql import functions as F

from skyledger import session
from skyledger.operators import alarms as al
from skyledger.operators import allocation, keyed
from skyledger.plans import bindings as b
from skyledger.sources import clustered


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_shuffle_partitions_join_up_to_a_split(spark):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64MB")
    session.prepare(spark)
    assert int(spark.conf.get(key)) == session.SPLIT_BYTES
    spark.conf.set(key, "1MB")
    session.prepare(spark)
    assert spark.conf.get(key) == "1MB"  # a smaller one is the user's
    spark.conf.set(key, before)


def test_shuffle_partitions_follow_the_table(spark, tmp_path):
    before = spark.conf.get(session.INITIAL, None)
    try:
        (tmp_path / "part").write_bytes(b"x" * (9 * session.PARTITION_BYTES + 1))
        session.partition_for(spark, str(tmp_path))
        assert spark.conf.get(session.INITIAL) == "10"
        (tmp_path / "part").write_bytes(b"x")
        session.partition_for(spark, str(tmp_path))
        assert spark.conf.get(session.INITIAL) == "10"
    finally:
        spark.conf.unset(session.INITIAL)
        if before:
            spark.conf.set(session.INITIAL, before)


def test_alarms_are_never_broadcast(spark):
    alarms = spark.createDataFrame(
        [("a", "r", 60, ["m"], ["Sum"], "m1")], "alarm_name string, resource_id string, period int, metrics array<string>, statistics array<string>, expression string"
    )
    samples = spark.createDataFrame([("r", "m", 30, 1.0), ("r", "m", 40, 2.0)], "resource_id string, metric string, epoch long, value double")
    points = al.alarm_points(samples, alarms)
    assert "Broadcast" not in _plan(points)
    assert [tuple(r) for r in points.select("alarm_name", "period_start", "value").collect()] == [("a", 0, 3.0)]


NUMBERS = [*allocation.CAPACITY, *allocation.SCALED]


def _cost(spark, rows):
    """Cost lines of (resource_id, charge_type, usage_type, project, amount, eks_cluster_name)."""
    fixed = {"year": "2024", "month": "7", "usage_account": "1", "region": "r"}
    df = spark.createDataFrame(rows, "resource_id string, charge_type string, usage_type string, project string, amount double, eks_cluster_name string")
    for c in allocation.COST_DIMENSIONS:
        if c not in df.columns:
            df = df.withColumn(c, F.lit("2024-07-01").cast("date") if c == "date" else F.lit(fixed.get(c, "")))
    # stored, so that the optimizer does not fold the constants into the join
    return session.cut_lineage(df.select("*", *[F.col("amount").alias(c) for c in NUMBERS]).drop("amount"))


@pytest.fixture(scope="module")
def lines(spark):
    return _cost(
        spark,
        [("i", "Usage", "BoxUsage", "p", 1.0, "c1"), ("i", "Usage", "BoxUsage", "p", 2.0, "c2"), ("i", "Usage", "BoxUsage", None, 4.0, ""), ("i", "Usage", "BoxUsage", "", 8.0, ""),
         ("i", "Usage", "DataTransfer", "p", 16.0, ""), ("", "Usage", "BoxUsage", "p", 32.0, ""), (None, "Usage", "BoxUsage", "p", 64.0, ""), ("j", "Usage", "BoxUsage", "p", 128.0, ""), ("i", "Fee", "x", "p", 256.0, "")],
    )


@pytest.fixture(scope="module")
def usage(spark):
    row = ("2024", "7", "1", "r", "i")
    df = spark.createDataFrame([row, row], "year string, month string, usage_account string, region string, instance string")
    return session.cut_lineage(df.withColumn("date", F.lit("2024-07-01").cast("date")))


@pytest.mark.parametrize("transfer", [True, False])
def test_lines_are_summed_and_flagged_behind_one_exchange(spark, lines, usage, transfer):
    columns = ["resource_id", "charge_type", "usage_type", "project", "billing_cost", "eks_flag"]
    now = allocation.flagged_cost(lines, usage, transfer)
    then = allocation.flag_lines(allocation.cost_lines(lines), usage, transfer)
    assert sorted(map(tuple, now.select(*columns).collect())) == sorted(map(tuple, then.select(*columns).collect()))
    assert now.count() == 8  # NULL and '' stay lines of their own
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = [x for x in _plan(allocation.flagged_cost(lines, usage, transfer)).splitlines() if "Exchange hashpartitioning" in x]
        old = [x for x in _plan(allocation.flag_lines(allocation.cost_lines(lines), usage, transfer)).splitlines() if "Exchange hashpartitioning" in x]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(wide) < len(old)


def _metrics(spark, rows):
    """Pods of (date, instance, resource_id, namespace, cpu, network), two samples of each."""
    df = spark.createDataFrame(rows + rows, "date string, instance string, resource_id string, eks_namespace string, actual_cpu double, network_in double")
    fixed = {"year": "2024", "month": "7", "usage_account": "1", "region": "r", "eks_cluster_name": "c", "eks_app": "a"}
    return session.cut_lineage(df.withColumns({k: F.lit(v) for k, v in fixed.items()}).withColumns({"actual_mem": F.col("actual_cpu"), "network_out": F.lit(0.0)}))


@pytest.fixture(scope="module")
def pods(spark):
    day = "2024-07-01"
    return _metrics(
        spark,
        [(day, "i", "p1", "n", 1.0, 1.0), (day, "i", "p2", "n", 2.0, 3.0), (day, "i", "p2", None, 4.0, 0.0), (day, "i", "p2", "", 8.0, 0.0), (day, "k", "p3", "n", 1.0, 0.0),
         (day, None, "p4", "n", 1.0, 1.0), (day, "", "p5", "n", 1.0, 1.0), (None, "i", "p6", "n", 1.0, 1.0)],
    )


@pytest.fixture(scope="module")
def stored_lines(spark, lines, tmp_path_factory):
    placed = allocation.placed_lines(lines, 3)
    dims = [*allocation.COST_DIMENSIONS, "eks_cluster_name", allocation.PLACED]
    summed = keyed.blank_strings(placed.groupBy(*dims).agg(*[F.sum(c).alias(c) for c in NUMBERS]))
    return clustered.store_placed(summed, "bounds_placed_lines", str(tmp_path_factory.mktemp("placed") / "t"), allocation.PLACED_BY, 3)


def _rounded(df):
    return sorted(tuple("" if v is None else round(v, 6) if isinstance(v, float) else str(v) for v in r) for r in df.collect())


@pytest.mark.parametrize("cut", [False, True])
@pytest.mark.parametrize("level", [allocation.allocate_compute, allocation.allocate_compute_and_transfer, allocation.allocate_with_residual])
def test_stored_lines_are_allocated_where_they_lie(spark, lines, stored_lines, pods, level, cut, monkeypatch):
    if cut:
        monkeypatch.setattr(allocation, "PART_WORKLOADS", 1)
    # as they are stored, NULL and '' are one
    plain = keyed.blank_strings(lines)
    now = level(pods, stored_lines)
    assert _rounded(now) == _rounded(level(pods, plain))
    for c in allocation.COSTS:
        assert now.agg(F.sum(c)).first()[0] == pytest.approx(511.0)
    if not cut:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            text = _plan(level(pods, stored_lines))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert text.count("Exchange hashpartitioning") == 1  # that of the shares


def test_usage_is_summed_and_shared_behind_one_exchange(spark, lines, pods, monkeypatch):
    monkeypatch.setattr(allocation, "heavy_keys", lambda df, keys: keyed.HeavyKeys())
    shares, billed = allocation.usage_shares(pods), allocation.billed_shares(pods, lines)
    usage, none = allocation.measured_usage(pods)
    assert not none and _plan(shares).count("Exchange hashpartitioning") == 1
    assert _plan(billed).count("Exchange hashpartitioning") == 2  # billed capacity is summed before
    assert _rounded(usage) == _rounded(allocation.workload_usage(pods))
    assert _rounded(shares) == _rounded(allocation.relative_shares(allocation.workload_usage(pods)))
    assert _rounded(billed) == _rounded(allocation.capacity_shares(allocation.workload_usage(pods), lines))
    assert usage.where("instance = 'i' AND date IS NOT NULL").count() == 4  # NULL and '' stay workloads of their own
    monkeypatch.undo()
    monkeypatch.setattr(allocation, "heavy_keys", lambda df, keys: keyed.heavy_keys(df, keys, 8))
    usage, heavy = allocation.measured_usage(pods)
    assert heavy and _rounded(allocation.usage_shares(pods)) == _rounded(shares)
    assert _rounded(allocation.billed_shares(pods, lines)) == _rounded(billed)


def test_stored_steps_leave_no_shuffles(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles
    shuffles = lambda: sum(f.startswith("shuffle_") for f in (files().apply(i).getName() for i in range(files().size())))
    before = shuffles()
    stored = session.cut_lineage(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count())
    assert shuffles() <= before and stored.count() == 7
    session.forget(stored)
    assert not glob.glob(stored.inputFiles()[0].removeprefix("file://"))


def test_line_items_are_moved_once_before_they_are_summed(spark, sf, monkeypatch):
    moved = lambda: sum("l_partkey" in x for x in _plan(b.billing_lines(spark, sf)).splitlines() if "Exchange hashpartitioning" in x)
    rows = b.billing_lines(spark, sf).agg(F.count(F.lit(1)), F.sum("line_item_unblended_cost").cast("long")).first()
    monkeypatch.setattr(b, "TASK_LINES", 1000)
    assert moved() == 1  # dealt, for few parts are broadcast
    monkeypatch.setattr(b, "BROADCAST_PARTS", 1)
    assert moved() == 1 and "SortMergeJoin" in _plan(b.billing_lines(spark, sf))
    assert b.billing_lines(spark, sf).agg(F.count(F.lit(1)), F.sum("line_item_unblended_cost").cast("long")).first() == rows


def test_landed_events_are_packed(spark, tmp_path):
    text = spark.range(30, numPartitions=1).select(F.concat(F.lit("line "), F.col("id").cast("string")).alias("line"))
    back = b.landed_lines(spark, str(tmp_path), "packed-lines", text, packed=True)
    assert sorted(r["line"] for r in back.select("line").collect()) == sorted(f"line {i}" for i in range(30))
    path = b._LANDED[(spark.sparkContext.applicationId, str(tmp_path), "packed-lines")]
    assert all(f.endswith(".gz") for f in glob.glob(os.path.join(path.removeprefix("file:"), "part-*")))


def test_events_are_dealt_to_bounded_tasks(spark, tmp_path, monkeypatch):
    spark.range(100).withColumnRenamed("id", "event_id").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    monkeypatch.setattr(b, "TASK_EVENTS", 30)
    events = b.table(spark, str(tmp_path), "events")
    dealt = b.dealt_events(spark, str(tmp_path), events)
    assert dealt.rdd.getNumPartitions() == 4 and dealt.count() == 100


def test_sample_store_groups_labels_as_they_are(spark):
    from skyledger.plans.metric_queries import _first_of_second

    rows = [("m", {"a": "1", "b": 'x"y'}, 5, 1.0), ("m", {"a": "1", "b": 'x"y'}, 5, 3.0), ("m", {"a": "1", "b": None}, 5, 2.0), ("m", {}, 5, None), ("m", None, 5, 4.0)]
    out = _first_of_second(spark.createDataFrame(rows, "metric string, labels map<string,string>, epoch long, value double"))
    text = out._jdf.queryExecution().toString()
    assert "to_json" not in text and "from_json" not in text
    got = sorted((str(r.labels), r.epoch, r.value) for r in out.collect())
    want = [(str(x), 5, v) for x, v in [({"a": "1", "b": 'x"y'}, 3.0), ({"a": "1", "b": None}, 2.0), ({}, None), (None, 4.0)]]
    assert got == sorted(w for w in want for _ in range(2))
