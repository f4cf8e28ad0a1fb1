"""Golden cases and properties of cost allocation."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from skyledger.operators import allocation as al
from skyledger.operators import cost as c

DAY = dt.date(2024, 7, 2)


def metrics(spark, pods, instance="i-1"):
    rows = [
        ("2024", "7", dt.datetime(2024, 7, 2), "acct", "r", instance, "prod", "ns", name, f"{instance}:pod/{name}", cpu, mem * 1024.0**3, net / 2, net / 2)
        for name, cpu, mem, net in pods
    ]
    return spark.createDataFrame(
        rows,
        "year string, month string, date timestamp, usage_account string, region string, instance string, eks_cluster_name string, "
        "eks_namespace string, eks_app string, resource_id string, actual_cpu double, actual_mem double, network_in double, network_out double",
    )


def bill(spark, lines):
    """lines: (resource, charge_type, usage_type, vcpus, memory, cost)"""
    rows = []
    for resource, charge, usage, vcpus, memory, amount in lines:
        d = {k: "" for k in c.DIMENSIONS}
        d.update(year="2024", month="7", date=DAY, usage_account="acct", region="r", resource_id=resource, charge_type=charge, usage_type=usage)
        d.update({m: 0.0 for m in c.MEASURES})
        d.update(usage_amount=1.0, vcpus=vcpus, memory_gb=memory, ondemand_cost=amount, amortized_cost=amount, net_amortized_cost=amount, billing_cost=amount)
        rows.append(tuple(d[k] for k in (*c.DIMENSIONS, *c.MEASURES)))
    schema = ", ".join([f"{k} {'date' if k == 'date' else 'string'}" for k in c.DIMENSIONS] + [f"{m} double" for m in c.MEASURES])
    return spark.createDataFrame(rows, schema)


TWO_PODS = [("A", 1.0, 2.0, 30.0), ("B", 3.0, 6.0, 70.0)]
ONE_BOX = [("i-1", "Usage", "BoxUsage:m5", 4.0, 16.0, 10.0), ("i-1", "Usage", "DataTransfer-Out", 0.0, 0.0, 2.0)]


def by_app(df, usage="BoxUsage"):
    return {r.eks_app: r for r in df.where(F.col("usage_type").contains(usage)).collect()}


def total(df):
    return df.agg(F.sum("ondemand_cost")).first()[0]


def test_level_zero_golden(spark):
    out = al.allocate_compute(metrics(spark, TWO_PODS), bill(spark, ONE_BOX))
    rows = by_app(out)
    assert rows["A"].ondemand_cost == pytest.approx(2.5)
    assert rows["B"].ondemand_cost == pytest.approx(7.5)
    assert by_app(out, "DataTransfer")[""].ondemand_cost == 2.0
    assert total(out) == pytest.approx(12.0)


def test_level_one_golden(spark):
    out = al.allocate_compute_and_transfer(metrics(spark, TWO_PODS), bill(spark, ONE_BOX))
    moved = by_app(out, "DataTransfer")
    assert moved["A"].ondemand_cost == pytest.approx(0.6)
    assert moved["B"].ondemand_cost == pytest.approx(1.4)
    assert moved["A"].vcpus == 0 and moved["B"].memory_gb == 0
    assert total(out) == pytest.approx(12.0)


def test_level_two_golden(spark):
    out = al.allocate_with_residual(metrics(spark, TWO_PODS), bill(spark, ONE_BOX[:1]))
    rows = by_app(out)
    assert rows["A"].ondemand_cost == pytest.approx(2.115385, abs=1e-6)
    assert rows["B"].ondemand_cost == pytest.approx(6.346154, abs=1e-6)
    idle = rows[""]
    assert idle.ondemand_cost == pytest.approx(1.538462, abs=1e-6)
    assert idle.vcpus == pytest.approx(0.0) and idle.memory_gb == pytest.approx(8.0)
    assert idle.eks_cluster_name == "prod" and idle.eks_namespace == "" and idle.resource_id == "i-1"


def test_two_charge_types_conserve(spark):
    lines = [("i-1", "Usage", "BoxUsage:m5", 2.0, 8.0, 6.0), ("i-1", "DiscountedUsage", "BoxUsage:m5", 2.0, 8.0, 4.0)]
    out = al.allocate_with_residual(metrics(spark, TWO_PODS), bill(spark, lines))
    assert total(out) == pytest.approx(10.0)
    assert out.count() == 6


def test_unmatched_and_zero_usage(spark):
    lines = [*ONE_BOX, ("i-9", "Usage", "BoxUsage:m5", 4.0, 16.0, 5.0), ("i-1", "Tax", "BoxUsage:m5", 0.0, 0.0, 1.0)]
    idle_pods = [("A", 0.0, 0.0, 0.0), ("B", 0.0, 0.0, 0.0)]
    for step in (al.allocate_compute, al.allocate_compute_and_transfer, al.allocate_with_residual):
        assert total(step(metrics(spark, idle_pods), bill(spark, lines))) == pytest.approx(18.0)
    stages = al.allocation_stages(metrics(spark, TWO_PODS, "i-7"), bill(spark, lines))
    assert stages["unmatched_usage"].count() == 2


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_conservation(spark, seed):
    rnd = random.Random(seed)
    pods = None
    for i in range(3):
        some = [(f"p{i}{j}", rnd.random() * 3, rnd.random() * 8, rnd.random() * 9) for j in range(rnd.randint(1, 4))]
        part = metrics(spark, some, f"i-{i}")
        pods = part if pods is None else pods.unionByName(part)
    kinds = [("Usage", "BoxUsage"), ("SavingsPlanCoveredUsage", "SpotUsage"), ("Usage", "DataTransfer-Out"), ("Credit", "BoxUsage")]
    lines = [(f"i-{rnd.randint(0, 4)}", *rnd.choice(kinds), float(rnd.randint(0, 8)), float(rnd.randint(0, 32)), rnd.random() * 50 - 5) for _ in range(40)]
    before = bill(spark, lines)
    for step in (al.allocate_compute, al.allocate_compute_and_transfer, al.allocate_with_residual):
        check = c.conservation(before, step(pods, before)).first()
        for name in c.COSTS:
            assert abs(check[f"{name}_diff"]) < 1e-6


def tagged(spark, rows, tags):
    data = [(d, *t, *[float(v)] * 4) for d, t, v in rows]
    schema = "date string, " + ", ".join(f"{t} string" for t in tags) + ", " + ", ".join(f"{m} double" for m in c.COSTS)
    return spark.createDataFrame(data, schema).withColumn("date", F.to_date("date"))


def test_untag_golden(spark):
    rows = [
        ("2024-07-02", ("sporty", "uat"), 100),
        ("2024-07-02", ("sporty", ""), 100),
        ("2024-07-02", ("", "stg"), 100),
        ("2024-07-02", ("", ""), 99),
        ("2024-07-03", ("", None), 80),
    ]
    out = al.allocate_untagged(tagged(spark, rows, ["costowner", "environment"]), ["costowner", "environment"])
    got = {(str(r.date), r.costowner, r.environment): r.ondemand_cost for r in out.collect()}
    assert set(got) == {("2024-07-02", "sporty", "uat"), ("2024-07-02", "", "stg"), ("2024-07-03", "", "")}
    assert got[("2024-07-02", "sporty", "uat")] == pytest.approx(266)
    assert got[("2024-07-02", "", "stg")] == pytest.approx(133)
    assert got[("2024-07-03", "", "")] == pytest.approx(80)


def brute_untag(rows, n):
    """Row by row, pass by pass."""
    live = [[d, t, float(v)] for d, t, v in rows]
    for mask in range((1 << n) - 1):
        fixed = [i for i in range(n) if mask >> i & 1]
        spread = [i for i in range(n) if not mask >> i & 1]
        groups = {}
        for r in live:
            groups.setdefault((r[0], *[r[1][i] for i in fixed]), []).append(r)
        nxt = []
        for members in groups.values():
            has = [any(r[1][i] for i in spread) for r in members]
            with_tag = sum(r[2] for r, h in zip(members, has, strict=True) if h)
            without = sum(r[2] for r, h in zip(members, has, strict=True) if not h)
            for r, h in zip(members, has, strict=True):
                if with_tag == 0:
                    nxt.append(r)
                elif h:
                    nxt.append([r[0], r[1], r[2] * (1 + without / with_tag)])
        live = nxt
    out = {}
    for d, t, v in live:
        out[(d, t)] = out.get((d, t), 0) + v
    return out


@pytest.mark.parametrize("n", [1, 2, 3])
def test_untag_against_row_by_row(spark, n):
    rnd = random.Random(n)
    names = [f"t{i}" for i in range(n)]
    rows = [(f"2024-07-0{rnd.randint(1, 3)}", tuple(rnd.choice(["", "a", "b"]) for _ in names), rnd.randint(1, 90)) for _ in range(120)]
    rows.append(("2024-07-09", ("",) * n, -5))
    out = al.allocate_untagged(tagged(spark, rows, names), names)
    got = {}
    for r in out.collect():
        key = (str(r.date), tuple(r[t] for t in names))
        got[key] = got.get(key, 0) + r.billing_cost
    want = brute_untag(rows, n)
    assert set(got) == set(want)
    for key in want:
        assert got[key] == pytest.approx(want[key])
    for day in {r[0] for r in rows}:
        assert sum(v for (d, _), v in got.items() if d == day) == pytest.approx(sum(v for d, _, v in rows if d == day))


def test_credit_rows_survive(spark):
    rows = [("2024-07-01", ("a",), 100), ("2024-07-01", ("",), -10)]
    out = al.allocate_untagged(tagged(spark, rows, ["t0"]), ["t0"]).collect()
    assert [r.ondemand_cost for r in out] == [pytest.approx(90)]


def test_tag_subsets_order():
    assert al.tag_subsets(["a", "b"]) == [[], ["a"], ["b"]]
    assert len(al.tag_subsets(list("abcd"))) == 15
    assert all(len(s) < 4 for s in al.tag_subsets(list("abcd")))
    assert list(itertools.chain(*al.tag_subsets(["x"]))) == []


def test_instance_with_most_workloads_is_split(spark, monkeypatch):
    """Nine tenths of the workloads on one instance: cut into parts, each line still shared out once and in full."""
    monkeypatch.setattr(al, "PART_WORKLOADS", 100)
    pods = [(f"p{i}", 1.0 + i % 7, 2.0 + i % 5, 1.0 + i % 3) for i in range(900)]
    usage = metrics(spark, pods).unionByName(metrics(spark, pods[:100], "i-2"))
    lines = [*ONE_BOX, ("i-2", "Usage", "BoxUsage:m5", 4.0, 16.0, 20.0), ("i-3", "Usage", "BoxUsage:m5", 4.0, 16.0, 40.0)]
    for level in (al.allocate_compute, al.allocate_compute_and_transfer):
        out = level(usage, bill(spark, lines))
        assert total(out) == pytest.approx(72.0)
        shared = out.where("resource_id LIKE 'i-1:pod%' AND usage_type LIKE '%BoxUsage%'")
        assert shared.count() == 900 and total(shared) == pytest.approx(10.0)
    parts = al.relative_shares(al.workload_usage(usage)).withColumn("part", F.ceil(F.col("_n") / al.PART_WORKLOADS))
    assert {r.part for r in parts.where("instance = 'i-1'").select("part").distinct().collect()} == {9}


def test_blank_instances_are_not_matched(spark):
    """A line without resource id is not shared out to pods that have no node."""
    out = al.allocate_with_residual(metrics(spark, TWO_PODS, ""), bill(spark, [("", "Usage", "BoxUsage:m5", 4.0, 16.0, 10.0)]))
    assert [(r.resource_id, r.ondemand_cost, r.eks_app) for r in out.collect()] == [("", 10.0, "")]
