"""State over deliveries: streamed alarm states, file ledger, compaction, refresh, nested blocks, payload slices."""

import hashlib
import ipaddress
import os
from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.functions import network
from skyledger.operators import alarms as al
from skyledger.operators import geo, slices
from skyledger.sources import ledger as ld
from skyledger.sources import writers
from skyledger.sources.files import create_marker, list_files
from skyledger.streaming import alarm_states, archive

ALARM = "alarm_name string, resource_id string, metrics array<string>, statistics array<string>, expression string, period int, datapoints int, periods int, comparison string, threshold double, missing string"
SAMPLE = "resource_id string, metric string, epoch long, value double"
POLICIES = [("a", "r", "m1", 60, 2, 3, ">=", 5.0, "missing"), ("b", "r", "DIFF(m1)", 60, 1, 2, ">", 1.0, "ignore"), ("c", "s", "m1", 120, 1, 4, "<", 5.0, "ignore"), ("d", "none", "m1", 60, 1, 1, ">", 0.0, "missing")]


def alarm_table(spark):
    return spark.createDataFrame([(n, r, ["m"], ["Average"], e, p, k, of, c, t, m) for n, r, e, p, k, of, c, t, m in POLICIES], ALARM)


def state_rows(df):
    return sorted((r.alarm_name, r.period_start, r.value, r.breaches, r.present, r.state, r.previous_state) for r in df.collect())


def samples_of(rng, count, start, end):
    at = np.sort(rng.choice(np.arange(start, end), count, replace=False))
    return [(str(rng.choice(["r", "r", "s"])), "m", int(t), float(rng.integers(0, 11))) for t in at if not 900 < t < 1500]


def test_streamed_states_equal_the_whole(spark, tmp_path):
    rows = samples_of(np.random.default_rng(5), 160, 100, 2400)
    batches = [[r for r in rows if low <= r[2] < high] for low, high in ((0, 700), (700, 1000), (1000, 2400))]
    late = [r for r in batches[0] if r[2] > 640][:2]
    batches = [[r for r in batches[0] if r not in late], batches[1] + late, batches[2]]
    frame = lambda part: spark.createDataFrame(part, SAMPLE)
    rules, out = alarm_table(spark), str(tmp_path / "states")
    for number, part in enumerate(batches):
        alarm_states.advance(frame(part), rules, out, number, start=100, late_periods=2)
    whole = al.evaluate_alarms(al.alarm_points(frame(rows), rules), rules, start=100, as_of=max(r[2] for r in rows))
    want = state_rows(whole)
    assert state_rows(alarm_states.current_states(spark, out)) == want
    assert {r[5] for r in want} == {"OK", "ALARM", "INSUFFICIENT_DATA"}
    assert alarm_states.late_samples(spark, out).count() == 0
    # a batch done again changes nothing, nor does one without samples
    alarm_states.advance(frame(batches[2]), rules, out, 2, start=100, late_periods=2)
    alarm_states.advance(frame(rows).limit(0), rules, out, 3, start=100, late_periods=2)
    assert state_rows(alarm_states.current_states(spark, out)) == want
    # too late: no state changes, the sample is kept aside
    alarm_states.advance(frame([("r", "m", 130, 100.0)]), rules, out, 4, start=100, late_periods=2)
    assert state_rows(alarm_states.current_states(spark, out)) == want
    assert {(r.alarm_name, r.period_start, r._sum) for r in alarm_states.late_samples(spark, out).collect()} == {("a", 120, 100.0), ("b", 120, 100.0)}
    kept = spark.read.parquet(f"{out}/state/version=4/statistics")
    assert kept.groupBy("alarm_name").count().agg(F.max("count")).first()[0] <= 4 + 2 + 3


def test_silent_alarms_follow_the_time_of_the_stream(spark, tmp_path):
    rules, out = alarm_table(spark).where("alarm_name = 'd'"), str(tmp_path / "states")
    for number, at in enumerate((130, 400, 390)):
        alarm_states.advance(spark.createDataFrame([("r", "m", at, 1.0)], SAMPLE), rules, out, number, start=60)
    got = state_rows(alarm_states.current_states(spark, out))
    assert [(r[1], r[5]) for r in got] == [(t, "INSUFFICIENT_DATA") for t in range(60, 420, 60)]


def write_file(path, name, text, stamp):
    os.makedirs(path, exist_ok=True)
    with open(f"{path}/{name}", "w") as f:
        f.write(text)
    os.utime(f"{path}/{name}", (stamp, stamp))


def test_files_are_taken_once(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    book = ld.FileLedger(spark, str(tmp_path / "ledger"))

    def lines(plan, run):
        return ld.read_planned(book, run, ld.read_lines_since(book, run, source)).select("line")

    def seen():
        return sorted((r.line, r.run) for r in ld.committed_rows(book, out, "line string").collect())

    write_file(source, "a1", "one\n", 1000)
    write_file(source, "b1", "two\n", 1000)
    assert ld.pick_up(book, list_files(spark, source), lines, out) == 0
    # the same second, an older time, and a file written again under its name
    write_file(source, "c1", "three\n", 1000)
    write_file(source, "d1", "four\n", 500)
    write_file(source, "a1", "one and more\n", 1000)
    run = book.begin(list_files(spark, source))
    ld.write_run(lines(None, run), out, run)
    assert [n for _, n in seen()] == [0, 0]  # written, not committed: not read
    write_file(source, "e1", "five\n", 2000)  # comes while the run is lost; the run keeps its files
    again = ld.FileLedger(spark, str(tmp_path / "ledger"))
    assert again.begin(list_files(spark, source)) == run == 1
    ld.write_run(lines(None, run), out, run)
    assert again.commit(run) and not again.commit(run)
    assert ld.pick_up(book, list_files(spark, source), lines, out) == 2
    assert ld.pick_up(book, list_files(spark, source), lines, out) is None
    assert seen() == [("five", 2), ("four", 1), ("one", 0), ("one and more", 1), ("three", 1), ("two", 0)]
    assert book.taken().count() == 6
    # files of earlier runs are not opened: the last run's plan begins at 2000
    assert {r.line for r in ld.read_lines_since(book, 2, source).collect()} == {"five"}
    assert not create_marker(spark, str(tmp_path / "ledger/commits/2"))


MINUTE = "minute long, host string, country string, asn string, response_code string, result_type string, requests long, bytes_down long, bytes_up long, speed_count long, speed_sum double, speed_max double, speed_min double"
DAY = 86_400_000


def minute(day, n, requests, host="h"):
    return (day * DAY + n * 60_000, host, "c", "a", "200", "Hit", requests, requests, 0, 1, float(requests), float(requests), float(requests))


def test_compaction_keeps_the_minutes(spark, tmp_path):
    partials, root = str(tmp_path / "partials"), str(tmp_path / "archive")
    book = archive.MinuteArchive(spark, partials, root)
    with pytest.raises(ValueError):
        book.read()

    def deliver(batch, rows):
        spark.createDataFrame(rows, MINUTE).write.mode("overwrite").parquet(f"{partials}/batch_id={batch}")

    def rows():
        return sorted((r.minute // DAY, r.minute % DAY // 60_000, r.requests, r.speed_max) for r in book.read().collect())

    deliver(0, [minute(1, 0, 5), minute(1, 1, 7), minute(2, 0, 1)])
    deliver(1, [minute(1, 0, 2)])
    deliver(2, [minute(2, 0, 4)])
    before = rows()
    assert before == [(1, 0, 7, 5.0), (1, 1, 7, 7.0), (2, 0, 5, 4.0)]
    assert book.compact(1) and book.upto() == 1
    assert rows() == before  # batch 2 is still read from its partial
    book.clean()
    assert sorted(n for n in os.listdir(partials) if "batch" in n) == ["batch_id=2"] and rows() == before
    assert not book.compact(1)
    # lost before its marker: another generation's files without a marker are not read
    spark.createDataFrame([minute(1, 0, 1000)], MINUTE).withColumn("day", F.lit("1970-01-02")).write.partitionBy("day").parquet(f"{root}/days/generation=1")
    assert rows() == before
    assert book.compact(2) and rows() == before
    # a late file corrects its day; the other day's files stay as they are
    other = _digest(f"{root}/days/generation=1")
    deliver(3, [minute(1, 1, 1)])
    assert book.compact(3)
    assert rows() == [(1, 0, 7, 5.0), (1, 1, 8, 7.0), (2, 0, 5, 4.0)]
    book.clean()
    assert rows() == [(1, 0, 7, 5.0), (1, 1, 8, 7.0), (2, 0, 5, 4.0)]
    assert _digest(f"{root}/days/generation=1") == other
    # a day made anew, and one emptied
    deliver(4, [minute(2, 0, 9)])
    with pytest.raises(ValueError):
        book.recompute(book.read(), [date(1970, 1, 3)])
    assert book.compact(4)
    anew = spark.createDataFrame([minute(2, 5, 3)], MINUTE)
    book.recompute(anew, [date(1970, 1, 3), date(1970, 1, 2)])
    assert rows() == [(2, 5, 3, 3.0)]
    deliver(5, [minute(1, 0, 1)])
    assert book.compact(5) and rows() == [(1, 0, 1, 1.0), (2, 5, 3, 3.0)]


def _digest(folder):
    out = {}
    for at, _, names in os.walk(folder):
        for name in names:
            with open(f"{at}/{name}", "rb") as f:
                out[f"{at}/{name}"] = hashlib.sha256(f.read()).hexdigest()
    return out


def test_refresh_removes_days(spark, tmp_path):
    path = str(tmp_path / "table")
    days = [f"2024-03-{d:02d}" for d in range(1, 11)]
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(days)] + [(99, None)], "n int, d string").withColumn("day", F.col("d").cast("date")).drop("d")
    writers.write_partitions(rows, path, ["day"])
    outside = {k: v for k, v in _digest(path).items() if "day=2024-03-0" in k and int(k.split("day=2024-03-")[1][:2]) < 5}
    writers.refresh(rows.where("n in (5, 7)").withColumn("n", F.col("n") * 10), path, "day", date(2024, 3, 10), days=5)
    got = sorted((str(r.day), r.n) for r in spark.read.parquet(path).collect())
    assert got == sorted([(d, i) for i, d in enumerate(days[:4])] + [("2024-03-06", 50), ("2024-03-08", 70), ("None", 99)])
    after = _digest(path)
    assert outside and all(after[k] == v for k, v in outside.items())
    writers.refresh(rows.where("n < 0"), path, "day", date(2024, 3, 10), days=5)
    assert spark.read.parquet(path).count() == 5


def test_most_specific_block_wins(spark):
    rng = np.random.default_rng(9)
    nets = ["0.0.0.0/0", "10.0.0.0/8", "10.1.0.0/16", "10.1.2.0/24", "10.1.2.128/25", "10.1.2.200/32", "10.1.2.200/32", "2001:db8::/32", "2001:db8:0:1::/64", "2001:db8::/127", "::/1"]
    nets += [f"10.{rng.integers(0, 4)}.{rng.integers(0, 4)}.{rng.integers(0, 256) & -(1 << int(k))}/{32 - int(k)}" for k in rng.integers(0, 8, 40)]
    blocks = [(*network.cidr_keys(n), n, k) for k, n in enumerate(nets)]
    blocks += [("0" * 20 + "ffff0a010000", "0" * 20 + "ffff0a0100fe", "range", 99), ("f" * 32, "0" * 32, "backwards", 100)]
    ips = ["10.1.2.200", "10.1.2.129", "10.1.2.3", "10.1.9.9", "10.9.9.9", "9.9.9.9", "2001:db8::1", "2001:db8::2", "2001:db8:0:1::5", "2001:db9::1", "9001::1", "x", None, "10.1.0.7"]
    ips += [f"10.{rng.integers(0, 4)}.{rng.integers(0, 4)}.{rng.integers(0, 256)}" for _ in range(60)] + ["10.1.2.3"] * 5
    frame = spark.createDataFrame(list(enumerate(ips)), "id int, ip string").withColumn("key", network.address_key("ip"))
    known = spark.createDataFrame(blocks, "start_key string, end_key string, name string, no int")
    got = {r.id: (r.name, r.no) for r in geo.enrich_by_block(frame, known, ["name", "no"], "key").collect()}
    assert len(got) == len(ips)

    def best(ip):
        try:
            a = ipaddress.ip_address(ip)
        except ValueError:
            return "unknown", "unknown"
        key = int(a) + (0xFFFF << 32 if a.version == 4 else 0)
        held = [(int(z, 16) - int(s, 16), s, n, k) for s, z, n, k in blocks if int(s, 16) <= key <= int(z, 16)]
        return (min(held)[2], str(min(held)[3])) if held else ("unknown", "unknown")

    assert got == {i: best(ip) for i, ip in enumerate(ips)}


def test_only_lengths_that_occur_are_looked_up(spark):
    known = spark.createDataFrame([(167772160, 184549375, "ten"), (167837696, 167903231, "ten.one")], "start_ip long, end_ip long, name string")
    rows = spark.range(1000).select((F.lit(167772160) + F.col("id") * 7919).alias("ip_number"))
    out = geo.enrich_by_block(rows, known, ["name"])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "[2,4]" in plan.replace(" ", "")  # two lengths, not nine
    assert out.count() == 1000


def plain_fill(sizes, limit):
    out, filled, number = [], 0, -1
    for n in sizes:
        if number < 0 or filled + n > limit:
            number, filled = number + 1, 0
        filled += n
        out.append(number)
    return out


@pytest.mark.parametrize("seed", [0, 1])
def test_filled_slices_equal_the_sequential_fill(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(k, i, "x" * int(rng.integers(0, 400 if rng.random() < 0.03 else 40))) for k, count in (("a", 900), (None, 150), ("b", 1), ("c", 40)) for i in range(count)]
    rows.append(("c", 40, None))
    frame = spark.createDataFrame(rows, "k string, i int, body string").repartition(5)
    got = {(r.k, r.i): r.slice for r in slices.filled_slices(frame, ["k"], ["i"], F.floor(F.col("i") / 50), "body", 100, stretch=2).collect()}
    for key in ("a", None, "b", "c"):
        mine = sorted((i, max(len(t or ""), 1)) for k, i, t in rows if k == key)
        want = plain_fill([n for _, n in mine], 100)
        assert [got[key, i] for i, _ in mine] == want
    assert slices.filled_slices(frame.limit(0), ["k"], ["i"], F.col("i"), "body", 100).count() == 0


def test_even_slices(spark):
    rows = spark.createDataFrame([("k", i, "x" * 30) for i in range(10)] + [("e", 0, None)], "k string, i int, body string")
    got = sorted((r.k, r.i, r.slice) for r in slices.even_slices(rows, ["k"], ["i"], F.floor(F.col("i") / 4), "body", 100).collect())
    assert [s for k, _, s in got if k == "k"] == [0, 0, 0, 0, 1, 1, 1, 1, 2, 2]
    assert got[0] == ("e", 0, 0)
