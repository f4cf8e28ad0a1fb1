"""Goldens for expressions, logs, events, alarms and compliance; plan shape checks; stream equals batch."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from skyledger.functions import billing, capacity, network, text, timefns
from skyledger.operators import alarms as al
from skyledger.operators import compliance, events, geo, inventory, keyed, logs, metrics, rollup
from skyledger.plans import bindings
from skyledger.plans.catalogue import RULES, rule_table
from skyledger.session import prepare


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_instance_families(spark):
    names = ["m5.large", "c5n.large", "r6gd.large", "db.m5.large", ""]
    df = spark.createDataFrame([(n,) for n in names], "product_instance_type string")
    got = [r.f for r in df.select(billing.instance_family().alias("f")).collect()]
    assert got == ["m5", "c5n", "", "m5", ""]


def test_times(spark):
    assert one(spark, timefns.rfc1123(F.lit("Mon, 26 Jul 2021 12:00:00 GMT"))) == dt.datetime(2021, 7, 26, 12)
    assert one(spark, timefns.warehouse_time(F.lit("Thu, 24 Jun 2021 01:46:05:123"))) == dt.datetime(2021, 6, 24, 1, 46, 5, 123000)
    stamp = F.lit("2021-07-11 20:49:29").cast("timestamp_ntz")
    assert one(spark, timefns.local_stamp(stamp)) == "2021-07-12T04:49:29+0800"
    assert timefns.run_month("2024-07-04T00:00:00Z") == ("2024", "07")
    assert timefns.run_month(as_of=dt.date(2024, 1, 4)) == ("2023", "12")


def test_addresses(spark):
    assert one(spark, network.ip_number(F.lit("10.0.0.1"))) == 167772161
    for bad in ("10.0.0.256", "ec2.amazonaws.com", "1.2.3", ""):
        assert one(spark, network.ip_number(F.lit(bad))) is None
    assert one(spark, network.in_any_cidr(F.lit("10.0.1.7"), ["10.0.0.0/23"])) is True
    assert one(spark, network.in_any_cidr(F.lit("host"), ["0.0.0.0/0"])) is False
    assert one(spark, network.subnet_use_limit(F.lit("10.0.0.0/24"))) == pytest.approx(92.1875)
    assert one(spark, network.cidr_size(F.lit("10.0.0.0/16"))) == 65536


def test_text(spark):
    assert one(spark, text.base_device(F.lit("nvme0n1"))) == "/dev/nvme0n"
    assert one(spark, text.partition_number(F.lit("xvda"))) is None
    assert one(spark, text.array_length(F.lit(None).cast("array<string>"))) is None
    assert one(spark, text.association_target(F.lit("null:rt"))) == "null"
    assert one(spark, text.cluster_from_stream(F.lit("arn:kinesis/aws-rds-das-cluster-ABC"))) == "ABC"


def lines(spark, rows, path="s3/acct_redshift_r1_c1_useractivitylog_x.gz"):
    return spark.createDataFrame([(path, r) for r in rows], "path string, line string")


def test_mysql_logs(spark):
    rows = ["2021-06-24T01:46:05.123456Z 17 Query select  1", "2021-06-24T01:46:06.000000Z 18 Quit", "Time  Id Command", "2021-13-99 x"]
    got = logs.parse_mysql_general(lines(spark, rows), "db").collect()
    assert [(r.id, r.command, r.argument, r.parse_ok) for r in got[:2]] == [("17", "Query", "select 1", True), ("18", "Quit", None, True)]
    assert got[0].timestamp == 1624499165123 and len(got) == 3 and got[2].parse_ok is False
    audit = logs.parse_mysql_audit(lines(spark, ["20210624 01:46:05,h,u,10.0.0.1,17,99,QUERY,db,'select 1, 2',0"]), "db").first()
    assert (audit.object, audit.retcode, audit.database) == ("select 1, 2", "0", "db")


def test_warehouse_logs(spark):
    rows = ["'2021-06-24T01:46:05Z UTC [ db=dev user=rdsdb pid=1 userid=1 xid=2 ]' LOG: select 1", "  continued"]
    got = logs.parse_warehouse_activity(lines(spark, rows)).collect()
    assert len(got) == 1 and got[0].query == "select 1" and got[0].cluster_id == "c1" and got[0].parse_ok
    user = "|".join(["1", " u ", "", "create", "0", "0", "0", "", "9", "7"])
    kept = logs.parse_warehouse_user(lines(spark, [user, user + "|Thu, 24 Jun 2021 01:46:05:123"])).collect()
    assert len(kept) == 1 and kept[0].username == "u" and kept[0].timestamp == 1624499165123


def test_cdn_zero_time(spark):
    fields = ["date", "time", "sc-bytes", "time-taken"]
    rows = ["#Fields: " + " ".join(fields), "2024-01-01\t00:00:01\t100\t0.000", "2024-01-01\t00:00:02\t100\t0.5", "short"]
    df = logs.parse_cdn(lines(spark, rows), fields).select(logs.download_speed().alias("s"))
    assert sorted(r.s or 0 for r in df.collect()) == [0, 200.0]
    assert logs.cdn_header_ok(lines(spark, rows), fields).count() == 0


def test_server_timing(spark):
    df = spark.createDataFrame([('cdn-upstream-dns;dur=2,cdn-upstream-connect;dur=5,cdn-upstream-fbl;dur=80,cdn-pop;desc="NRT57-C1"', "FRA6"), ("", "FRA6"), (None, "FRA6")], "timing string, pop string")
    got = [(r.dns_ms, r.connect_ms, r.first_byte_ms, r.city) for r in logs.server_timing(df).collect()]
    assert got == [(2, 5, 80, "NRT"), (0, 0, 0, "FRA"), (0, 0, 0, "FRA")]


def test_cache_event_without_key(spark):
    df = spark.createDataFrame([('{"ElastiCache:SnapshotComplete":"node-1","Zone":"z"}',), ('{"a":"b"}',)], "message string")
    got = [(r.detail_type, r.resource) for r in events.flatten_cache_event(df).collect()]
    assert got == [("ElastiCache:SnapshotComplete", "node-1"), ("", "")]


def test_audit_two_findings(spark):
    df = spark.createDataFrame([("ConsoleLogin", "Root", None, "8.8.8.8"), ("RunInstances", "IAMUser", "ops", "8.8.8.8")], "event_name string, user_type string, user_name string, source_ip string")
    got = [r.finding for r in events.audit_findings(df, ["10.0.0.0/8"], [], ["ops"]).collect()]
    assert sorted(got) == sorted([events.ROOT_LOGIN, events.UNTRUSTED_LOGIN])


def test_required_tags_edges(spark):
    tag = "array<struct<key:string,value:string>>"
    df = spark.createDataFrame([("v1", [("Owner", "")]), ("v2", [("Owner", "x")]), ("v3", None), ("v4", [])], f"resource_id string, tags {tag}")
    got = {r.resource_id: r.compliance for r in compliance.required_tags(df, "Owner,", ["v4"]).collect()}
    assert got == {"v1": "NON_COMPLIANT", "v2": "COMPLIANT", "v3": "NON_COMPLIANT", "v4": "COMPLIANT"}
    assert {r.compliance for r in compliance.required_tags(df, "").collect()} == {"COMPLIANT"}


def test_snapshot_increment(spark):
    t = dt.datetime
    snaps = spark.createDataFrame([("o", "v", "s2", t(2024, 2, 1), 5), ("o", "v", "s1", t(2024, 1, 1), 5)], "owner_id string, volume_id string, snapshot_id string, start_time timestamp, volume_size int")
    blocks = spark.createDataFrame([("s1", "s2", 1), ("s1", "s2", 2)], "first_snapshot_id string, second_snapshot_id string, block_index bigint")
    got = {r.snapshot_id: (r.previous_snapshot_id, r.increment_bytes) for r in inventory.snapshot_increment(snaps, blocks).collect()}
    assert got == {"s1": (inventory.FIRST_SNAPSHOT, 5 * 1024**3), "s2": ("s1", 2 * 524288)}


def volume(spark, kind, size, iops=0.0, threshold=None):
    tags = [("AlarmThreshold", threshold)] if threshold else []
    df = spark.createDataFrame([("EBS", "v", kind, size, iops, tags)], "service string, resource_id string, volume_type string, size_gib double, iops double, tags array<struct<key:string,value:string>>")
    limits = capacity.capacity_limits()
    return al.as_resources(df).select(limits["volume_iops"].alias("i"), limits["volume_throughput"].alias("t")).first()


def test_volume_limits(spark):
    assert volume(spark, "gp2", 20.0).i == pytest.approx(80)
    assert volume(spark, "gp2", 6000.0).i == pytest.approx(12800)
    assert volume(spark, "gp3", 10.0, 3000.0).i == pytest.approx(2400)
    assert volume(spark, "gp2", 333.0).t == pytest.approx(128 * 1024 * 1024 * 0.8)
    assert volume(spark, "gp2", 20.0, threshold="disable").i is None
    assert volume(spark, "gp2", 20.0, threshold='{"IOPS": 0.5}').i == pytest.approx(50)
    assert volume(spark, "gp2", 20.0, threshold="{broken").i == pytest.approx(80)
    assert volume(spark, "st1", 20.0).i is None


def test_catalogue(spark):
    assert len(RULES) == 97 and len({r.rule_id for r in RULES}) == 97
    assert all(1 <= r.datapoints <= r.periods for r in RULES)
    assert rule_table(spark).count() == 97


ALARM = "alarm_name string, resource_id string, metrics array<string>, statistics array<string>, expression string, period int, datapoints int, periods int, comparison string, threshold double, missing string"


def states(spark, values, comparison=">=", missing="missing", need=(3, 3), threshold=5.0):
    alarms = spark.createDataFrame([("a", "r", ["m"], ["Sum"], "m1", 60, need[0], need[1], comparison, threshold, missing)], ALARM)
    rows = [("r", "m", i * 60 + 7, float(v)) for i, v in enumerate(values) if v is not None]
    samples = spark.createDataFrame(rows, "resource_id string, metric string, epoch bigint, value double")
    out = al.evaluate_alarms(al.alarm_points(samples, alarms), alarms).orderBy("period_start")
    return [r.state for r in out.collect()]


def test_m_of_n(spark):
    assert states(spark, [9, 9, 9, 1]) == ["OK", "OK", "ALARM", "OK"]
    assert states(spark, [9, 1, 9, 9], need=(2, 3)) == ["OK", "OK", "ALARM", "ALARM"]
    assert states(spark, [5, 5, 5]) == ["OK", "OK", "ALARM"]
    assert states(spark, [5, 5, 5], comparison=">") == ["OK"] * 3


def test_missing_data_policies(spark):
    gap = [9, None, None, 1]
    assert states(spark, gap, need=(1, 1)) == ["ALARM", "INSUFFICIENT_DATA", "INSUFFICIENT_DATA", "OK"]
    assert states(spark, gap, need=(1, 1), missing="ignore") == ["ALARM", "ALARM", "ALARM", "OK"]


def test_counter_resets_across_hours(spark):
    rows = [("s", 0, 5.0), ("s", 1800, 9.0), ("s", 3600, 12.0), ("s", 3700, 2.0), ("s", 90000, 4.0)]
    df = spark.createDataFrame(rows, "series string, epoch bigint, value double")
    got = {r.window_start: r.increase for r in metrics.counter_increase(df, ["series"]).collect()}
    assert got == {0: 4.0, 3600: 5.0, 90000: 2.0}


def test_block_borders(spark):
    blocks = spark.createDataFrame([(0, 70000, "a"), (70002, 4294967295, "b")], "start_ip bigint, end_ip bigint, org string")
    rows = spark.createDataFrame([(1, 0), (2, 70000), (3, 70001), (4, 70002), (5, None)], "id int, ip_number bigint")
    small = blocks.where("org = 'a'").unionByName(blocks.where("org = 'b'").withColumn("end_ip", F.lit(200000).cast("bigint")))
    got = {r.id: r.org for r in geo.enrich_by_block(rows, small, ["org"]).collect()}
    assert got == {1: "a", 2: "a", 3: "unknown", 4: "b", 5: "unknown"}


def test_hot_key_join_keeps_rows(spark):
    df = spark.range(10000).select((F.col("id") % 3 == 0).cast("int").alias("k"), "id", F.lit("same").alias("s"))
    totals = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = keyed.join_totals(df, totals, ["k"])
    assert out.count() == 10000
    assert out.groupBy("k", "n").count().where("n <> count").count() == 0


def test_positions_of_a_large_key(spark):
    df = spark.range(3000).select((F.col("id") % 50 == 0).cast("int").alias("k"), "id", (F.col("id") % 7).alias("w"))
    out = keyed.position_before(df, ["k"], ["id"], F.col("w"), "before", F.floor(F.col("id") / 100))
    seen = {0: 0, 1: 0}
    for r in out.orderBy("id").collect():
        assert r.before == seen[r.k]
        seen[r.k] += r.w


def test_delivery_batches(spark):
    sizes = rollup.delivery_batches(spark.range(0, 5001, 1, 3), 500).groupBy("batch").count()
    top = sizes.agg(F.max("count"), F.sum("count")).first()
    assert top[0] <= 500 and top[1] == 5001


def test_definitions_pick_first_match(spark):
    schema = "service string, filter_no int, filter_key string, filter_values array<string>, metric string, enabled boolean, threshold double, severity int, category string, plan string"
    defs = spark.createDataFrame(
        [
            ("S3", 0, "resource_id", ["b1"], "5xxRate", True, 1.0, 3, "", ""),
            ("S3", 1, "tag:Project", ["p"], "5xxRate", True, 2.0, 3, "", ""),
            ("S3", 2, "tag:Project", ["off"], "5xxRate", False, 9.0, 3, "", ""),
            ("S3", None, None, None, "5xxRate", True, 7.0, 3, "", ""),
        ],
        schema,
    )
    rows = [("S3", "b1", [("Project", "p")]), ("S3", "b2", [("Project", "p")]), ("S3", "b3", []), ("S3", "b4", [("Project", "off")])]
    df = spark.createDataFrame(rows, "service string, resource_id string, tags array<struct<key:string,value:string>>")
    got = {r.resource_id: r.threshold for r in al.resolve_definition(df, defs).collect()}
    assert got == {"b1": 1.0, "b2": 2.0, "b3": 7.0}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rules_and_definitions_are_broadcast_and_resources_are_not(spark, tmp_path):
    spark.range(300).selectExpr(
        "'ElastiCache' AS service", "concat('r', id) AS resource_id", "concat('s', id % 9) AS sub_id", "'s3' AS name", "int(4) AS vcpus"
    ).write.parquet(str(tmp_path / "resources"))
    resources = spark.read.parquet(str(tmp_path / "resources"))
    chosen = [r for r in RULES if r.threshold.kind == "defined" and r.service == "ElastiCache" and not r.applies]
    key = chosen[0].threshold.key
    defs = spark.createDataFrame(
        [("ElastiCache", 1, "sub_id", ["s3"], key, True, 7.0, 3, "", ""), ("ElastiCache", 0, "sub_id", ["s4", "s5"], key, True, 8.0, 3, "", ""),
         ("ElastiCache", None, None, None, key, True, 40.0, 3, "", "")], al.DEFINITION_SCHEMA)
    out = al.expand_rules(resources, rule_table(spark, chosen[:1]), defs)
    lines = plan(out).splitlines()
    depths = [(len(line) - len(line.lstrip(" :+-|")), line) for line in lines]
    for i, (depth, line) in enumerate(depths):
        if "BroadcastExchange" in line:
            below = []
            for d, text in depths[i + 1 :]:
                if d <= depth:
                    break
                below.append(text)
            assert not any("FileScan" in text for text in below), below
    factor = chosen[0].threshold.factor
    got = {r.resource_id: r.threshold for r in out.collect()}
    assert got == {f"r{i}": {3: 7.0, 4: 8.0, 5: 8.0}.get(i % 9, 40.0) * factor for i in range(300)}


def test_line_items_are_widened_in_bounded_tasks(spark, tmp_path, monkeypatch):
    spark.range(1000).selectExpr("id % 90 AS l_partkey", "id AS l_orderkey", "int(1) AS l_linenumber").coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    monkeypatch.setattr(bindings, "TASK_LINES", 100)
    lines = bindings.dealt_lines(spark, str(tmp_path))
    assert ", 10)" in plan(lines) and "hashpartitioning" in plan(lines)
    assert sorted(r.l_orderkey for r in lines.collect()) == list(range(1000))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 << 20))
    assert prepare(spark)._jsparkSession.sessionState().conf().filesMaxPartitionBytes() == 16 << 20
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1m")
    assert prepare(spark).conf.get("spark.sql.files.maxPartitionBytes") == "1m"
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    prepare(spark)


def test_types_are_not_broadcast_by_file_size(spark, tmp_path):
    spark.range(1000).selectExpr("concat('t', id) AS instance_type", "id AS vcpus").write.parquet(str(tmp_path / "types"))
    types = spark.read.parquet(str(tmp_path / "types"))
    nodes = spark.range(2000).selectExpr("id", "concat('db.t', id % 1200) AS class")
    out = inventory.resources_of_type(nodes, types, "class", "db.")
    assert "Broadcast" not in plan(out)
    got = {r.id: r.vcpus for r in out.collect()}
    assert got == {i: i % 1200 if i % 1200 < 1000 else None for i in range(2000)}


@pytest.mark.parametrize("name", ["x05_allocate_with_residual", "i03_inventory_subnets", "j10_l08_block_enrichment", "w02_share_of_group", "r05_expand_rules", "m08_pod_daily_usage"])
def test_no_nested_loops_or_python(spark, sf, name):
    from skyledger.plans import all_queries

    text_plan = plan(all_queries()[name].run(spark, sf))
    for operator in ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in text_plan


def test_latest_points_limit_before_shuffle(spark, sf):
    from skyledger.plans import all_queries

    assert "WindowGroupLimit" in plan(all_queries()["o02_latest_three_points"].run(spark, sf))


def test_month_predicate_prunes(spark, tmp_path):
    from skyledger.sources import readers, writers

    path = str(tmp_path / "t")
    df = spark.createDataFrame([("2024", str(m), m) for m in range(1, 13)], "year string, month string, v int")
    writers.write_partitions(df, path, ["year", "month"])
    month = readers.read_partition(spark, path, "2024", "03")
    assert [r.v for r in month.collect()] == [3]
    pruned = plan(month).split("PartitionFilters: [", 1)[1].split("PushedFilters")[0]
    assert "year" in pruned and "month" in pruned


def test_stream_equals_batch(spark, sf):
    from skyledger.plans import all_queries
    from skyledger.plans.log_queries import CDN_FIELDS, cdn_lines, shown
    from skyledger.streaming.streams import cdn_requests

    streamed = all_queries()["t01_t03_stream_partial_minutes"].run(spark, sf)
    batch = shown(rollup.cdn_minutes(cdn_requests(cdn_lines(spark, sf), CDN_FIELDS)), "minute", *rollup.CDN_KEYS)
    assert streamed.exceptAll(batch).count() == 0
    assert batch.exceptAll(streamed).count() == 0


def test_many_periods_and_unknown_expressions(spark):
    assert states(spark, [9] * 12, need=(8, 8)) == ["OK"] * 7 + ["ALARM"] * 5
    alarms = spark.createDataFrame([("a", "r", ["m"], ["Sum"], "m1^2", 60, 1, 1, ">=", 5.0, "missing")], ALARM)
    samples = spark.createDataFrame([("r", "m", 7, 1.0)], "resource_id string, metric string, epoch bigint, value double")
    with pytest.raises(Exception, match="unknown alarm expression: m1"):
        al.alarm_points(samples, alarms).collect()


def test_alarms_without_samples(spark):
    alarms = spark.createDataFrame(
        [(n, r, ["m"], ["Sum"], "m1", 60, 1, 2, ">=", 5.0, "missing") for n, r in (("a", "r"), ("b", "none"))], ALARM
    )
    samples = spark.createDataFrame([("r", "m", 7, 9.0)], "resource_id string, metric string, epoch bigint, value double")
    out = al.evaluate_alarms(al.alarm_points(samples, alarms), alarms, start=0, as_of=200).orderBy("alarm_name", "period_start")
    none = "INSUFFICIENT_DATA"
    assert [r.state for r in out.collect()] == ["ALARM", "ALARM", none, none] + [none] * 4


def test_null_keys(spark):
    rows = spark.createDataFrame([(None, 1, 1.0), (None, 2, 3.0), ("a", 1, 4.0)], "k string, t int, v double")
    assert sorted(r.v for r in keyed.keep_greatest(rows, ["k"], "v").collect()) == [3.0, 4.0]
    assert {(r.k, r.s) for r in keyed.share_of_total(rows, ["k"], {"v": "s"}).collect()} == {(None, 0.25), (None, 0.75), ("a", 1.0)}
    lagged = keyed.carried_lag(rows, ["k"], ["t"], "v", "before", F.col("t"))
    assert {(r.k, r.t, r.before) for r in lagged.collect()} == {(None, 1, None), (None, 2, 1.0), ("a", 1, None)}
    placed = keyed.position_before(rows, ["k"], ["t"], F.lit(1), "n", F.col("t"))
    assert {(r.k, r.t, r.n) for r in placed.collect()} == {(None, 1, 0), (None, 2, 1), ("a", 1, 0)}


def test_equal_rows_of_a_key_get_several_salts(spark):
    rows = spark.range(0, 1000, 1, 16).select(F.lit("hot").alias("k"))
    salts = rows.select(keyed._row_salt(rows, ["k"], 8).alias("s")).distinct().count()
    assert salts > 2
    totals = spark.createDataFrame([("hot", 7)], "k string, n int")
    assert keyed.join_totals(rows, totals, ["k"]).where("n = 7").count() == 1000


def test_memory_text(spark):
    texts = ["1,952 GiB", "24576.5 GiB", "16 GiB", ".5 GiB", "NA", "12345678 GiB", "x 4 GiB"]
    df = spark.createDataFrame([(t,) for t in texts], "product_memory string")
    digits = F.replace(F.regexp_extract("product_memory", billing.MEMORY_TEXT, 1), F.lit(","), F.lit(""))
    assert [r.d for r in df.select(digits.alias("d")).collect()] == ["1952", "24576.5", "16", ".5", "", "12345678", ""]


def test_one_partner_per_name_and_namespace(spark):
    many = spark.createDataFrame([("ns1", "web-0", 10.0), ("ns2", "web-0", 5.0)], "namespace string, pod string, value double")
    apps = spark.createDataFrame([("ns1", "web-0", "a", 1.0), ("ns2", "web-0", "b", 1.0), ("", "web-0", "c", 1.0)], "namespace string, pod string, app string, value double")
    got = {(r.namespace, r.app, r.value) for r in metrics.match_named(many, apps, ["pod"], "namespace", ["app"]).collect()}
    assert got == {("ns1", "a", 10.0), ("ns2", "b", 5.0)}
    assert metrics.match_left(many, apps, ["pod"], ["app"]).agg(F.sum("value")).first()[0] == 15.0


def test_addresses_of_both_families(spark):
    import ipaddress

    texts = ["1.2.3.4", "::", "::1", "2001:DB8::1", "::ffff:1.2.3.4", "1:2:3:4:5:6:7::", "64:ff9b::10.0.0.1", "1::2::3", ":::1", "12345::", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "ip string")

    def want(t):
        try:
            a = ipaddress.ip_address(t)
        except ValueError:
            return None
        return network.MAPPED + f"{int(a):08x}" if a.version == 4 else f"{int(a):032x}"

    assert [r.k for r in df.select(network.address_key("ip").alias("k")).collect()] == [want(t) for t in texts]
    hits = df.where(network.in_any_cidr("ip", ["1.2.0.0/16", "2001:db8::/32", "no block"])).collect()
    assert [r.ip for r in hits] == ["1.2.3.4", "2001:DB8::1", "::ffff:1.2.3.4"]


def test_payload_slices_keep_the_limit(spark):
    rows = spark.createDataFrame([("k", i, "x" * n) for i, n in enumerate([40, 30, 5, 5, 90, 20, 250, 1, 99])], "k string, i int, body string")
    out = rollup.payload_slices(rows, ["k"], ["i"], F.floor(F.col("i") / 2), "body", 100)
    sizes = out.groupBy("slice").agg(F.sum(F.length("body")).alias("n"), F.count(F.lit(1)).alias("rows"), F.min("i").alias("a")).orderBy("slice").collect()
    assert all(r.n <= 100 or r.rows == 1 for r in sizes) and [r.a for r in sizes] == sorted(r.a for r in sizes)


def test_scratch_is_released(spark, monkeypatch):
    from skyledger import session

    monkeypatch.setattr(session, "_made", [])
    stored = session.cut_lineage(spark.range(5).toDF("x"))
    folder = stored.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert stored.count() == 5 and os.path.isdir(folder)
    session.release_scratch(spark)
    assert not os.path.exists(folder)


def test_measured_salts_follow_the_share(spark):
    rows = spark.range(0, 90_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id").cast("string"))).otherwise(F.concat(F.lit("g"), (F.col("id") % 900).cast("string"))).alias("k"),
        F.col("id").alias("v"),
    )
    heavy = keyed.heavy_keys(rows, ["k"], tasks=30)
    assert list(heavy.values()) == [10]  # a third of thirty tasks
    totals = rows.groupBy("k").agg(F.sum("v").alias("s"))
    assert keyed.heavy_counts(rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")), ["k"], "n", tasks=30) == heavy
    copies = totals.select(F.sum(heavy.salts(["k"])).alias("n"), F.count(F.lit(1)).alias("keys")).first()
    assert copies.n == copies["keys"] + 9  # no copies of other keys
    joined = keyed.join_totals(rows, totals, ["k"], "inner", salts=heavy, grows=True)
    assert joined.agg(F.count(F.lit(1)), F.sum("s")).first() == totals.join(rows, "k").agg(F.count(F.lit(1)), F.sum("s")).first()
    salted = rows.where("k = 'hot'").select(keyed._row_salt(rows, ["k"], heavy.salts(["k"])).alias("salt")).groupBy("salt").count().collect()
    assert len(salted) == 10 and max(r["count"] for r in salted) < 2 * 3000
    assert "Generate explode(sequence(0," in plan(joined)
    even = spark.range(1000).withColumnRenamed("id", "k")
    assert keyed.heavy_keys(even, ["k"], tasks=30) == {} and keyed.heavy_keys(even.limit(0), ["k"]) == {}
    unsalted = keyed.join_totals(even, even.groupBy("k").count(), ["k"], salts=keyed.heavy_keys(even, ["k"], 30), grows=True)
    assert "Generate" not in plan(unsalted)
    with_null = spark.createDataFrame([(None, 1.0)] * 40 + [("a", 1.0)] * 2, "k string, v double")
    shares = keyed.share_of_total(with_null, ["k"], {"v": "s"}, salts=keyed.heavy_keys(with_null, ["k"], 8))
    assert sorted({(r.k or "", r.s) for r in shares.collect()}) == [("", 0.025), ("a", 0.5)]


def test_allocation_plan_has_few_exchanges(spark, sf):
    from skyledger.plans import all_queries

    # the shares are stored; what is left is the sum of the lines and one join
    assert plan(all_queries()["x05_allocate_with_residual"].run(spark, sf)).count("Exchange ") <= 5


def test_clustered_lineage_moves_and_sorts_nothing(spark, tmp_path):
    from skyledger.operators import inventory
    from skyledger.sources import clustered

    rows = spark.range(3000).select(
        F.lit("self").alias("owner_id"), F.concat(F.lit("v"), (F.col("id") % 40).cast("string")).alias("volume_id"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("snapshot_id"),
        (F.col("id") * 7919 % 100).alias("start_time"), F.lit(3).alias("volume_size"),
    )
    name = "skyledger_test_clustered"
    table = clustered.write_clustered(rows, name, str(tmp_path / "t"), ["volume_id"], inventory.SNAPSHOT_ORDER, buckets=4)
    changed = rows.select("volume_id", "snapshot_id").where("start_time % 2 = 0")
    with clustered.clustered_plans(spark):
        out = inventory.clustered_increment(table, changed)
        big, small = plan(out).split("ShuffledHashJoin", 1)[1].split("Exchange", 1)
        assert "Sort" not in big and "Window" in big and "Exchange" in "Exchange" + small
        got = {r.snapshot_id: (r.previous_snapshot_id, r.increment_bytes) for r in out.collect()}
    want = {}
    for v in range(40):
        chain = sorted((i * 7919 % 100, f"s{i}") for i in range(v, 3000, 40))
        for (_, before), (at, snap) in zip([(0, None), *chain], chain, strict=False):
            want[snap] = (before or inventory.FIRST_SNAPSHOT, 3 << 30 if before is None else (inventory.BLOCK_BYTES if at % 2 == 0 else 0))
    assert got == want
    assert spark.conf.get("spark.sql.requireAllClusterKeysForCoPartition") == "true"
    assert clustered.out_of_order(table, ["volume_id", *inventory.SNAPSHOT_ORDER]).count() == 0
    mixed = str(tmp_path / "mixed")
    rows.coalesce(1).write.parquet(mixed)
    assert clustered.out_of_order(spark.read.parquet(mixed), ["start_time"]).count() > 0
    spark.sql(f"DROP TABLE {name}")
