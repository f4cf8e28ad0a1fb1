"""Source and sink queries: write a derived table through a sink, read it back through its source."""

from __future__ import annotations

import time
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.numbers import tidy
from skyledger.operators import cost, inventory, logs, rollup
from skyledger.plans import bindings as b
from skyledger.plans.inventory_queries import subnets
from skyledger.plans.registry import query
from skyledger.session import scratch_path
from skyledger.sources import ledger as ld
from skyledger.sources import readers, writers
from skyledger.sources.files import list_files


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return b.table(spark, sf_dir, name)


@query(
    "s01_s10_partitioned_table",
    "SELECT cast(year(o_orderdate) AS VARCHAR) AS year, cast(month(o_orderdate) AS VARCHAR) AS month, count(*) AS orders FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 3 GROUP BY 1, 2",
)
def s10(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders-by-month")
    orders = t(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate").cast("string")).withColumn("month", F.month("o_orderdate").cast("string"))
    writers.write_partitions(orders, path, ["year", "month"])
    # A second run of one month replaces that partition only.
    writers.write_partitions(orders.where((F.col("year") == "1997") & (F.col("month") == "3")), path, ["year", "month"])
    month = readers.read_partition(spark, path, "1997", "03")
    return month.groupBy("year", "month").agg(F.count(F.lit(1)).alias("orders"))


@query(
    "s04_json_records",
    "SELECT event_id, epoch_us(ts) // 1000000 AS seconds, value FROM events",
)
def s04(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "records")
    rows = t(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"), "value")
    writers.write_json_lines(rows, path)
    back = readers.read_records(spark, path, "event_id bigint, date string, value double")
    return back.select("event_id", F.unix_seconds("date").alias("seconds"), "value")


@query("s05_json_lines", "SELECT event_id, event_type, value FROM events")
def s05(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "lines")
    writers.write_json_lines(t(spark, sf_dir, "events").select("event_id", "event_type", "value"), path)
    return readers.read_json_lines(spark, path, "event_id bigint, event_type string, value double")


@query(
    "s06_gzip_text_lines",
    "SELECT length(line) AS line_length, count(*) AS lines FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1",
)
def s06(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "gzip")
    rows = t(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("line")).select(F.replace("line", F.lit("\r"), F.lit(" ")).alias("line"))
    writers.write_metric_log(rows, path)
    lines = readers.read_lines(spark, path)
    return lines.groupBy(F.length("line").cast("long").alias("line_length")).agg(F.count(F.lit(1)).alias("lines"))


@query(
    "s07_audit_documents",
    "SELECT 'u' || user_id AS user_name, event_type AS event_name, count(*) AS records FROM events GROUP BY 1, 2",
)
def s07(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "audit")
    record = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("eventTime"), F.col("event_type").alias("eventName"),
        F.struct(F.lit("IAMUser").alias("type"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("userName")).alias("userIdentity"),
    )
    documents = t(spark, sf_dir, "events").groupBy("user_id", F.to_date("ts").alias("d")).agg(F.collect_list(record).alias("Records")).select("Records")
    documents.write.option("compression", "gzip").json(f"{root}/CloudTrail/one")
    documents.write.option("compression", "gzip").json(f"{root}/Other/two")
    back = readers.read_audit(spark, root, multi_line=False)
    return back.groupBy("user_name", "event_name").agg(F.count(F.lit(1)).alias("records"))


@query(
    "s07_audit_open_types",
    """SELECT event_type AS event_name, CASE WHEN user_id % 2 = 0 THEN 'u' || user_id END AS user_name, CASE WHEN user_id % 2 = 0 THEN user_id END AS number, count(*) AS records FROM events GROUP BY 1, 2, 3""",
)
def s07_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In half of the documents the identity is a text instead of an object, and all have fields that no schema names."""
    root = scratch_path(spark, "audit")
    who = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    fields = [stamp.alias("eventTime"), F.col("event_type").alias("eventName")]
    sound = F.struct(*fields, F.struct(F.lit("IAMUser").alias("type"), who.alias("userName")).alias("userIdentity"), F.struct(F.col("user_id").alias("n")).alias("extra"))
    odd = F.struct(*fields, F.concat(F.lit("text "), who).alias("userIdentity"), F.array(F.lit("list")).alias("extra"))
    days = t(spark, sf_dir, "events").withColumn("d", F.to_date("ts"))
    for name, rows, record in (("sound", "user_id % 2 = 0", sound), ("odd", "user_id % 2 = 1", odd)):
        documents = days.where(rows).groupBy("user_id", "d").agg(F.collect_list(record).alias("Records")).select("Records")
        documents.write.json(f"{root}/CloudTrail/{name}")
    back = readers.read_audit_variant(spark, root, multi_line=False)
    number = F.try_variant_get("record", "$.extra.n", "bigint")
    return back.groupBy("event_name", "user_name", number.alias("number")).agg(F.count(F.lit(1)).alias("records"))


@query(
    "s08_s09_i05_snapshots",
    """SELECT 'subnet-' || n_nationkey AS id, cast(n_nationkey * 10 AS INTEGER) AS available_ip_count, n_nationkey % 2 = 0 AS map_public_ip, region FROM nation, (SELECT unnest(['r1', 'r2']) AS region)""",
)
def s08(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "snapshots")
    rows = subnets(spark, sf_dir).select("id", "available_ip_count", "map_public_ip")
    # An older day without one column, then two regions of the wanted day; the second write of r1 replaces the first.
    writers.write_snapshot(rows.drop("map_public_ip"), root, "r1", date(2024, 1, 1))
    writers.write_snapshot(rows.unionByName(rows), root, "r1", date(2024, 1, 2))
    writers.write_snapshot(rows, root, "r1", date(2024, 1, 2))
    writers.write_snapshot(rows, root, "r2", date(2024, 1, 2))
    day = readers.snapshot_day(readers.read_snapshots(spark, root), datetime(2024, 1, 2))
    return day.select("id", "available_ip_count", "map_public_ip", "region")


@query("s11_named_stages", "SELECT 'lines' AS stage, count(*) AS \"rows\" FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders")
def s11(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "stages")
    stages = {
        "lines": t(spark, sf_dir, "lineitem").select("l_orderkey", F.year("l_shipdate").cast("string").alias("year")),
        "orders": t(spark, sf_dir, "orders").select("o_orderkey"),
    }
    writers.write_stages(stages, root)
    counts = [spark.read.parquet(f"{root}/{name}").agg(F.lit(name).alias("stage"), F.count(F.lit(1)).alias("rows")) for name in stages]
    return counts[0].select("stage", "rows").unionByName(counts[1].select("stage", "rows"))


@query("s12_index_folders", "SELECT 'ev-' || strftime(ts, '%Y-%m-%d') AS index, count(*) AS records, round(sum(value), 4) + 0 AS total FROM events GROUP BY 1")
def s12(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "index")
    rows = rollup.day_index(t(spark, sf_dir, "events").select("ts", "event_id", "value"), F.col("ts"), "ev-")
    writers.write_by_index(rows.drop("ts"), path)
    back = spark.read.schema("event_id bigint, value double, index string").json(path)
    return back.groupBy("index").agg(F.count(F.lit(1)).alias("records"), tidy(F.sum("value"), 4).alias("total"))


@query(
    "s13_failed_records",
    "SELECT 'good' AS kind, count(*) AS records FROM events WHERE event_type <> 'error' UNION ALL SELECT 'failed', count(*) FROM events WHERE event_type = 'error'",
)
def s13(spark: SparkSession, sf_dir: str) -> DataFrame:
    good_path, failed_path = scratch_path(spark, "good"), scratch_path(spark, "failed")
    stamp = F.when(F.col("event_type") == "error", F.lit("2024-99-99T00:00:00.000Z")).otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    lines = t(spark, sf_dir, "events").select(F.concat_ws(" ", stamp, F.col("user_id").cast("string"), "event_type").alias("line"))
    writers.write_delivery(logs.parse_mysql_general(lines, "db"), good_path, failed_path)
    good = spark.read.schema("command string").json(good_path).agg(F.lit("good").alias("kind"), F.count(F.lit(1)).alias("records"))
    failed = spark.read.text(failed_path).agg(F.lit("failed").alias("kind"), F.count(F.lit(1)).alias("records"))
    return good.unionByName(failed)


@query("s15_changed_files", "SELECT count(*) AS lines FROM events WHERE event_type = 'click'")
def s15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of an earlier load are not read again. File times count in seconds, hence the pause before the mark."""
    path = scratch_path(spark, "changed")
    rows = t(spark, sf_dir, "events").select("event_type")
    rows.write.text(path)
    time.sleep(1.1)
    mark = datetime.now(UTC)
    rows.where("event_type = 'click'").write.mode("append").text(path)
    return readers.changed_files(spark, path, mark, 1, "txt$").agg(F.count(F.lit(1)).alias("lines"))


@query(
    "s16_archive_layout",
    "SELECT strftime(o_orderdate, '%Y') || '-01-01' AS date, 'db-' || (o_custkey % 3) AS instance, count(*) AS lines FROM orders GROUP BY 1, 2",
)
def s16(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archive")
    rows = t(spark, sf_dir, "orders").select(
        F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-01-01")).alias("date"), F.concat(F.lit("db-"), (F.col("o_custkey") % 3).cast("string")).alias("instance"),
        F.lit("b1").alias("backup"), F.col("o_orderkey").cast("string").alias("line"),
    )
    writers.write_archive(rows, path)
    back = spark.read.schema("value string, date string, instance string, backup string").text(path)
    return back.groupBy("date", "instance").agg(F.count(F.lit(1)).alias("lines"))


@query(
    "s17_refresh",
    "WITH m AS (SELECT cast(date_trunc('month', o_orderdate) AS DATE) AS day FROM orders) SELECT day, count(*) * CASE WHEN day >= DATE '2001-07-20' - 35 THEN 1 ELSE 2 END AS orders FROM m GROUP BY day",
)
def s17(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "refresh")
    orders = t(spark, sf_dir, "orders").select("o_orderkey", F.trunc("o_orderdate", "month").alias("day"))
    writers.write_partitions(orders.unionByName(orders), path, ["day"])
    writers.refresh(orders, path, "day", date(2001, 7, 20))
    back = spark.read.schema("o_orderkey bigint, day date").parquet(path)
    return back.groupBy("day").agg(F.count(F.lit(1)).alias("orders"))


@query(
    "s17_refresh_removes_days",
    """WITH m AS (SELECT cast(date_trunc('week', o_orderdate) AS DATE) AS day FROM orders)
      SELECT day, count(*) * CASE WHEN day >= DATE '2001-07-20' - 35 THEN 1 ELSE 2 END AS orders FROM m WHERE day < DATE '2001-07-20' - 35 OR day(day) % 2 = 0 GROUP BY day""",
)
def s17_removes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In the window only even days are left in the source; odd ones disappear, days before the window stay."""
    path = scratch_path(spark, "refresh")
    orders = t(spark, sf_dir, "orders").select("o_orderkey", F.to_date(F.date_trunc("week", "o_orderdate")).alias("day"))
    writers.write_partitions(orders.unionByName(orders), path, ["day"])
    writers.refresh(orders.where(F.dayofmonth("day") % 2 == 0), path, "day", date(2001, 7, 20))
    back = spark.read.schema("o_orderkey bigint, day date").parquet(path)
    return back.groupBy("day").agg(F.count(F.lit(1)).alias("orders"))


@query(
    "s19_registered_catalog",
    "SELECT r_name, count(*) AS nations FROM nation JOIN region ON r_regionkey = n_regionkey GROUP BY 1",
)
def s19(spark: SparkSession, sf_dir: str) -> DataFrame:
    readers.register(spark, skyledger_nation=t(spark, sf_dir, "nation"), skyledger_region=t(spark, sf_dir, "region"))
    return spark.sql(
        "SELECT r_name, count(*) AS nations FROM skyledger_nation JOIN skyledger_region ON r_regionkey = n_regionkey GROUP BY r_name"
    )


@query("j08_text_tag_rows", "SELECT n_nationkey, n_name AS name FROM nation WHERE n_nationkey % 5 <> 4")
def j08(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inventory.text_tag_rows(subnets(spark, sf_dir), ["id"], "Name", "name")
    return rows.select(F.substring("id", 8, 10).cast("int").alias("n_nationkey"), "name")


@query("s15_t06_file_ledger", "SELECT event_type, CASE WHEN event_id % 3 = 0 THEN 0 WHEN event_id % 3 = 1 THEN 1 ELSE 2 END AS run, count(*) AS lines FROM events GROUP BY 1, 2")
def s15_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries within seconds. The second run is lost after its write and done again; a run too many finds nothing."""
    source, out, root = (scratch_path(spark, n) for n in ("arrivals", "picked", "ledger"))
    events = t(spark, sf_dir, "events").select("event_id", "event_type")
    book = ld.FileLedger(spark, root)

    def take(run: int) -> DataFrame:
        return ld.read_planned(book, run, ld.read_lines_since(book, run, source)).select(F.col("line").alias("event_type"))

    for delivery in range(3):
        events.where(F.col("event_id") % 3 == delivery).select("event_type").write.mode("append").text(source)
        files = list_files(spark, source).where(F.col("size") > 0)
        run = book.begin(files)
        ld.write_run(take(run), out, run)
        if delivery == 1:  # lost before the commit; what comes next is the same run with the same files
            events.where("false").select("event_type").write.mode("append").text(source)
            run = book.begin(files)
            ld.write_run(take(run), out, run)
        book.commit(run)
    assert book.begin(list_files(spark, source).where(F.col("size") > 0)) is None
    return ld.committed_rows(book, out, "event_type string").groupBy("event_type", "run").agg(F.count(F.lit(1)).alias("lines"))
