"""Queries over the column expressions: filters, classifiers, tags, time, text, network, rank and top-n forms."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions import network, text, timefns
from skyledger.functions.numbers import ratio, text_number, tidy
from skyledger.operators import allocation, cost, keyed, metrics
from skyledger.plans import bindings as b
from skyledger.plans.bindings_sql import SAMPLES
from skyledger.plans.registry import query
from skyledger.sources.readers import month_of


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return b.table(spark, sf_dir, name)


@query(
    "s02_trailing_months",
    "SELECT count(*) AS orders, min(o_orderdate)::DATE AS first_day FROM orders WHERE o_orderdate >= DATE '2001-11-01' - INTERVAL 24 MONTH",
)
def s02(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = cost.trailing_months(t(spark, sf_dir, "orders"), "o_orderdate", 24, date(2001, 11, 30))
    return recent.agg(F.count(F.lit(1)).alias("orders"), F.to_date(F.min("o_orderdate")).alias("first_day"))


@query(
    "s03_previous_month",
    """SELECT cast(year(o_orderdate - INTERVAL 1 MONTH) AS VARCHAR) AS year, cast(month(o_orderdate - INTERVAL 1 MONTH) AS VARCHAR) AS month, count(*) AS orders
      FROM orders GROUP BY 1, 2""",
)
def s03(spark: SparkSession, sf_dir: str) -> DataFrame:
    year, month = timefns.previous_month("o_orderdate")
    return t(spark, sf_dir, "orders").groupBy(year.alias("year"), month.alias("month")).agg(F.count(F.lit(1)).alias("orders"))


@query(
    "s01_month_partition",
    "SELECT cast(o_orderdate AS DATE) AS day, count(*) AS orders FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 3 GROUP BY 1",
)
def s01(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = t(spark, sf_dir, "orders").select(
        F.year("o_orderdate").cast("string").alias("year"), F.month("o_orderdate").cast("string").alias("month"),
        F.to_date("o_orderdate").alias("day"),
    )
    return month_of(orders, "1997", "03").groupBy("day").agg(F.count(F.lit(1)).alias("orders"))


@query(
    "s17_look_back_days",
    "SELECT cast(o_orderdate AS DATE) AS day, round(sum(o_totalprice), 4) + 0 AS total FROM orders WHERE o_orderdate >= DATE '2001-07-20' - 35 GROUP BY 1",
)
def s17(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = cost.look_back(t(spark, sf_dir, "orders"), "o_orderdate", date(2001, 7, 20))
    return recent.groupBy(F.to_date("o_orderdate").alias("day")).agg(tidy(F.sum("o_totalprice"), 4).alias("total"))


@query(
    "p13_p14_order_classes",
    """SELECT CASE WHEN o_orderpriority LIKE '%URGENT%' THEN 'now' WHEN o_orderpriority LIKE '%HIGH%' THEN 'soon' WHEN o_orderpriority LIKE '%NOT%SPECIFIED%' THEN 'open' ELSE 'other' END AS class,
      CASE WHEN p_type LIKE '%O%' AND p_type LIKE '%M%' THEN 'om' WHEN p_type LIKE '%S%' THEN 's' ELSE '-' END AS kind, count(*) AS lines
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
)
def p13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = (
        t(spark, sf_dir, "lineitem")
        .join(t(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    urgency = cost._first_match("o_orderpriority", [("URGENT", "now"), ("HIGH", "soon"), ("NOT&SPECIFIED", "open")], F.lit("other"))
    kind = cost._first_match("p_type", [("O&M", "om"), ("S", "s")], F.lit("-"))
    return rows.groupBy(urgency.alias("class"), kind.alias("kind")).agg(F.count(F.lit(1)).alias("lines"))


@query(
    "p15_split_line_rule",
    """SELECT l_returnflag, round(sum(CASE WHEN l_linenumber = 6 THEN l_extendedprice * 0.75 WHEN l_linenumber = 5 AND (p_type = 'SMALL' OR p_type = 'MEDIUM' OR p_type = 'PROMO') THEN 0 ELSE l_extendedprice END), 4) + 0 AS total
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def p15(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skyledger.functions import billing

    flags = b.billing_lines(spark, sf_dir)
    klass = billing.charge_class(billing.DASHBOARD_SPLIT)
    kind = F.col("line_item_line_item_type")
    flag = F.when(kind.isin("DiscountedUsage", "SavingsPlanRecurringFee"), "A").when(kind.isin("RIFee", "EdpDiscount"), "R").otherwise("N")
    price = F.col("savings_plan_recurring_commitment_for_billing_period") * 2
    value = F.when(klass == "split", F.col("split_line_item_split_cost") + F.col("split_line_item_unused_cost")).when(
        F.length("resource_tags_aws_eks_cluster_name") > 0,
        F.when(F.col("line_item_usage_type").contains("BoxUsage") | F.col("line_item_usage_type").contains("SpotUsage"), 0.0).otherwise(price),
    ).otherwise(price)
    return flags.groupBy(flag.alias("l_returnflag")).agg(tidy(F.sum(value), 4).alias("total"))


@query("p16_blank_strings", "SELECT coalesce(nullif(p_type, 'PROMO'), '') AS p_type, count(*) AS parts FROM part GROUP BY 1")
def p16(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = t(spark, sf_dir, "part").select(F.nullif("p_type", F.lit("PROMO")).alias("p_type"))
    return keyed.blank_strings(parts).groupBy("p_type").agg(F.count(F.lit(1)).alias("parts"))


@query(
    "p18_line_class",
    """SELECT cast(CASE WHEN l_returnflag = 'A' AND p_type IN ('SMALL', 'MEDIUM', 'PROMO') THEN 1 WHEN l_returnflag = 'A' AND p_type = 'LARGE' THEN 2 ELSE 0 END AS INTEGER) AS class, count(*) AS lines
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1""",
)
def p18(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t(spark, sf_dir, "lineitem").join(t(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    charged = rows.withColumn("charge_type", F.when(F.col("l_returnflag") == "A", F.lit("Usage")).otherwise(F.lit("Fee")))
    return charged.withColumn("usage_type", b.usage_type()).groupBy(allocation.line_class().alias("class")).agg(
        F.count(F.lit(1)).alias("lines")
    )


@query(
    "p19_cpu_weight",
    "SELECT p_partkey, round(CASE WHEN p_size % 5 = 0 THEN 0.5 ELSE 9.0 * p_size / (9.0 * p_size + p_retailprice) END, 9) + 0 AS weight FROM part",
)
def p19(spark: SparkSession, sf_dir: str) -> DataFrame:
    empty = F.col("p_size") % 5 == 0
    parts = t(spark, sf_dir, "part").select(
        "p_partkey",
        F.when(empty, 0.0).otherwise(F.col("p_size").cast("double")).alias("vcpus"),
        F.when(empty, 0.0).otherwise(F.col("p_retailprice")).alias("memory_gb"),
    )
    return parts.select("p_partkey", tidy(allocation.cpu_weight(), 9).alias("weight"))


@query(
    "p20_p22_composite_ids",
    """WITH e AS (SELECT event_id, json_extract_string(props, '$.k') AS k, event_type, user_id FROM events)
      SELECT event_id, CASE WHEN user_id % 2 = 0 THEN 'i-' || k ELSE 'j-' || k END || ':pod/c/' || event_type || '/' || user_id AS resource_id,
        CASE WHEN user_id % 3 = 0 THEN 'a' || user_id WHEN user_id % 3 = 1 THEN 'n' || user_id ELSE '' END AS app FROM e""",
)
def p20(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    node = F.when(
        F.col("user_id") % 2 == 0, F.concat(F.lit('{"d1":"i-'), k, F.lit('","d2":"x"}'))
    ).otherwise(F.concat(F.lit('{"d1":"","d2":"j-'), k, F.lit('"}')))
    labels = F.when(
        F.col("user_id") % 3 == 0, F.create_map(F.lit("label_app"), F.concat(F.lit("a"), F.col("user_id").cast("string")))
    ).when(
        F.col("user_id") % 3 == 1, F.create_map(F.lit("label_name"), F.concat(F.lit("n"), F.col("user_id").cast("string")))
    ).otherwise(F.create_map(F.lit("other"), F.lit("x")))
    events = t(spark, sf_dir, "events").withColumn("node", node).withColumn("labels", labels)
    instance = text.node_id("node", "d1", "d2")
    return events.select(
        "event_id",
        text.workload_id(instance, F.lit("c"), "event_type", F.col("user_id").cast("string")).alias("resource_id"),
        text.first_label("labels", "label_app", "label_name").alias("app"),
    )


@query("p23_usage_day", "SELECT event_id, cast(ts - INTERVAL 1 DAY AS DATE) AS day FROM events")
def p23(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "events").select("event_id", timefns.usage_day("ts").alias("day"))


@query(
    "p26_p29_tag_lookup",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS project, CASE WHEN c_custkey % 4 <> 0 THEN c_name END AS name,
      cast(CASE WHEN c_nationkey = 7 THEN NULL ELSE 2 END AS INTEGER) AS tag_count, 'subnet-' || c_nationkey AS subnet FROM customer""",
)
def p26(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = t(spark, sf_dir, "customer")
    project = F.when(F.col("c_custkey") % 3 != 0, F.lit("Project")).otherwise(F.lit("Other"))
    structs = F.array(
        F.struct(F.lit("Owner").alias("key"), F.col("c_name").alias("value")),
        F.struct(project.alias("key"), F.col("c_mktsegment").alias("value")),
    )
    label = F.when(F.col("c_custkey") % 4 != 0, F.lit("Name:")).otherwise(F.lit("Zone:"))
    texts = F.array(F.lit("Env:x"), F.concat(label, F.col("c_name")))
    rows = c.withColumn("tags", structs).withColumn("labels", texts)
    counted = F.when(F.col("c_nationkey") != 7, F.col("tags"))
    target = text.association_target(F.concat(F.lit("subnet-"), F.col("c_nationkey").cast("string"), F.lit(":assoc:x")))
    return rows.select(
        "c_custkey",
        text.struct_tag("tags", "Project").alias("project"),
        text.text_tag("labels", "Name").alias("name"),
        text.array_length(counted).cast("int").alias("tag_count"),
        target.alias("subnet"),
    )


@query(
    "p30_epoch_conversions",
    "SELECT event_id, cast(floor(epoch(ts)) AS BIGINT) AS seconds, cast(epoch_us(ts) // 1000 AS BIGINT) AS millis, strftime(make_timestamp(cast(floor(epoch(ts)) AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S') AS rendered FROM events",
)
def p30(spark: SparkSession, sf_dir: str) -> DataFrame:
    seconds = timefns.epoch_seconds("ts")
    return t(spark, sf_dir, "events").select(
        "event_id",
        seconds.alias("seconds"),
        timefns.epoch_millis("ts").alias("millis"),
        F.from_unixtime(seconds).alias("rendered"),
    )


@query(
    "p31_local_time",
    "SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%S') || '+0800' AS stamp, strftime(ts + INTERVAL 8 HOUR, '%H:%M:%S') AS clock FROM events",
)
def p31(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "events").select(
        "event_id", timefns.local_stamp("ts").alias("stamp"), timefns.local_clock("ts").alias("clock")
    )


@query(
    "p32_rfc1123_time",
    "SELECT event_id, cast(floor(epoch(ts)) AS BIGINT) AS seconds FROM events",
)
def p32(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    return t(spark, sf_dir, "events").select("event_id", F.unix_seconds(timefns.rfc1123(written)).alias("seconds"))


@query(
    "p34_receiver_default",
    "SELECT event_type, coalesce(CASE WHEN user_id % 2 = 0 THEN 'team-' || event_type END, 'all') AS receiver, count(*) AS events FROM events GROUP BY 1, 2",
)
def p34(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skyledger.operators.notify import addressed

    rows = t(spark, sf_dir, "events").select(
        "event_type", F.lit("x").alias("message"), F.lit("none").alias("route"),
        F.when(F.col("user_id") % 2 == 0, F.concat(F.lit("team-"), F.col("event_type"))).alias("receiver"),
    )
    return addressed(rows).groupBy("event_type", "receiver").agg(F.count(F.lit(1)).alias("events"))


@query(
    "p36_address_count",
    """SELECT s_suppkey, cast(pow(2, 32 - (16 + s_nationkey % 13)) AS BIGINT) AS addresses,
      cast(base - (base % cast(pow(2, 16 - s_nationkey % 13) AS BIGINT)) AS BIGINT) AS first_address FROM (SELECT *, 167772160 + (s_suppkey % 65536) * 256 AS base FROM supplier)""",
)
def p36(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = t(spark, sf_dir, "supplier")
    base = F.lit(167772160) + (F.col("s_suppkey") % 65536) * 256
    cidr = F.concat(network.ip_text(base), F.lit("/"), (16 + F.col("s_nationkey") % 13).cast("string"))
    return s.select(
        "s_suppkey",
        network.cidr_size(cidr).alias("addresses"),
        (network.cidr_end(cidr) - network.cidr_size(cidr) + F.lit(1)).alias("first_address"),
    )


@query(
    "p37_file_name_parts",
    "SELECT event_id, 'acct' || user_id AS account, event_type AS region, 'c' || (user_id % 7) AS cluster FROM events",
)
def p37(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id").cast("string")
    path = F.concat(
        F.lit("s3/logs/acct"), user, F.lit("_redshift_"), F.col("event_type"), F.lit("_c"),
        (F.col("user_id") % 7).cast("string"), F.lit("_useractivitylog_x.gz"),
    )
    return t(spark, sf_dir, "events").withColumn("path", path).select(
        "event_id",
        text.file_name_part("path", 0).alias("account"),
        text.file_name_part("path", 2).alias("region"),
        text.file_name_part("path", 3).alias("cluster"),
    )


@query(
    "p38_url_decode",
    "SELECT page_id, url AS decoded, split_part(split_part(url, '://', 2), '/', 1) AS host FROM pages",
)
def p38(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = t(spark, sf_dir, "pages").withColumn("coded", F.url_encode("url"))
    host = F.split(F.split(text.decoded_key("coded"), "://")[1], "/")[0]
    return coded.select("page_id", text.decoded_key("coded").alias("decoded"), host.alias("host"))


@query(
    "p35_disk_fields",
    "SELECT event_id, '/dev/nvme' || event_type AS base, cast(nullif(user_id % 10, 0) AS VARCHAR) AS part, right(event_type, 1) AS letter, left(event_type, 1) AS drive FROM events",
)
def p35(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.col("user_id") % 10
    device = F.concat(F.lit("nvme"), F.col("event_type"), F.when(part == 0, F.lit("")).otherwise(part.cast("string")))
    return t(spark, sf_dir, "events").withColumn("device", device).select(
        "event_id",
        text.base_device("device").alias("base"),
        text.partition_number("device").alias("part"),
        text.device_letter("device").alias("letter"),
        text.drive_letter("event_type").alias("drive"),
    )


@query(
    "p40_sorted_aliases",
    "SELECT n_regionkey, string_agg(n_name, '/' ORDER BY n_name) AS aliases FROM nation GROUP BY 1",
)
def p40(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = t(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.collect_list("n_name").alias("names"))
    return names.select("n_regionkey", text.joined_sorted("names").alias("aliases"))


@query(
    "p41_volume_operation",
    """SELECT CASE WHEN l_returnflag = 'A' THEN CASE WHEN l_linenumber > 1 THEN 'reattach' ELSE 'attach' END WHEN l_returnflag = 'R' THEN CASE WHEN l_linenumber > 1 THEN 'detach' ELSE 'detachlast' END END AS operation, count(*) AS lines FROM lineitem GROUP BY 1""",
)
def p41(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skyledger.operators.events import volume_operation

    name = F.when(F.col("l_returnflag") == "A", "AttachVolume").when(F.col("l_returnflag") == "R", "DetachVolume").otherwise("Other")
    return t(spark, sf_dir, "lineitem").groupBy(volume_operation(name, "l_linenumber").alias("operation")).agg(
        F.count(F.lit(1)).alias("lines")
    )


@query(
    "p43_run_month",
    "SELECT cast(o_orderdate AS DATE) AS day, strftime(date_trunc('month', o_orderdate) - INTERVAL 2 DAY, '%Y') AS year, strftime(date_trunc('month', o_orderdate) - INTERVAL 2 DAY, '%m') AS month, count(*) AS orders FROM orders GROUP BY 1, 2, 3",
)
def p43(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = t(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("day"))
    span = orders.agg(F.min("day").alias("a"), F.max("day").alias("b")).first()  # one row
    months = [date(y, m, 1) for y in range(span["a"].year, span["b"].year + 1) for m in range(1, 13)]
    runs = [(day, *timefns.run_month(as_of=day.replace(day=17))) for day in months]
    known = spark.createDataFrame(runs, "_month date, year string, month string")
    return (
        orders.withColumn("_month", F.trunc("day", "month").cast("date")).join(known, "_month")
        .groupBy("day", "year", "month").agg(F.count(F.lit(1)).alias("orders"))
    )


@query(
    "f03_quiet_hours",
    "SELECT strftime(ts + INTERVAL 8 HOUR, '%H:%M:%S') >= '08:00' AND strftime(ts + INTERVAL 8 HOUR, '%H:%M:%S') < '23:00' AS awake, count(*) AS events FROM events GROUP BY 1",
)
def f03(spark: SparkSession, sf_dir: str) -> DataFrame:
    awake = timefns.in_quiet_window(timefns.local_clock("ts"))
    return t(spark, sf_dir, "events").groupBy(awake.alias("awake")).agg(F.count(F.lit(1)).alias("events"))


_IP = "(user_id * 2654435761 + event_id * 40503) % 4294967296"


@query(
    "f06_trusted_address",
    f"""WITH e AS (SELECT event_id, {_IP} AS n FROM events) SELECT event_id, (n BETWEEN 0 AND 1073741823) OR (n BETWEEN 2147483648 AND 2281701375) AS trusted FROM e""",
)
def f06(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.pmod(F.col("user_id") * F.lit(2654435761) + F.col("event_id") * F.lit(40503), F.lit(4294967296))
    rows = t(spark, sf_dir, "events").withColumn("ip", network.ip_text(n))
    return rows.select("event_id", network.in_any_cidr("ip", ["0.0.0.0/2", " 128.0.0.0/5 ", ""]).alias("trusted"))


@query(
    "f07_allow_list",
    "SELECT event_type, count(*) AS events FROM events WHERE user_id NOT IN (1, 2, 3, 5, 8, 13) GROUP BY 1",
)
def f07(spark: SparkSession, sf_dir: str) -> DataFrame:
    outside = t(spark, sf_dir, "events").where(~F.col("user_id").isin(1, 2, 3, 5, 8, 13))
    return outside.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))


@query(
    "f08_f09_document_lines",
    "WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) SELECT doc_id, count(*) AS lines FROM l WHERE NOT starts_with(line, '#') AND length(line) >= 10 AND contains(line, 'the') GROUP BY 1",
)
def f08(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skyledger.operators import logs

    lines = t(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return logs.lines_with(logs.cdn_lines(lines), "the").groupBy("doc_id").agg(F.count(F.lit(1)).alias("lines"))


@query(
    "s20_deduplicated_samples",
    f"WITH {SAMPLES}, d AS (SELECT DISTINCT resource_id, metric, cast(floor(epoch(ts) / 3600) AS BIGINT) AS h FROM samples) SELECT metric, count(*) AS n FROM d GROUP BY 1",
)
def s20(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = b.event_samples(spark, sf_dir).select(
        "resource_id", "metric", F.floor(F.col("epoch") / 3600).cast("long").alias("h")
    )
    twice = hours.unionByName(hours)
    unique = metrics.drop_repeated_samples(twice, ["resource_id", "metric"], "h")
    return unique.groupBy("metric").agg(F.count(F.lit(1)).alias("n"))


@query(
    "w01_rank_first_with_ties",
    """SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority DESC) AS r FROM orders) WHERE r = 1""",
)
def w01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed.keep_greatest(t(spark, sf_dir, "orders"), ["o_custkey"], "o_orderpriority").select(
        "o_custkey", "o_orderkey", "o_orderpriority"
    )


@query(
    "w02_share_of_group",
    "SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice / sum(l_extendedprice) OVER (PARTITION BY l_suppkey, l_returnflag), 9) + 0 AS share FROM lineitem",
)
def w02(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, keys = t(spark, sf_dir, "lineitem"), ["l_suppkey", "l_returnflag"]
    shares = keyed.share_of_total(lines, keys, {"l_extendedprice": "share"}, salts=keyed.heavy_keys(lines, keys))
    return shares.select("l_orderkey", "l_linenumber", "l_partkey", tidy("share", 9).alias("share"))


@query(
    "j02_w02_measured_salts",
    """WITH k AS (SELECT *, CASE WHEN l_returnflag = 'R' THEN 'hot' WHEN l_suppkey % 7 <> 0 THEN l_suppkey || '' END AS owner FROM lineitem)
      SELECT l_orderkey, l_linenumber, owner, round(l_extendedprice / sum(l_extendedprice) OVER (PARTITION BY owner), 9) + 0 AS share FROM k""",
)
def j02_measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One owner holds a quarter of the rows and none holds a tenth: these two are salted by their share, the others not at all."""
    owner = F.when(F.col("l_returnflag") == "R", F.lit("hot")).when(F.col("l_suppkey") % 7 != 0, F.col("l_suppkey").cast("string"))
    lines = t(spark, sf_dir, "lineitem").withColumn("owner", owner)
    shares = keyed.share_of_total(lines, ["owner"], {"l_extendedprice": "share"}, salts=keyed.heavy_keys(lines, ["owner"], tasks=64))
    return shares.select("l_orderkey", "l_linenumber", "owner", tidy("share", 9).alias("share"))


@query(
    "w07_carried_lag",
    "SELECT event_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM events",
)
def w07(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = t(spark, sf_dir, "events")
    day = F.to_date("ts")
    return keyed.carried_lag(rows, ["user_id"], ["ts", "event_id"], "event_type", "previous", day).select("event_id", "previous")


@query(
    "o01_sorted_lineage",
    "SELECT o_custkey, o_orderkey, o_orderdate::DATE AS day FROM orders ORDER BY o_custkey, o_orderdate, o_orderkey",
)
def o01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day")).orderBy(
        "o_custkey", "day", "o_orderkey"
    )


@query(
    "o02_latest_three_points",
    """WITH r AS (SELECT user_id, event_type, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) AS n FROM events)
      SELECT user_id, event_type, coalesce(max(CASE WHEN n = 1 THEN value END), 0) + 0 AS v0, coalesce(max(CASE WHEN n = 2 THEN value END), 0) + 0 AS v1, coalesce(max(CASE WHEN n = 3 THEN value END), 0) + 0 AS v2 FROM r WHERE n <= 3 GROUP BY 1, 2""",
)
def o02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.latest_points(t(spark, sf_dir, "events"), ["user_id", "event_type"], 3, "ts")


@query(
    "o03_first_datapoint",
    "SELECT event_id, CASE WHEN user_id % 4 <> 0 THEN cast(json_extract(props, '$.k') AS DOUBLE) END AS alarm_value FROM events",
)
def o03(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("double")
    points = F.when(F.col("user_id") % 4 != 0, F.array(k, k + 1)).otherwise(F.array().cast("array<double>"))
    return t(spark, sf_dir, "events").select("event_id", F.get(points, F.lit(0)).alias("alarm_value"))


@query(
    "u04_union_distinct",
    "SELECT n_regionkey AS k FROM nation UNION SELECT r_regionkey FROM region UNION SELECT c_nationkey FROM customer",
)
def u04(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [
        t(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("k")),
        t(spark, sf_dir, "region").select(F.col("r_regionkey").alias("k")),
        t(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")),
    ]
    return parts[0].union(parts[1]).union(parts[2]).distinct()


@query(
    "u01_u03_union_by_name",
    """SELECT src, count(*) AS "rows", round(sum(amount), 4) + 0 AS total FROM (SELECT 'line' AS src, l_extendedprice AS amount FROM lineitem UNION ALL SELECT 'order', o_totalprice FROM orders
      UNION ALL SELECT 'customer', c_acctbal FROM customer UNION ALL SELECT 'supplier', s_acctbal FROM supplier) GROUP BY 1""",
)
def u01(spark: SparkSession, sf_dir: str) -> DataFrame:
    def part(name: str, column: str, label: str, swap: bool) -> DataFrame:
        columns = [F.lit(label).alias("src"), F.col(column).alias("amount")]
        return t(spark, sf_dir, name).select(*(reversed(columns) if swap else columns))

    stacked = (
        part("lineitem", "l_extendedprice", "line", False)
        .unionByName(part("orders", "o_totalprice", "order", True))
        .unionByName(part("customer", "c_acctbal", "customer", False))
        .unionByName(part("supplier", "s_acctbal", "supplier", True))
    )
    return stacked.groupBy("src").agg(F.count(F.lit(1)).alias("rows"), tidy(F.sum("amount"), 4).alias("total"))


@query(
    "u05_array_difference",
    "SELECT p_partkey, array_to_string(list_filter(['red', 'small', 'Owner'], lambda x: NOT list_contains(string_split(p_name, ' '), x)), ',') AS missing FROM part",
)
def u05(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = F.array(F.lit("red"), F.lit("small"), F.lit("Owner"))
    return t(spark, sf_dir, "part").select(
        "p_partkey", F.array_join(F.array_except(wanted, F.split("p_name", " ")), ",").alias("missing")
    )


@query(
    "a01_wide_group_by",
    """SELECT year(l_shipdate)::INTEGER AS y, month(l_shipdate)::INTEGER AS m, l_returnflag, l_linestatus, l_linenumber, l_suppkey, count(*) AS n, round(sum(l_quantity), 4) + 0 AS quantity, round(sum(l_extendedprice), 4) + 0 AS price
      FROM lineitem GROUP BY 1, 2, 3, 4, 5, 6""",
)
def a01(spark: SparkSession, sf_dir: str) -> DataFrame:
    return t(spark, sf_dir, "lineitem").groupBy(
        F.year("l_shipdate").alias("y"), F.month("l_shipdate").alias("m"), "l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey"
    ).agg(
        F.count(F.lit(1)).alias("n"), tidy(F.sum("l_quantity"), 4).alias("quantity"), tidy(F.sum("l_extendedprice"), 4).alias("price")
    )


@query(
    "a02_a03_conditional_sums",
    "SELECT l_suppkey, round(sum(CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE 0 END), 4) + 0 AS with_flag, round(sum(CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_extendedprice END), 4) + 0 AS without_flag, count(*) > 0 AS present FROM lineitem GROUP BY 1",
)
def a02(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged, price = F.col("l_returnflag") == "R", F.col("l_extendedprice")
    return t(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        tidy(F.sum(F.when(flagged, price).otherwise(0.0)), 4).alias("with_flag"),
        tidy(F.sum(F.when(flagged, 0.0).otherwise(price)), 4).alias("without_flag"),
        F.max(F.lit(True)).alias("present"),
    )


@query(
    "a10_a11_name_per_resource",
    "SELECT l_suppkey, max(CASE WHEN l_partkey % 5 <> 0 THEN 'srv-' || (l_partkey % 50) END) AS name, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1",
)
def a10(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("l_partkey") % 5 != 0, F.concat(F.lit("srv-"), (F.col("l_partkey") % 50).cast("string")))
    lines = t(spark, sf_dir, "lineitem")
    pairs = lines.select("l_suppkey", "l_partkey").distinct().groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("parts"))
    return lines.groupBy("l_suppkey").agg(F.max(name).alias("name")).join(pairs, "l_suppkey")


@query(
    "scalar_functions",
    """SELECT c_custkey, length(c_name) AS len, trim('  ' || c_mktsegment || ' ') AS trimmed, nullif(c_mktsegment, 'MACHINERY') AS kept, substr(c_name, 10, 4) AS part,
      instr(c_name, '#') AS pos, right(c_name, 3) AS tail, md5(c_name) AS digest, ends_with(c_mktsegment, 'Y') AS ends_y, cast(ceil(c_acctbal) AS BIGINT) AS up, cast(trunc(c_acctbal) AS BIGINT) AS cut,
      greatest(c_acctbal, 0.0) AS positive, decode(from_base64(to_base64(encode(c_mktsegment)))) AS roundtrip, round(c_acctbal / nullif(c_nationkey, 0), 6) + 0 AS per_nation, try_cast(substr(c_name, 10) AS INTEGER) AS number FROM customer""",
)
def scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, segment, balance = F.col("c_name"), F.col("c_mktsegment"), F.col("c_acctbal")
    return t(spark, sf_dir, "customer").select(
        "c_custkey",
        F.length(name).cast("long").alias("len"),
        F.trim(F.concat(F.lit("  "), segment, F.lit(" "))).alias("trimmed"),
        F.nullif(segment, F.lit("MACHINERY")).alias("kept"),
        F.substring(name, 10, 4).alias("part"),
        F.instr(name, "#").cast("long").alias("pos"),
        F.right(name, F.lit(3)).alias("tail"),
        F.md5(name).alias("digest"),
        segment.endswith("Y").alias("ends_y"),
        F.ceil(balance).alias("up"),
        balance.cast("long").alias("cut"),
        F.greatest(balance, F.lit(0.0)).alias("positive"),
        F.decode(F.unbase64(F.base64(F.encode(segment, "UTF-8"))), "UTF-8").alias("roundtrip"),
        tidy(ratio(balance, F.col("c_nationkey"))).alias("per_nation"),
        text_number(F.substring(name, 10, 20), exact=False).cast("int").alias("number"),
    )
