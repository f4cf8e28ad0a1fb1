"""Log queries: events written as log lines, parsed back, enriched and rolled up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions import network
from skyledger.functions.numbers import tidy
from skyledger.functions.timefns import epoch_seconds
from skyledger.operators import geo, logs, rollup, slices
from skyledger.plans import bindings as b
from skyledger.plans.registry import query
from skyledger.streaming.streams import cdn_requests

MS = "cast(epoch_us(ts) // 1000 AS BIGINT)"
SEC = "cast(epoch_us(ts) // 1000000 * 1000 AS BIGINT)"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.table(spark, sf_dir, "events")


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def _join(separator: str, *parts: Column | str) -> Column:
    return F.concat_ws(separator, *[F.col(p).cast("string") if isinstance(p, str) else p for p in parts])


@query(
    "l01_mysql_general",
    f"SELECT cast(user_id AS VARCHAR) AS id, event_type AS command, CASE WHEN event_type <> 'signup' THEN 'select ' || event_id || ' from t' END AS argument, {MS} AS timestamp, 'db1' AS database_id, true AS parse_ok FROM events WHERE event_type <> 'error'",
)
def l01(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = F.when(F.col("event_type") != "signup", _join(" ", F.lit("select"), "event_id", F.lit("from t")))
    line = _join(" ", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), "user_id", F.lit(" "), "event_type", rest)
    banner = F.when(F.col("event_type") == "error", F.lit("Time                 Id Command    Argument")).otherwise(line)
    out = logs.parse_mysql_general(events(spark, sf_dir).select(banner.alias("line")), "db1")
    return out.select("id", "command", "argument", "timestamp", "database_id", "parse_ok")


@query(
    "l02_mysql_audit",
    f"SELECT 'host' AS serverhost, 'u' || user_id AS username, cast(event_id AS VARCHAR) AS queryid, event_type AS operation, 'select ' || event_id || ', 2' AS object, cast(user_id % 3 AS VARCHAR) AS retcode, {SEC} AS timestamp FROM events",
)
def l02(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = _join(
        ",", F.date_format("ts", "yyyyMMdd HH:mm:ss"), F.lit("host"), _join("", F.lit("u"), "user_id"), F.lit("10.0.0.1"), F.lit("17"),
        "event_id", "event_type", F.lit("db"), _join("", F.lit("'select "), "event_id", F.lit(", 2'")), (F.col("user_id") % 3).cast("string"),
    )
    out = logs.parse_mysql_audit(events(spark, sf_dir).select(line.alias("line")), "db1")
    return out.where("parse_ok").select("serverhost", "username", "queryid", "operation", "object", "retcode", "timestamp")


_PATH = ("acct", "redshift", "r1", "c1")


def _path(kind: str) -> Column:
    return _join("", F.lit("s3/x/"), F.lit("_".join(_PATH)), F.lit(f"_{kind}_2024.gz"))


@query(
    "l03_warehouse_activity",
    f"SELECT 'd' || (user_id % 4) AS db, 'u' || user_id AS \"user\", cast(event_id AS VARCHAR) AS pid, 'select ' || event_type AS query, {SEC} AS timestamp, 'acct' AS account_id, 'r1' AS region, 'c1' AS cluster_id FROM events WHERE event_type <> 'error'",
)
def l03(spark: SparkSession, sf_dir: str) -> DataFrame:
    quote = F.when(F.col("user_id") % 2 == 0, F.lit("'")).otherwise(F.lit(""))
    line = _join(
        "", quote, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(" UTC [ db=d"), (F.col("user_id") % 4).cast("string"),
        F.lit(" user=u"), "user_id", F.lit(" pid="), "event_id", F.lit(" userid=1 xid=2 ]' LOG: select "), "event_type",
    )
    tail = F.when(F.col("event_type") == "error", F.lit("   from continued_line")).otherwise(line)
    out = logs.parse_warehouse_activity(events(spark, sf_dir).select(_path("useractivitylog").alias("path"), tail.alias("line")))
    return out.select("db", "user", "pid", "query", "timestamp", "account_id", "region", "cluster_id")


def _warehouse_time() -> Column:
    return F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss:SSS")


@query(
    "l04_warehouse_user",
    f"SELECT cast(user_id AS VARCHAR) AS userid, 'u' || user_id AS username, event_type AS action, cast(event_id AS VARCHAR) AS xid, {MS} AS timestamp, 'c1' AS cluster_id FROM events WHERE event_type <> 'error'",
)
def l04(spark: SparkSession, sf_dir: str) -> DataFrame:
    empty = F.lit("  ")
    fields = ["user_id", _join("", F.lit(" u"), "user_id", F.lit(" ")), empty, "event_type", empty, empty, empty, empty, F.lit("9"), "event_id"]
    line = _join("|", *fields, _warehouse_time())
    short = F.when(F.col("event_type") == "error", _join("|", *fields)).otherwise(line)
    out = logs.parse_warehouse_user(events(spark, sf_dir).select(_path("userlog").alias("path"), short.alias("line")))
    return out.select("userid", "username", "action", "xid", "timestamp", "cluster_id")


@query(
    "l05_warehouse_connection",
    f"SELECT event_type AS event, '10.0.0.' || user_id AS remotehost, cast(event_id AS VARCHAR) AS pid, 'driver' AS driver_version, 'plug' AS plugin_name, {MS} AS timestamp FROM events",
)
def l05(spark: SparkSession, sf_dir: str) -> DataFrame:
    blanks = [F.lit(" ")] * 11
    line = _join(
        "|", "event_type", _warehouse_time(), _join("", F.lit("10.0.0."), "user_id"), F.lit("5439"), "event_id", *blanks,
        F.lit("driver"), F.lit("linux"), F.lit("plug "),
    )
    out = logs.parse_warehouse_connection(events(spark, sf_dir).select(_path("connectionlog").alias("path"), line.alias("line")))
    return out.select("event", "remotehost", "pid", "driver_version", "plugin_name", "timestamp")


@query(
    "l06_log_kind",
    "SELECT CASE user_id % 4 WHEN 0 THEN 'activity' WHEN 1 THEN 'connection' WHEN 2 THEN 'user' END AS kind, count(*) AS files FROM events GROUP BY 1",
)
def l06(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*[F.lit(n) for n in ("useractivitylog", "connectionlog", "userlog", "otherlog")])
    path = F.concat(F.lit("a_b_c_d_"), F.get(names, (F.col("user_id") % 4).cast("int")), F.lit("_x.gz"))
    return events(spark, sf_dir).select(path.alias("path")).groupBy(logs.log_kind().alias("kind")).agg(F.count(F.lit(1)).alias("files"))


CDN_FIELDS = [
    "date", "time", "x-edge-location", "sc-bytes", "c-ip", "cs-method", "x-host-header", "sc-status", "cs-bytes",
    "time-taken", "x-edge-response-result-type",
]


def address() -> Column:
    return F.pmod(F.col("user_id") * F.lit(2654435761), F.lit(4294967296))


ADDRESS = "(user_id * 2654435761) % 4294967296"


def cdn_line() -> Column:
    taken = F.when(F.col("user_id") % 10 == 0, F.lit("0.000")).otherwise(((F.col("user_id") % 10) * 0.25).cast("string"))
    status = F.when(F.col("value") > 100, F.lit("500")).otherwise(F.lit("200"))
    return _join(
        "\t", F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm:ss"), F.lit("NRT57"), (F.col("value") * 100).cast("long").cast("string"),
        network.ip_text(address()), F.lit("GET"), "event_type", status, "user_id", taken,
        F.when(F.col("user_id") % 2 == 0, F.lit("Hit")).otherwise(F.lit("Miss")),
    )


def cdn_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as landed access-log files, with the two header lines once per day of logs."""
    rows = events(spark, sf_dir).select(cdn_line().alias("line"), F.to_date("ts").alias("d"))
    headers = rows.select("d").distinct().select(
        F.explode(F.array(F.lit("#Version: 1.0"), F.lit("#Fields: " + " ".join(CDN_FIELDS)))).alias("line")
    )
    return b.landed_lines(spark, sf_dir, "cdn-log", rows.select("line").unionByName(headers))


REQ = f"""req AS (SELECT event_id, ts, event_type AS host, CASE WHEN value > 100 THEN '500' ELSE '200' END AS response_code, CASE WHEN user_id % 2 = 0 THEN 'Hit' ELSE 'Miss' END AS result_type,
  cast(trunc(value * 100) AS BIGINT) AS down, user_id AS up, {ADDRESS} AS ip, {SEC} AS ms, CASE WHEN user_id % 10 <> 0 THEN trunc(value * 100) / ((user_id % 10) * 0.25) END AS speed FROM events)"""


@query(
    "l07_cdn_log",
    f"WITH {REQ} SELECT ms AS timestamp, host, response_code, result_type, down AS bytes_down, up AS bytes_up, round(speed, 6) + 0 AS speed FROM req",
)
def l07(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = cdn_requests(cdn_lines(spark, sf_dir), CDN_FIELDS)
    return out.select("timestamp", "host", "response_code", "result_type", "bytes_down", "bytes_up", tidy("speed").alias("speed"))


@query(
    "l07_cdn_log_by_header",
    f"WITH {REQ} SELECT host, response_code, count(*) AS lines, cast(sum(down) AS BIGINT) AS bytes_down FROM req GROUP BY 1, 2",
)
def l07_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select(F.date_format("ts", "yyyy-MM-dd").alias("path"), cdn_line().alias("line"))
    headers = rows.select("path").distinct().withColumn("line", F.lit("#Fields: " + " ".join(CDN_FIELDS)))
    out = logs.parse_cdn_by_header(rows.unionByName(headers))
    f = F.col("fields")
    return out.groupBy(f["x-host-header"].alias("host"), f["sc-status"].alias("response_code")).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(f["sc-bytes"].cast("bigint")).alias("bytes_down")
    )


@query("l07_header_check", "SELECT cast(count(DISTINCT cast(ts AS DATE)) AS BIGINT) AS odd_headers FROM events")
def l07_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.cdn_header_ok(cdn_lines(spark, sf_dir), CDN_FIELDS[:-1]).agg(F.count(F.lit(1)).alias("odd_headers"))


@query("l09_download_speed", f"WITH {REQ} SELECT host, count(speed) AS n, round(avg(speed), 6) + 0 AS speed FROM req GROUP BY 1")
def l09(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = cdn_requests(cdn_lines(spark, sf_dir), CDN_FIELDS)
    return out.groupBy("host").agg(F.count("speed").alias("n"), tidy(F.avg("speed")).alias("speed"))


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as address blocks over the lower five sixths of the address space, with gaps."""
    key, width = F.col("n_nationkey").cast("long"), 143165576
    return b.table(spark, sf_dir, "nation").select(
        (key * width).alias("start_ip"),
        (key * width + F.lit(width - 20000000)).alias("end_ip"),
        (key + 64500).alias("asn"),
        F.col("n_name").alias("org"),
        F.concat(F.lit("cont-"), _text("n_regionkey")).alias("continent"),
        F.col("n_name").alias("country"),
        F.concat(F.lit("city-"), _text("n_nationkey")).alias("city"),
    )


BLOCKS = "blocks AS (SELECT n_nationkey::BIGINT * 143165576 AS s, n_nationkey::BIGINT * 143165576 + 123165576 AS e, n_nationkey + 64500 AS asn, n_name, n_regionkey, n_nationkey FROM nation)"


@query(
    "j10_l08_block_enrichment",
    f"""WITH {REQ}, {BLOCKS} SELECT event_id, coalesce(cast(asn AS VARCHAR), 'unknown') AS asn, coalesce(n_name, 'unknown') AS org, coalesce('cont-' || n_regionkey, 'unknown') AS continent, coalesce(n_name, 'unknown') AS country, coalesce('city-' || n_nationkey, 'unknown') AS city
      FROM req LEFT JOIN blocks ON ip BETWEEN s AND e""",
)
def j10(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("event_id", address().alias("ip_number"))
    known = blocks(spark, sf_dir)
    out = geo.enrich_geo(rows, known.select("start_ip", "end_ip", "asn", "org"), known.select("start_ip", "end_ip", "continent", "country", "city"))
    return out.select("event_id", "asn", "org", "continent", "country", "city")


_NESTED = """nested AS (SELECT n_nationkey::BIGINT * 16777216 * 5 AS s, n_nationkey::BIGINT * 16777216 * 5 + 16777216 * 5 - 1 AS e, 'n' || n_nationkey AS name FROM nation
      UNION ALL SELECT r_regionkey::BIGINT * 16777216 * 25, r_regionkey::BIGINT * 16777216 * 25 + 16777216 * 25 - 1, 'r' || r_regionkey FROM region
      UNION ALL SELECT c_custkey::BIGINT * 65536 * 4, c_custkey::BIGINT * 65536 * 4 + 65535, 'c' || c_custkey FROM customer WHERE c_custkey < 16384
      UNION ALL SELECT s_suppkey::BIGINT * 65536 * 8 + 30000, s_suppkey::BIGINT * 65536 * 8 + 90000, 's' || s_suppkey FROM supplier WHERE s_suppkey < 8192
      UNION ALL SELECT 0, 4294967295, 'all')"""


@query(
    "j10_l08_nested_blocks",
    f"""WITH {REQ}, {_NESTED} SELECT event_id, f.family, coalesce(min_by(name, (e - s, s, name)), 'unknown') AS name
      FROM req CROSS JOIN (SELECT unnest([4, 6]) AS family) f LEFT JOIN nested ON ip BETWEEN s AND e GROUP BY 1, 2""",
)
def j10_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks within blocks: everything, regions, nations, /16 networks of customers, and ranges of suppliers across them; as both families."""
    def block(table: str, key: str, step: int, size: int, letter: str, shift: int = 0, most: int = 1 << 31) -> DataFrame:
        rows = b.table(spark, sf_dir, table).where(F.col(key) < most)
        start = F.col(key).cast("long") * step + shift
        return rows.select(start.alias("s"), (start + size).alias("e"), F.concat(F.lit(letter), _text(key)).alias("name"))

    known = block("nation", "n_nationkey", 5 << 24, (5 << 24) - 1, "n").unionByName(block("region", "r_regionkey", 25 << 24, (25 << 24) - 1, "r"))
    known = known.unionByName(block("customer", "c_custkey", 4 << 16, 65535, "c", most=16384)).unionByName(block("supplier", "s_suppkey", 8 << 16, 60000, "s", 30000, 8192))
    known = known.unionByName(b.table(spark, sf_dir, "region").where("r_regionkey = 0").select(F.lit(0).cast("long").alias("s"), F.lit(4294967295).cast("long").alias("e"), F.lit("all").alias("name")))
    rows = events(spark, sf_dir).select("event_id", address().alias("ip_number"))

    def key(column: str) -> Column:
        return F.concat(F.lit("20010db8"), F.lpad(F.lower(F.hex(column)), 8, "0"), F.lit("0" * 16))

    v4 = geo.enrich_by_block(rows, known.withColumnsRenamed({"s": "start_ip", "e": "end_ip"}), ["name"]).select("event_id", F.lit(4).alias("family"), "name")
    last = F.concat(F.substring(key("e"), 1, 16), F.lit("f" * 16))
    wide = known.select(key("s").alias("start_key"), last.alias("end_key"), "name")
    v6 = geo.enrich_by_block(rows.withColumn("key", key("ip_number")), wide, ["name"], "key").select("event_id", F.lit(6).alias("family"), "name")
    return v4.unionByName(v6)


def cdn_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed, located and rolled up to minutes."""
    parsed = cdn_requests(cdn_lines(spark, sf_dir), CDN_FIELDS).drop("country", "asn")
    known = blocks(spark, sf_dir)
    located = geo.enrich_by_block(parsed.withColumn("ip_number", network.ip_number("ip")), known, ["asn", "country"])
    return rollup.cdn_minutes(located)


_MINUTES = f"""{REQ}, {BLOCKS}, loc AS (SELECT req.*, coalesce(cast(asn AS VARCHAR), 'unknown') AS asn, coalesce(n_name, 'unknown') AS country FROM req LEFT JOIN blocks ON ip BETWEEN s AND e),
  mins AS (SELECT ms // 60000 * 60000 AS minute, host, country, asn, response_code, result_type, count(*) AS requests, cast(sum(down) AS BIGINT) AS bytes_down, cast(sum(up) AS BIGINT) AS bytes_up,
    count(speed) AS speed_count, sum(speed) AS speed_sum, max(speed) AS speed_max, min(speed) AS speed_min FROM loc GROUP BY 1, 2, 3, 4, 5, 6)"""
_SHOW = "round(speed_sum, 6) + 0 AS speed_sum, round(speed_max, 6) + 0 AS speed_max, round(speed_min, 6) + 0 AS speed_min"


def shown(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(
        *keys, "requests", "bytes_down", "bytes_up", "speed_count", tidy("speed_sum").alias("speed_sum"),
        tidy("speed_max").alias("speed_max"), tidy("speed_min").alias("speed_min"),
    )


@query(
    "a12_cdn_minutes",
    f"WITH {_MINUTES} SELECT minute, host, country, asn, response_code, result_type, requests, bytes_down, bytes_up, speed_count, {_SHOW} FROM mins",
)
def a12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(cdn_rollup(spark, sf_dir), "minute", *rollup.CDN_KEYS)


@query(
    "j10_blocks_of_both_families",
    """SELECT user_id % 2 AS family, coalesce(n_name, 'unknown') AS name, count(*) AS events, count(DISTINCT (user_id % 256) * 256 + event_id % 256) AS addresses
      FROM events LEFT JOIN nation ON n_nationkey = (user_id % 256) // 10 GROUP BY 1, 2""",
)
def j10_both(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of both families, in blocks of ten /24 or /48 networks per nation."""
    x, y = F.col("user_id") % 256, F.col("event_id") % 256
    v4 = F.concat_ws(".", F.lit("10"), F.lit("0"), x.cast("string"), y.cast("string"))
    v6 = F.concat(F.lit("2001:DB8:"), F.hex(x), F.lit("::"), F.hex(y))
    rows = events(spark, sf_dir).select((F.col("user_id") % 2).alias("family"), F.when(F.col("user_id") % 2 == 0, v4).otherwise(v6).alias("ip"))
    n = F.col("n_nationkey")
    nations = b.table(spark, sf_dir, "nation")
    low = nations.select("n_name", F.concat(F.lit("10.0."), (n * 10).cast("string"), F.lit(".0")).alias("a"), F.concat(F.lit("10.0."), (n * 10 + 9).cast("string"), F.lit(".255")).alias("z"))
    high = nations.select("n_name", F.concat(F.lit("2001:db8:"), F.hex(n * 10), F.lit("::")).alias("a"), F.concat(F.lit("2001:db8:"), F.hex(n * 10 + 9), F.lit(":ffff:ffff:ffff:ffff:ffff")).alias("z"))
    blocks = low.unionByName(high).select(network.address_key("a").alias("start_key"), network.address_key("z").alias("end_key"), F.col("n_name").alias("name"))
    out = geo.enrich_by_block(rows.withColumn("key", network.address_key("ip")), blocks, ["name"], "key")
    return out.groupBy("family", "name").agg(F.count(F.lit(1)).alias("events"), F.countDistinct("key").alias("addresses"))


@query(
    "a13_cdn_dimension_sets",
    f"""WITH {_MINUTES}, hours AS (SELECT minute // 86400000 * 86400000 AS minute, * EXCLUDE (minute) FROM mins)
      SELECT minute, host, country, response_code, cast(3 - grouping(host) - grouping(country) - grouping(response_code) AS INTEGER) AS level, cast(sum(requests) AS BIGINT) AS requests, cast(sum(bytes_down) AS BIGINT) AS bytes_down, cast(sum(bytes_up) AS BIGINT) AS bytes_up,
        cast(sum(speed_count) AS BIGINT) AS speed_count, round(sum(speed_sum), 4) + 0 AS speed_sum FROM hours GROUP BY GROUPING SETS ((minute), (minute, host), (minute, host, country), (minute, host, country, response_code))""",
)
def a13(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = cdn_rollup(spark, sf_dir).withColumn("minute", rollup.minute_of("minute", 86400))
    out = rollup.cdn_dimension_sets(days)
    return out.select(
        "minute", "host", "country", "response_code", "level", "requests", "bytes_down", "bytes_up", "speed_count", tidy("speed_sum", 4).alias("speed_sum")
    )


@query(
    "a13_chosen_dimension_sets",
    f"""WITH {_MINUTES}, hours AS (SELECT minute // 86400000 * 86400000 AS minute, * EXCLUDE (minute) FROM mins)
      SELECT minute, result_type, host, cast(2 - grouping(result_type) - grouping(host) AS INTEGER) AS level, cast(sum(requests) AS BIGINT) AS requests, cast(sum(bytes_up) AS BIGINT) AS bytes_up FROM hours GROUP BY GROUPING SETS ((minute, result_type), (minute, result_type, host))""",
)
def a13_chosen(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = cdn_rollup(spark, sf_dir).withColumn("minute", rollup.minute_of("minute", 86400))
    out = rollup.cdn_dimension_sets(days, [["result_type"], ["result_type", "host"]])
    return out.select("minute", "result_type", "host", "level", "requests", "bytes_up")


@query(
    "a13_sets_of_equal_size",
    f"""WITH {_MINUTES}, hours AS (SELECT minute // 86400000 * 86400000 AS minute, * EXCLUDE (minute) FROM mins)
      SELECT minute, CASE WHEN grouping(host) = 0 THEN 'host' ELSE 'response_code' END || CASE WHEN grouping(country) = 0 THEN ',country' ELSE '' END AS dimensions, host, response_code, country, cast(sum(requests) AS BIGINT) AS requests
      FROM hours GROUP BY GROUPING SETS ((minute, host), (minute, response_code), (minute, host, country))""",
)
def a13_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sets of one dimension each are told apart by their names."""
    days = cdn_rollup(spark, sf_dir).withColumn("minute", rollup.minute_of("minute", 86400))
    out = rollup.cdn_dimension_sets(days, [["host"], ["response_code"], ["host", "country"]])
    return out.select("minute", "dimensions", "host", "response_code", "country", "requests")


@query(
    "a15_cdn_statistic_values",
    f"WITH {_MINUTES} SELECT minute, host, country, result_type, response_code, requests, speed_count AS sample_count, cast(trunc(coalesce(speed_sum, 0)) AS BIGINT) AS speed_sum, cast(trunc(coalesce(speed_min, 0)) AS BIGINT) AS speed_min, cast(trunc(coalesce(speed_max, 0)) AS BIGINT) AS speed_max FROM mins",
)
def a15(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rollup.statistic_values(cdn_rollup(spark, sf_dir))
    return out.select("minute", "host", "country", "result_type", "response_code", "requests", "sample_count", "speed_sum", "speed_min", "speed_max")


@query(
    "s14_metric_log",
    f"""WITH {_MINUTES} SELECT host, minute, cast(sum(requests) AS BIGINT) AS requests, cast(sum(bytes_down) AS BIGINT) AS bytes_down, 'CdnLogs' AS namespace, '[[],["Host"]]' AS dimension_sets FROM mins GROUP BY 1, 2""",
)
def s14(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rollup.merge_minutes(cdn_rollup(spark, sf_dir), ["host"])
    records = rollup.metric_log(
        rows, "CdnLogs", [[], ["Host"]], {"Host": "host"}, {"Requests": ("requests", None), "BytesDownloaded": ("bytes_down", "Bytes")}
    )

    def path(p: str) -> Column:
        return F.get_json_object("value", p)

    return records.select(
        path("$.Host").alias("host"), path("$._aws.Timestamp").cast("bigint").alias("minute"), path("$.Requests").cast("bigint").alias("requests"),
        path("$.BytesDownloaded").cast("bigint").alias("bytes_down"), path("$._aws.CloudWatchMetrics[0].Namespace").alias("namespace"),
        path("$._aws.CloudWatchMetrics[0].Dimensions").alias("dimension_sets"),
    )


@query(
    "l10_l11_activity_stream",
    "SELECT event_id, 'r1' AS region, 'c' || (user_id % 6) AS \"clusterId\", event_type AS command, cast(epoch_us(ts) // 1000 AS BIGINT) AS timestamp, 'aurora-das-' || strftime(ts, '%Y-%m-%d') AS index FROM events",
)
def l10(spark: SparkSession, sf_dir: str) -> DataFrame:
    when = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS'+00'")
    started = F.when(F.col("user_id") % 2 == 0, when)
    event = F.struct(
        started.alias("startTime"), when.alias("logTime"), F.col("event_type").alias("command"), F.col("event_id").alias("rowCount")
    )
    # Payloads carry a bounded list: the events of one user and hour.
    grouped = events(spark, sf_dir).groupBy(
        F.concat(F.lit("arn:x/aws-rds-das-cluster-c"), (F.col("user_id") % 6).cast("string"), F.lit("-z")).alias("stream_arn"), "user_id", F.date_trunc("hour", F.col("ts")).alias("h"),
    ).agg(F.collect_list(event).alias("databaseActivityEventList"))
    payloads = grouped.select("stream_arn", F.lit("r1").alias("region"), F.to_json(F.struct("databaseActivityEventList")).alias("payload"))
    out = logs.activity_stream(payloads)
    return out.select(F.col("rowCount").alias("event_id"), "region", "clusterId", "command", "timestamp", "index")


@query(
    "l11_stream_cluster",
    "SELECT 'c' || (user_id % 6) AS cluster, count(*) AS events FROM events GROUP BY 1",
)
def l11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from skyledger.functions.text import cluster_from_stream

    arn = F.concat(F.lit("arn:x/aws-rds-das-cluster-c"), (F.col("user_id") % 6).cast("string"), F.lit("-z"))
    return events(spark, sf_dir).groupBy(cluster_from_stream(arn).alias("cluster")).agg(F.count(F.lit(1)).alias("events"))


def probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    pop = F.when(F.col("user_id") % 2 == 0, F.lit(',cdn-pop;desc="NRT57-C1"')).otherwise(F.lit(""))
    timing = F.concat(F.lit("cdn-upstream-dns;dur="), k, F.lit(",cdn-upstream-connect;dur="), _text("user_id"), pop)
    full = F.when(F.col("user_id") % 7 == 0, F.lit("")).otherwise(F.concat(timing, F.lit(",cdn-upstream-fbl;dur=8")))
    rows = events(spark, sf_dir).select(
        "event_id", (epoch_seconds("ts") * 1000).alias("timestamp"), F.col("event_type").alias("target"), F.lit("FRA56").alias("pop"),
        F.when(F.col("value") > 100, 500).otherwise(200).alias("status"), full.alias("timing"),
    )
    return logs.server_timing(rows)


PROBES = f"""probe AS (SELECT event_id, event_type AS target, {SEC} AS ms, CASE WHEN value > 100 THEN 0 ELSE 1 END AS success,
  cast(CASE WHEN user_id % 7 = 0 THEN 0 ELSE cast(json_extract(props, '$.k') AS INTEGER) END AS INTEGER) AS dns, cast(CASE WHEN user_id % 7 = 0 THEN 0 ELSE user_id END AS INTEGER) AS con, cast(CASE WHEN user_id % 7 = 0 THEN 0 ELSE 8 END AS INTEGER) AS fbl,
  CASE WHEN user_id % 7 <> 0 AND user_id % 2 = 0 THEN 'NRT' ELSE 'FRA' END AS city FROM events)"""


@query("l12_server_timing", f"WITH {PROBES} SELECT event_id, dns AS dns_ms, con AS connect_ms, fbl AS first_byte_ms, city FROM probe")
def l12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probes(spark, sf_dir).select("event_id", "dns_ms", "connect_ms", "first_byte_ms", "city")


@query(
    "a14_probe_minutes",
    f"""WITH {PROBES} SELECT ms // 60000 * 60000 AS minute, city, target, count(*) AS probes, cast(sum(success) AS BIGINT) AS success_sum, cast(sum(dns) AS BIGINT) AS dns_ms_sum, round(avg(dns), 6) + 0 AS dns_ms_avg,
      min(dns) AS dns_ms_min, max(dns) AS dns_ms_max, cast(min(success) AS INTEGER) AS success_min, round(avg(con), 6) + 0 AS connect_ms_avg FROM probe GROUP BY 1, 2, 3""",
)
def a14(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rollup.probe_minutes(probes(spark, sf_dir))
    return out.select(
        "minute", "city", "target", "probes", "success_sum", "dns_ms_sum", tidy("dns_ms_avg").alias("dns_ms_avg"), "dns_ms_min", "dns_ms_max",
        "success_min", tidy("connect_ms_avg").alias("connect_ms_avg"),
    )


@query(
    "a16_insert_count_per_minute",
    f"SELECT {SEC} // 60000 * 60000 AS minute, count(*) AS count FROM events WHERE event_type = 'signup' GROUP BY 1",
)
def a16(spark: SparkSession, sf_dir: str) -> DataFrame:
    verb = F.when(F.col("event_type") == "signup", F.lit("INSERT INTO t")).otherwise(F.lit("SELECT 1"))
    rows = events(spark, sf_dir).select((epoch_seconds("ts") * 1000).alias("ms"), F.concat(F.lit("x "), verb).alias("line"))
    return rollup.count_per_minute(logs.lines_with(rows, "INSERT INTO"), "ms")


@query(
    "a21_ingest_counts",
    "SELECT CASE WHEN grouping(o_orderstatus) = 0 THEN 'r-' || o_orderstatus END AS region, CASE WHEN grouping(o_custkey) = 0 THEN 'db-' || o_custkey END AS instance, o_orderpriority AS log_prefix, count(*) AS copied_file_count, CASE WHEN grouping(o_custkey) = 0 THEN 'instance' ELSE 'prefix' END AS level FROM orders GROUP BY GROUPING SETS ((o_orderpriority), (o_orderstatus, o_custkey, o_orderpriority))",
)
def a21(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = b.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("r-"), F.col("o_orderstatus")).alias("region"), F.concat(F.lit("db-"), _text("o_custkey")).alias("instance"),
        F.col("o_orderpriority").alias("log_prefix"),
    )
    return rollup.ingest_counts(files)


@query(
    "l13_disk_listing",
    "SELECT 'i-' || c_custkey AS instance_id, 'xvda' || (c_nationkey % 4 + 1) AS device, '/data/' || c_nationkey AS path, lower(c_mktsegment) AS fstype FROM customer UNION ALL SELECT 'i-' || c_custkey, 'xvdz', '/', 'xfs' FROM customer",
)
def l13(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = _join(" ", _join("", F.lit("/dev/xvda"), (F.col("c_nationkey") % 4 + 1).cast("string")), F.lower("c_mktsegment"), F.lit("1 2 3 4"), _join("", F.lit("/data/"), "c_nationkey"))
    output = _join("\n", F.lit("Filesystem Type Size"), first, F.lit("tmpfs tmpfs 1 2 3 4 /run"), F.lit("/dev/xvdz xfs 1 2 3 4 /"))
    rows = b.table(spark, sf_dir, "customer").select(_join("", F.lit("i-"), "c_custkey").alias("instance_id"), output.alias("output"))
    return logs.disk_listing(rows)


@query(
    "s15_new_log_files",
    """SELECT 'slow/log.' || o_orderkey || CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE '.txt' END AS name, cast(floor(epoch(o_orderdate)) AS BIGINT) AS last_written FROM orders WHERE o_orderkey % 2 = 0 AND o_orderdate >= TIMESTAMP '2000-01-01' AND o_totalprice >= 1000""",
)
def s15(spark: SparkSession, sf_dir: str) -> DataFrame:
    ending = F.when(F.col("o_orderkey") % 2 == 0, F.lit("")).otherwise(F.lit(".txt"))
    files = b.table(spark, sf_dir, "orders").select(
        F.concat(F.lit("slow/log."), _text("o_orderkey"), ending).alias("name"),
        epoch_seconds("o_orderdate").alias("last_written"), F.col("o_totalprice").alias("size"),
    )
    return logs.new_log_files(files, "slow", 946684800, 1000).select("name", "last_written")


@query("s15_next_mark", "SELECT cast(floor(epoch(max(o_orderdate))) AS BIGINT) + 1 AS next_mark FROM orders")
def s15_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return logs.next_mark(b.table(spark, sf_dir, "orders").select(epoch_seconds("o_orderdate").alias("last_written")))


@query(
    "s16_archive_names",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') || '/db-' || o_custkey || '/backup_' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '/log.' || o_orderkey || '.gz' AS name FROM orders",
)
def s16(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = logs.archive_name("o_orderdate", F.concat(F.lit("db-"), _text("o_custkey")), F.concat(F.lit("log."), _text("o_orderkey")))
    return b.table(spark, sf_dir, "orders").select("o_orderkey", name.alias("name"))


@query(
    "s18_numbered_batches",
    "SELECT cast(ts AS DATE) AS day, cast((row_number() OVER (PARTITION BY cast(ts AS DATE) ORDER BY event_id) - 1) // 50 AS BIGINT) AS batch, event_id FROM events",
)
def s18(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select(F.to_date("ts").alias("day"), "event_id")
    return rollup.numbered_batches(rows, ["day"], ["event_id"], F.floor(F.col("event_id") / 100), 50)


@query(
    "s18_payload_slices",
    """WITH p AS (SELECT cast(ts AS DATE) AS day, event_id, coalesce(length(props), 0) AS n, coalesce(sum(length(props)) OVER (PARTITION BY cast(ts AS DATE) ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begun FROM events)
      SELECT day, cast(begun // 500 * 2 + CASE WHEN begun + n > (begun // 500 + 1) * 500 THEN 1 ELSE 0 END AS BIGINT) AS slice, event_id FROM p""",
)
def s18_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select(F.to_date("ts").alias("day"), "event_id", "props")
    return rollup.payload_slices(rows, ["day"], ["event_id"], F.floor(F.col("event_id") / 100), "props", 500).drop("props")


@query(
    "s18_filled_slices",
    """WITH RECURSIVE p AS (SELECT cast(ts AS DATE) AS day, event_id, greatest(coalesce(length(props), 0), 1) AS n, row_number() OVER (PARTITION BY cast(ts AS DATE) ORDER BY event_id) AS rn FROM events),
      f AS (SELECT day, event_id, rn, n AS filled, 0::BIGINT AS slice FROM p WHERE rn = 1
        UNION ALL SELECT p.day, p.event_id, p.rn, CASE WHEN f.filled + p.n <= 200 THEN f.filled + p.n ELSE p.n END, CASE WHEN f.filled + p.n <= 200 THEN f.slice ELSE f.slice + 1 END
        FROM f JOIN p ON p.day = f.day AND p.rn = f.rn + 1)
      SELECT day, slice, event_id FROM f""",
)
def s18_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select(F.to_date("ts").alias("day"), "event_id", "props")
    return slices.filled_slices(rows, ["day"], ["event_id"], F.floor(F.col("event_id") / 100), "props", 200, stretch=4).select("day", "slice", "event_id")


@query(
    "s18_even_slices",
    """WITH p AS (SELECT cast(ts AS DATE) AS day, event_id, row_number() OVER (PARTITION BY cast(ts AS DATE) ORDER BY event_id) - 1 AS rn,
        sum(coalesce(length(props), 0)) OVER (PARTITION BY cast(ts AS DATE)) AS total, count(*) OVER (PARTITION BY cast(ts AS DATE)) AS n FROM events)
      SELECT day, cast(rn // cast(ceil(n / greatest(ceil(total / 500), 1)) AS BIGINT) AS BIGINT) AS slice, event_id FROM p""",
)
def s18_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select(F.to_date("ts").alias("day"), "event_id", "props")
    return slices.even_slices(rows, ["day"], ["event_id"], F.floor(F.col("event_id") / 100), "props", 500).drop("props")


@query("s18_delivery_batches", "SELECT count(*) AS records, true AS within_limit FROM events")
def s18_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = rollup.delivery_batches(events(spark, sf_dir)).groupBy("batch").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.sum("n").alias("records"), (F.max("n") <= 500).alias("within_limit"))


@query("s12_day_index", "SELECT 'ev-' || strftime(ts, '%Y-%m-%d') AS index, count(*) AS records FROM events GROUP BY 1")
def s12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.day_index(events(spark, sf_dir), F.col("ts"), "ev-").groupBy("index").agg(F.count(F.lit(1)).alias("records"))
