"""Metric queries on the events table: resampling, counters, label products, metric math, usage tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.numbers import tidy
from skyledger.operators import metrics as m
from skyledger.operators import usage
from skyledger.plans import bindings as b
from skyledger.plans.bindings_sql import SAMPLES
from skyledger.plans.registry import query

DAY0 = 1704067200  # 2024-01-01 00:00 UTC


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.event_samples(spark, sf_dir)


def _floor(seconds: str, width: int) -> str:
    return f"({seconds} // {width} * {width})"


def _resample(stat: str, sql: str, name: str) -> None:
    @query(
        name,
        f"WITH {SAMPLES} SELECT resource_id, metric, {_floor('epoch', 3600)} AS period_start, round({sql}, 6) + 0 AS value FROM samples GROUP BY 1, 2, 3",
    )
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        points = m.resample(samples(spark, sf_dir), ["resource_id", "metric"], 3600, stat)
        return points.select("resource_id", "metric", "period_start", tidy("value").alias("value"))


_resample("Average", "avg(value)", "m01_resample_average")
_resample("Sum", "sum(value)", "m01_resample_sum")
_resample("Minimum", "min(value)", "m01_resample_minimum")
_resample("Maximum", "max(value)", "m01_resample_maximum")


def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter per user: the JSON number of each event, which falls now and then (a reset)."""
    return samples(spark, sf_dir).select(
        "resource_id", "epoch", "event_id", F.get_json_object("props", "$.k").cast("double").alias("value")
    )


_COUNTER = f"""{SAMPLES}, c AS (SELECT resource_id, epoch, event_id, cast(json_extract(props, '$.k') AS DOUBLE) AS v FROM samples),
  l AS (SELECT *, lag(v) OVER (PARTITION BY resource_id ORDER BY epoch, event_id) AS p FROM c),
  inc AS (SELECT resource_id, {_floor("epoch", 3600)} AS window_start, sum(CASE WHEN p IS NULL THEN 0 WHEN v < p THEN v ELSE v - p END) AS increase FROM l GROUP BY 1, 2)"""


@query(
    "m02_counter_rate",
    f"WITH {_COUNTER} SELECT resource_id, window_start, round(increase, 6) + 0 AS increase, round(increase / 3600, 9) + 0 AS rate FROM inc",
)
def m02(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = m.counter_increase(counters(spark, sf_dir), ["resource_id"], tie=["event_id"])
    return out.select("resource_id", "window_start", tidy("increase").alias("increase"), tidy("rate", 9).alias("rate"))


@query(
    "m04_daily_sum_of_hours",
    f"WITH {_COUNTER} SELECT resource_id, {_floor('window_start', 86400)} AS day_start, round(sum(increase), 6) + 0 AS value, count(increase) AS samples FROM inc GROUP BY 1, 2",
)
def m04(spark: SparkSession, sf_dir: str) -> DataFrame:
    hourly = m.counter_increase(counters(spark, sf_dir), ["resource_id"], tie=["event_id"])
    out = m.sum_by_day(hourly, ["resource_id"], "increase")
    return out.select("resource_id", "day_start", tidy("value").alias("value"), "samples")


@query(
    "m03_average_over_hour",
    f"WITH {SAMPLES} SELECT resource_id, {_floor('epoch', 3600)} AS window_start, round(avg(value), 6) + 0 AS average FROM samples GROUP BY 1, 2",
)
def m03(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = m.average_over(samples(spark, sf_dir), ["resource_id"])
    return out.select("resource_id", "window_start", tidy("average").alias("average"))


@query(
    "m04_reserved_minutes",
    f"""WITH {SAMPLES}, a AS (SELECT resource_id, {_floor("epoch", 60)} AS w, avg(value) AS v FROM samples GROUP BY 1, 2)
      SELECT resource_id, {_floor("w", 86400)} AS day_start, round(sum(v) / 60, 6) + 0 AS value FROM a GROUP BY 1, 2""",
)
def m04_reserved(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = m.average_over(samples(spark, sf_dir), ["resource_id"], 60)
    out = m.sum_by_day(minutes, ["resource_id"], "average", 1.0 / 60.0)
    return out.select("resource_id", "day_start", tidy("value").alias("value"))


@query(
    "m05_sum_and_average_by_label",
    f"WITH {SAMPLES} SELECT metric, round(sum(value), 4) + 0 AS total, round(avg(value), 6) + 0 AS average FROM samples GROUP BY 1",
)
def m05(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = samples(spark, sf_dir)
    total = m.aggregate_by(points, ["metric"], "sum").withColumnRenamed("value", "total")
    average = m.aggregate_by(points, ["metric"], "avg").withColumnRenamed("value", "average")
    return total.join(average, "metric").select("metric", tidy("total", 4).alias("total"), tidy("average").alias("average"))


@query(
    "j12_vector_match_left",
    f"""WITH {SAMPLES} SELECT 'r-' || c_custkey AS resource_id, c_mktsegment AS app, round(sum(value * (1 + c_custkey % 3)), 4) + 0 AS value FROM samples JOIN customer ON user_id = c_custkey GROUP BY 1, 2""",
)
def j12(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = b.table(spark, sf_dir, "customer").select(
        F.concat(F.lit("r-"), F.col("c_custkey").cast("string")).alias("resource_id"), F.col("c_mktsegment").alias("app"),
        (F.lit(1.0) + F.col("c_custkey") % 3).alias("value"),
    )
    product = m.match_left(samples(spark, sf_dir).select("resource_id", "value"), labels, ["resource_id"], ["app"])
    return m.aggregate_by(product, ["resource_id", "app"], "sum").select("resource_id", "app", tidy("value", 4).alias("value"))


@query(
    "m07_host_network_filter",
    f"""WITH {SAMPLES}, ok AS (SELECT DISTINCT resource_id, {_floor("epoch", 86400)} AS d FROM samples WHERE metric = 'view' AND user_id % 2 = 0)
      SELECT s.resource_id, round(sum(value), 4) + 0 AS value FROM samples s JOIN ok ON s.resource_id = ok.resource_id AND {_floor("s.epoch", 86400)} = d WHERE metric = 'click' GROUP BY 1""",
)
def m07(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir)
    host = F.when(F.col("user_id") % 2 == 0, F.lit("false")).otherwise(F.lit("true"))
    info = rows.where(F.col("metric") == "view").select(
        F.lit("kube_pod_info").alias("metric"), "epoch", F.lit(1.0).alias("value"),
        F.create_map(F.lit("pod"), F.col("resource_id"), F.lit("host_network"), host).alias("labels"),
    )
    allowed = usage.pods_off_host_network(info)
    clicks = rows.where(F.col("metric") == "click").select(
        F.col("resource_id").alias("pod"), m.floor_epoch("epoch", 86400).alias("day_start"), "value"
    )
    product = m.match_left(clicks, allowed, ["pod", "day_start"])
    return product.groupBy(F.col("pod").alias("resource_id")).agg(tidy(F.sum("value"), 4).alias("value"))


@query(
    "j13_metric_math",
    f"""WITH {SAMPLES}, p AS (SELECT resource_id, {_floor("epoch", 86400)} AS period_start, sum(value) FILTER (metric = 'click') AS m1, sum(value) FILTER (metric = 'view') AS m2 FROM samples WHERE metric IN ('click', 'view') GROUP BY 1, 2)
      SELECT resource_id, period_start, round((m1 + m2) / 86400, 9) + 0 AS rate, round(m1 / nullif(m2, 0) * 100, 6) + 0 AS percent, round(greatest(m1, m2), 6) + 0 AS larger FROM p""",
)
def j13(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = m.resample(samples(spark, sf_dir), ["resource_id", "metric"], 86400, "Sum")
    wide = m.metric_math(points, ["resource_id", "period_start"], ["click", "view"])
    larger = F.when(F.col("m1").isNotNull() | F.col("m2").isNotNull(), F.greatest("m1", "m2"))
    return wide.select(
        "resource_id", "period_start", tidy((F.col("m1") + F.col("m2")) / 86400, 9).alias("rate"),
        tidy(F.try_divide("m1", "m2") * 100).alias("percent"), tidy(larger).alias("larger"),
    )


_DAILY = f"{SAMPLES}, p AS (SELECT resource_id, {_floor('epoch', 86400)} AS period_start, sum(value) AS value FROM samples GROUP BY 1, 2)"


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.resample(samples(spark, sf_dir), ["resource_id"], 86400, "Sum")


@query(
    "w03_lag_and_change_rate",
    f"""WITH {_DAILY} SELECT resource_id, period_start, round(lag(value) OVER w, 6) + 0 AS last_value, round(lag(value, 2) OVER w, 6) + 0 AS before_last_value,
      round(lag(value) OVER w / nullif(lag(value, 2) OVER w, 0) - 1, 6) + 0 AS change_rate FROM p WINDOW w AS (PARTITION BY resource_id ORDER BY period_start)""",
)
def w03(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = m.lagged(daily(spark, sf_dir), ["resource_id"])
    return out.select(
        "resource_id", "period_start", *[tidy(c).alias(c) for c in ("last_value", "before_last_value", "change_rate")]
    )


@query(
    "w04_w05_difference_and_rate",
    f"""WITH {_DAILY} SELECT resource_id, period_start, round(value - lag(value) OVER w, 6) + 0 AS difference,
      round((value - lag(value) OVER w) / (period_start - lag(period_start) OVER w) * 300, 9) + 0 AS scaled_rate FROM p WINDOW w AS (PARTITION BY resource_id ORDER BY period_start)""",
)
def w04(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = m.scaled_rate(m.difference(daily(spark, sf_dir), ["resource_id"]), ["resource_id"])
    return points.select("resource_id", "period_start", tidy("difference").alias("difference"), tidy("scaled_rate", 9).alias("scaled_rate"))


@query(
    "a06_m10_container_hours",
    """SELECT date_trunc('hour', ts)::DATE AS day, cast(hour(ts) AS INTEGER) AS hour, 'i-' || (user_id % 10) || ':pod/c1/ns-' || (user_id % 5) || '/' || user_id AS resource_id, event_type AS project,
      cast(floor(epoch(min(ts))) AS BIGINT) AS first_second, cast(floor(epoch(max(ts))) AS BIGINT) AS last_second, count(value) AS actual_cpu_cnt, round(sum(value), 4) + 0 AS actual_cpu,
      count(CASE WHEN user_id % 2 = 0 THEN value END) AS reserved_cpu_cnt, round(sum(cast(json_extract(props, '$.k') AS DOUBLE)), 4) + 0 AS actual_mem FROM events WHERE user_id % 9 <> 0 GROUP BY 1, 2, 3, 4""",
)
def a06(spark: SparkSession, sf_dir: str) -> DataFrame:
    user = F.col("user_id").cast("string")
    logs = b.table(spark, sf_dir, "events").select(
        "ts",
        F.when(F.col("user_id") % 9 != 0, user).alias("pod_name"),
        F.concat(F.lit("i-"), (F.col("user_id") % 10).cast("string")).alias("instance"),
        F.lit("c1").alias("eks_cluster_name"),
        F.concat(F.lit("ns-"), (F.col("user_id") % 5).cast("string")).alias("eks_namespace"),
        F.lit("app").alias("eks_app"),
        F.col("event_type").alias("project"),
        F.col("value").alias("pod_cpu_usage_total"),
        F.when(F.col("user_id") % 2 == 0, F.col("value")).alias("pod_cpu_request"),
        F.get_json_object("props", "$.k").cast("double").alias("pod_memory_working_set"),
        F.lit(1.0).alias("pod_memory_request"),
    )
    out = usage.container_hourly_usage(logs)
    return out.select(
        F.to_date("date").alias("day"), F.hour("date").alias("hour"), "resource_id", "project",
        m.floor_epoch(F.unix_seconds(F.col("start_time").cast("timestamp")), 1).alias("first_second"),
        m.floor_epoch(F.unix_seconds(F.col("end_time").cast("timestamp")), 1).alias("last_second"),
        "actual_cpu_cnt", tidy("actual_cpu", 4).alias("actual_cpu"), "reserved_cpu_cnt", tidy("actual_mem", 4).alias("actual_mem"),
    )


@query(
    "a09_p24_m11_database_io",
    """SELECT date_trunc('hour', ts)::DATE AS day, cast(hour(ts) AS INTEGER) AS hour, 'db-' || user_id AS db_id, round(sum(value) FILTER (event_type = 'click'), 4) + 0 AS read_iops, round(sum(value) FILTER (event_type = 'view'), 4) + 0 AS write_iops,
      round((sum(value) FILTER (event_type = 'click') + sum(value) FILTER (event_type = 'view')) * 3600, 2) + 0 AS io_cnt FROM events WHERE event_type IN ('click', 'view') GROUP BY 1, 2, 3""",
)
def a09(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("event_type") == "click", "ReadIOPS").when(F.col("event_type") == "view", "WriteIOPS").otherwise("Other")
    rows = b.table(spark, sf_dir, "events").select(
        "ts", "value", name.alias("metric"), F.concat(F.lit("db-"), F.col("user_id").cast("string")).alias("db_id"),
        F.lit("r").alias("region"), F.lit("a").alias("usage_account"),
    )
    out = usage.db_io_hourly(rows)
    return out.select(
        F.to_date("usage_date").alias("day"), F.hour("usage_date").alias("hour"), "db_id", tidy("read_iops", 4).alias("read_iops"),
        tidy("write_iops", 4).alias("write_iops"), tidy("io_cnt", 2).alias("io_cnt"),
    )


def _raw(spark: SparkSession, sf_dir: str, copies: int = 2) -> DataFrame:
    """Raw pod and ingress samples from events, with boundary repeats (every sample occurs ``copies`` times)."""
    rows = b.dealt_events(spark, sf_dir, samples(spark, sf_dir))
    pod = F.concat(F.lit("p-"), F.col("user_id").cast("string"))
    node = F.concat(F.lit('{"ebs.csi.aws.com":"i-'), (F.col("user_id") % 10).cast("string"), F.lit('"}'))
    region = F.concat(F.lit("r"), (F.col("user_id") % 2).cast("string"))
    base = [
        F.lit("topology_kubernetes_io_region"), region, F.lit("alpha_eksctl_io_cluster_name"), F.lit("c1"),
        F.lit("namespace"), F.concat(F.lit("ns-"), (F.col("user_id") % 5).cast("string")), F.lit("pod"), pod, F.lit("nodeid"), node,
        F.lit("image"), F.lit("x"),
    ]
    k = F.get_json_object("props", "$.k").cast("double")
    kind = F.col("metric")

    def series(condition: Column, name: str, labels: Column, value: Column) -> Column:
        return F.when(condition, F.struct(F.lit(name).alias("metric"), labels.alias("labels"), F.col("epoch").alias("epoch"), value.alias("value")))

    every = F.lit(True)
    host = F.when(F.col("user_id") % 3 == 0, F.lit("true")).otherwise(F.lit("false"))
    ns = F.concat(F.lit("ns-"), (F.col("user_id") % 5).cast("string"))
    ingress = F.concat(F.lit("in-"), F.col("user_id").cast("string"))
    parts = F.array_compact(
        F.array(
            series(kind == "click", usage.POD_METRICS["cpu"], F.create_map(*base), k),
            series(kind == "view", usage.POD_METRICS["memory"], F.create_map(*base), F.col("value")),
            series(kind == "purchase", usage.POD_METRICS["network_in"], F.create_map(*base[:-2]), k),
            series(kind == "signup", usage.POD_METRICS["network_out"], F.create_map(*base[:-2]), k),
            series(every, "kube_pod_labels", F.create_map(F.lit("pod"), pod, F.lit("label_app"), F.concat(F.lit("a-"), (F.col("user_id") % 7).cast("string"))), F.lit(1.0)),
            series(every, "kube_pod_info", F.create_map(F.lit("pod"), pod, F.lit("host_network"), host), F.lit(1.0)),
            series(kind == "error", "kube_pod_container_resource_requests", F.create_map(F.lit("namespace"), ns, F.lit("pod"), pod, F.lit("resource"), F.lit("cpu")), F.col("value")),
            series(kind == "error", "nginx_ingress_controller_requests", F.create_map(F.lit("region"), region, F.lit("cluster_name"), F.lit("c1"), F.lit("namespace"), ns, F.lit("ingress"), ingress), k),
            series(every, "kube_ingress_labels", F.create_map(F.lit("ingress"), ingress, F.lit("label_app_kubernetes_io_name"), F.lit("web")), F.lit(1.0)),
        )
    )
    repeat = F.sequence(F.lit(1), F.lit(copies))
    return rows.select(F.explode(parts).alias("s"), F.lit(None).alias("_")).select("s.*").withColumn("_c", F.explode(repeat)).drop("_c")


def _counter_sql(kind: str, name: str) -> str:
    return f"""{name}_u AS (SELECT user_id, epoch, max(k) AS v FROM e WHERE metric = '{kind}' GROUP BY 1, 2),
      {name}_l AS (SELECT *, lag(v) OVER (PARTITION BY user_id ORDER BY epoch) AS p FROM {name}_u),
      {name} AS (SELECT user_id, {_floor("epoch", 86400)} AS d, sum(CASE WHEN p IS NULL THEN 0 WHEN v < p THEN v ELSE v - p END) AS v FROM {name}_l GROUP BY 1, 2)"""


_USAGE_SQL = f"""WITH {SAMPLES}, e AS (SELECT *, cast(json_extract(props, '$.k') AS DOUBLE) AS k FROM samples),
  {_counter_sql("click", "cpu")}, {_counter_sql("purchase", "nin")}, {_counter_sql("signup", "nout")}, {_counter_sql("error", "req")},
  mem_u AS (SELECT user_id, epoch, max(value) AS v FROM e WHERE metric = 'view' GROUP BY 1, 2),
  mem_h AS (SELECT user_id, {_floor("epoch", 3600)} AS h, avg(v) AS v FROM mem_u GROUP BY 1, 2),
  mem AS (SELECT user_id, {_floor("h", 86400)} AS d, sum(v) AS v FROM mem_h GROUP BY 1, 2),
  res_u AS (SELECT user_id, epoch, max(value) AS v FROM e WHERE metric = 'error' GROUP BY 1, 2),
  res_m AS (SELECT user_id, {_floor("epoch", 60)} AS h, avg(v) AS v FROM res_u GROUP BY 1, 2),
  res AS (SELECT user_id, {_floor("h", 86400)} AS d, sum(v) / 60 AS v FROM res_m GROUP BY 1, 2),
  days AS (SELECT user_id, d FROM cpu UNION SELECT user_id, d FROM mem UNION SELECT user_id, d FROM nin WHERE user_id % 3 <> 0 UNION SELECT user_id, d FROM nout WHERE user_id % 3 <> 0)"""


@query(
    "m08_pod_daily_usage",
    f"""{_USAGE_SQL} SELECT make_timestamp(x.d * 1000000)::DATE AS date, 'r' || (x.user_id % 2) AS region, 'i-' || (x.user_id % 10) AS instance, 'a-' || (x.user_id % 7) AS eks_app,
      'i-' || (x.user_id % 10) || ':pod/c1/ns-' || (x.user_id % 5) || '/p-' || x.user_id AS resource_id, round(coalesce(cpu.v, 0) / 3600, 9) + 0 AS actual_cpu, round(coalesce(mem.v, 0), 6) + 0 AS actual_mem,
      round(CASE WHEN x.user_id % 3 <> 0 THEN coalesce(nin.v, 0) ELSE 0 END, 6) + 0 AS network_in, round(CASE WHEN x.user_id % 3 <> 0 THEN coalesce(nout.v, 0) ELSE 0 END, 6) + 0 AS network_out, round(res.v, 6) + 0 AS reserved_cpu
      FROM days x LEFT JOIN cpu ON cpu.user_id = x.user_id AND cpu.d = x.d LEFT JOIN mem ON mem.user_id = x.user_id AND mem.d = x.d LEFT JOIN nin ON nin.user_id = x.user_id AND nin.d = x.d
      LEFT JOIN nout ON nout.user_id = x.user_id AND nout.d = x.d LEFT JOIN res ON res.user_id = x.user_id AND res.d = x.d""",
)
def m08(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = usage.pod_daily_usage(raw_samples(spark, sf_dir), "acct")
    return out.select(
        "date", "region", "instance", "eks_app", "resource_id", tidy("actual_cpu", 9).alias("actual_cpu"), tidy("actual_mem").alias("actual_mem"),
        tidy("network_in").alias("network_in"), tidy("network_out").alias("network_out"), tidy("reserved_cpu").alias("reserved_cpu"),
    )


def raw_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sample store: written once, read by every usage table."""
    return b.landed_table(spark, sf_dir, "raw-samples", lambda: _first_of_second(_raw(spark, sf_dir, copies=1)))


def _first_of_second(raw: DataFrame) -> DataFrame:
    """Events of one series in the same second count as one sample, the largest, which occurs twice."""
    best = raw.groupBy("metric", F.map_entries("labels").alias("k"), "epoch").agg(F.max("value").alias("value"))
    repeat = F.sequence(F.lit(1), F.lit(2))
    return best.select("metric", F.map_from_entries("k").alias("labels"), "epoch", "value", F.explode(repeat).alias("_c")).drop("_c")


@query(
    "m09_ingress_daily_requests",
    f"""{_USAGE_SQL} SELECT make_timestamp(d * 1000000)::DATE AS date, 'r' || (user_id % 2) AS region, 'web' AS eks_app, 'ingress/c1/ns-' || (user_id % 5) || '/in-' || user_id AS resource_id, round(v, 6) + 0 AS requests FROM req""",
)
def m09(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = usage.ingress_daily_requests(raw_samples(spark, sf_dir), "acct")
    return out.select("date", "region", "eks_app", "resource_id", tidy("requests").alias("requests"))


@query(
    "j06_reservation_join",
    f"""{_USAGE_SQL} SELECT 'ns-' || (user_id % 5) AS namespace, 'p-' || user_id AS pod, d AS day_start, round(v, 6) + 0 AS reserved_cpu FROM res""",
)
def j06(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = usage.pod_reservations(raw_samples(spark, sf_dir))
    return out.select("namespace", "pod", "day_start", tidy("reserved_cpu").alias("reserved_cpu"))


@query(
    "a07_a08_daily_results",
    f"WITH d AS (SELECT DISTINCT event_type, ts, value FROM events) SELECT event_type, cast(ts - INTERVAL 1 DAY AS DATE) AS date, round(sum(value), 4) + 0 AS value, count(value) AS samples FROM d WHERE month(ts - INTERVAL 1 DAY) = 1 AND year(ts - INTERVAL 1 DAY) = 2024 GROUP BY 1, 2",
)
def a07(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.table(spark, sf_dir, "events").select("event_type", "ts", "value")
    out = usage.daily_query_results(rows.unionByName(rows), ["event_type"], 2024, 1)
    return out.select("event_type", "date", tidy("value", 4).alias("value"), "samples")


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the metric-sample layout; clicks are CPU samples of instances, views of databases."""
    kind = F.col("event_type")
    instance = F.concat(F.lit("i-"), F.col("user_id").cast("string"))
    return b.table(spark, sf_dir, "events").select(
        F.lit("r1").alias("region"),
        F.when(kind == "click", "AWS/EC2").when(kind == "view", "AWS/RDS").otherwise("AWS/Lambda").alias("namespace"),
        F.when(kind == "error", "Errors").otherwise("CPUUtilization").alias("metric_name"),
        F.array(
            F.struct(F.lit("InstanceId").alias("dim_name"), instance.alias("dim_value")),
            F.struct(F.lit("Other").alias("dim_name"), F.lit("x").alias("dim_value")),
        ).alias("dimensions"),
        F.when(F.col("user_id") % 5 == 0, 60).otherwise(300).alias("period"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp"),
        "value",
        F.when(F.col("user_id") % 7 == 0, "Maximum").otherwise("Average").alias("statistic"),
    )


@query(
    "p25_m12_metric_daily_extract",
    f"""WITH {SAMPLES} SELECT CASE metric WHEN 'click' THEN 'AWS/EC2' ELSE 'AWS/RDS' END AS namespace, 'i-' || user_id AS dimension, epoch AS timestamp, value FROM samples
      WHERE metric IN ('click', 'view') AND user_id % 5 <> 0 AND user_id % 7 <> 0 AND epoch >= {DAY0 + 86400 * 9} AND epoch < {DAY0 + 86400 * 10}""",
)
def m12(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = usage.metric_daily_extract(metric_samples(spark, sf_dir), DAY0 + 86400 * 9)
    return out.select("namespace", F.col("dimensions")[0]["dim_value"].alias("dimension"), "timestamp", "value")


@query(
    "j11_m13_named_metrics",
    f"""WITH {SAMPLES}, n AS (SELECT l_suppkey, max(CASE WHEN l_suppkey % 4 <> 0 THEN 'srv-' || l_suppkey END) AS name FROM lineitem GROUP BY 1)
      SELECT name AS resource_name, 'i-' || user_id AS resource_id, epoch AS seconds, value AS metric_value FROM samples JOIN n ON l_suppkey = user_id WHERE metric = 'click'""",
)
def m13(spark: SparkSession, sf_dir: str) -> DataFrame:
    cur = b.billing_lines(spark, sf_dir).select("line_item_resource_id", "resource_tags_user_name")
    out = usage.named_metrics(metric_samples(spark, sf_dir), cur)
    return out.select("resource_name", "resource_id", F.unix_seconds("time").alias("seconds"), "metric_value")


@query(
    "a17_r09_quota_check",
    f"""WITH {SAMPLES}, mi AS (SELECT 'r' || (user_id % 5) AS region, {_floor("epoch", 60)} AS w, sum(value) AS v FROM samples GROUP BY 1, 2), p AS (SELECT region, max(v) AS mx FROM mi GROUP BY 1)
      SELECT region, round(mx, 4) + 0 AS max_invocations, cast(CASE WHEN region = 'r1' THEN 20 ELSE 10000 END AS BIGINT) AS quota, cast(trunc(mx / 60 * 5) AS BIGINT) AS estimated_rps, trunc(mx / 60 * 5) > CASE WHEN region = 'r1' THEN 20 ELSE 10000 END AS over_quota FROM p""",
)
def a17(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = samples(spark, sf_dir).select(F.concat(F.lit("r"), (F.col("user_id") % 5).cast("string")).alias("region"), "epoch", "value")
    quotas = b.table(spark, sf_dir, "region").where(F.col("r_regionkey") == 1).select(F.lit("r1").alias("region"), F.lit(20).cast("long").alias("quota"))
    out = m.quota_check(counts, quotas)
    return out.select("region", tidy("max_invocations", 4).alias("max_invocations"), "quota", "estimated_rps", "over_quota")


@query(
    "r10_origin_bandwidth",
    f"""WITH {SAMPLES}, p AS (SELECT resource_id, {_floor("epoch", 86400)} AS period_start, sum(value) FILTER (metric = 'click') AS b, avg(cast(json_extract(props, '$.k') AS DOUBLE)) FILTER (metric = 'view') AS h FROM samples GROUP BY 1, 2)
      SELECT resource_id, period_start, round(b * (100 - h) / 100 * 8 / 86400, 9) + 0 AS bandwidth FROM p""",
)
def r10(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, k = F.col("metric"), F.get_json_object("props", "$.k").cast("double")
    wide = samples(spark, sf_dir).groupBy("resource_id", m.floor_epoch("epoch", 86400).alias("period_start")).agg(
        F.sum(F.when(kind == "click", F.col("value"))).alias("b"), F.avg(F.when(kind == "view", k)).alias("h")
    )
    return wide.select("resource_id", "period_start", tidy(m.origin_bandwidth("b", "h", 86400), 9).alias("bandwidth"))


@query(
    "j12_match_conflicts",
    f"WITH {SAMPLES} SELECT resource_id, count(DISTINCT metric) AS partners FROM samples GROUP BY 1 HAVING count(DISTINCT metric) > 1",
)
def j12_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = samples(spark, sf_dir).select("resource_id", F.col("metric").alias("app"), F.lit(1.0).alias("value"))
    return m.match_conflicts(labels, ["resource_id"], ["app"])


@query(
    "a15_statistic_set",
    f"WITH {SAMPLES} SELECT resource_id, count(value) AS sample_count, cast(trunc(sum(value)) AS BIGINT) AS sum, cast(trunc(min(value)) AS BIGINT) AS minimum, cast(trunc(max(value)) AS BIGINT) AS maximum FROM samples GROUP BY 1",
)
def a15(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = samples(spark, sf_dir).groupBy("resource_id").agg(m.statistic_set("value").alias("s"))
    return sets.select("resource_id", "s.*")
