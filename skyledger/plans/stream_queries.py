"""Streaming queries: derived files run through availableNow streams, compared with the batch meaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.numbers import tidy
from skyledger.operators import rollup
from skyledger.plans import bindings as b
from skyledger.plans.alarm_queries import EVALUATED, daily_alarms
from skyledger.plans.log_queries import CDN_FIELDS, REQ, cdn_line, shown
from skyledger.plans.registry import query
from skyledger.session import scratch_path
from skyledger.streaming import alarm_states, archive
from skyledger.streaming import streams as st

_MINS = f"""{REQ}, mins AS (SELECT ms // 60000 * 60000 AS minute, host, 'unknown' AS country, 'unknown' AS asn, response_code, result_type, count(*) AS requests, cast(sum(down) AS BIGINT) AS bytes_down, cast(sum(up) AS BIGINT) AS bytes_up,
    count(speed) AS speed_count, round(sum(speed), 6) + 0 AS speed_sum, round(max(speed), 6) + 0 AS speed_max, round(min(speed), 6) + 0 AS speed_min FROM req GROUP BY 1, 2, 5, 6)"""


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.table(spark, sf_dir, "events").select(cdn_line().alias("line"), F.to_date("ts").alias("d"), "user_id", "ts")


@query("t01_t03_stream_partial_minutes", f"WITH {_MINS} SELECT * FROM mins")
def t03(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries, the second with older minutes: late rows are taken and partials of a minute combine."""
    source, checkpoint, out = (scratch_path(spark, n) for n in ("in", "checkpoint", "minutes"))
    lines = _lines(spark, sf_dir)
    sink = st.partial_minutes_sink(out)
    for late in (False, True):
        lines.where((F.col("user_id") % 2 == 0) == F.lit(late)).select("line").write.mode("append").text(source)
        requests = st.cdn_requests(st.line_stream(spark, source), CDN_FIELDS)
        st.run_available(requests, checkpoint, sink)
    return shown(st.merged_minutes(spark, out), "minute", *rollup.CDN_KEYS)


@query("t06_stream_no_repeats", f"WITH {_MINS} SELECT host, cast(sum(requests) AS BIGINT) AS requests FROM mins GROUP BY 1")
def t06(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running the stream again without new files changes nothing."""
    source, checkpoint, out = (scratch_path(spark, n) for n in ("in", "checkpoint", "minutes"))
    _lines(spark, sf_dir).select("line").write.text(source)
    for _ in range(2):
        st.run_available(st.cdn_requests(st.line_stream(spark, source), CDN_FIELDS), checkpoint, st.partial_minutes_sink(out))
    merged = st.merged_minutes(spark, out)
    return merged.groupBy("host").agg(F.sum("requests").alias("requests"))


@query(
    "t02_t04_stream_final_minutes",
    f"WITH {_MINS}, e AS (SELECT max(ms) - 3600000 AS mark FROM req) SELECT mins.* FROM mins, e WHERE minute + 60000 <= mark",
)
def t02(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append form: a minute appears once the watermark (one hour behind the newest row) has passed it."""
    source, checkpoint, out = (scratch_path(spark, n) for n in ("in", "checkpoint", "final"))
    _lines(spark, sf_dir).select("line").write.text(source)
    requests = st.cdn_requests(st.line_stream(spark, source), CDN_FIELDS)
    st.run_available(st.minutes_final(requests), checkpoint, path=out)
    return shown(spark.read.parquet(out), "minute", *rollup.CDN_KEYS)


@query(
    "t05_stream_fan_out",
    f"""WITH {REQ} SELECT 'index cdn-' || strftime(ts, '%Y-%m-%d') AS output, count(*) AS records FROM req GROUP BY 1
      UNION ALL SELECT 'minutes', cast(count(*) AS BIGINT) FROM req UNION ALL SELECT 'failed', count(DISTINCT cast(ts AS DATE)) FROM req""",
)
def t05(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, checkpoint, index, minutes, failed = (scratch_path(spark, n) for n in ("in", "checkpoint", "index", "minutes", "failed"))
    lines = _lines(spark, sf_dir)
    broken = lines.select("d").distinct().select(F.concat(F.lit("broken line of "), F.col("d").cast("string")).alias("line"))
    lines.select("line").unionByName(broken).write.text(source)
    st.run_available(st.line_stream(spark, source), checkpoint, st.fan_out_sink(index, minutes, failed, CDN_FIELDS))
    by_index = spark.read.schema("host string, index string, batch_id int").option("basePath", index).json(index)
    counts = by_index.groupBy(F.concat(F.lit("index "), F.col("index")).alias("output")).agg(F.count(F.lit(1)).alias("records"))
    rolled = st.merged_minutes(spark, minutes).agg(F.lit("minutes").alias("output"), F.sum("requests").alias("records"))
    bad = spark.read.option("recursiveFileLookup", True).text(failed).agg(F.lit("failed").alias("output"), F.count(F.lit(1)).alias("records"))
    return counts.unionByName(rolled.select("output", "records")).unionByName(bad.select("output", "records"))


@query("t09_stream_unique_samples", "SELECT event_type, count(*) AS samples, round(sum(value), 4) + 0 AS total FROM (SELECT DISTINCT event_type, user_id, ts, value FROM events) GROUP BY 1")
def t09(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sample delivered twice; the stream keeps one."""
    source, checkpoint, out = (scratch_path(spark, n) for n in ("in", "checkpoint", "unique"))
    rows = b.table(spark, sf_dir, "events").select("event_type", "user_id", F.col("ts").cast("timestamp").alias("ts"), "value")
    rows.unionByName(rows).write.parquet(source)
    stream = st.record_stream(spark, source, "event_type string, user_id bigint, ts timestamp, value double", "parquet")
    st.run_available(st.unique_samples(stream, ["event_type", "user_id"]), checkpoint, path=out)
    back = spark.read.parquet(out)
    return back.groupBy("event_type").agg(F.count(F.lit(1)).alias("samples"), tidy(F.sum("value"), 4).alias("total"))


STREAMED = EVALUATED.replace(
    "x AS (SELECT user_id, min(period_start) AS lo, max(period_start) AS hi FROM p GROUP BY 1)",
    "x AS (SELECT user_id, lo, hi FROM (SELECT DISTINCT user_id FROM events), (SELECT min(epoch) // 86400 * 86400 AS lo, max(epoch) // 86400 * 86400 AS hi FROM samples))",
)


@query("r07_t07_stream_alarm_states", f"WITH {STREAMED} SELECT alarm_name, period_start, value, breaches, present, state, previous_state FROM f")
def t07_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples in three deliveries, some a day late, the last delivered again: the states are those of the whole table."""
    source, checkpoint, out = (scratch_path(spark, n) for n in ("samples", "checkpoint", "alarm-states"))
    samples = b.event_samples(spark, sf_dir).select("resource_id", "metric", "epoch", "value")
    first, last = samples.agg(F.min("epoch"), F.max("epoch")).first()
    # every seventh second is delivered up to a day late
    due = F.col("epoch") + F.when(F.col("epoch") % 7 == 0, F.col("epoch") % 86400).otherwise(F.lit(0))
    third = F.least(F.floor((due - F.lit(first)) * 3 / F.lit(last + 1 - first)), F.lit(2))
    sink = alarm_states.alarm_sink(out, daily_alarms(spark, sf_dir), first, late_periods=2)
    for delivery in range(3):
        samples.where(third == delivery).write.mode("append").parquet(source)
        stream = st.record_stream(spark, source, "resource_id string, metric string, epoch long, value double", "parquet")
        st.run_available(stream, checkpoint, sink)
    sink(samples.where(third == 2), 2)
    return alarm_states.current_states(spark, out).withColumn("value", tidy("value"))


@query("t03_t04_compacted_minutes", f"WITH {_MINS} SELECT * FROM mins")
def t03_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four deliveries with late rows, compacted after the second and the third; one day is then made anew from the log."""
    source, checkpoint, partials, root = (scratch_path(spark, n) for n in ("in", "checkpoint", "partials", "archive"))
    lines = _lines(spark, sf_dir)
    book = archive.MinuteArchive(spark, partials, root)
    for delivery in range(4):
        lines.where(F.col("user_id") % 4 == delivery).select("line").write.mode("append").text(source)
        st.run_available(st.cdn_requests(st.line_stream(spark, source), CDN_FIELDS), checkpoint, st.partial_minutes_sink(partials))
        if delivery in (1, 2):
            book.compact(archive.committed_batch(spark, checkpoint))
            book.clean()
    book.compact(archive.committed_batch(spark, checkpoint))
    day = lines.agg(F.min("d")).first()[0]
    requests = st.cdn_requests(lines.where(F.col("d") == F.lit(day)).select("line"), CDN_FIELDS)
    book.recompute(rollup.cdn_minutes(requests), [day])
    book.clean()
    return shown(book.read(), "minute", *rollup.CDN_KEYS)
