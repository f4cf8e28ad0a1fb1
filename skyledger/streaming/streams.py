"""Structured Streaming forms: file sources, per-minute roll-ups, fan-out, de-duplication.

The parsers and the aggregate lists are the batch ones, so both modes compute the same thing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from skyledger.operators import logs, rollup


def line_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Text files as they arrive: path and line. Files seen once stay seen (checkpoint)."""
    raw = spark.readStream.option("recursiveFileLookup", True).option("maxFilesPerTrigger", max_files).text(path)
    return raw.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))


def record_stream(spark: SparkSession, path: str, schema: str, format: str = "json", max_files: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).format(format).load(path)


def cdn_requests(lines: DataFrame, fields: Sequence[str], country: str | None = None) -> DataFrame:
    """Access-log lines to the roll-up's input columns; batch or streaming."""
    return parsed_requests(logs.parse_cdn(lines, fields).where(F.col("parse_ok")), country)


def parsed_requests(rows: DataFrame, country: str | None = None) -> DataFrame:
    """Parsed access-log rows to the roll-up's input columns."""
    return rows.select(
        "timestamp",
        F.timestamp_millis("timestamp").alias("ts"),
        F.col("`x-host-header`").alias("host"),
        (F.col(country) if country else F.lit("unknown")).alias("country"),
        F.lit("unknown").alias("asn"),
        F.col("`sc-status`").alias("response_code"),
        F.col("`x-edge-response-result-type`").alias("result_type"),
        F.col("`sc-bytes`").try_cast("bigint").alias("bytes_down"),
        F.col("`cs-bytes`").try_cast("bigint").alias("bytes_up"),
        logs.download_speed().alias("speed"),
        F.col("`c-ip`").alias("ip"),
    )


def minutes_final(requests: DataFrame, watermark: str = "1 hour", period: str = "60 seconds") -> DataFrame:
    """Append form: a minute is emitted once the watermark has passed it; later rows are dropped by the watermark."""
    windowed = requests.withWatermark("ts", watermark).groupBy(F.window("ts", period), *rollup.CDN_KEYS)
    return windowed.agg(*rollup.cdn_measures()).select(
        F.unix_millis("window.start").alias("minute"), *rollup.CDN_KEYS, *_names()
    )


def _names() -> list[str]:
    return ["requests", "bytes_down", "bytes_up", "speed_count", "speed_sum", "speed_max", "speed_min"]


def run_available(
    df: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None] | None = None, path: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Process everything that has arrived, then stop; to a Parquet path or through ``sink`` per micro-batch."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = writer.foreachBatch(sink).start() if sink else writer.format("parquet").option("path", path).start()
    query.awaitTermination()
    return query


def replace_batch(df: DataFrame, path: str, batch_id: int, format: str = "parquet") -> None:
    """Write one micro-batch under its own folder; running the batch again replaces it, so nothing doubles."""
    df.write.mode("overwrite").format(format).save(f"{path}/batch_id={batch_id}")


def partial_minutes_sink(path: str, keys: Sequence[str] = tuple(rollup.CDN_KEYS)) -> Callable[[DataFrame, int], None]:
    """Per-batch partial roll-ups. Late rows are always taken: they land in a later partial of the same minute."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        replace_batch(rollup.cdn_minutes(batch, keys=keys), path, batch_id)

    return sink


def merged_minutes(spark: SparkSession, path: str, keys: Sequence[str] = tuple(rollup.CDN_KEYS)) -> DataFrame:
    """All partials of a minute combined."""
    return rollup.merge_minutes(spark.read.parquet(path), keys)


def fan_out_sink(
    index_path: str, minutes_path: str, failed_path: str, fields: Sequence[str], prefix: str = "cdn-"
) -> Callable[[DataFrame, int], None]:
    """One input, three outputs per micro-batch: indexed records, minute partials, unreadable lines."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        parsed = logs.parse_cdn(batch, fields).persist()
        good = parsed.where(F.col("parse_ok"))
        day = F.timestamp_millis("timestamp")
        indexed = rollup.day_index(good.drop("parse_ok", "line"), day, prefix)
        indexed.write.mode("overwrite").partitionBy("index").json(f"{index_path}/batch_id={batch_id}")
        replace_batch(rollup.cdn_minutes(parsed_requests(good)), minutes_path, batch_id)
        failed = parsed.where(~F.col("parse_ok")).select("line")
        replace_batch(failed, failed_path, batch_id, "text")
        parsed.unpersist()

    return sink


def unique_samples(samples: DataFrame, series: Sequence[str], ts: str = "ts", watermark: str = "1 hour") -> DataFrame:
    """One sample per series and time inside the watermark; state older than that is released."""
    return samples.withWatermark(ts, watermark).dropDuplicatesWithinWatermark([*series, ts])
