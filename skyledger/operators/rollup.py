"""Per-minute roll-ups of access logs and probes, dimension subsets, metric-log records, delivery batches."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.timefns import floor_epoch
from skyledger.operators.keyed import position_before

CDN_KEYS = ["host", "country", "asn", "response_code", "result_type"]
# Default dimension subsets.
CDN_SETS = [[], ["host"], ["host", "country"], ["host", "country", "response_code"]]
PROBE_SETS = [["target"], ["target", "city"]]


def minute_of(millis: Column | str, period: int = 60) -> Column:
    """Start, in epoch milliseconds, of the epoch-aligned period."""
    m = F.col(millis) if isinstance(millis, str) else millis
    return floor_epoch(m, period * 1000)


def cdn_minutes(requests: DataFrame, period: int = 60, keys: Sequence[str] = tuple(CDN_KEYS)) -> DataFrame:
    """Requests, bytes and download-speed statistics per minute and key.

    ``requests``: timestamp (ms), the key columns, bytes_down, bytes_up, speed (NULL when unknown).
    """
    return requests.groupBy(minute_of("timestamp", period).alias("minute"), *keys).agg(*cdn_measures())


def cdn_measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("requests"),
        F.sum("bytes_down").alias("bytes_down"),
        F.sum("bytes_up").alias("bytes_up"),
        F.count("speed").alias("speed_count"),
        F.sum("speed").alias("speed_sum"),
        F.max("speed").alias("speed_max"),
        F.min("speed").alias("speed_min"),
    ]


def merge_measures() -> list[Column]:
    """How two partial roll-ups of the same key combine: counts and sums add, extremes extend."""
    return [
        F.sum("requests").alias("requests"),
        F.sum("bytes_down").alias("bytes_down"),
        F.sum("bytes_up").alias("bytes_up"),
        F.sum("speed_count").alias("speed_count"),
        F.sum("speed_sum").alias("speed_sum"),
        F.max("speed_max").alias("speed_max"),
        F.min("speed_min").alias("speed_min"),
    ]


def merge_minutes(partials: DataFrame, keys: Sequence[str] = tuple(CDN_KEYS)) -> DataFrame:
    return partials.groupBy("minute", *keys).agg(*merge_measures())


def _sets(rows: DataFrame, sets: Sequence[Sequence[str]], measures: Sequence[Column]) -> DataFrame:
    dims = list(dict.fromkeys(d for s in sets for d in s))
    columns = [[F.col(c) for c in ("minute", *s)] for s in sets]
    if not dims:
        return rows.groupBy("minute").agg(*measures).withColumns({"level": F.lit(0), "dimensions": F.lit("")})
    grouped = rows.groupingSets(columns, "minute", *dims).agg(*measures, F.grouping_id("minute", *dims).alias("_gid"))
    # a bit of the id is set for each dimension that is not in the row's set, the last one lowest
    present = [F.when(F.shiftright("_gid", len(dims) - 1 - i).bitwiseAND(F.lit(1)) == 0, F.lit(d)) for i, d in enumerate(dims)]
    grouped = grouped.withColumn("dimensions", F.concat_ws(",", *present))
    return grouped.withColumn("level", (F.lit(len(dims)) - F.bit_count("_gid")).cast("int")).drop("_gid")


def cdn_dimension_sets(minutes: DataFrame, sets: Sequence[Sequence[str]] = CDN_SETS) -> DataFrame:
    """The measures on each set of dimensions, tagged by ``dimensions``, their names, and ``level``, their number.

    Dimensions outside a row's set are NULL. Runs on the per-minute table, so the raw log is aggregated once.
    """
    return _sets(minutes, sets, merge_measures())


def probe_dimension_sets(probes: DataFrame, sets: Sequence[Sequence[str]] = PROBE_SETS, period: int = 60) -> DataFrame:
    """``probe_minutes`` on each set of dimensions; averages do not add up, so this reads the probes themselves."""
    return _sets(_timed_probes(probes, period), sets, _probe_measures())


def statistic_values(minutes: DataFrame) -> DataFrame:
    """Speed statistic set, cut to whole numbers."""
    return minutes.select(
        *[c for c in minutes.columns if not c.startswith("speed_")],
        F.col("speed_count").alias("sample_count"),
        F.coalesce(F.col("speed_sum"), F.lit(0.0)).cast("long").alias("speed_sum"),
        F.coalesce(F.col("speed_min"), F.lit(0.0)).cast("long").alias("speed_min"),
        F.coalesce(F.col("speed_max"), F.lit(0.0)).cast("long").alias("speed_max"),
    )


def probe_minutes(probes: DataFrame, period: int = 60) -> DataFrame:
    """Probe results per minute, city and target: count, sum, average, true minimum and maximum of each duration.

    ``probes``: timestamp (ms), city, target, status, dns_ms, connect_ms, first_byte_ms.
    """
    return _timed_probes(probes, period).groupBy("minute", "city", "target").agg(*_probe_measures())


def _timed_probes(probes: DataFrame, period: int) -> DataFrame:
    success = F.when(F.col("status") == 200, 1).otherwise(0)
    return probes.withColumn("success", success).withColumn("minute", minute_of("timestamp", period))


def _probe_measures() -> list[Column]:
    measures = [F.count(F.lit(1)).alias("probes")]
    for c in ("success", "dns_ms", "connect_ms", "first_byte_ms"):
        measures += [
            F.sum(c).alias(f"{c}_sum"),
            F.avg(c).alias(f"{c}_avg"),
            F.min(c).alias(f"{c}_min"),
            F.max(c).alias(f"{c}_max"),
        ]
    return measures


def count_per_minute(df: DataFrame, millis: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(minute_of(millis).alias("minute"), *keys).agg(F.count(F.lit(1)).alias("count"))


def ingest_counts(files: DataFrame) -> DataFrame:
    """Copied files per prefix, and per region, instance and prefix."""
    dims = ["region", "instance", "log_prefix"]
    sets = [[F.col("log_prefix")], [F.col(c) for c in dims]]
    return files.groupingSets(sets, *dims).agg(
        F.count(F.lit(1)).alias("copied_file_count"), F.grouping_id(*dims).alias("_gid")
    ).withColumn("level", F.when(F.col("_gid") == 0, F.lit("instance")).otherwise(F.lit("prefix"))).drop("_gid")


def metric_log(
    rows: DataFrame,
    namespace: str,
    sets: Sequence[Sequence[str]],
    dimensions: dict[str, str],
    metrics: dict[str, tuple[str, str | None]],
    millis: str = "minute",
) -> DataFrame:
    """One JSON record per row in the structured metric-log layout.

    ``dimensions`` and ``metrics`` map an output name to its column (metrics also to a unit or None).
    """
    declared = [{"Name": n, **({"Unit": u} if u else {})} for n, (_, u) in metrics.items()]
    header = json.dumps([{"Dimensions": [list(s) for s in sets], "Metrics": declared, "Namespace": namespace}])
    described = F.from_json(
        F.lit(header),
        "array<struct<Dimensions:array<array<string>>,Metrics:array<struct<Name:string,Unit:string>>,Namespace:string>>",
    )
    aws = F.struct(F.col(millis).alias("Timestamp"), described.alias("CloudWatchMetrics"))
    body = F.struct(
        *[F.col(c).alias(n) for n, c in dimensions.items()],
        aws.alias("_aws"),
        *[F.col(c).alias(n) for n, (c, _) in metrics.items()],
    )
    return rows.select(F.to_json(body).alias("value"))


def delivery_batches(df: DataFrame, size: int = 500) -> DataFrame:
    """Adds ``batch``: at most ``size`` rows share one; numbered inside each partition, so nothing is shuffled."""
    numbered = df.withColumn("_id", F.monotonically_increasing_id())
    partition = F.shiftright("_id", 33)
    position = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.withColumn(
        "batch", F.concat_ws("-", partition.cast("string"), F.floor(position / F.lit(size)).cast("string"))
    ).drop("_id")


def numbered_batches(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, size: int = 500
) -> DataFrame:
    """Ordered form: batch number 0, 1, … of ``size`` rows per key; ``bucket`` splits large keys along the order."""
    placed = position_before(df, keys, order, F.lit(1), "_position", bucket)
    return placed.withColumn("batch", F.floor(F.col("_position") / F.lit(size)).cast("long")).drop("_position")


def payload_slices(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, body: str, limit: int = 40960
) -> DataFrame:
    """Slice numbers that grow with the order, so that the payload texts of a slice have ``limit`` characters at most.

    Texts that lie within the same stretch of ``limit`` characters of the key's running length share a slice; one that
    crosses into the next stretch has a slice of its own, as has a text that is longer than the limit.
    """
    size = F.coalesce(F.length(body), F.lit(0)).cast("long")
    placed = position_before(df, keys, order, size, "_position", bucket)
    stretch = F.floor(F.col("_position") / F.lit(limit)).cast("long")
    crosses = F.col("_position") + size > (stretch + 1) * F.lit(limit)
    return placed.withColumn("slice", stretch * 2 + crosses.cast("long")).drop("_position")


def day_index(df: DataFrame, day: Column, prefix: str) -> DataFrame:
    """Target index named by the record's own day."""
    return df.withColumn("index", F.concat(F.lit(prefix), F.date_format(day, "yyyy-MM-dd")))
