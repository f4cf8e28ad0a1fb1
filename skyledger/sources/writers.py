"""Batch sinks. None of them funnels data through one task: file counts follow the partitions of the data."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.session import delete_path
from skyledger.sources.files import file_names


def write_partitions(df: DataFrame, path: str, by: Sequence[str], format: str = "parquet") -> None:
    """Replace exactly the partitions present in ``df``.

    The rebalance hint brings the rows of a partition together, so that files are few, and lets adaptive execution
    split a partition that is too large for one task and merge small ones.
    """
    rows = df.hint("rebalance", *by)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).format(format).save(path)


def write_snapshot(df: DataFrame, root: str, region: str, day: date) -> None:
    """One run replaces one region and day; parts of the date are zero-padded folders."""
    dated = (
        df.drop("region", "day", "month", "year")
        .withColumn("region", F.lit(region))
        .withColumn("day", F.lit(f"{day.day:02d}"))
        .withColumn("month", F.lit(f"{day.month:02d}"))
        .withColumn("year", F.lit(f"{day.year:04d}"))
    )
    write_partitions(dated, root, ["region", "day", "month", "year"], "orc")


def write_stages(stages: dict[str, DataFrame], root: str, by: Sequence[str] = ("usage_account", "year", "month")) -> None:
    """Named intermediate steps, one folder each."""
    for name, df in stages.items():
        present = [c for c in by if c in df.columns]
        if present:
            write_partitions(df, f"{root}/{name}", present)
        else:
            df.write.mode("overwrite").parquet(f"{root}/{name}")


def write_json_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    df.write.mode(mode).json(path)


def write_by_index(df: DataFrame, path: str, mode: str = "append") -> None:
    """JSON records under one folder per target index."""
    df.write.mode(mode).partitionBy("index").json(path)


def split_failed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed rows, and the lines that could not be read."""
    return df.where(F.col("parse_ok")).drop("parse_ok", "line"), df.where(~F.col("parse_ok")).select("line")


def write_delivery(df: DataFrame, path: str, failed_path: str, everything: bool = False, mode: str = "append") -> None:
    """Good records as JSON; failed lines (or, with ``everything``, all lines) to the side output."""
    good, bad = split_failed(df)
    write_json_lines(good, path, mode)
    (df.select("line") if everything else bad).write.mode(mode).text(failed_path)


def write_metric_log(records: DataFrame, path: str, mode: str = "append") -> None:
    """Metric-log records (one JSON text column) as compressed text."""
    records.write.mode(mode).option("compression", "gzip").text(path)


def write_archive(lines: DataFrame, path: str) -> None:
    """Compressed text below date/instance/backup folders taken from ``date``, ``instance`` and ``backup`` columns."""
    lines.select("date", "instance", "backup", "line").write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).option("compression", "gzip").partitionBy("date", "instance", "backup").text(path)


def refresh(df: DataFrame, path: str, day: str, as_of: date, days: int = 35) -> None:
    """Make the last ``days`` day partitions those of ``df`` and leave older ones alone.

    Partitions in the window that have no rows any more are removed. They are told by the names of the folders, before the
    window is written, and removed after it: a run that is lost in between leaves old days for the next run to remove, and
    never takes one away whose new rows are not there.
    """
    spark = df.sparkSession
    recent = df.where(F.col(day) >= F.date_sub(F.lit(as_of.isoformat()).cast("date"), days))
    first = (as_of - timedelta(days=days)).isoformat()
    prefix = f"{day}="
    held = [n for n in file_names(spark, path) if n.startswith(prefix) and n[len(prefix) :] >= first and n[len(prefix) :] != HIVE_NULL]
    present = spark.createDataFrame([(n[len(prefix) :],) for n in held], "name string")
    vanished = present.join(recent.select(F.col(day).cast("string").alias("name")).distinct(), "name", "left_anti")
    gone = [r.name for r in vanished.collect()]  # at most one row for each day of the window
    write_partitions(recent, path, [day])
    for name in gone:
        delete_path(spark, f"{path}/{prefix}{name}")


HIVE_NULL = "__HIVE_DEFAULT_PARTITION__"  # fixed value: folder of rows without a day
