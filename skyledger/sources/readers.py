"""Batch sources: partitioned tables, JSON records, text logs, audit documents, snapshots."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def month_of(df: DataFrame, year: str | int, month: str | int) -> DataFrame:
    """One partition of a table partitioned by text columns year and un-padded month.

    Both predicates are literals on bare columns, so only that partition is listed and read.
    """
    return df.where((F.col("year") == str(int(year))) & (F.col("month") == str(int(month))))


def read_partition(spark: SparkSession, table: str, year: str | int, month: str | int) -> DataFrame:
    """The same for a catalog table or, when ``table`` is a path, a Parquet folder.

    The partition columns of a folder are read as text, whatever type inference would make of them.
    """
    if "/" not in table:
        return month_of(spark.table(table), year, month)
    found = spark.read.parquet(table)
    kinds = {f.name: f.dataType.simpleString() for f in found.schema}
    if kinds.get("year") != "string" or kinds.get("month") != "string":
        schema = ", ".join(
            f"`{f.name}` {'string' if f.name in ('year', 'month') else f.dataType.simpleString()}" for f in found.schema
        )
        found = spark.read.schema(schema).parquet(table)
    return month_of(found, year, month)


def read_records(spark: SparkSession, path: str, schema: str, ts: str = "date") -> DataFrame:
    """JSON records with an explicit schema; the time column becomes a timestamp."""
    return spark.read.schema(schema).json(path).withColumn(ts, F.to_timestamp(ts))


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text logs, gzip by extension: one row per line with its file path."""
    return spark.read.text(path, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("line")
    )


AUDIT = (
    "Records array<struct<eventTime:string,eventName:string,eventSource:string,awsRegion:string,"
    "sourceIPAddress:string,userIdentity:struct<type:string,userName:string>>>"
)
AUDIT_FOLDER = "/CloudTrail/"  # fixed value: only documents below such a folder hold audit records


def read_audit(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Audit documents to one row per record; ``multi_line=False`` for files with one document per line."""
    documents = spark.read.schema(AUDIT).json(path, multiLine=multi_line, recursiveFileLookup=True)
    rows = documents.where(F.col("_metadata.file_path").contains(AUDIT_FOLDER)).select(F.explode("Records").alias("r"))
    return rows.select(
        F.col("r.eventTime").alias("event_time"),
        F.col("r.eventName").alias("event_name"),
        F.col("r.userIdentity.type").alias("user_type"),
        F.col("r.userIdentity.userName").alias("user_name"),
        F.col("r.sourceIPAddress").alias("source_ip"),
    )


def read_audit_variant(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The same, and each record whole: a document is parsed once into a variant, and columns are taken from it.

    A field of an unexpected type, or an unknown one, costs no other column; a record is kept with NULL where a column
    cannot be read. Documents of more than Spark's limit for one variant (128 MiB) need ``read_audit``.
    """
    reader = spark.read.option("singleVariantColumn", "document").option("recursiveFileLookup", True)
    documents = reader.json(path, multiLine=multi_line)
    records = F.try_variant_get("document", "$.Records", "array<variant>")
    rows = documents.where(F.col("_metadata.file_path").contains(AUDIT_FOLDER)).select(F.explode(records).alias("record"))

    def text(at: str):
        return F.try_variant_get("record", f"$.{at}", "string")

    return rows.select(
        text("eventTime").alias("event_time"),
        text("eventName").alias("event_name"),
        text("userIdentity.type").alias("user_type"),
        text("userIdentity.userName").alias("user_name"),
        text("sourceIPAddress").alias("source_ip"),
        "record",
    )


def read_snapshots(spark: SparkSession, root: str, merge_schema: bool = True) -> DataFrame:
    """ORC snapshots under region=/day=/month=/year= folders; schemas may differ between days."""
    return spark.read.option("mergeSchema", merge_schema).option("basePath", root).orc(root)


def snapshot_day(df: DataFrame, day: datetime, region: str | None = None) -> DataFrame:
    """One day's partition; inferred partition numbers and padded text compare alike."""
    kept = (
        (F.col("year").cast("int") == day.year)
        & (F.col("month").cast("int") == day.month)
        & (F.col("day").cast("int") == day.day)
    )
    return df.where(kept & (F.col("region") == region) if region else kept)


def changed_files(spark: SparkSession, path: str, after: datetime, min_size: int = 0, name: str = "[0-9]$") -> DataFrame:
    """Lines of files modified after the mark, at least ``min_size`` long, with a name ending in a digit."""
    lines = spark.read.option("modifiedAfter", after.strftime("%Y-%m-%dT%H:%M:%S")).option(
        "recursiveFileLookup", True
    ).text(path)
    kept = (F.col("_metadata.file_size") >= min_size) & F.col("_metadata.file_name").rlike(name)
    return lines.where(kept).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))


def register(spark: SparkSession, **tables: DataFrame) -> None:
    """Give inputs catalog names, so that SQL text can use them."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
