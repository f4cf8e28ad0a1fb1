"""Clustered tables: rows of a key in one file, in order, so that later windows and joins move and sort nothing."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.session import delete_path

#: A scan of one file per bucket hands on the order in it, and a join may use a partitioning by some of its keys.
SETTINGS = {
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}

#: Bytes of a row group of a placed table.
PLACED_BLOCK = 8 << 20


def write_clustered(df: DataFrame, name: str, path: str, by: Sequence[str], order: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Write a table of the catalog, bucketed by ``by`` and sorted by ``by`` and ``order``: one file per bucket.

    A key lies in one file whatever its size, so this suits keys that no task is too small for; see ``keyed.heavy_keys``.
    Without ``buckets`` there are as many as shuffle partitions.
    """
    spark = df.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    delete_path(spark, path)
    rows = df.repartition(count, *by).sortWithinPartitions(*by, *order)
    rows.write.format("parquet").bucketBy(count, *by).sortBy(*by, *order).option("path", path).saveAsTable(name)
    return spark.table(f"`{name}`")


def store_placed(df: DataFrame, name: str, path: str, by: Sequence[str], buckets: int) -> DataFrame:
    """The same for rows that a step has placed by ``by`` in ``buckets`` partitions already: nothing is moved again.

    What sums or joins the table by ``by`` reads whole buckets and needs no exchange of it.
    """
    df.write.format("parquet").bucketBy(buckets, *by).sortBy(*by).option("path", path).option("parquet.block.size", PLACED_BLOCK).saveAsTable(name)
    return df.sparkSession.table(f"`{name}`")


@contextmanager
def clustered_plans(spark: SparkSession) -> Iterator[None]:
    """Plans made inside use buckets and their order; run or store what they give before leaving."""
    before = {key: spark.conf.get(key) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def out_of_order(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of a Parquet table that come before their predecessor in the same file; none in a sorted one."""
    place = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    key = F.struct(*by)
    before = F.lag(key).over(Window.partitionBy("_file").orderBy("_row"))
    return place.withColumn("_before", before).where(F.col("_before") > key).drop("_file", "_row", "_before")
