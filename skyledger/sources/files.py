"""Folders and marker files in whatever store holds them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _store(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def complete_folders(spark: SparkSession, path: str, key: str, inner: str = "") -> list[int]:
    """Numbers n of the folders ``<key>=<n>`` whose write (of ``inner`` within them) has ended, smallest first."""
    folder, store = _store(spark, path)
    if not store.exists(folder):
        return []
    names = [s.getPath().getName() for s in store.listStatus(folder)]
    numbers = sorted(int(n.split("=", 1)[1]) for n in names if n.startswith(f"{key}=") and n.split("=", 1)[1].isdigit())
    return [n for n in numbers if exists(spark, f"{path}/{key}={n}/{inner}/_SUCCESS" if inner else f"{path}/{key}={n}/_SUCCESS")]


def exists(spark: SparkSession, path: str) -> bool:
    found, store = _store(spark, path)
    return store.exists(found)


def create_marker(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False where it exists already. Stores create a file once, whoever asks first."""
    found, store = _store(spark, path)
    if store.exists(found):
        return False
    try:
        store.create(found, False).close()
    except Exception as error:
        if "AlreadyExists" in str(error):
            return False
        raise
    return True


def file_names(spark: SparkSession, path: str) -> list[str]:
    found, store = _store(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(found)) if store.exists(found) else []


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, last_written in epoch milliseconds, size) of all files below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"), F.unix_millis("modificationTime").alias("last_written"), F.col("length").alias("size"))
