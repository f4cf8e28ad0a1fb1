"""Exactly-once pick-up of files: a ledger of what each run took, committed by one marker per run.

A run goes through three steps, and may be lost between any two of them:

1. ``begin`` lists what no committed run has taken, by name, time and size together, and stores that plan. Where the run
   before has a plan but no marker, its plan is taken up again as it is, so the same files go into the same run.
2. The caller writes the run's output with ``write_run``: a folder of the run's own, replaced when the run is repeated.
3. ``commit`` creates the run's marker, which a store does once. From then on the files are taken and the rows visible.

Readers see committed runs only, so output of a run that was lost is neither read nor doubled. Files of one second, files
that are rewritten under the same name, and files that appear late below the newest time seen are told apart, which a
high-water mark cannot do.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.sources.files import complete_folders, create_marker, file_names

ENTRY = "path string, name string, last_written long, size long"
IDENTITY = ["path", "last_written", "size"]


class FileLedger:
    """The ledger below ``root``: ``plan/run=<n>`` and ``commits/<n>``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def committed(self) -> list[int]:
        return sorted(int(n) for n in file_names(self.spark, f"{self.root}/commits") if n.isdigit())

    def plan(self, run: int) -> DataFrame:
        return self.spark.read.schema(ENTRY).parquet(f"{self.root}/plan/run={run}")

    def taken(self) -> DataFrame:
        """Files of committed runs, with the run."""
        runs = self.committed()
        if not runs:
            return self.spark.createDataFrame([], f"{ENTRY}, run int")
        plans = self.spark.read.schema(f"{ENTRY}, run int").parquet(f"{self.root}/plan")
        return plans.where(F.col("run").isin(runs))

    def begin(self, files: DataFrame) -> int | None:
        """Number of the run to do now; None where there is nothing to take.

        ``files``: path, name, last_written (epoch milliseconds), size, as ``list_files`` gives them.
        """
        done = self.committed()
        number = done[-1] + 1 if done else 0
        planned = number in complete_folders(self.spark, f"{self.root}/plan", "run")
        # an empty plan promises nothing, so it is made again
        if not planned or self.plan(number).isEmpty():
            fresh = files.select("path", "name", "last_written", "size").distinct().join(self.taken(), IDENTITY, "left_anti")
            fresh.write.mode("overwrite").parquet(f"{self.root}/plan/run={number}")
        return None if self.plan(number).isEmpty() else number

    def commit(self, run: int) -> bool:
        """Make the run count; False where it did already."""
        return create_marker(self.spark, f"{self.root}/commits/{run}")


def read_lines_since(ledger: FileLedger, run: int, source: str) -> DataFrame:
    """Rows (path, line) of the text files below ``source`` that are no older than the oldest file of the run's plan.

    Files of earlier runs are passed over by their time, before they are opened; ``read_planned`` then keeps the plan's own.
    """
    oldest = ledger.plan(run).agg(F.min("last_written")).first()[0] or 0
    after = datetime.fromtimestamp(max(oldest // 1000 - 1, 0), UTC).strftime("%Y-%m-%dT%H:%M:%S")
    reader = ledger.spark.read.option("recursiveFileLookup", True).option("modifiedAfter", after).option("timeZone", "UTC")
    return reader.text(source).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"))


def read_planned(ledger: FileLedger, run: int, lines: DataFrame, path: str = "path") -> DataFrame:
    """Rows of the run's files out of ``lines``, which carry their file's path."""
    return lines.join(ledger.plan(run).select(F.col("path").alias(path)), path, "left_semi")


def write_run(df: DataFrame, path: str, run: int, format: str = "parquet") -> None:
    """The run's rows in a folder of its own; repeating the run replaces them."""
    df.write.mode("overwrite").format(format).save(f"{path}/run={run}")


def committed_rows(ledger: FileLedger, path: str, schema: str, format: str = "parquet") -> DataFrame:
    """Rows of committed runs, with ``run``; folders of other runs are pruned before they are read."""
    rows = ledger.spark.read.schema(f"{schema}, run int").format(format).load(path)
    return rows.where(F.col("run").isin(ledger.committed() or [-1]))


def pick_up(ledger: FileLedger, files: DataFrame, process: Callable[[DataFrame, int], DataFrame], path: str) -> int | None:
    """One whole run: ``process`` turns the plan's files into rows. Returns the run's number, None without new files."""
    run = ledger.begin(files)
    if run is None:
        return None
    write_run(process(ledger.plan(run), run), path, run)
    ledger.commit(run)
    return run
