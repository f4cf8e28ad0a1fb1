"""Compaction of the partial roll-ups that a stream leaves: one set of files per day instead of a folder per batch.

``compact`` merges the partials of all batches that the stream has committed into the days they touch. It writes a new
generation that holds these days whole, and one marker makes it count: from then on the days are read from it and the
batches up to the marker's number are not read any more. A run lost before the marker leaves nothing that is read, and a
run done twice writes the same. A late file arrives as one more batch, so the next run corrects its day and no other.
``recompute`` replaces days by rows made anew from the logs. ``clean`` deletes what no reader needs any more.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators import rollup
from skyledger.session import delete_path
from skyledger.sources.files import create_marker, file_names


class MinuteArchive:
    """Partials below ``partials/batch_id=<n>``, days below ``root/days/generation=<g>/day=<date>``."""

    def __init__(self, spark: SparkSession, partials: str, root: str, keys: Sequence[str] = tuple(rollup.CDN_KEYS)):
        self.spark, self.partials, self.root, self.keys = spark, partials.rstrip("/"), root.rstrip("/"), list(keys)

    def _commits(self) -> list[tuple[int, int]]:
        """(generation, last batch in it) of all that count, in order."""
        names = [n.split("_") for n in file_names(self.spark, f"{self.root}/commits")]
        return sorted((int(g), int(b)) for g, b in (n for n in names if len(n) == 2))

    def upto(self) -> int:
        """Last batch that the days include, -1 before the first run."""
        return max((b for _, b in self._commits()), default=-1)

    def _days(self) -> DataFrame | None:
        commits = self._commits()
        if not commits:
            return None
        counted = [g for g, _ in commits]
        rows = self.spark.read.option("basePath", f"{self.root}/days").parquet(*[f"{self.root}/days/generation={g}" for g in counted])
        # the newest generation of each day; their folders' names tell
        newest = rows.groupBy("day").agg(F.max("generation").alias("generation"))
        return rows.join(newest, ["day", "generation"], "left_semi").where(F.col("minute").isNotNull())

    def _partials(self, after: int, upto: int | None = None) -> DataFrame | None:
        if not any(n.startswith("batch_id=") for n in file_names(self.spark, self.partials)):
            return None
        rows = self.spark.read.parquet(self.partials).where(F.col("batch_id") > after)
        return rows if upto is None else rows.where(F.col("batch_id") <= upto)

    def _merged(self, parts: list[DataFrame | None]) -> DataFrame:
        given = [p.select("minute", *self.keys, *MEASURES) for p in parts if p is not None]
        if not given:
            raise ValueError(f"there is nothing at {self.partials}")
        rows = given[0]
        for more in given[1:]:
            rows = rows.unionByName(more)
        return rollup.merge_minutes(rows, self.keys)

    def read(self) -> DataFrame:
        """All minutes: the days, and the partials of batches that came after."""
        return self._merged([self._days(), self._partials(self.upto())])

    def compact(self, committed: int) -> bool:
        """Take the batches up to ``committed``, which the stream must not repeat any more; False without new ones."""
        fresh = self._partials(self.upto(), committed)
        if fresh is None or fresh.isEmpty():
            return False
        touched = fresh.select(_day().alias("day")).distinct()
        days = self._days()
        old = None if days is None else days.join(touched, "day", "left_semi")
        return self._publish(self._merged([old, fresh]), max(committed, self.upto()))

    def recompute(self, minutes: DataFrame, days: Sequence[date]) -> bool:
        """Replace whole days by ``minutes``, made from the logs of all batches so far; a day without rows is emptied.

        Raises where batches that came after the last ``compact`` hold rows of these days, as they would count twice.
        """
        wanted = _day().isin([F.lit(d) for d in days])
        waiting = self._partials(self.upto())
        if waiting is not None and not waiting.where(wanted).isEmpty():
            raise ValueError("compact the batches of these days first")
        rows = minutes.where(wanted).select("minute", *self.keys, *MEASURES)
        present = {r[0] for r in rows.select(_day()).distinct().collect()}
        gone = [d for d in days if d not in present]
        # an emptied day keeps one row without a minute, which marks it and is not read
        kinds = {f.name: f.dataType for f in rows.schema}
        blank = [F.lit(None).cast(kinds[c]).alias(c) for c in ("minute", *self.keys, *MEASURES)]
        held = self.spark.createDataFrame([(d,) for d in gone], "day date").select(*blank, "day") if gone else None
        return self._publish(rows, self.upto(), held)

    def _publish(self, minutes: DataFrame, upto: int, held: DataFrame | None = None) -> bool:
        commits = self._commits()
        generation = commits[-1][0] + 1 if commits else 0
        rows = minutes.withColumn("day", _day())
        rows = rows if held is None else rows.unionByName(held)
        # static: days that a lost run left in this generation go
        writer = rows.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("day")
        writer.parquet(f"{self.root}/days/generation={generation}")
        return create_marker(self.spark, f"{self.root}/commits/{generation}_{upto}")

    def clean(self) -> None:
        """Delete batches that the days include, and days that a newer generation holds."""
        upto, commits = self.upto(), self._commits()
        for name in file_names(self.spark, self.partials):
            if name.startswith("batch_id=") and int(name.split("=")[1]) <= upto:
                delete_path(self.spark, f"{self.partials}/{name}")
        seen: set[str] = set()
        for generation, _ in reversed(commits):
            folder = f"{self.root}/days/generation={generation}"
            for name in file_names(self.spark, folder):
                if name in seen and name.startswith("day="):
                    delete_path(self.spark, f"{folder}/{name}")
                seen.add(name)


MEASURES = ["requests", "bytes_down", "bytes_up", "speed_count", "speed_sum", "speed_max", "speed_min"]


def _day():
    return F.to_date(F.timestamp_millis("minute"))


def committed_batch(spark: SparkSession, checkpoint: str) -> int:
    """Newest batch that a stream with this checkpoint will not repeat, -1 for none."""
    return max((int(n) for n in file_names(spark, f"{checkpoint}/commits") if n.isdigit()), default=-1)
