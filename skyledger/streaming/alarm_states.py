"""Alarm states over a stream of metric samples.

Every micro-batch leaves a new version of a small stored state and the states of the periods it decided. A version holds

* ``statistics``: count, sum, least and greatest value per alarm, metric and period, for the periods that may still change
  and those the next judgement looks back on (the alarm's N periods, and the two newest older points, which differences
  and rates refer to);
* ``heads``: one row per alarm: the newest period judged, the time reached, and the last known state and the state just
  before the periods that may still change.

A batch starts from the newest version older than itself and writes the version of its own number, so a batch that is
repeated after a failure finds what it found before and replaces what it wrote. Alarms whose metrics are silent advance with
the batch's time. The cost of a batch follows the number of alarms and the length of their windows, not the history.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyledger.operators import alarms as al
from skyledger.session import delete_path
from skyledger.sources.files import complete_folders

#: Older points that differences between periods refer to.
LOOK_BACK_POINTS = 2


def alarm_sink(path: str, alarms: DataFrame, start: int, late_periods: int = 1) -> Callable[[DataFrame, int], None]:
    """Sink for ``foreachBatch`` over samples (resource_id, metric, epoch, value).

    ``start`` (epoch seconds) is where every alarm's periods begin. The newest ``late_periods`` periods that were judged
    and the open one are judged again in every batch, so samples that late change them. Samples of older periods, and of
    any before ``start``, change no state; they go to ``late_samples``. An alarm that is new, or whose period changed, begins at ``start``.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        advance(batch, alarms, path, batch_id, start, late_periods)

    return sink


def advance(batch: DataFrame, alarms: DataFrame, path: str, batch_id: int, start: int, late_periods: int = 1) -> None:
    """One micro-batch: read the state before it, judge, write states, late samples and the new state."""
    spark = batch.sparkSession
    statistics, heads, reached = _state_before(spark, path, batch_id)
    newest = batch.agg(F.max("epoch")).first()[0]
    as_of = max(v for v in (newest, reached, start) if v is not None)
    # alarms, and with them spans and heads, grow with the resources: they are merged, never collected for a broadcast
    spans = _spans(alarms, heads, start, as_of, late_periods)

    new = al.period_statistics(batch, alarms)
    placed = new.join(spans.select("alarm_name", "first_open").hint("merge"), "alarm_name")
    in_time = F.col("period_start") >= F.col("first_open")
    placed.where(~in_time).drop("first_open").write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")
    known = statistics.join(spans.select("alarm_name", "period").hint("merge"), ["alarm_name", "period"], "left_semi")
    merged = al.merge_statistics(placed.where(in_time).drop("first_open").select(*known.columns).unionByName(known))
    folder = f"{path}/state/version={batch_id}"
    kept = _tail(merged, spans)
    kept.write.mode("overwrite").parquet(f"{folder}/statistics")
    merged = spark.read.schema(kept.schema).parquet(f"{folder}/statistics")

    points = al.points_of(merged, alarms)
    step = F.col("period").cast("long")
    grid = spans.select("*", F.explode(F.sequence("first_seen", "last", step)).alias("period_start"))
    rows = (
        grid.join(points.select("alarm_name", "period_start", "value").hint("merge"), ["alarm_name", "period_start"], "left")
        .withColumn("context", F.col("period_start") < F.col("first_open"))
        .join(alarms.select("alarm_name", *al.RULE).hint("merge"), "alarm_name")
    )
    target = f"{path}/states/batch_id={batch_id}"
    al.judge_periods(rows, carried=True).write.mode("overwrite").parquet(target)
    judged = spark.read.parquet(target)
    _heads_after(judged, spans, late_periods).withColumn("reached", F.lit(as_of).cast("long")).write.mode("overwrite").parquet(f"{folder}/heads")
    for old in complete_folders(spark, f"{path}/state", "version", "heads"):
        if old < batch_id - 1:
            delete_path(spark, f"{path}/state/version={old}")


HEADS = "alarm_name string, period long, last long, known_before string, state_before string, reached long"
PARTS = "alarm_name string, resource_id string, period int, _position int, statistic string, period_start long, _n long, _sum double, _min double, _max double"


def _state_before(spark: SparkSession, path: str, batch_id: int) -> tuple[DataFrame, DataFrame, int | None]:
    versions = [v for v in complete_folders(spark, f"{path}/state", "version", "heads") if v < batch_id]
    if not versions:
        return spark.createDataFrame([], PARTS), spark.createDataFrame([], HEADS), None
    folder = f"{path}/state/version={max(versions)}"
    heads = spark.read.schema(HEADS).parquet(f"{folder}/heads")
    return spark.read.schema(PARTS).parquet(f"{folder}/statistics"), heads, heads.agg(F.max("reached")).first()[0]


def _spans(alarms: DataFrame, heads: DataFrame, start: int, as_of: int, late_periods: int) -> DataFrame:
    """Per alarm: the first period that may change, the last one, and the first whose values are looked at."""
    step = F.col("period").cast("long")

    def floor(at: int):
        return F.lit(at).cast("long") - F.pmod(F.lit(at).cast("long"), step)

    known = heads.select("alarm_name", F.col("period").cast("int").alias("period"), F.col("last").alias("_last"), "known_before", "state_before")
    spans = alarms.select("alarm_name", F.col("period").cast("int").alias("period"), "periods").distinct().join(known.hint("merge"), ["alarm_name", "period"], "left")
    begin = floor(start)
    first_open = F.greatest(begin, F.coalesce(F.col("_last") - F.lit(late_periods) * step, begin))
    return (
        spans.withColumn("first_open", first_open)
        .withColumn("last", F.greatest(floor(as_of), F.coalesce("_last", begin)))
        .withColumn("first_seen", F.greatest(begin, F.col("first_open") - F.col("periods") * step))
        .select("alarm_name", "period", "first_open", "last", "first_seen", "known_before", "state_before")
    )


def _tail(statistics: DataFrame, spans: DataFrame) -> DataFrame:
    """The statistics that this and the next judgement need."""
    columns = statistics.columns
    rows = statistics.join(spans.select("alarm_name", "first_seen").hint("merge"), "alarm_name")
    old = F.col("period_start") < F.col("first_seen")
    newest_first = Window.partitionBy("alarm_name", old).orderBy(F.col("period_start").desc())
    rows = rows.withColumn("_age", F.dense_rank().over(newest_first))
    return rows.where(~old | (F.col("_age") <= LOOK_BACK_POINTS)).select(*columns)


def _heads_after(judged: DataFrame, spans: DataFrame, late_periods: int) -> DataFrame:
    """One row per alarm: its newest period, and what it was in just before the periods that stay open."""
    step = F.col("period").cast("long")
    # judged rows start at the first open period, so rows before the next open one are among them or the old values hold
    rows = judged.select("alarm_name", "period_start", "last_known", "state").join(
        spans.withColumn("next_open", F.greatest("first_open", F.col("last") - F.lit(late_periods) * step)).hint("merge"), "alarm_name"
    )
    settled = F.when(F.col("period_start") < F.col("next_open"), F.col("period_start"))
    out = rows.groupBy("alarm_name", F.col("period").cast("long").alias("period"), "last").agg(
        F.max_by("last_known", settled).alias("_known"),
        F.max_by("state", settled).alias("_state"),
        F.max(settled).alias("_settled"),
        F.max("known_before").alias("known_before"),
        F.max("state_before").alias("state_before"),
    )
    moved = F.col("_settled").isNotNull()
    return out.select(
        "alarm_name",
        "period",
        "last",
        F.when(moved, F.col("_known")).otherwise(F.col("known_before")).alias("known_before"),
        F.when(moved, F.col("_state")).otherwise(F.col("state_before")).alias("state_before"),
    )


STATES = "alarm_name string, period_start long, value double, breaches int, present int, state string, previous_state string, last_known string, batch_id int"


def current_states(spark: SparkSession, path: str) -> DataFrame:
    """The latest judgement of every alarm and period, whatever number of batches judged it."""
    rows = spark.read.schema(STATES).parquet(f"{path}/states")
    latest = rows.groupBy("alarm_name", "period_start").agg(F.max_by(F.struct(*al.JUDGED[2:]), "batch_id").alias("_s"))
    return latest.select("alarm_name", "period_start", "_s.*")


def late_samples(spark: SparkSession, path: str) -> DataFrame:
    """Statistics of periods that were closed when their samples came."""
    return spark.read.schema(f"{PARTS}, batch_id int").parquet(f"{path}/late")
