"""Keyed building blocks that stay safe when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALT = "_salt"
DEFAULT_SALTS = 8
#: Most keys that are salted by their measured rows, and items the sketch that measures them tells apart. Both bound what
#: reaches the driver and the map literal that goes back out.
HEAVY_KEYS, SKETCH_ITEMS = 1024, 8192


def blank_strings(df: DataFrame) -> DataFrame:
    """NULL strings become ''; equi-joins on dimensions rely on it."""
    return df.na.fill("")


def _row_salt(df: DataFrame, keys: Sequence[str], salts: int | Column) -> Column:
    """Salt from the row and the partition it is in: equal rows of a key spread too, a repeated task gives the same."""
    atomic = [n for n, t in df.dtypes if n not in keys and not t.startswith(("map", "array", "struct", "variant"))]
    parts = salts if isinstance(salts, Column) else F.lit(salts)
    return F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(f"`{n}`") for n in atomic]), parts).cast("int")


def join_null_safe(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join on ``keys`` where NULL equals NULL, as grouping and windows have it; the keys come from ``df``."""
    named = {k: f"_key_{i}" for i, k in enumerate(keys)}
    right = other.select(*[F.col(f"`{k}`").alias(n) for k, n in named.items()], *[f"`{c}`" for c in other.columns if c not in named])
    same = F.lit(True)
    for k, n in named.items():
        same = same & df[f"`{k}`"].eqNullSafe(right[n])
    return df.join(right, same, how).drop(*named.values())


class HeavyKeys(dict):
    """Number of salts by the hash of a key, for the keys that hold more rows than a task should."""

    def salts(self, keys: Sequence[str]) -> Column:
        """Salts of the row's key, 1 for all but the heavy ones."""
        known = F.create_map(*[F.lit(x) for pair in sorted(self.items()) for x in pair])
        return F.coalesce(F.try_element_at(known, _key_hash(keys)), F.lit(1))


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def heavy_keys(df: DataFrame, keys: Sequence[str], tasks: int | None = None) -> HeavyKeys:
    """Keys that hold two tasks' fair share of the rows or more, each with as many salts as its share of the tasks.

    One pass over the key columns: a frequent-items sketch per task, merged by Spark. A key's number is an estimate from
    above, off by less than the rows divided by ``SKETCH_ITEMS``; salts need no more. Worth it where ``df`` is stored or
    scanned, since its plan runs once more for this.
    """
    tasks = tasks or _tasks(df)
    sketch = F.expr(f"approx_top_k(_hash, {HEAVY_KEYS}, {SKETCH_ITEMS})")
    found = df.select(_key_hash(keys).alias("_hash")).agg(sketch.alias("top"), F.count(F.lit(1)).alias("rows")).first()
    return _salted({r["item"]: r["count"] for r in found["top"] or []}, found["rows"], tasks)


def heavy_counts(counts: DataFrame, keys: Sequence[str], rows: str, tasks: int | None = None) -> HeavyKeys:
    """The same from a table with one row per key and its number of rows."""
    tasks = tasks or _tasks(counts)
    total = counts.agg(F.sum(rows)).first()[0] or 0
    large = counts.where(F.col(rows) * F.lit(tasks) >= 2 * total).select(_key_hash(keys).alias("hash"), F.col(rows).cast("long").alias("rows"))
    top = large.orderBy(F.col("rows").desc(), "hash").limit(HEAVY_KEYS)
    return _salted({r["hash"]: r["rows"] for r in top.collect()}, total, tasks)


def _salted(counts: dict[int, int], total: int, tasks: int) -> HeavyKeys:
    return HeavyKeys({k: -(-n * tasks // total) for k, n in counts.items() if total and n * tasks >= 2 * total})


def join_totals(
    df: DataFrame,
    totals: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    salts: int | HeavyKeys = DEFAULT_SALTS,
    null_safe: bool = False,
    grows: bool = False,
) -> DataFrame:
    """Attach one-row-per-key ``totals`` to ``df`` without sending a hot key to one task.

    ``salts`` is the number of parts of every key, or, measured by ``heavy_keys``, of the heavy ones: then the totals of
    all other keys are not copied, and nothing is salted where no key is heavy.

    The salt is a hash of the row and its partition, so recomputed tasks place rows exactly as before. ``totals`` is
    already aggregated, so its ``salts`` copies stay small; adaptive execution broadcasts it when its measured size
    allows. With ``null_safe`` a NULL key meets the NULL key of ``totals``. ``grows`` says that the number of keys grows
    with the data: such totals are never broadcast, since a stored table's file size says little of its size in memory.
    """
    if not salts or salts == 1:
        totals = totals.hint("merge") if grows else totals
        return join_null_safe(df, totals, keys, how) if null_safe else df.join(totals, list(keys), how)
    parts = salts.salts(keys) if isinstance(salts, HeavyKeys) else F.lit(salts)
    copies = totals.withColumn(SALT, F.explode(F.sequence(F.lit(0), parts - 1)))
    copies = copies.hint("merge") if grows else copies
    salted = df.withColumn(SALT, _row_salt(df, keys, parts))
    joined = join_null_safe(salted, copies, [*keys, SALT], how) if null_safe else salted.join(copies, [*keys, SALT], how)
    return joined.drop(SALT)


def mark_members(df: DataFrame, members: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Boolean column telling whether the row's key occurs in ``members``; never multiplies rows."""
    distinct = members.select(*keys).distinct().withColumn(flag, F.lit(True))
    return join_totals(df, distinct, keys).withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def share_of_total(
    df: DataFrame, keys: Sequence[str], measures: dict[str, str], salts: int | HeavyKeys = DEFAULT_SALTS
) -> DataFrame:
    """``measures`` maps a numeric column to the name of its share within the key; ``salts`` as for ``join_totals``."""
    totals = df.groupBy(*keys).agg(*[F.sum(m).alias(f"_total_{m}") for m in measures])
    out = join_totals(df, totals, keys, salts=salts, null_safe=True)
    for measure, share in measures.items():
        out = out.withColumn(share, F.try_divide(F.col(measure).cast("double"), F.col(f"_total_{measure}")))
    return out.drop(*[f"_total_{m}" for m in measures])


def keep_greatest(df: DataFrame, keys: Sequence[str], by: str, salts: int | HeavyKeys = DEFAULT_SALTS) -> DataFrame:
    """Rows whose ``by`` equals the greatest value of their key, ties included (rank = 1, descending)."""
    best = df.groupBy(*keys).agg(F.max(by).alias("_best"))
    return join_totals(df, best, keys, "inner", salts=salts, null_safe=True).where(F.col(by).eqNullSafe(F.col("_best"))).drop("_best")


def carried_lag(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
    bucket: Column,
) -> DataFrame:
    """Previous ``value`` per key, computed bucket by bucket.

    ``bucket`` is a coarse, order-preserving function of the first order column (an hour or a day). Only rows of one
    (key, bucket) meet in a task; the last value of the nearest earlier non-empty bucket is carried in, from a
    summary with one row per (key, bucket).
    """
    rows = df.withColumn("_bucket", bucket)
    position = F.struct(*[F.col(c) for c in order])
    last = rows.groupBy(*keys, "_bucket").agg(F.max_by(F.struct(F.col(value).alias("v")), position).alias("_last"))
    carried = last.withColumn(
        "_carried", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_bucket"))
    ).drop("_last")
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    lagged = rows.withColumn("_inside", F.lag(F.struct(F.col(value).alias("v"))).over(inside))
    return (
        join_null_safe(lagged, carried, [*keys, "_bucket"], "left")
        .withColumn(out, F.coalesce("_inside", "_carried")["v"])
        .drop("_bucket", "_inside", "_carried")
    )


def position_before(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], weight: Column, out: str, bucket: Column
) -> DataFrame:
    """Sum of ``weight`` over the rows of the key that come before this one, without gathering a whole key.

    As in ``carried_lag`` the rows of a key are split into order-preserving buckets: totals of earlier buckets come
    from a summary, the rest is a running sum inside the bucket.
    """
    rows = df.withColumn("_bucket", bucket).withColumn("_weight", weight.cast("long"))
    sums = rows.groupBy(*keys, "_bucket").agg(F.sum("_weight").alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.withColumn("_offset", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).drop("_sum")
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_inside", F.coalesce(F.sum("_weight").over(inside), F.lit(0)))
    return (
        join_null_safe(placed, offsets, [*keys, "_bucket"], "left")
        .withColumn(out, F.col("_offset") + F.col("_inside"))
        .drop("_bucket", "_weight", "_inside", "_offset")
    )
