"""Payload slices of a limited size: filled one after the other, or of an even number of records.

Filling is sequential by nature: a slice ends where the next body does not fit, and the next one begins there. It runs in
parallel all the same. Running lengths cut a key into stretches of ``STRETCH`` limits. Within a stretch the borders depend
only on where its first border is, and that can be one of the few rows of its first ``limit`` characters: each of those
is followed to the end of the stretch, where it leads to a first border of the next stretch. These small tables (a row for
each stretch and possible first border) are composed by pointer doubling: after k rounds the first 2^k stretches of every
key know their borders. No task holds a key, only a stretch of it.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.operators.keyed import join_totals, position_before
from skyledger.session import cut_lineage

#: A stretch is so many limits long.
STRETCH = 64


def _size(body: str, overhead: int) -> Column:
    return F.greatest(F.coalesce(F.length(body), F.lit(0)) + F.lit(overhead), F.lit(1)).cast("long")


def even_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, body: str, limit: int = 40960) -> DataFrame:
    """``slice``: as many slices as the key's characters need, each of the same number of records; the last may be shorter.

    A slice may be longer than the limit where bodies differ in length; see ``filled_slices`` for one that never is.
    """
    size = F.coalesce(F.length(body), F.lit(0)).cast("long")
    totals = df.groupBy(*keys).agg(F.sum(size).alias("_total"), F.count(F.lit(1)).alias("_rows"))
    wanted = F.greatest(F.ceil(F.col("_total") / F.lit(limit)), F.lit(1))
    totals = totals.select(*keys, F.ceil(F.col("_rows") / wanted).cast("long").alias("_each"))
    placed = join_totals(position_before(df, keys, order, F.lit(1), "_position", bucket), totals, keys, null_safe=True)
    return placed.withColumn("slice", F.floor(F.col("_position") / F.col("_each")).cast("long")).drop("_position", "_each")


def filled_slices(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column, body: str, limit: int = 40960, overhead: int = 0, stretch: int = STRETCH
) -> DataFrame:
    """``slice`` 0, 1, … per key: each is filled along the order until the next body does not fit.

    A body counts its characters and ``overhead``, one at least; one that is longer than the limit has a slice of its own.
    ``order`` must tell rows of a key apart, and ``bucket`` is a coarse, order-preserving function of it (see
    ``keyed.position_before``). Null keys are a key.
    """
    span = limit * stretch
    placed = position_before(df.withColumn("_size", _size(body, overhead)), keys, order, F.col("_size"), "_position", bucket)
    placed = placed.withColumn("_key", F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})).withColumn("_stretch", F.floor(F.col("_position") / span))
    placed = cut_lineage(placed)
    chains = cut_lineage(_chains(placed.select("_key", "_stretch", "_position", "_size"), limit, span))
    # the last stretch of a key may lie within the slice that was open before it: no chain is taken there
    stretches = chains.select("_key", "_stretch").distinct()
    taken = stretches.join(_taken(chains, limit), ["_key", "_stretch"], "left").withColumn("borders", F.coalesce("borders", F.array().cast("array<long>")))
    before = Window.partitionBy("_key").orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    taken = taken.select("_key", "_stretch", "borders", F.coalesce(F.sum(F.size("borders")).over(before), F.lit(0)).alias("_base"))
    out = join_totals(placed, taken, ["_key", "_stretch"], "inner", salts=1, grows=True)
    passed = F.size(F.filter("borders", lambda at: at <= F.col("_position")))
    return out.withColumn("slice", (F.col("_base") + passed - 1).cast("long")).select(*df.columns, "slice")


CHAINS = "_key string, _stretch long, first_end long, first long, last long, borders array<long>"


def _chains(rows: DataFrame, limit: int, span: int) -> DataFrame:
    """Per stretch and possible first border: its place and end, the borders that follow it, and the last of them."""

    def follow(key: tuple, table: pa.Table) -> pa.Table:
        start = np.sort(table.column("_position").to_numpy())
        end = start + table.column("_size").to_numpy()[np.argsort(table.column("_position").to_numpy(), kind="stable")]
        onward = np.maximum(np.searchsorted(end, start + limit, side="right"), np.arange(len(start)) + 1)
        stretch = key[1].as_py()
        # an open slice begins before the stretch, so its border is at the latest the row that passes the stretch's first limit
        possible = 1 if stretch == 0 else min(len(start), int(np.searchsorted(end, stretch * span - 1 + limit, side="right")) + 1)
        borders = []
        for row in range(possible):
            chain = []
            while row < len(start):
                chain.append(int(start[row]))
                row = int(onward[row])
            borders.append(chain)
        kinds = pa.int64()
        return pa.table(
            {
                "_key": pa.array([key[0].as_py()] * possible, pa.string()),
                "_stretch": pa.array([stretch] * possible, kinds),
                "first_end": pa.array(end[:possible], kinds),
                "first": pa.array(start[:possible], kinds),
                "last": pa.array([c[-1] for c in borders], kinds),
                "borders": pa.array(borders, pa.list_(kinds)),
            }
        )

    return rows.groupBy("_key", "_stretch").applyInArrow(follow, CHAINS)


def _taken(chains: DataFrame, limit: int) -> DataFrame:
    """The chain that each stretch takes, found from the first stretch of every key by pointer doubling."""
    stretches = chains.select("_key", "_stretch").distinct()
    following = F.lead("_stretch").over(Window.partitionBy("_key").orderBy("_stretch"))
    stretches = stretches.withColumn("_next", following)
    ends = chains.select("_key", "_stretch", "last").distinct().join(stretches.where(F.col("_next").isNotNull()), ["_key", "_stretch"])
    entries = chains.select("_key", F.col("_stretch").alias("_next"), "first_end", "first")
    hops = (
        ends.join(entries, ["_key", "_next"])
        .where(F.col("first_end") > F.col("last") + F.lit(limit))
        .groupBy("_key", "_stretch", "last")
        .agg(F.min(F.struct("first_end", F.col("_next").alias("to_stretch"), F.col("first").alias("to_first"))).alias("_to"))
        .select("_key", "_stretch", "last", "_to.to_stretch", "_to.to_first")
    )
    nodes = chains.select("_key", "_stretch", "first", "last").join(hops, ["_key", "_stretch", "last"]).drop("last")
    nodes = cut_lineage(nodes)
    begun = chains.groupBy("_key").agg(F.min("_stretch").alias("_stretch"))
    reached = cut_lineage(chains.select("_key", "_stretch", "first").join(begun, ["_key", "_stretch"], "left_semi"))
    most = stretches.groupBy("_key").count().agg(F.max("count")).first()[0] or 0
    done = 1
    while done < most:
        found = reached.join(nodes, ["_key", "_stretch", "first"]).select("_key", F.col("to_stretch").alias("_stretch"), F.col("to_first").alias("first"))
        reached = cut_lineage(reached.unionByName(found))
        done *= 2
        if done < most:
            onward = nodes.select(
                "_key", F.col("_stretch").alias("to_stretch"), F.col("first").alias("to_first"),
                F.col("to_stretch").alias("then_stretch"), F.col("to_first").alias("then_first"),
            )
            nodes = cut_lineage(
                nodes.join(onward, ["_key", "to_stretch", "to_first"]).select(
                    "_key", "_stretch", "first", F.col("then_stretch").alias("to_stretch"), F.col("then_first").alias("to_first")
                )
            )
    return chains.join(reached, ["_key", "_stretch", "first"], "left_semi").select("_key", "_stretch", "borders")
