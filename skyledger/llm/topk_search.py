"""Exact top-k search by a pivot-distance index.

Scores are inner products of integer vectors. One more component, sqrt(M - |x|^2) with M the largest squared length,
gives all indexed vectors the same length, and a query gets a zero there: then the largest inner product is the least
distance. Every vector is keyed by its nearest pivot and its distance from it, cut into rings of equal width. A vector x
in a ring [lo, hi) around pivot p is at least max(d(q,p) - hi, lo - d(q,p)) from a query q. A query first visits its few
nearest rings; the k-th best score there bounds how far the rest can matter, and it visits every ring within that
distance and no other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import sample_fraction, stored

PIVOTS = 32
FIT_ROWS = 4096
RINGS = 64
BLOCK_ROWS = 2048
QUERY_ROWS = 4096
PROBE = 3
#: Largest component that takes part, far above any embedding; it keeps all sums within 64 bits.
LARGEST = 1 << 25


def quantised(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """Rows (vec_id, v): floor(scale * x) of every component, one row per vec_id, unusable vectors left out.

    Left out are null ids, vectors that are null or empty or hold a null, non-finite or huge component, and those with
    another number of components than most. Of rows that repeat a vec_id the smallest vector counts.
    """
    whole = F.transform(F.col("embedding"), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < LARGEST / scale)
    rows = vectors.where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
        & F.coalesce(F.forall("embedding", sound), F.lit(False))
    ).select(F.col("vec_id").cast("long").alias("vec_id"), whole.cast("array<int>").alias("v"))
    rows = stored(rows.groupBy("vec_id").agg(F.min("v").alias("v")), "vectors")
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return rows.where(F.size("v") == (sizes[0]["n"] if sizes else 0))


def _matrix(column: pa.Array | pa.ChunkedArray, n: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy().astype(np.float64).reshape(n, -1)


def _lifted(v: np.ndarray, square: float) -> np.ndarray:
    return np.concatenate([v, np.sqrt(np.maximum(square - (v * v).sum(axis=1), 0))[:, None]], axis=1)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * x @ pivots.T, 0))


def fit_pivots(rows: DataFrame, square: float, pivots: int = PIVOTS, most: int = FIT_ROWS) -> np.ndarray:
    """Pivots from about ``most`` vectors chosen by hash: spread out first, then moved to the means around them."""
    share = sample_fraction(rows.count(), most)
    sample = rows.where(F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1 << 20)) < int(share * (1 << 20))).orderBy("vec_id")
    table = sample.select("v").toArrow()
    if not table.num_rows:
        table = rows.orderBy("vec_id").limit(pivots).select("v").toArrow()
    x = _lifted(_matrix(table.column("v"), table.num_rows), square)
    chosen = [0]
    nearest = _distances(x, x[:1])[:, 0]
    while len(chosen) < min(pivots, len(x)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _distances(x, x[chosen[-1:]])[:, 0])
    centres = x[chosen]
    for _ in range(8):
        home = _distances(x, centres).argmin(axis=1)
        count = np.bincount(home, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, home, x)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, pivots: int = PIVOTS, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for each row that meets ``is_query`` the k best other rows of ``vectors``.

    Scores are integer inner products of ``quantised`` vectors; ties go to the smaller vec_id; a query with fewer than k
    candidates gets all. ``is_query`` is a condition on vec_id. Vectors left out by ``quantised`` are neither queries nor
    candidates. Equal vectors are rows of their own. Empty tables give an empty result. The pivots are fitted on about
    ``fit_rows`` vectors; every vector is indexed, and no bound depends on the sample.

    A ring with many vectors is split into blocks of about ``BLOCK_ROWS``, and queries are split likewise, so that one
    group compares a bounded number of both.
    """
    schema = "query_id long, vec_id long, score long"
    rows = quantised(vectors, scale)
    stats = rows.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0).cast("long"), lambda a, x: a + x.cast("long") * x)).alias("square")
    ).first()
    spark = vectors.sparkSession
    if not stats["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    square = float(stats["square"])
    centres = fit_pivots(rows, square, pivots, fit_rows)
    width = max(2 * np.sqrt(square) / RINGS, 1e-9)
    exact_floats = square < 2**52

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = _distances(_lifted(_matrix(batch.column("v"), batch.num_rows), square), centres)
                home = d.argmin(axis=1)
                ring = (d[np.arange(len(d)), home] / width).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("v"), pa.array(home.astype(np.int32)), pa.array(ring)],
                    names=["vec_id", "v", "pivot", "ring"],
                )

    index = stored(rows.mapInArrow(place, "vec_id long, v array<int>, pivot int, ring int"), "index")
    # at most pivots * rings rows, whatever the table's size
    sizes = sorted((r["pivot"], r["ring"], -(-r["n"] // BLOCK_ROWS)) for r in index.groupBy("pivot", "ring").agg(F.count(F.lit(1)).alias("n")).collect())
    key_pivot, key_ring, key_blocks = (np.array(x) for x in zip(*sizes, strict=True))
    asked = rows.where(is_query)
    groups = max(1, -(-asked.count() // QUERY_ROWS))
    slack = 1e-6 * (1 + np.sqrt(square))

    def visit(first: int, last: int | None):
        """Queries with a row for each block of the rings from place ``first`` to ``last`` in their order of distance."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                v = _matrix(batch.column("v"), batch.num_rows)
                to_pivot = _distances(np.concatenate([v, np.zeros((len(v), 1))], axis=1), centres)[:, key_pivot]
                low = np.maximum(np.maximum(to_pivot - (key_ring + 1) * width, key_ring * width - to_pivot), 0)
                order = low.argsort(axis=1, kind="stable")[:, first:last]
                bound = np.take_along_axis(low, order, axis=1)
                floor = batch.column("floor").to_numpy(zero_copy_only=False).astype(float)  # NaN: fewer than k so far
                reach = np.sqrt(np.maximum((v * v).sum(axis=1) + square - 2 * floor, 0)) + slack
                row, at = np.nonzero(~(bound > np.where(np.isnan(reach), np.inf, reach)[:, None]))
                ring = order[row, at]
                blocks = key_blocks[ring]
                row, ring = np.repeat(row, blocks), np.repeat(ring, blocks)
                block = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                for cut in range(0, len(row), 50_000):
                    part = slice(cut, cut + 50_000)
                    taken = pa.array(row[part])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(c).take(taken) for c in ("vec_id", "v", "floor")]
                        + [pa.array(x.astype(np.int32)) for x in (key_pivot[ring[part]], key_ring[ring[part]], block[part])],
                        names=["query_id", "v", "floor", "pivot", "ring", "block"],
                    )

        return run

    def best(block: pa.Table, queries: pa.Table) -> pa.Table:
        out = [[], [], []]
        if block.num_rows and queries.num_rows:
            ids = block.column("vec_id").to_numpy()
            own = queries.column("query_id").to_numpy()
            x, q = _matrix(block.column("v"), len(ids)), _matrix(queries.column("v"), len(own))
            floor = queries.column("floor").to_numpy().astype(float)
            for cut in range(0, len(own), 512):
                part = slice(cut, cut + 512)
                score = q[part] @ x.T if exact_floats else q[part].astype(np.int64) @ x.T.astype(np.int64)
                same = own[part][:, None] == ids[None, :]
                least = np.where(np.isnan(floor[part]), -np.inf, floor[part])
                if len(ids) > k + 1:
                    kth = np.partition(np.where(same, -np.inf, score), len(ids) - k, axis=1)[:, len(ids) - k]
                    least = np.maximum(least, kth)
                row, at = np.nonzero((score >= least[:, None]) & ~same)
                order = np.lexsort((ids[at], -score[row, at], row))
                row, at = row[order], at[order]
                rank = np.arange(len(row)) - np.searchsorted(row, row, side="left")
                row, at = row[rank < k], at[rank < k]
                for to, value in zip(out, (own[part][row], ids[at], score[row, at].astype(np.int64)), strict=True):
                    to.append(value)
        values = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in out]
        return pa.table([pa.array(x, pa.int64()) for x in values], names=["query_id", "vec_id", "score"])

    blocks_of = F.element_at(
        F.create_map(*[F.lit(x) for p, r, b in sizes for x in (f"{p}:{r}", int(b))]), F.concat_ws(":", "pivot", "ring")
    )
    placed = (
        index.withColumn("block", F.pmod(F.xxhash64("vec_id"), blocks_of).cast("int"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    )
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    keys = ["pivot", "ring", "block", "part"]

    def searched(queries: DataFrame, first: int, last: int | None) -> DataFrame:
        visits = queries.select("vec_id", "v", "floor").mapInArrow(
            visit(first, last), "query_id long, v array<int>, floor double, pivot int, ring int, block int"
        ).withColumn("part", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int"))
        return placed.groupBy(*keys).cogroup(visits.groupBy(*keys)).applyInArrow(best, schema)

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)

    near = stored(ranked(searched(asked.withColumn("floor", F.lit(None).cast("double")), 0, PROBE)), "near")
    floors = near.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("floor"))
    rest = searched(asked.join(floors, "vec_id", "left"), PROBE, None)
    return ranked(near.drop("rank").unionByName(rest)).select("query_id", "rank", "vec_id", "score")
