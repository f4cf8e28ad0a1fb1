"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction; it catches the vectors within a cap around it. Near vectors fall into common caps. Directions
are structured: after a random rotation a vector is halved, and every pair of a code word for each half is a direction,
so a few code words make thousands of directions. A vector's filters are decoded from the lists of its scores with the
code words of each half: only words whose best completion can exceed the bound are extended. Vectors meet in the
filters they share and are compared there exactly; a pair is counted in the first filter they share.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import runs, stored
from skyledger.llm.components import connected_components
from skyledger.operators.keyed import join_totals

SIMILARITY = 0.93
ROTATIONS, WORDS = 8, 32
#: A filter catches a vector whose score exceeds this many standard deviations of a random direction.
BOUND = 3.2
#: A vector too far from every direction for that takes its best ones, this many in all.
LEAST_FILTERS = 16
#: Vectors with fewer components than this share one filter: there, caps are no narrower than the space.
LEAST_DIMENSIONS = 8
BUCKET_ROWS = 2048
TASK_ROWS = 20_000


@lru_cache(maxsize=4)
def _codes(dimensions: int, rotations: int, words: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rotation and code words of both halves, the same on every executor."""
    rng = np.random.default_rng(dimensions)
    out = []
    for _ in range(rotations):
        turn = np.linalg.qr(rng.standard_normal((dimensions, dimensions)))[0]
        halves = [rng.standard_normal((words, n)) for n in (dimensions // 2, dimensions - dimensions // 2)]
        out.append((turn, *[h / np.linalg.norm(h, axis=1, keepdims=True) / np.sqrt(2) for h in halves]))
    return out


def decode(unit: np.ndarray, rotations: int = ROTATIONS, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Rows and filter numbers of all filters of each unit vector, sorted by row, then filter."""
    n, dimensions = unit.shape
    if dimensions < LEAST_DIMENSIONS:
        return np.arange(n), np.zeros(n, np.int64)
    bound = np.full(n, BOUND / np.sqrt(dimensions))
    codes = _codes(dimensions, rotations, words)
    scores = []
    for turn, first, second in codes:
        turned = unit @ turn
        scores.append((turned[:, : dimensions // 2] @ first.T, turned[:, dimensions // 2 :] @ second.T))

    def listed(bound: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = []
        for r, (s1, s2) in enumerate(scores):
            s1, s2 = s1[rows], s2[rows]
            row, one = np.nonzero(s1 >= (bound - s2.max(axis=1))[:, None])
            total = s1[row, one][:, None] + s2[row]
            at, two = np.nonzero(total >= bound[row][:, None])
            found.append((rows[row[at]], (r * words + one[at]) * words + two, total[at, two]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    everyone = np.arange(n)
    row, number, value = listed(bound, everyone)
    few = everyone[np.bincount(row, minlength=n) < LEAST_FILTERS]
    if len(few):
        # the bound is lowered for these vectors until their lists are long enough, then cut at their best ones
        ready = np.bincount(row, minlength=n) >= LEAST_FILTERS
        row, number, value = row[ready[row]], number[ready[row]], value[ready[row]]
        parts, lower = [(row, number)], BOUND
        while len(few):
            lower -= 0.4
            r, f, v = listed(np.full(len(few), lower / np.sqrt(dimensions)), few)
            enough = (np.bincount(r, minlength=n) >= LEAST_FILTERS) | (lower < -3)
            use = enough[r]
            r, f, v = r[use], f[use], v[use]
            order = np.lexsort((f, -v, r))
            r, f = r[order], f[order]
            edge = runs(r)
            rank = np.arange(len(r)) - np.repeat(edge[:-1], np.diff(edge)) if len(r) else r
            parts.append((r[rank < LEAST_FILTERS], f[rank < LEAST_FILTERS]))
            few = few[~enough[few]]
        row, number = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((number, row))
    return row[order], number[order]


def _units(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(column.offsets.to_numpy())
    return flat, sizes


def filter_rows(reps: DataFrame, rotations: int = ROTATIONS, words: int = WORDS) -> DataFrame:
    """Rows (rep, label, size, filter, filters, unit): one per vector and filter; ``unit`` is the vector of length 1."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat, sizes = _units(batch.column("embedding"))
            starts = np.cumsum(sizes) - sizes
            for dimensions in np.unique(sizes):
                own = np.flatnonzero(sizes == dimensions)
                unit = flat[starts[own][:, None] + np.arange(dimensions)]
                unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
                row, number = decode(unit, rotations, words)
                edge = runs(row)
                lists = [number[a:b].astype("<i4").tobytes() for a, b in zip(edge[:-1], edge[1:], strict=True)]
                taken = pa.array(own[row])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(taken) for c in ("rep", "label", "size")]
                    + [
                        pa.array(number.astype(np.int32)),
                        pa.array([lists[i] for i in row], pa.binary()),
                        pa.array([unit[i].tobytes() for i in row], pa.binary()),
                    ],
                    names=["rep", "label", "size", "filter", "filters", "unit"],
                )

    return reps.select("rep", "label", "size", "embedding").mapInArrow(
        explode, "rep long, label string, size long, filter int, filters binary, unit binary"
    )


def _linked(units: np.ndarray, lists: list[np.ndarray], number: int, left: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs of a bucket, as a square matrix, and those of them that share no filter before this one.

    ``left`` marks two parts of a bucket whose pairs within a part are looked at elsewhere.
    """
    near = units @ units.T >= similarity
    np.fill_diagonal(near, False)
    if left.any() and not left.all():
        near &= left[:, None] != left[None, :]
    active = np.flatnonzero(near.any(axis=1))
    if not len(active):
        return near, near
    earlier = [lists[i][lists[i] < number] for i in active]
    first = near.copy()
    if any(map(len, earlier)):
        seen, code = np.unique(np.concatenate(earlier), return_inverse=True)
        has = np.zeros((len(active), len(seen)), np.float32)
        has[np.repeat(np.arange(len(active)), [len(x) for x in earlier]), code] = 1
        first[np.ix_(active, active)] &= (has @ has.T) == 0
    return near, first


def _bucket_links(table: pd.DataFrame, similarity: float) -> pd.DataFrame:
    """For each vector of each bucket with links: what they weigh, and the smallest vector it hangs together with here."""
    out = []
    keys = table.groupby(["label", "filter", "dims", "one", "two"], sort=False).indices
    for (_, number, _, one, two), at in keys.items():
        if len(at) < 2:
            continue
        rows = table.iloc[at]
        units = np.stack([np.frombuffer(u) for u in rows["unit"]])
        lists = [np.frombuffer(x, "<i4") for x in rows["filters"]]
        left = (rows["chunk"].to_numpy() == one) & (one != two)
        near, first = _linked(units, lists, number, left, similarity)
        some = np.flatnonzero(near.any(axis=1))
        if not len(some):
            continue
        reps, sizes = rows["rep"].to_numpy(), rows["size"].to_numpy().astype(float)
        links = first[some] @ sizes
        near = near[np.ix_(some, some)]
        root, before = reps[some].copy(), None
        while before is None or (root != before).any():
            before = root
            around = np.where(near, root[None, :], np.iinfo(np.int64).max).min(axis=1)
            root = np.minimum(root, around)
        out.append(pd.DataFrame({"rep": reps[some], "links": np.rint(links).astype(np.int64), "root": root}))
    return pd.concat(out) if out else pd.DataFrame({"rep": pd.Series([], dtype="int64"), "links": pd.Series([], dtype="int64"), "root": pd.Series([], dtype="int64")})


def near_duplicates(
    vectors: DataFrame,
    similarity: float = SIMILARITY,
    rotations: int = ROTATIONS,
    words: int = WORDS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept): one per vec_id of ``vectors`` (vec_id, embedding, label).

    Two vectors are linked when their labels are equal and not null, they have equally many components, and their
    cosine in double precision is at least ``similarity``. A vector that is null, empty or zero or has a null or
    non-finite component links with nothing, nor does a null vec_id. Rows that repeat a vec_id count once, by the
    smallest label and vector. Other columns are ignored; an empty table gives an empty one.

    Equal vectors form a class and go on as one. A filter's vectors are cut into chunks of ``bucket_rows``, and pairs
    of chunks are compared apart, so a filter that holds a large part of a table is split. Tasks return one row per
    vector and bucket, never pairs.
    """
    rows = (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
        .groupBy("vec_id")
        .agg(F.min(F.struct("label", "embedding")).alias("_v"))
        .select("vec_id", "_v.label", "_v.embedding")
    )
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    norm = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)
    usable = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
        & F.coalesce(F.forall("embedding", number), F.lit(False)) & (norm > 0) & (norm < float("inf"))
    )
    rows = stored(
        rows.withColumn("_ok", F.coalesce(usable, F.lit(False)))
        .withColumn("_k1", F.xxhash64("label", "embedding"))
        .withColumn("_k2", F.xxhash64(F.lit(1), "embedding", "label")),
        "vectors",
    )
    good = rows.where("_ok")
    classes = good.groupBy("_k1", "_k2").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("size"), F.min("label").alias("label"), F.min("embedding").alias("embedding")
    )
    caught = stored(filter_rows(classes, rotations, words), "filters").withColumn("dims", F.length("unit"))
    key = ["label", "dims", "filter"]
    chunks = caught.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / bucket_rows).cast("int").alias("_chunks"))
    chunks = chunks.where(F.col("_chunks") > 1)
    dealt = join_totals(caught, chunks, key).withColumn("_chunks", F.coalesce("_chunks", F.lit(1)))
    own = F.pmod(F.xxhash64("rep"), F.col("_chunks")).cast("int")
    dealt = (
        dealt.withColumn("chunk", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
        .withColumn("one", F.least("chunk", "_other"))
        .withColumn("two", F.greatest("chunk", "_other"))
    )
    tasks = max(1, -(-caught.count() // TASK_ROWS))
    task = F.pmod(F.xxhash64(*key, "one", "two"), F.lit(tasks))
    links = stored(
        dealt.select("rep", "label", "dims", "size", "filter", "filters", "unit", "chunk", "one", "two", task.alias("_task"))
        .groupBy("_task")
        .applyInPandas(lambda t: _bucket_links(t, similarity), "rep long, links long, root long"),
        "links",
    )
    components = connected_components(links.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    counted = links.groupBy("rep").agg(F.sum("links").alias("_links"))
    per_class = (
        classes.select("_k1", "_k2", "rep", "size")
        .join(counted, "rep", "left")
        .join(components.withColumnRenamed("node", "rep"), "rep", "left")
        .select("_k1", "_k2", (F.coalesce("_links", F.lit(0)) + F.col("size") - 1).alias("_n"), F.coalesce("component", "rep").alias("_c"), F.lit(True).alias("_ok"))
    )
    members = join_totals(rows.select("vec_id", "_ok", "_k1", "_k2"), per_class, ["_k1", "_k2", "_ok"], grows=True)
    component = F.coalesce("_c", "vec_id")
    return members.select(
        "vec_id",
        F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
