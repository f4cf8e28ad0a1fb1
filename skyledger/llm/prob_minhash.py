"""Near-duplicate documents by ProbMinHash signatures of weighted word shingles, banding and exact verification.

Each shingle of a document sends arrivals, a Poisson process whose rate is its number of occurrences and whose times and
registers depend on the shingle alone. A register keeps the shingle that arrived first; two documents agree in a register
with the probability of their probability Jaccard similarity. Once every register is filled, later arrivals change
nothing: the process stops at a horizon by which that is nearly sure, and goes on only where a register is still empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import byte_groups, lowered, mixed, prefix_hash, ranges, runs, slices, span_hash, stored, text_bytes, word_spans
from skyledger.llm.components import connected_components
from skyledger.operators.keyed import join_totals

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 5
TASK_PAIRS = 1500
CHUNK, TASK_ROWS, COLUMNS = 512, 2000, 4096
#: Bytes of text that are shingled at once (a worker needs about a hundred times as much), and bytes of the texts whose
#: shingles are held while they are compared with one another.
SHINGLED_BYTES, HELD_BYTES = 512 << 10, 4 << 20


def shingles(values: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text with their counts, the n + 1 offsets, and two hashes of all its words.

    Words are runs of letters and digits, in lower case. A text with fewer words than a shingle is one shingle.
    """
    data, offsets = text_bytes(values)
    low = lowered(data)
    begin, end, first = word_spans(low, offsets)
    word = span_hash(prefix_hash(low), begin, end)
    prefix, other = prefix_hash(word), prefix_hash(mixed(word))
    rows, n = len(first) - 1, np.diff(first)
    count = np.where(n > 0, np.maximum(n - words + 1, 1), 0)
    row = np.repeat(np.arange(rows), count)
    start = np.repeat(first[:-1], count) + ranges(count)
    hashed = span_hash(prefix, start, np.minimum(start + words, first[1:][row]))
    order = np.lexsort((hashed, row))
    hashed, row = hashed[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (hashed[1:] != hashed[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    weight = np.diff(np.concatenate((at, [len(row)])))
    bounds = np.searchsorted(row[at], np.arange(rows + 1))
    whole = np.stack([span_hash(prefix, first[:-1], first[1:]), span_hash(other, first[:-1], first[1:])], axis=1)
    return hashed[at], weight, bounds, whole


def _exponential(seed: np.ndarray, turn: int) -> np.ndarray:
    bits = mixed(seed + np.uint64((2 * turn + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    return -np.log((bits >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54)


def signatures(hashed: np.ndarray, weight: np.ndarray, bounds: np.ndarray, registers: int) -> np.ndarray:
    """One row of registers per text; a text without shingles has zeros."""
    rows = len(bounds) - 1
    out = np.zeros((rows, registers), np.uint64)
    sizes = np.diff(bounds)
    total = np.add.reduceat(np.concatenate((weight, [0])), bounds[:-1]) * (sizes > 0) if rows else np.zeros(0)
    open_rows = np.flatnonzero(sizes)
    spare = 3.0
    while len(open_rows):
        row = np.repeat(open_rows, sizes[open_rows])
        item = np.repeat(bounds[open_rows], sizes[open_rows]) + ranges(sizes[open_rows])
        horizon = (registers * (np.log(registers) + spare) / total[row]) * weight[item]
        seed, time, turn, found = hashed[item], np.zeros(len(item)), 0, []
        while len(item):
            time = time + _exponential(seed, turn)
            use = time <= horizon
            item, row, horizon, seed, time = item[use], row[use], horizon[use], seed[use], time[use]
            register = (mixed(seed + np.uint64((2 * turn + 2) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(33)) % np.uint64(registers)
            found.append((row * registers + register.astype(np.int64), time / weight[item], seed))
            turn += 1
        cell, time, seed = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(-time, kind="stable")
        out.reshape(-1)[cell[order]] = seed[order]  # the earliest arrival of a cell is written last
        filled = np.zeros(rows * registers, bool)
        filled[cell] = True
        open_rows = open_rows[~filled.reshape(rows, registers)[open_rows].all(axis=1)]
        spare = 2 * spare + np.log(registers)
    return out


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact similarity of two sorted (hashes, weights): the chance that both send the same first arrival."""
    both, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    x, y = a[1].astype(np.float64), b[1].astype(np.float64)
    xs, ys = x[at_a], y[at_b]
    only = x.sum() - xs.sum(), y.sum() - ys.sum()
    total = 0.0
    ratio = xs / ys
    for r in np.unique(ratio):
        total += xs[ratio == r].sum() / (only[0] + r * only[1] + np.maximum(xs, r * ys).sum())
    return float(total)


def signature_rows(docs: DataFrame, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Rows (doc_id, k1, k2, keys): two hashes of the words, and one key per band; no keys for a text without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SHINGLED_BYTES):
            hashed, weight, bounds, whole = shingles(batch.column("text"))
            n = len(bounds) - 1
            registers = signatures(hashed, weight, bounds, bands * rows).reshape(n, bands, rows)
            key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (n, bands))
            for k in range(rows):
                key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + registers[:, :, k])
            count = np.where(np.diff(bounds) > 0, bands, 0)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate(([0], np.cumsum(count))).astype(np.int32)), pa.array(key[count > 0].ravel().view(np.int64))
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(whole[:, 0].view(np.int64)), pa.array(whole[:, 1].view(np.int64)), lists],
                names=["doc_id", "k1", "k2", "keys"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        sign, "doc_id long, k1 long, k2 long, keys array<long>"
    )


def packed_texts(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, packed): each text compressed, so that moving it costs less."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in slices(batches, "text", SHINGLED_BYTES):
            data, offsets = text_bytes(batch.column("text"))
            whole = data.tobytes()
            packed = [squeeze(whole[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(packed, pa.binary())], names=["doc_id", "packed"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(pack, "doc_id long, packed binary")


class _Texts:
    """Packed texts of a task; shingled a few at a time, cut by their bytes."""

    def __init__(self, packed: pa.ChunkedArray):
        self.packed = packed.combine_chunks()
        self.unpack = zstandard.ZstdDecompressor().decompress
        self.sizes = np.array([max(zstandard.frame_content_size(p.as_buffer()), 0) if p.is_valid else 0 for p in self.packed], np.int64)

    def sets(self, at: np.ndarray) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray]]]:
        """Each place with its text's sorted shingles and their numbers."""
        for part in byte_groups(self.sizes[at], SHINGLED_BYTES):
            some = at[part]
            hashed, weight, bounds, _ = shingles(pa.array([self.unpack(self.packed[int(i)].as_py()) for i in some], pa.binary()).cast(pa.string()))
            for i, start, stop in zip(some, bounds[:-1], bounds[1:], strict=True):
                yield int(i), (hashed[start:stop].copy(), weight[start:stop].astype(np.int32))


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) that are similar. A text ``a`` with many partners is sent to each group of them once."""
    pairs = pairs.where(F.col("a") != F.col("b")).distinct()
    n = pairs.count()
    tasks = max(1, -(-n // TASK_PAIRS))
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / TASK_PAIRS).cast("int").alias("_parts"))
    task = F.pmod(F.xxhash64("a", "_part"), F.lit(tasks)).alias("task")
    dealt = (
        join_totals(pairs, parts, ["a"], grows=True)
        .withColumn("_part", F.pmod(F.xxhash64("b"), F.col("_parts")).cast("int"))
        .select("a", F.col("b").alias("doc_id"), task)
        .join(texts, "doc_id")
        .select("a", F.col("doc_id").alias("b"), "task", "packed")
    )
    heads = (
        parts.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        .select(F.col("a").alias("doc_id"), task)
        .join(texts, "doc_id")
        .select(F.col("doc_id").alias("a"), F.lit(None).cast("long").alias("b"), "task", "packed")
    )

    def verify(table: pa.Table) -> pa.Table:
        a, b = table.column("a").to_numpy(), table.column("b").to_numpy(zero_copy_only=False)
        partner = table.column("b").is_valid().to_numpy(zero_copy_only=False)
        texts = _Texts(table.column("packed"))

        order = np.argsort(a, kind="stable")
        edge = runs(a[order])
        kept: list[tuple[int, int]] = []
        for start, stop in zip(edge[:-1], edge[1:], strict=True):
            group = order[start:stop]
            head = [h for _, h in texts.sets(group[~partner[group]])]
            for i, other in texts.sets(group[partner[group]]):
                if any(probability_jaccard(h, other) >= similarity for h in head):
                    kept.append((a[i], int(b[i])))
        left, right = zip(*kept, strict=True) if kept else ((), ())
        return pa.table([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return dealt.unionByName(heads).groupBy("task").applyInArrow(verify, "a long, b long")


def _similar(sets: list[tuple[np.ndarray, np.ndarray]], asked: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Pairs of ``asked``, a square matrix of which the upper half counts, that are similar; enough of them to connect all such.

    No similarity exceeds the share of either text's shingles, by weight, that the other one has. These shares come from
    products of matrices; only pairs above the bound that nothing connects yet are looked at one by one.
    """
    n = len(sets)
    code = np.unique(np.concatenate([h for h, _ in sets]), return_inverse=True)[1]
    sizes = np.array([len(h) for h, _ in sets])
    row = np.repeat(np.arange(n), sizes)
    weight = np.concatenate([w for _, w in sets]).astype(np.float64)
    total = np.bincount(row, weight, n)
    often = np.bincount(code)[code] > 1
    row, share = row[often], (weight / total[row])[often].astype(np.float32)
    code = np.unique(code[often], return_inverse=True)[1] if often.any() else code[often]
    order = np.argsort(code, kind="stable")
    row, code, share = row[order], code[order], share[order]
    common = np.zeros((n, n), np.float32)
    for low in range(0, int(code.max()) + 1 if len(code) else 0, COLUMNS):
        a, b = np.searchsorted(code, [low, low + COLUMNS])
        has = np.zeros((n, COLUMNS), np.float32)
        mass = np.zeros((n, COLUMNS), np.float32)
        has[row[a:b], code[a:b] - low] = 1
        mass[row[a:b], code[a:b] - low] = share[a:b]
        common += mass @ has.T
    left, right = np.nonzero(np.triu(asked, 1) & (np.minimum(common, common.T) >= similarity - 1e-4))
    order = np.argsort(-(common[left, right] + common[right, left]), kind="stable")
    root, found = list(range(n)), []

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in zip(left[order].tolist(), right[order].tolist(), strict=True):
        if top(i) != top(j) and probability_jaccard(sets[i], sets[j]) >= similarity:
            root[top(i)] = top(j)
            found.append((i, j))
    return found


def _linked_apart(placed: DataFrame, signed: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) between members (key, rep, component) of a bucket that are in different components.

    The members of a bucket's largest component need no comparison with each other. They and the rest are cut into
    chunks, and chunks are compared in pairs: a large bucket that hangs together but for a few costs each member once
    per chunk of those few. A pair is looked at in the first band that both share.
    """
    per = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    sizes = (
        per.groupBy("key")
        .agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("n").alias("n"), F.max("n").alias("most"))
        .where(F.col("n") > F.col("most"))
        .select("key", "main", F.ceil(F.col("most") / CHUNK).cast("int").alias("_mains"), F.ceil((F.col("n") - F.col("most")) / CHUNK).cast("int").alias("_others"))
    )
    loose = join_totals(placed, stored(sizes, "sizes"), ["key"], "inner", grows=True)
    is_main = F.col("component") == F.col("main")
    own = F.pmod(F.xxhash64("rep"), F.when(is_main, F.col("_mains")).otherwise(F.col("_others"))).cast("int")
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    cell = lambda kind, i, j: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    cells = F.when(is_main, F.transform(upto("_others"), lambda j: cell(0, F.col("chunk"), j))).otherwise(
        F.concat(
            F.transform(upto("_mains"), lambda i: cell(0, i, F.col("chunk"))),
            F.transform(upto("_others"), lambda j: cell(1, F.least(j, F.col("chunk")), F.greatest(j, F.col("chunk")))),
        )
    )
    dealt = stored(
        loose.withColumn("chunk", own).select("key", F.col("rep").alias("doc_id"), "component", is_main.alias("main"), "chunk", F.explode(cells).alias("cell")),
        "loose",
    )
    keys = signed.where(F.size("keys") > 0).groupBy("doc_id").agg(F.min("keys").alias("keys"))
    asked = dealt.select("doc_id").distinct()
    payload = stored(texts.join(asked, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("packed").alias("packed")).join(keys, "doc_id"), "payload")
    tasks, most = max(1, -(-dealt.count() // TASK_ROWS)), HELD_BYTES
    rows = dealt.join(payload, "doc_id").withColumn("task", F.pmod(F.xxhash64("key", "cell"), F.lit(tasks)))

    def compare(table: pa.Table) -> pa.Table:
        key, doc, component = (table.column(c).to_numpy() for c in ("key", "doc_id", "component"))
        main, chunk = (table.column(c).to_numpy(zero_copy_only=False) for c in ("main", "chunk"))
        kind, i, j = (table.column(c).to_numpy() for c in ("kind", "i", "j"))
        all_keys = table.column("keys").combine_chunks()
        all_keys = all_keys.flatten().to_numpy().reshape(len(doc), -1)
        texts = _Texts(table.column("packed"))
        order = np.lexsort((doc, j, i, kind, key))
        fresh = np.zeros(len(order), bool)
        for c in (key, kind, i, j):
            fresh[1:] |= c[order][1:] != c[order][:-1]
        out = [[], []]
        for own in np.split(order, np.flatnonzero(fresh)):
            k, c, of = all_keys[own], component[own], doc[own]
            asked = c[:, None] != c[None, :]
            if kind[own[0]] == 0:
                asked &= main[own][:, None] != main[own][None, :]
            elif i[own[0]] != j[own[0]]:
                asked &= chunk[own][:, None] != chunk[own][None, :]
            if not asked.any():
                continue
            # the first band that both share is the bucket's
            band = int((k[0] == key[own[0]]).argmax())
            for earlier in range(band):
                asked &= k[:, earlier][:, None] != k[:, earlier][None, :]
            some = np.flatnonzero(asked.any(axis=1))
            if not len(some):
                continue
            # large cells are compared part by part, so that no more than two parts are held
            parts = [some[cut] for cut in byte_groups(texts.sizes[own[some]], most)]
            for x, left in enumerate(parts):
                first = [s for _, s in texts.sets(own[left])]
                for y in range(x, len(parts)):
                    right = parts[y] if y > x else left[:0]
                    both = np.concatenate((left, right))
                    wanted = asked[np.ix_(both, both)]
                    if y > x:
                        wanted[: len(left), : len(left)] = False
                        wanted[len(left) :, len(left) :] = False
                    if not wanted.any():
                        continue
                    for u, v in _similar(first + [s for _, s in texts.sets(own[right])], wanted, similarity):
                        out[0].append(of[both[u]])
                        out[1].append(of[both[v]])
        return pa.table([pa.array(x, pa.int64()) for x in out], names=["a", "b"])

    columns = ["task", "key", "doc_id", "component", "main", "chunk", "cell.kind", "cell.i", "cell.j", "keys", "packed"]
    return rows.select(*columns).groupBy("task").applyInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Rows (doc_id, class_id, kept), one per row of ``docs`` (doc_id, text): the smallest doc_id of its group.

    A group hangs together by pairs whose probability Jaccard similarity of shingles of five words, weighted by their
    number, is at least ``similarity``. ``kept`` is true for the document that gives the group its id. Null and empty
    texts, and texts without a letter or digit, are in no group and kept. Rows that repeat a doc_id are one document.
    A row without doc_id has no class, teaches nothing and is kept. Other columns are ignored.

    Texts of equal words are one class before anything is compared. Where a band's bucket has several classes, each is
    compared with the smallest; then members of a bucket that do not yet hang together are compared block by block, so
    no link is lost to the choice of the first one, and no table of pairs is made.
    """
    signed = stored(signature_rows(docs, bands, rows), "signatures")
    lettered = signed.where(F.col("doc_id").isNotNull() & (F.size("keys") > 0))
    classes = lettered.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep"))
    keyed = stored(
        lettered.select(F.col("doc_id").alias("rep"), "k1", "k2", "keys")
        .join(classes, ["k1", "k2", "rep"], "left_semi")
        .select("rep", F.explode("keys").alias("key"))
        .distinct(),
        "bands",
    )
    firsts = keyed.groupBy("key").agg(F.min("rep").alias("first"), F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).drop("_n")
    shared = stored(join_totals(keyed, firsts, ["key"], "inner", grows=True), "buckets")
    star = stored(shared.where(F.col("rep") != F.col("first")).select(F.col("first").alias("a"), F.col("rep").alias("b")).distinct(), "pairs")
    needed = shared.select(F.col("rep").alias("doc_id")).distinct()
    texts = stored(packed_texts(docs).join(needed, "doc_id", "left_semi"), "texts")
    links = stored(_verified(star, texts, similarity), "links")
    groups = connected_components(links)
    placed = (
        shared.join(groups.select(F.col("node").alias("rep"), "component"), "rep", "left")
        .select("key", "rep", F.coalesce("component", "rep").alias("component"))
    )
    more = stored(_linked_apart(placed, signed, texts, similarity), "links")
    groups = connected_components(links.unionByName(more))
    per_class = classes.join(groups.withColumnRenamed("node", "rep"), "rep", "left").select(
        "k1", "k2", F.coalesce("component", "rep").alias("class_id"), F.lit(True).alias("_lettered")
    )
    members = signed.select("doc_id", "k1", "k2", (F.col("doc_id").isNotNull() & (F.size("keys") > 0)).alias("_lettered"))
    out = join_totals(members, per_class, ["k1", "k2", "_lettered"], grows=True)
    class_id = F.coalesce("class_id", "doc_id")
    return out.select("doc_id", class_id.alias("class_id"), F.col("doc_id").eqNullSafe(class_id).alias("kept"))
