"""Exact substring de-duplication by suffix arrays.

A byte goes when a string of ``width`` bytes covers it that also starts earlier in the corpus. Equal strings are brought
together first: every string picks the smallest gram within it as its anchor, which depends on its bytes alone, and the
strings of a text that pick the same place make one segment. Equal segments are collapsed to their first occurrence.
Where an anchor has several different segments, those are fetched and sorted: a task lays its segments end to end,
sorts the suffixes that are smaller than their successors, induces the order of the others by scanning the buckets of
first bytes, and finds equal strings as neighbours with a common prefix of ``width`` bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import binary_column, mixed, prefix_hash, ranges, runs, slices, span_hash, stored, text_bytes
from skyledger.llm.prob_minhash import packed_texts

WIDTH = 100
GRAM = 24
PLACE_BITS = 31
SEGMENTS_PER_TASK = 300_000
TEXT_PER_TASK = 16 << 20
SORT_BYTES = 1 << 20
#: Bytes of text that are cut into segments at once; a worker needs about a hundred times as much.
CUT_BYTES = 512 << 10
#: An anchor with more segments than this is split into its single strings.
HOT_SEGMENTS = 50_000
HOT_SHARE = 1e-5
HOT_SAMPLE = 16
SEGMENT, REMOVED, WANTED = 0, 1, 2
_ROW = "kind int, key long, hash long, doc_id long, start int, count int"


def segments(
    data: np.ndarray, offsets: np.ndarray, width: int = WIDTH, gram: int = GRAM
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of texts end to end: anchor hash, first string, number of strings, place of the anchor; and prefix hashes."""
    prefix = prefix_hash(data)
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < width:
        return none.astype(np.uint64), none, none, none, prefix
    place = np.arange(n - gram + 1)
    hashed = span_hash(prefix, place, place + gram)
    low = (hashed >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | place.astype(np.uint64)
    want, have = width - gram + 1, 1
    while have < want:
        step = min(have, want - have)
        low = np.minimum(low[:-step], low[step:])
        have += step
    size = np.diff(offsets)
    inside = np.repeat(offsets[:-1], np.maximum(size - width + 1, 0)) + ranges(np.maximum(size - width + 1, 0))
    anchor = (low[inside] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    if not len(inside):
        return none.astype(np.uint64), none, none, none, prefix
    edge = runs(anchor)
    # an anchor is a place in one text, so a change of text is a change of anchor
    start, count, anchor = inside[edge[:-1]], np.diff(edge), anchor[edge[:-1]]
    return hashed[anchor], start, count, anchor - start, prefix


def _collapse(doc: np.ndarray, start: np.ndarray, key: np.ndarray, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by key, hash and occurrence; where a new segment and a new key begin."""
    order = np.lexsort((start, doc, hashed, key))
    fresh_key = np.ones(len(order), bool)
    fresh_key[1:] = key[order][1:] != key[order][:-1]
    fresh = fresh_key.copy()
    fresh[1:] |= hashed[order][1:] != hashed[order][:-1]
    return order, fresh, fresh_key


def _merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of the byte ranges of each document."""
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    if not len(doc):
        return doc, start, end
    edge = runs(doc)
    reach = np.empty(len(doc), np.int64)
    for a, b in zip(edge[:-1], edge[1:], strict=True):
        np.maximum.accumulate(end[a:b], out=reach[a:b])
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1])
    first = np.flatnonzero(new)
    return doc[first], start[first], reach[np.concatenate((first[1:], [len(doc)])) - 1]


def _rows(kind, key, hashed, doc, start, count) -> pa.RecordBatch:
    columns = [
        pa.array(np.broadcast_to(np.int32(kind), len(doc))),
        pa.array(key.view(np.int64)),
        pa.array(hashed.view(np.int64)),
        pa.array(doc),
        pa.array(start.astype(np.int32)),
        pa.array(count.astype(np.int32)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["kind", "key", "hash", "doc_id", "start", "count"])


def _segment_rows(docs: DataFrame, hot: np.ndarray, width: int, gram: int) -> DataFrame:
    """Segments, each kind once per batch, and the ranges of their repeats within the batch (count is then a length)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", CUT_BYTES):
            data, offsets = text_bytes(batch.column("text"))
            key, start, count, off, prefix = segments(data, offsets, width, gram)
            if not len(key):
                continue
            split = np.isin(key, hot) if len(hot) else np.zeros(len(key), bool)
            if split.any():
                many = count[split]
                step = ranges(many)
                one = np.repeat(start[split], many) + step
                one_key = mixed(np.repeat(key[split], many) + (np.repeat(off[split], many) - step + 1).astype(np.uint64))
                key = np.concatenate((key[~split], one_key))
                start = np.concatenate((start[~split], one))
                off = np.concatenate((off[~split], np.zeros(len(one), np.int64)))
                count = np.concatenate((count[~split], np.ones(len(one), np.int64)))
            hashed = mixed(span_hash(prefix, start, start + count + width - 1) + (count * 256 + off).astype(np.uint64))
            row = np.searchsorted(offsets, start, side="right") - 1
            # empty texts repeat an offset; the last text that begins there holds the bytes
            doc, start = batch.column("doc_id").to_numpy()[row], start - offsets[row]
            order, fresh, _ = _collapse(doc, start, key, hashed)
            first, again = order[fresh], order[~fresh]
            yield _rows(SEGMENT, key[first], hashed[first], doc[first], start[first], count[first])
            if len(again):
                d, s, e = _merged(doc[again], start[again], start[again] + count[again] + width - 1)
                yield _rows(REMOVED, mixed(d.view(np.uint64)), np.zeros(len(d), np.uint64), d, s, e - s)

    return docs.mapInArrow(run, _ROW)


def _classes(rows: DataFrame, tasks: int, width: int) -> DataFrame:
    """Removed ranges, and the segments wanted: the first of each kind where an anchor has several kinds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)) if (batches := [b for b in batches if b.num_rows]) else None
        if table is None:
            return
        kind, key, hashed, doc, start, count = (table.column(c).to_numpy() for c in ("kind", "key", "hash", "doc_id", "start", "count"))
        own = kind == SEGMENT
        done = [(doc[~own], start[~own].astype(np.int64), start[~own].astype(np.int64) + count[~own])]
        key, hashed, doc, start, count = key[own], hashed[own], doc[own], start[own].astype(np.int64), count[own]
        order, fresh, fresh_key = _collapse(doc, start, key, hashed)
        again = order[~fresh]
        done.append((doc[again], start[again], start[again] + count[again] + width - 1))
        d, s, e = _merged(*(np.concatenate(x) for x in zip(*done, strict=True)))
        for cut in range(0, len(d), 100_000):
            part = slice(cut, cut + 100_000)
            zero = np.zeros(len(d[part]), np.uint64)
            yield _rows(REMOVED, zero, zero, d[part], s[part], (e - s)[part])
        kinds = np.add.reduceat(fresh, np.flatnonzero(fresh_key)) if len(order) else np.zeros(0, int)
        several = (np.repeat(kinds, np.diff(np.concatenate((np.flatnonzero(fresh_key), [len(order)])))) > 1) if len(order) else fresh
        want = order[fresh & several]
        for cut in range(0, len(want), 100_000):
            at = want[cut : cut + 100_000]
            yield _rows(WANTED, key[at], hashed[at], doc[at], start[at], count[at])

    return rows.repartition(tasks, "key").mapInArrow(run, _ROW)


def _by_document(docs: DataFrame, rows: DataFrame, tasks: int) -> DataFrame:
    """Packed texts and rows that name a document, side by side in the document's partition."""
    none = F.lit(None)
    texts = packed_texts(docs).select(
        none.cast("int").alias("kind"), none.cast("long").alias("key"), "doc_id", none.cast("int").alias("start"),
        none.cast("int").alias("count"), "packed",
    )
    named = rows.select("kind", "key", "doc_id", "start", "count", none.cast("binary").alias("packed"))
    return texts.unionByName(named).repartition(tasks, "doc_id")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """(doc_id, bytes, keys, starts, counts) of each text in a partition of ``_by_document``."""
    batches = [b for b in batches if b.num_rows]
    if not batches:
        return
    table = pa.Table.from_batches(batches).combine_chunks()
    text = table.column("packed").is_valid().to_numpy(zero_copy_only=False)
    named = table.filter(pa.array(~text))
    doc, key, start, count = (named.column(c).to_numpy() for c in ("doc_id", "key", "start", "count"))
    order = np.lexsort((start, doc))
    doc, key, start, count = doc[order], key[order], start[order].astype(np.int64), count[order].astype(np.int64)
    unpack = zstandard.ZstdDecompressor().decompress
    texts = table.filter(pa.array(text))
    for own, packed in zip(texts.column("doc_id").to_pylist(), texts.column("packed"), strict=True):
        a, b = (0, 0) if own is None else np.searchsorted(doc, [own, own + 1])
        yield own, unpack(packed.as_py()), key[a:b], start[a:b], count[a:b]


def _wanted_bytes(docs: DataFrame, wanted: DataFrame, tasks: int, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            key, doc, start, parts = zip(*held, strict=True)
            sizes = np.array([len(p) for p in parts])
            whole = np.frombuffer(b"".join(parts), np.uint8)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(key, pa.int64()), pa.array(doc, pa.int64()), pa.array(start, pa.int32()), binary_column(whole, np.concatenate(([0], np.cumsum(sizes))))],
                names=["key", "doc_id", "start", "bytes"],
            )

        for doc, text, keys, starts, counts in _documents(batches):
            for key, start, count in zip(keys.tolist(), starts.tolist(), counts.tolist(), strict=True):
                held.append((key, doc, start, text[start : start + count + width - 1]))
            if len(held) > 20_000:
                yield flush()
        if held:
            yield flush()

    return _by_document(docs, wanted, tasks).mapInArrow(run, "key long, doc_id long, start int, bytes binary")


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Order of all suffixes of ``text`` by their first ``depth`` values at least; 0 marks an end and sorts first.

    Two-stage sorting. A suffix smaller than its successor is sorted directly. Any other one follows its successor: its
    place is found when the bucket of the successor is read in order, and is the next in the bucket of its own first
    value. Within a bucket those come before the directly sorted ones.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    # the value after a run of equal values decides for the whole run; the end counts as smaller
    edge = runs(text)
    after = np.concatenate((text[edge[1:-1]], [0])) if len(edge) > 1 else np.zeros(0)
    rising = np.repeat(text[edge[:-1]] < after, np.diff(edge)) & (text != 0)
    direct = np.flatnonzero(rising)
    padded = np.concatenate((text.astype(np.uint8), np.zeros(depth, np.uint8)))
    windows = np.lib.stride_tricks.sliding_window_view(padded, depth)[direct]
    direct = direct[np.argsort(np.ascontiguousarray(windows).view(f"S{depth}")[:, 0], kind="stable")]
    del windows
    first = text[direct]
    induced: list[list[np.ndarray]] = [[] for _ in range(257)]
    out = []
    values = np.flatnonzero(np.bincount(text, minlength=256))

    def induce(read: np.ndarray) -> list[np.ndarray]:
        """Predecessors of the suffixes just read go to the buckets of their first values; those of the same value are returned."""
        before = read[read > 0] - 1
        before = before[~rising[before] & (text[before] != 0)]
        own = text[before]
        order = np.argsort(own, kind="stable")
        edge = runs(own[order])
        same = []
        for a, b in zip(edge[:-1], edge[1:], strict=True):
            value = own[order[a]]
            (same if value == current else induced[value]).append(before[order[a:b]])
        return same

    for current in values:
        if current == 0:
            bucket = [np.flatnonzero(text == 0)]
            induce(bucket[0])
            out += bucket
            continue
        waves = induced[current]
        while waves:
            read = np.concatenate(waves)
            out.append(read)
            waves = induce(read)
        a, b = np.searchsorted(first, [current, current + 1])
        if a < b:
            out.append(direct[a:b])
            induce(direct[a:b])
    return np.concatenate(out)


def _sorted_out(keys: np.ndarray, doc: np.ndarray, start: np.ndarray, parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(doc_id, start) of the strings of these segments that also start earlier in one of them."""
    sizes = np.array([len(p) for p in parts])
    text = np.zeros(int(sizes.sum()) + len(parts), np.uint16)
    begin = np.cumsum(sizes + 1) - sizes - 1
    text[np.repeat(begin, sizes) + ranges(sizes)] = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint16) + 1
    text = text.astype(np.uint8)  # UTF-8 has no byte 255
    order = suffix_array(text, width)
    row = np.searchsorted(begin, order, side="right") - 1
    inside = order - begin[row]
    full = inside <= sizes[row] - width
    order, row, inside = order[full], row[full], inside[full]
    # the common prefix of neighbours, as far as the width
    same = np.ones(max(len(order) - 1, 0), bool)
    view = np.lib.stride_tricks.sliding_window_view(np.concatenate((text, np.zeros(8, np.uint8))), 8)
    for at in (*range(0, width - 8, 8), width - 8):
        left = np.flatnonzero(same)
        a, b = view[order[left] + at], view[order[left + 1] + at]
        same[left] = (a == b).all(axis=1)
    new = np.concatenate(([True], ~same))[: len(order)]
    group = np.cumsum(new)
    d, s = doc[row], start[row] + inside
    by = np.lexsort((s, d, group))
    again = ~np.concatenate(([True], group[by][1:] != group[by][:-1]))[: len(by)]
    return d[by][again], s[by][again]


def _sorted_ranges(rows: DataFrame, tasks: int, width: int) -> DataFrame:
    """Removed ranges among the wanted segments; segments of one anchor are sorted together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        key, doc, start = (table.column(c).to_numpy() for c in ("key", "doc_id", "start"))
        parts = table.column("bytes")
        order = np.argsort(key, kind="stable")
        size = np.array([len(p) for p in parts.to_pylist()])
        edge = runs(key[order])
        filled = np.cumsum(size[order])
        begin = 0
        while begin < len(order):
            # whole anchors up to about SORT_BYTES
            most = np.searchsorted(filled, (filled[begin - 1] if begin else 0) + SORT_BYTES, side="right")
            stop = int(edge[max(np.searchsorted(edge, most, side="right") - 1, np.searchsorted(edge, begin, side="right"))])
            at = order[begin:stop]
            d, s = _sorted_out(key[at], doc[at], start[at].astype(np.int64), [parts[int(i)].as_py() for i in at], width)
            d, s, e = _merged(d, s, s + width)
            if len(d):
                zero = np.zeros(len(d), np.uint64)
                yield _rows(REMOVED, zero, zero, d, s, e - s)
            begin = stop

    return rows.repartition(tasks, "key").mapInArrow(run, _ROW)


def _hot_anchors(docs: DataFrame, total: int, width: int, gram: int) -> np.ndarray:
    """Anchors that a sample of documents shows to have very many segments; at most about 1 / HOT_SHARE of them.

    They only decide how strings are dealt out; which are found does not depend on them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", CUT_BYTES):
            data, offsets = text_bytes(batch.column("text"))
            key, count = np.unique(segments(data, offsets, width, gram)[0], return_counts=True)
            often = count > 1
            yield pa.RecordBatch.from_arrays([pa.array(key[often].view(np.int64)), pa.array(count[often])], names=["key", "n"])

    most = max(HOT_SEGMENTS, total // (width - gram) * 2 * HOT_SHARE) / HOT_SAMPLE
    sample = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(HOT_SAMPLE)) == 0)
    found = sample.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= most)
    return np.sort(found.select("key").toArrow().column("key").to_numpy().view(np.uint64))


def removed_ranges(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """Rows (doc_id, start, count): ranges of bytes of ``docs`` (doc_id, text; ids distinct) that occur earlier."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    named = docs.where(F.col("doc_id").isNotNull() & (F.octet_length("text") >= width))
    hot = _hot_anchors(named, total, width, gram)
    tasks = max(8, -(-2 * total // (width - gram) // SEGMENTS_PER_TASK))
    first = stored(_classes(_segment_rows(named, hot, width, gram), tasks, width), "segments")
    wanted = first.where(F.col("kind") == WANTED)
    by_doc = max(8, -(-total // TEXT_PER_TASK))
    pieces = stored(_wanted_bytes(named, wanted, by_doc, width), "pieces")
    more = _sorted_ranges(pieces, max(8, -(-pieces.count() // 50_000)), width)
    return stored(
        first.where(F.col("kind") == REMOVED).unionByName(more).select("kind", "key", "doc_id", "start", "count"), "removed"
    )


def distinct_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with one row per id: rows that repeat one are told apart by nothing, the smallest text stands for them."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    repeated = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) & F.col("doc_id").isNotNull())
    if repeated.isEmpty():
        return rows
    repeated = repeated.select("doc_id")
    return rows.join(repeated, "doc_id", "left_anti").unionByName(
        rows.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text"))
    )


def deduplicate(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept): what is left of each text of ``docs`` (doc_id, text), as bytes.

    A byte is removed when a string of ``width`` bytes over it also starts earlier: in a document with a smaller id, or
    in the same document before. Strings are judged on the input and never cross documents. A null text is empty. One
    row per doc_id comes back; of rows that repeat an id the smallest text counts. Rows without an id are kept whole
    and compared with nothing. Texts shorter than ``width`` are kept whole. Other columns are ignored.
    """
    docs = distinct_documents(docs)
    removed = removed_ranges(docs, width, gram)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*held, strict=True))
            held.clear()
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
            )

        size = 0
        for doc, text, _, starts, counts in _documents(batches):
            _, begin, end = _merged(np.zeros(len(starts), np.int64), starts, starts + counts)
            parts, at = [], 0
            for a, b in zip(begin.tolist(), end.tolist(), strict=True):
                parts.append(text[at:a])
                at = b
            parts.append(text[at:])
            kept = b"".join(parts)
            held.append((doc, len(text), len(text) - len(kept), len(begin), kept))
            size += len(kept)
            if size > 4 << 20:
                yield flush()
                size = 0
        if held:
            yield flush()

    return _by_document(docs, removed, max(8, -(-total // TEXT_PER_TASK))).mapInArrow(
        run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
