"""Shared helpers: stored intermediate tables, Arrow batches cut by bytes, rows packed into binary blobs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skyledger.session import forget, scratch_path  # noqa: F401

SLICE_BYTES = 2 << 20


def stored(df: DataFrame, label: str) -> DataFrame:
    """The table written to the shared folder and read back: computed once, and a lost executor costs a re-read."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in order, cut so that ``column`` has about ``most`` bytes; a longer single row stays whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum(_byte_lengths(batch.column(column)))
        start = 0
        while start < batch.num_rows:
            done = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, done + most, side="right")))
            yield batch.slice(start, end - start)
            start = end


def _byte_lengths(values: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def byte_groups(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Consecutive stretches of about ``most`` bytes each; something longer stands alone."""
    filled = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        done = filled[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(filled, done + most, side="right")))
        yield slice(start, stop)
        start = stop


def text_bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string column end to end, and the n + 1 offsets into them; null is empty."""
    import pyarrow.compute as pc

    values = pc.fill_null(values.cast(pa.large_string()), "")
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    buffers = values.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, len(values) + 1, values.offset * 8)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def binary_column(parts: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column over consecutive byte ranges of one buffer."""
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(parts))]
    ).cast(pa.binary())


def long_column(values: pa.Array) -> pa.Array:
    return values.cast(pa.int64())


def runs(sorted_values: np.ndarray) -> np.ndarray:
    """Offsets of the runs of equal values, with the total length at the end."""
    if not len(sorted_values):
        return np.zeros(1, np.int64)
    edges = np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1
    return np.concatenate(([0], edges, [len(sorted_values)]))


def ranges(lengths: np.ndarray) -> np.ndarray:
    """0 .. n-1 for each length, end to end."""
    total = int(lengths.sum())
    starts = np.cumsum(lengths) - lengths
    return np.arange(total) - np.repeat(starts, lengths)


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE_VALUE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, up to n; kept for the next batch."""
    if len(_powers.get("up", ())) <= n:
        size = max(n + 1, 1 << 19)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            np.multiply.accumulate(table, out=table)
            _powers[name] = table
    return _powers["up"], _powers["down"]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """Prefix sums that give the hash of any stretch; ``values`` are bytes or 64-bit words."""
    up, _ = _power(len(values))
    out = np.zeros(len(values) + 1, np.uint64)
    known = _BYTE_VALUE[values] if values.dtype == np.uint8 else values
    np.cumsum(known * up[: len(values)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each stretch, the same wherever it stands."""
    _, down = _power(len(prefix))
    return mixed((prefix[ends] - prefix[starts]) * down[starts])


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lowered(data: np.ndarray) -> np.ndarray:
    """Lower case of ASCII and Latin letters in UTF-8, byte by byte."""
    out = _LOWER[data]
    after = np.flatnonzero(data[:-1] == 0xC3) + 1 if len(data) > 1 else np.zeros(0, np.int64)
    upper = after[(out[after] >= 0x80) & (out[after] <= 0x9E) & (out[after] != 0x97)]
    out[upper] += 32
    return out


WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[48:58] = WORD_BYTE[65:91] = WORD_BYTE[97:123] = WORD_BYTE[128:] = True
INK_BYTE = np.arange(256) > 32


def word_spans(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = WORD_BYTE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``kind`` bytes within each text, and the n + 1 offsets into them."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = kind[data]
    starts = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    starts[edge] = inside[edge + 1]
    ends[edge - 1] = inside[edge]
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return begin, end, np.searchsorted(begin, offsets)


def sample_fraction(rows: int, most: int) -> float:
    return min(1.0, most / rows) if rows else 1.0
