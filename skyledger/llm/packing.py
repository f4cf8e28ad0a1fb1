"""Best-fit packing of token pieces into sequences under several capacities.

A document becomes pieces of at most ``length`` tokens. A piece weighs three things: its tokens, one document and the
cost of attending within it (tokens squared). Pieces are dealt to shards of bounded size and packed there by vector
best fit: largest piece first, each into the open sequence that still holds it under every capacity and is best by the
weighted norm of what would be left (``norm``) or the weighted dot product of need and room (``dot``). Sequences that
stay loose are taken apart and packed once more together with those of other shards. Where pieces have an order, shards
are consecutive stretches of it and sequences are numbered along it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger.llm.common import binary_column, ranges, slices, stored, text_bytes
from skyledger.llm.mixing import PART_BITS

SEQUENCE_TOKENS = 2048
SHARD_PIECES = 4096
CACHED_WORDS = 300_000
SLICE_BYTES = 4 << 20
END_ID = 0

#: Chunks of these characters need no normalising but lower case, and fall into words as the tokenizer splits them.
_PLAIN = regex.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ0-9!-&(-/:;=?@\[-`{}~]+")
_WORDS = regex.compile(r"[a-zà-öø-ÿß]+|[0-9]|[!-/:-@\[-`{-~]+")


def _byte_alphabet() -> dict[int, str]:
    """Latin letters as the byte-level alphabet writes their UTF-8 bytes: printable bytes stay, others move up by rule."""
    stay = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {b: chr(b) for b in stay}
    shown |= {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in shown)}
    return {c: "".join(shown[b] for b in chr(c).encode()) for c in range(33, 256)}


class WordTokens:
    """Token ids of texts by way of their distinct white-space chunks; the same ids as encoding each text whole.

    The tokenizer's pattern never crosses white space, so a text's ids are those of its chunks end to end. Chunks and
    words are remembered up to a fixed number, after which the memory starts afresh.
    """

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        self.model = self.tokenizer.model
        self.alphabet = _byte_alphabet()
        self.chunks: dict[str, np.ndarray] = {}
        self.words: dict[str, list[int]] = {}

    def _word(self, word: str) -> list[int]:
        ids = self.words.get(word)
        if ids is None:
            if len(self.words) >= CACHED_WORDS:
                self.words.clear()
            ids = self.words[word] = [t.id for t in self.model.tokenize(word.translate(self.alphabet))]
        return ids

    def _chunk(self, chunk: str) -> np.ndarray:
        if _PLAIN.fullmatch(chunk):
            ids = [i for word in _WORDS.findall(chunk.lower()) for i in self._word(word)]
        else:
            ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        return np.array(ids, np.uint32)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, each text closed by ``END_ID``, and the n + 1 offsets."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        per_text = np.diff(split.offsets.to_numpy())
        words = split.flatten().dictionary_encode()
        known, parts = self.chunks, []
        for chunk in words.dictionary.to_pylist():
            ids = known.get(chunk)
            if ids is None:
                if len(known) >= CACHED_WORDS:
                    known.clear()
                ids = known[chunk] = self._chunk(chunk)
            parts.append(ids)
        parts.append(np.array([END_ID], np.uint32))
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        firsts = np.cumsum(sizes) - sizes
        table = np.concatenate(parts)
        index = words.indices.to_numpy().astype(np.int64)
        index = np.insert(index, np.cumsum(per_text), len(parts) - 1)
        lengths = sizes[index]
        flat = table[np.repeat(firsts[index], lengths) + ranges(lengths)]
        text_ends = np.cumsum(per_text + 1)
        return flat, np.concatenate(([0], np.cumsum(lengths)[text_ends - 1]))


@lru_cache(maxsize=2)
def _tokens(file: str) -> WordTokens:
    return WordTokens(file)


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_pieces(docs: DataFrame, file: str | None = None, length: int = SEQUENCE_TOKENS, keep: Sequence[str] = ()) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids): each document's token ids, closed by id 0, cut only beyond ``length``.

    ``ids`` is the piece's ids as little-endian unsigned 32-bit integers. A null text counts as empty and gives one
    piece of one id. Repeated rows and null ids are documents of their own. ``file`` is looked up by name on each
    executor where it is not given. Columns of ``docs`` named in ``keep`` come with every piece.
    """
    taken = [f for f in docs.schema if f.name in keep]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(file or tokenizer_file())
        for batch in slices(batches, "text", SLICE_BYTES):
            flat, offsets = tokens.ids(batch.column("text"))
            sizes = np.diff(offsets)
            pieces = -(-sizes // length)
            row = np.repeat(np.arange(len(sizes)), pieces)
            piece = ranges(pieces)
            start = piece * length
            size = np.minimum(sizes[row] - start, length)
            ends = np.concatenate(([0], np.cumsum(size)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start),
                    pa.array(size),
                    binary_column(flat.view(np.uint8), ends * 4),
                    *[batch.column(f.name).take(pa.array(row)) for f in taken],
                ],
                names=["doc_id", "piece", "start", "length", "ids", *[f.name for f in taken]],
            )

    return docs.select(F.col("doc_id").cast("long"), "text", *[f.name for f in taken]).mapInArrow(
        cut, ", ".join(["doc_id long, piece int, start long, length long, ids binary", *[f"{f.name} {f.dataType.simpleString()}" for f in taken]])
    )


def best_fit(
    tokens: np.ndarray, capacity: np.ndarray, weights: np.ndarray, rule: str = "norm"
) -> tuple[np.ndarray, np.ndarray]:
    """Bin and token offset of each piece; ``capacity`` and ``weights`` are for tokens, documents and attention cost.

    A piece that no empty bin can hold gets a bin of its own.
    """
    order = np.argsort(-tokens, kind="stable")
    bin_of, offset = np.empty(len(tokens), np.int64), np.empty(len(tokens), np.int64)
    room = np.empty((len(tokens), 3))
    open_bins = np.empty(len(tokens), np.int64)
    n_open = n_bins = 0
    least = float(tokens.min()) if len(tokens) else 0.0
    scale = weights / capacity**2
    for i in order:
        size = float(tokens[i])
        need = np.array([size, 1.0, size * size])
        left = room[:n_open] - need
        fits = (left >= 0).all(axis=1)
        if fits.any():
            value = (left * left) @ scale if rule == "norm" else -((room[:n_open] * need) @ scale)
            value[~fits] = np.inf
            k = int(value.argmin())
        else:
            k, n_open = n_open, n_open + 1
            room[k], open_bins[k] = capacity, n_bins
            n_bins += 1
        bin_of[i], offset[i] = open_bins[k], capacity[0] - room[k, 0]
        room[k] -= need
        if room[k, 0] < least or room[k, 1] < 1 or room[k, 2] < least * least:
            n_open -= 1
            room[k], open_bins[k] = room[n_open], open_bins[n_open]
    return bin_of, offset


def _along(bins: np.ndarray, number: np.ndarray, stretch: int) -> np.ndarray:
    """Numbers of the bins that grow along the order: by the stretch of the first piece, then by the mean place."""
    first = np.full(bins.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(first, bins, number)
    mean = np.bincount(bins, weights=number) / np.bincount(bins)
    rank = np.empty(len(first), np.int64)
    rank[np.lexsort((first, mean))] = np.arange(len(first))
    return ((first // stretch << 32) + rank)[bins]


def pack(
    pieces: DataFrame,
    capacity: int = SEQUENCE_TOKENS,
    max_docs: int | None = None,
    max_cost: int | None = None,
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01),
    rule: str = "norm",
    shard_pieces: int = SHARD_PIECES,
    loose: float = 0.995,
    order: str | None = None,
) -> DataFrame:
    """Every row of ``pieces`` with its ``sequence_id`` and its ``offset`` there; its other columns are kept.

    A piece longer than ``capacity`` raises an error. ``max_docs`` and ``max_cost`` limit the pieces of a sequence
    and the sum of their squared lengths; by default neither binds. Equal pieces and repeated rows are placed one by
    one; an empty table gives an empty one. Columns named like the added ones are replaced.

    ``order`` names a column of places as ``mixing.places`` gives them; it is not kept. Then every shard holds
    ``shard_pieces`` pieces that follow one another, loose sequences meet those of the stretches next to them, and
    ``sequence_id`` grows along the order: by the stretch of a sequence's first piece, within it by the mean place.
    """
    limits = np.array([capacity, max_docs or capacity, max_cost or capacity * capacity], float)
    scales = np.array(weights, float)
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    rows = stored(
        pieces.select(*kept).withColumn(
            "length",
            F.when(F.col("length") > capacity, F.raise_error(F.lit("piece longer than a sequence"))).otherwise(F.col("length")),
        ),
        "pieces",
    )

    def dealt(df: DataFrame, first: int) -> tuple[DataFrame, int]:
        shards = max(1, -(-df.count() // shard_pieces))
        return df.withColumn("_shard", F.pmod(F.monotonically_increasing_id(), F.lit(shards)) + first), first + shards

    def numbered(df: DataFrame, name: str) -> DataFrame:
        """Adds the number of every piece in the order, counted within each part of it and from the parts before."""
        df = df.withColumn("_part", F.shiftright(F.col(order), PART_BITS))
        at, bases = 0, []
        for part, n in sorted(map(tuple, df.groupBy("_part").count().collect())):  # one row per stored file
            bases.append((part, at))
            at += n
        inside = Window.partitionBy("_part").orderBy(order, "doc_id", "piece")
        base = df.sparkSession.createDataFrame(bases, "_part long, _base long")
        return df.join(base, "_part").withColumn(name, F.col("_base") + F.row_number().over(inside) - 1).drop("_part", "_base")

    def packed(df: DataFrame, again: bool = False) -> DataFrame:
        names = [c for c in df.columns if c != "_shard"]
        schema = df.select(*names, F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(0.0).alias("_fill")).schema

        def one(table: pa.Table) -> pa.Table:
            tokens = table.column("length").to_numpy().astype(np.int64)
            bins, offset = best_fit(tokens, limits, scales, rule)
            fill = np.bincount(bins, weights=tokens)[bins] / capacity
            shard = table.column("_shard")[0].as_py()
            if order is None:
                sequence = bins + (shard << 32)
            else:
                sequence = _along(bins, table.column("_number").to_numpy(), shard_pieces)
                # a stretch has loose pieces in two shards that follow one another at most
                sequence += (1 << 31) + shard % 2 * shard_pieces if again else 0
            out = table.select(names)
            for name, values in (("sequence_id", sequence), ("offset", offset), ("_fill", fill)):
                out = out.append_column(name, pa.array(values))
            return out

        return df.groupBy("_shard").applyInArrow(one, schema)

    if order is not None:
        stretch = lambda c: F.floor(F.col(c) / shard_pieces).cast("long")
        once = stored(packed(numbered(rows, "_number").withColumn("_shard", stretch("_number"))), "packed")
        again = once.where(F.col("_fill") < loose).drop("sequence_id", "offset", "_fill")
        again = numbered(again, "_again").withColumn("_shard", stretch("_again")).drop("_again")
        done = once.where(F.col("_fill") >= loose).unionByName(packed(again, again=True))
        return done.drop("_fill", "_number", order)

    first, shards = dealt(rows, 0)
    once = stored(packed(first), "packed")
    again, _ = dealt(once.where(F.col("_fill") < loose).drop("sequence_id", "offset", "_fill"), shards)
    return once.where(F.col("_fill") >= loose).drop("_fill").unionByName(packed(again).drop("_fill"))
