"""Mixing sources to target weights by Pfair scheduling, in native expressions.

Each source's documents are put in a pseudo-random order and cut into blocks of ``block_chars`` characters. With integer
shares a_s out of Q = sum of shares, block k of a source (from 0) may run from slot floor(k * Q / a_s) on and must run
before slot ceil((k + 1) * Q / a_s). Earliest deadline first, among blocks already released, keeps every source within
one block of its share at any slot. The pattern repeats after Q slots, so one frame of Q slots is scheduled and blocks
look their slot up by number. When a source runs out, the others go on under their shares alone: a new phase.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger.llm.common import stored

OTHER = "*"
#: A place is the number of a part of the order, and below so many bits the row within the part.
PART_BITS = 33


def frame_schedule(shares: Mapping[str, int]) -> list[str]:
    """The source that runs in each of the Q slots of a frame: released blocks, earliest deadline first, then by name."""
    frame = sum(shares.values())
    done = dict.fromkeys(shares, 0)
    slots = []
    for slot in range(frame):
        due = [
            (-(-(done[s] + 1) * frame // a), s) for s, a in shares.items() if done[s] < a and done[s] * frame // a <= slot
        ]
        chosen = min(due)[1]
        done[chosen] += 1
        slots.append(chosen)
    return slots


@dataclass(frozen=True)
class Phase:
    """Slots from ``first_slot`` on; source s begins with its block ``first_block[s]`` and takes ``blocks[s]`` of them."""

    first_slot: int
    shares: dict[str, int]
    first_block: dict[str, int]
    blocks: dict[str, int]
    schedule: list[str]


def phases(blocks: Mapping[str, int], shares: Mapping[str, int]) -> list[Phase]:
    """As many phases as sources at most. A phase ends at the slot whose source has no block left."""
    left = {s: n for s, n in blocks.items() if n > 0}
    taken = dict.fromkeys(left, 0)
    slot, out = 0, []
    while left:
        own = {s: shares[s] for s in left}
        schedule = frame_schedule(own)
        frames = min(n // own[s] for s, n in left.items())
        rest = {s: n - frames * own[s] for s, n in left.items()}
        tail = dict.fromkeys(left, 0)
        for s in schedule:
            if tail[s] == rest[s]:
                break
            tail[s] += 1
        used = {s: frames * own[s] + tail[s] for s in left}
        out.append(Phase(slot, own, {s: taken[s] for s in left}, used, schedule))
        slot += sum(used.values())
        for s, n in used.items():
            taken[s] += n
            left[s] -= n
        left = {s: n for s, n in left.items() if n > 0}
    return out


def _slot(group: Column, block: Column, plan: list[Phase]) -> Column:
    """Slot of block number ``block`` of a source, from the phase it falls into and its place in that phase's frame."""
    by_source: dict[str, list[Column]] = {}
    for phase in plan:
        places: dict[str, list[int]] = {}
        for at, s in enumerate(phase.schedule):
            places.setdefault(s, []).append(at)
        frame = len(phase.schedule)
        for s, n in phase.blocks.items():
            if not n:
                continue
            inside = block - F.lit(phase.first_block[s])
            # one text literal, which the optimiser folds to an array, instead of a literal per place
            turns = F.split(F.lit(",".join(map(str, places[s]))), ",").cast("array<int>")
            place = F.element_at(turns, (inside % phase.shares[s] + 1).cast("int"))
            slot = F.lit(phase.first_slot) + F.floor(inside / phase.shares[s]) * frame + place
            by_source.setdefault(s, []).append(F.when(block < phase.first_block[s] + n, slot))
    out = F.lit(None).cast("long")
    for s, choices in by_source.items():
        out = F.when(group == s, F.coalesce(*choices)).otherwise(out)
    return out.cast("long")


def mix(
    docs: DataFrame,
    shares: Mapping[str, int],
    block_chars: int = 65_536,
    bucket_rows: int = 4096,
    seed: int = 42,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows (doc_id, source_group, block, slot, position) for every row of ``docs`` with doc_id, source and text.

    Columns of ``docs`` named in ``keep`` come with them, as one struct column ``kept``.

    ``shares`` gives positive integers by source; sources without one, and null sources, form the group ``*``, which
    needs a share too (1 if absent). A document belongs to the block its first character falls into, and weighs its
    characters, one at least; a null text weighs one. ``slot`` is the turn of the block, ``position`` orders documents
    within and across slots of a source and ``slot, position`` orders the whole. Nothing is dropped or repeated.
    Repeated rows and equal ids keep their own places. The number of sources named in ``shares`` bounds what the driver
    sees; a source of any size is split into buckets of the order, so no task holds a whole source.
    """
    weights = {OTHER: 1, **shares}
    if min(weights.values()) < 1:
        raise ValueError("shares are positive integers")
    named = [s for s in weights if s != OTHER]
    # the row number tells repeated rows apart; rows that agree in all else are alike wherever they go
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.when(F.col("source").isin(named), F.col("source")).otherwise(F.lit(OTHER)).alias("source_group"),
        F.greatest(F.coalesce(F.length("text"), F.lit(0)), F.lit(1)).cast("long").alias("_chars"),
        F.coalesce(F.col("source"), F.lit("")).alias("_source"),
        *([F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept")] if keep else []),
    ).withColumn("_order", F.xxhash64("doc_id", "_chars", "_source", F.lit(seed)))
    sized = rows.groupBy("source_group").agg(F.count(F.lit(1)).alias("rows")).collect()  # one row per share
    most = max((r["rows"] for r in sized), default=1)
    buckets = 1 << max(0, -(-most // bucket_rows) - 1).bit_length()
    # the top bits of the order, so buckets follow one another as the order does
    shift = 64 - buckets.bit_length() + 1
    bucket = F.shiftright(F.col("_order"), shift) + buckets // 2 if buckets > 1 else F.lit(0).cast("long")
    rows = rows.withColumn("_bucket", bucket)
    totals = rows.groupBy("source_group", "_bucket").agg(F.sum("_chars").alias("_sum"))
    before = Window.partitionBy("source_group").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # stored, or the rows would follow this table's partitioning and bring a whole source together
    offsets = stored(totals.withColumn("_offset", F.coalesce(F.sum("_sum").over(before), F.lit(0))), "offsets")
    last = offsets.groupBy("source_group").agg(F.max(F.col("_offset") + F.col("_sum")).alias("chars")).collect()
    plan = phases({r["source_group"]: -(-r["chars"] // block_chars) for r in last}, weights)
    inside = (
        Window.partitionBy("source_group", "_bucket")
        .orderBy("_order", "doc_id", "_chars", "_source")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        rows.withColumn("_inside", F.coalesce(F.sum("_chars").over(inside), F.lit(0)))
        .join(offsets.drop("_sum"), ["source_group", "_bucket"])
        .withColumn("position", F.col("_offset") + F.col("_inside"))
        .withColumn("block", F.floor(F.col("position") / block_chars))
        .select("doc_id", "source_group", "block", _slot(F.col("source_group"), F.col("block"), plan).alias("slot"), "position", *(["kept"] if keep else []))
    )


def places(docs: DataFrame, name: str = "_place") -> DataFrame:
    """``docs`` with the place of every row in the order it was written in; places grow along that order.

    For a stored table this is the number of the part file and the row within it, however files are read. Another frame
    gives its rows the order in which its partitions are computed.
    """
    leaf = docs._jdf.queryExecution().analyzed().children().isEmpty()  # above a join or filter, files tell nothing of the order
    try:
        files = docs.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")) if leaf else None
    except AnalysisException:
        files = None
    if files is None:
        return docs.withColumn(name, F.monotonically_increasing_id())
    number = lambda pattern: F.coalesce(F.regexp_extract("_file", pattern, 1).try_cast("long"), F.lit(0).cast("long"))
    part = F.shiftleft(number(r"^part-(\d+)"), 11) + number(r"-c(\d+)\.")
    return files.withColumn(name, F.shiftleft(part, PART_BITS) + F.col("_row")).drop("_file", "_row")
