"""Look-up of the network block an address belongs to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions.network import MAPPED
from skyledger.operators.keyed import _row_salt


def keyed_blocks(blocks: DataFrame) -> DataFrame:
    """``blocks`` with ``start_key`` and ``end_key``: as given, or from the IPv4 numbers ``start_ip`` and ``end_ip``."""
    if "start_key" in blocks.columns:
        return blocks
    hexed = lambda c: F.lpad(F.lower(F.hex(F.col(c).cast("long"))), 8, "0")
    return blocks.withColumn("start_key", hexed("start_ip")).withColumn("end_key", hexed("end_ip"))


#: Beginnings of so few digits are shared by large parts of all addresses; their look-ups are dealt to ``SALTS`` tasks.
SHORT_DIGITS, SALTS = 2, 32
HALF = 16  # digits that an unsigned 64-bit number holds


def _number(digits: Column) -> Column:
    return F.coalesce(F.conv(digits, 16, 10).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))


def _size(start: Column, end: Column) -> Column:
    """Order of blocks by their number of addresses, as (high, low) halves of the difference of their ends."""
    cut = F.greatest(F.length(start) - F.lit(HALF), F.lit(0))

    def part(key: Column, low: bool) -> Column:
        return _number(key.substr(cut + 1, F.lit(HALF)) if low else key.substr(F.lit(1), cut))

    low = part(end, True) - part(start, True)
    borrowed = low < 0
    high = part(end, False) - part(start, False) - F.when(borrowed, F.lit(1)).otherwise(F.lit(0))
    return F.struct(high.alias("high"), F.when(borrowed, low + F.lit(str(1 << 64)).cast("decimal(20,0)")).otherwise(low).alias("low"))


def enrich_by_block(
    rows: DataFrame,
    blocks: DataFrame,
    attributes: Sequence[str],
    ip: str = "ip_number",
    salts: int = 8,
    missing: str = "unknown",
) -> DataFrame:
    """Attributes of the most specific block holding each address, ``missing`` where there is none; one row per row.

    ``ip`` is an IPv4 number where blocks have ``start_ip`` and ``end_ip``, or text as ``network.address_key`` gives it,
    for either family, where they have ``start_key`` and ``end_key``. Blocks may lie within each other, overlap and repeat:
    the one with the fewest addresses wins, of equally large ones the first by its start and then by its attributes.
    Blocks whose end lies before their start hold nothing.

    A block is filed once, under the digits that its first and last address have in common; an address is looked up under
    those of its beginnings whose lengths occur among the blocks. Of blocks that are networks (a power of two in size, at a
    multiple of it) no more than 15 different ones share a file, so no address meets more of them under one beginning.
    Files of the shortest beginnings hold large parts of all addresses: their look-ups are dealt to several tasks, to which
    their few blocks are copied. Addresses are de-duplicated first, which turns a source that sends a third of all rows
    into one look-up.
    """
    text = "start_key" in blocks.columns
    filed = keyed_blocks(blocks).where(F.col("start_key") <= F.col("end_key"))
    filed = filed.withColumns({"start_key": F.lower("start_key"), "end_key": F.lower("end_key")})
    digits = F.length("start_key")
    shared = F.size(F.filter(F.sequence(F.lit(1), digits), lambda n: F.col("start_key").substr(F.lit(1), n) == F.col("end_key").substr(F.lit(1), n)))
    attached = F.struct(_size(F.col("start_key"), F.col("end_key")).alias("size"), F.col("start_key").alias("start"), *[F.col(a) for a in attributes])
    filed = filed.select(shared.alias("_n"), F.col("start_key").substr(F.lit(1), shared).alias("_file"), "start_key", "end_key", attached.alias("_block"))
    lengths = sorted(r[0] for r in filed.select("_n").distinct().collect())  # as many as an address has digits at most

    distinct = rows.select(F.col(ip).alias("_ip")).where(F.col("_ip").isNotNull()).distinct()
    key = F.lower(F.col("_ip")) if text else F.lpad(F.lower(F.hex(F.col("_ip").cast("long"))), 8, "0")
    tried = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("_key"))
    looked = distinct.withColumn("_key", key).withColumn("_n", F.explode(tried)).withColumn("_file", F.col("_key").substr(F.lit(1), F.col("_n")))
    # IPv4 addresses share their first digits as keys of both families; those of IPv6 differ little in their first four
    common = F.when(F.col("_file").startswith(MAPPED), F.lit(len(MAPPED))).otherwise(F.lit(2 if text else 0))
    short = F.length("_file") < common + F.lit(SHORT_DIGITS)
    looked = looked.withColumn("_part", F.when(short, F.pmod(F.xxhash64("_key"), F.lit(SALTS)).cast("int")).otherwise(F.lit(0)))
    copies = F.when(short, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    found = (
        looked.join(filed.withColumn("_part", F.explode(copies)), ["_file", "_part"], "inner")
        .where(F.col("_key").between(F.col("start_key"), F.col("end_key")))
        .groupBy("_ip")
        .agg(F.min("_block").alias("_block"))
        .select("_ip", *[F.col("_block")[a].alias(a) for a in attributes])
    )
    # Back to the rows by address, salted because one address may be most of them.
    copies = found.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    keyed = rows.withColumn("_ip", F.col(ip)).withColumn("_salt", _row_salt(rows, [ip], salts))
    out = keyed.join(copies, ["_ip", "_salt"], "left").drop("_ip", "_salt")
    for a in attributes:
        out = out.withColumn(a, F.coalesce(F.col(a).cast("string"), F.lit(missing)))
    return out


def enrich_geo(rows: DataFrame, networks: DataFrame, places: DataFrame, ip: str = "ip_number") -> DataFrame:
    """Network owner from ``networks`` (asn, org) and place from ``places`` (continent, country, city)."""
    owned = enrich_by_block(rows, networks, ["asn", "org"], ip)
    return enrich_by_block(owned, places, ["continent", "country", "city"], ip)
