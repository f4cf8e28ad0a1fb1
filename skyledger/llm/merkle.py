"""Merkle manifest of a table: leaves, group roots, one root, and a proof for every row, by time-forward processing.

Every row is a leaf. The leaves of a group, in order of their id, form a tree of ``ARITY`` children a node, and the roots of
all groups, in order of the group's name, form the tree above them. A node sends its digest forward to its parent: a
priority queue ordered by node label (level, then place) holds the digests under way, so every node finds all its children's
digests at the head of the queue when its turn comes. A second sweep runs through the labels in reverse and sends each
node's proof, what its siblings and those of its ancestors are, back to its children until it reaches the leaves.

The queue is external: a sweep works on blocks of ``ARITY ** DEPTH`` neighbouring nodes, whose messages fit in a heap, and
messages between blocks travel as rows of a table sorted by Spark. Each round of blocks climbs ``DEPTH`` levels, so the
number of rounds is the logarithm of the rows to the base 4096, and no task holds more than one block of any group.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import stored
from skyledger.llm.url_rules import LOWER, UPPER

ARITY = 8
DEPTH = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

NODES = "tree string, idx long, n long, digest binary"
ROUTES = "tree string, block long, route binary"


def encoded(value: Column) -> Column:
    """A field as bytes: ``-`` where it is null, else the number of its UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")).cast("binary")


def leaf(*values: Column) -> Column:
    """Digest of a row from its fields in order, as lower-case hexadecimal text."""
    return F.sha2(F.concat(*[encoded(v) for v in values]), 256)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _hash(parts: list[bytes]) -> bytes:
    """Digest of digests, which are taken as hexadecimal text."""
    return hashlib.sha256("".join(p.hex() for p in parts).encode()).digest()


def levels(n: int, arity: int = ARITY) -> int:
    """Rounds until one of n nodes remains."""
    rounds = 0
    while n > 1:
        n = -(-n // arity)
        rounds += 1
    return rounds


def numbered(nodes: DataFrame, tree: str, order: list[str], label: str) -> DataFrame:
    """The rows with ``idx``, their place in their tree from 0, and ``n``, the rows of the tree.

    Rows are range-partitioned by (tree, order) and numbered within their partition; the totals of earlier partitions, a row
    for each partition and tree in it, are added. A tree of any size is spread over as many partitions as it fills.
    """
    spread = nodes.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    spread = stored(spread.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), label)
    counts = spread.groupBy("_part", tree).agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    whole = Window.partitionBy(tree)
    before = F.coalesce(F.sum("_rows").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select("_part", tree, "_first", before.alias("_before"), F.sum("_rows").over(whole).alias("n"))
    return spread.join(counts, ["_part", tree]).withColumn("idx", F.col("_at") - F.col("_first") + F.col("_before")).drop("_part", "_at", "_first", "_before")


def _forward(idx: list[int], digests: list[bytes], climb: int, arity: int) -> dict[tuple[int, int], list[bytes]]:
    """Sweep up: digests of the children of every node of a block, by the node's label.

    Labels are (level, place) and the queue holds (label of the receiver, place of the sender, digest).
    """
    queue = [((1, i // arity), i, d) for i, d in zip(idx, digests, strict=True)] if climb else []
    heapq.heapify(queue)
    children: dict[tuple[int, int], list[bytes]] = {}
    while queue:
        node = queue[0][0]
        got = []
        while queue and queue[0][0] == node:
            got.append(heapq.heappop(queue)[2])
        children[node] = got
        level, place = node
        if level < climb:
            heapq.heappush(queue, ((level + 1, place // arity), place, _hash(got)))
    return children


def _backward(children: dict[tuple[int, int], list[bytes]], climb: int, top: int, route: bytes, arity: int) -> dict[int, bytes]:
    """Sweep down: the route of every node at the bottom of a block, from the route that its top received.

    A route lists, from the node up, its place in its run, the run's other digests and the run's size.
    """
    queue = [((-climb, -top), route)]
    routes: dict[int, bytes] = {}
    while queue:
        (level, place), known = heapq.heappop(queue)
        level, place = -level, -place
        if level == 0:
            routes[place] = known
            continue
        run = children[level, place]
        for k in range(len(run)):
            step = bytes((k, len(run))) + b"".join(run[:k]) + b"".join(run[k + 1 :])
            heapq.heappush(queue, ((1 - level, -(place * arity + k)), step + known))
    return routes


def fold(digest: bytes, route: bytes) -> tuple[bytes, bytes]:
    """The root that a digest leads to along a route, and the digest of all siblings on it."""
    siblings = hashlib.sha256()
    at = 0
    while at < len(route):
        place, size = route[at], route[at + 1]
        others = [route[at + 2 + 32 * k : at + 34 + 32 * k] for k in range(size - 1)]
        for other in others:
            siblings.update(other.hex().encode())
        digest = _hash([*others[:place], digest, *others[place:]])
        at += 2 + 32 * (size - 1)
    return digest, siblings.digest()


def _rows(table: pa.Table) -> tuple[list[int], list[bytes], int]:
    idx = table.column("idx").to_numpy()
    order = np.argsort(idx, kind="stable")
    return idx[order].tolist(), table.column("digest").take(pa.array(order)).to_pylist(), table.column("n")[0].as_py()


def _climb(n: int, arity: int, depth: int) -> int:
    """Levels that a block of a tree with n nodes at its bottom climbs."""
    return min(depth, levels(n, arity))


def _raise(nodes: DataFrame, arity: int, depth: int) -> DataFrame:
    """One round of blocks up: a node per block, with its place and the number of nodes at its level."""
    span = arity**depth

    def block(key: tuple, table: pa.Table) -> pa.Table:
        idx, digests, n = _rows(table)
        climb = _climb(n, arity, depth)
        children = _forward(idx, digests, climb, arity)
        top = idx[0] // arity**climb
        digest = _hash(children[climb, top]) if climb else digests[0]
        return pa.table(
            {"tree": [key[0].as_py()], "idx": pa.array([top], pa.int64()), "n": pa.array([-(-n // arity**climb)], pa.int64()), "digest": pa.array([digest], pa.binary())}
        )

    return nodes.groupBy("tree", F.floor(F.col("idx") / span).alias("block")).applyInArrow(block, NODES)


def _lower(nodes: DataFrame, routes: DataFrame, arity: int, depth: int, to_leaf, schema: str) -> DataFrame:
    """One round of blocks down: ``to_leaf`` turns the rows of a block and their routes into rows."""
    span = arity**depth

    def block(key: tuple, below: pa.Table, above: pa.Table) -> pa.Table:
        if not below.num_rows:
            return to_leaf(None, None)
        order = pa.array(np.argsort(below.column("idx").to_numpy(), kind="stable"))
        below = below.take(order)
        idx, digests, n = _rows(below)
        climb = _climb(n, arity, depth)
        children = _forward(idx, digests, climb, arity)
        found = _backward(children, climb, idx[0] // arity**climb, above.column("route")[0].as_py(), arity)
        return to_leaf(below, [found[i] for i in idx])

    by_block = nodes.withColumn("block", F.floor(F.col("idx") / span)).groupBy("tree", "block")
    return by_block.cogroup(routes.groupBy("tree", "block")).applyInArrow(block, schema)


def _to_routes(below: pa.Table | None, routes: list[bytes] | None) -> pa.Table:
    if below is None:
        return pa.table({"tree": pa.array([], pa.string()), "block": pa.array([], pa.int64()), "route": pa.array([], pa.binary())})
    return pa.table({"tree": below.column("tree"), "block": below.column("idx"), "route": pa.array(routes, pa.binary())})


def _climbed(nodes: DataFrame, largest: int, arity: int, depth: int, label: str) -> list[DataFrame]:
    """The nodes before every round of blocks, and the roots after the last. Trees of less height keep their root."""
    rounds = [nodes]
    while largest > 1 or len(rounds) == 1:
        rounds.append(stored(_raise(rounds[-1], arity, depth), f"{label}_up{len(rounds)}"))
        largest = -(-largest // arity**depth)
    return rounds


def _descended(rounds: list[DataFrame], top: DataFrame, arity: int, depth: int, to_leaf, schema: str, label: str) -> DataFrame:
    """Routes from the roots down all rounds; ``top`` has the route of every root."""
    routes = top
    for k in range(len(rounds) - 2, 0, -1):
        routes = stored(_lower(rounds[k], routes, arity, depth, _to_routes, ROUTES), f"{label}_down{k}")
    return _lower(rounds[0], routes, arity, depth, to_leaf, schema)


def manifest(docs: DataFrame, forged: Column, group: str = "lang", key: str = "doc_id", arity: int = ARITY, depth: int = DEPTH) -> DataFrame:
    """One row per row of ``docs``: its key, leaf, subroot, root, proof and what the proof leads to.

    ``forged`` is the text that stands in place of the row's own when the proof is checked. Group names and keys may be null
    (they come first), keys may repeat (rows are then ordered by their digests, equal rows are interchangeable). Empty
    texts are values of no bytes and differ from null. Other columns take no part. An empty table gives no rows.
    """
    fields = [F.col(c) for c in FIELDS]
    swapped = [forged if c == "text" else F.col(c) for c in FIELDS]
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(group)), F.lit("")).alias("tree"),
        F.col(key).cast("long").alias("key"),
        F.unhex(leaf(*fields)).alias("digest"),
        F.unhex(leaf(*swapped)).alias("claim"),
    )
    leaves = stored(numbered(leaves, "tree", ["key", "digest"], "merkle_leaves"), "merkle_numbered")
    largest = leaves.agg(F.max("n")).first()[0]
    rounds = _climbed(leaves.select("tree", "idx", "n", "digest"), largest or 0, arity, depth, "merkle")

    groups = rounds[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    groups = stored(numbered(groups, "tree", ["name"], "merkle_groups"), "merkle_subroots")
    above = _climbed(groups.select("tree", "idx", "n", "digest"), groups.count(), arity, depth, "merkle_top")
    roots = above[-1].select("tree", F.lit(0).cast("long").alias("block"), F.lit(b"").alias("route"))
    tops = _descended(above, roots, arity, depth, _to_routes, ROUTES, "merkle_top").select(F.col("block").alias("idx"), "route")
    tops = stored(groups.join(tops, "idx").select("name", F.col("digest").alias("subroot"), "route"), "merkle_tops")
    root = above[-1].first()
    start = tops.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("block"), "route")
    first = leaves.select("tree", "idx", "n", "digest", "key", "claim")
    checked = _descended([first, *rounds[1:]], start, arity, depth, _to_checked, CHECKED, "merkle")

    def text(column: str) -> Column:
        return F.lower(F.hex(column))

    out = checked.join(tops.select(F.col("name").alias("tree"), "subroot"), "tree")
    out = out.withColumn("root", F.lit(bytes(root.digest) if root else None).cast("binary"))
    return out.select(
        F.col("key").alias(key),
        text("digest").alias("leaf"),
        text("subroot").alias("subroot"),
        text("root").alias("root"),
        text("proof").alias("proof_sha256"),
        text("folded").alias("folded_root"),
        (F.col("folded") == F.col("root")).alias("verified"),
    )


CHECKED = "tree string, key long, digest binary, proof binary, folded binary"


def _to_checked(below: pa.Table | None, routes: list[bytes] | None) -> pa.Table:
    if below is None:
        kinds = {"tree": pa.string(), "key": pa.int64(), "digest": pa.binary(), "proof": pa.binary(), "folded": pa.binary()}
        return pa.table({name: pa.array([], kind) for name, kind in kinds.items()})
    ends = [fold(claim, route) for claim, route in zip(below.column("claim").to_pylist(), routes, strict=True)]
    return pa.table(
        {
            "tree": below.column("tree"),
            "key": below.column("key"),
            "digest": below.column("digest"),
            "proof": pa.array([p for _, p in ends], pa.binary()),
            "folded": pa.array([f for f, _ in ends], pa.binary()),
        }
    )
