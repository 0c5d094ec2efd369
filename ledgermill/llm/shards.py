"""Shards by best-fit-decreasing bin packing of indivisible groups.

Documents with equal texts are a group, and a group is never divided. Groups enter in descending order of their bytes,
each into the shard with the least room that still takes it, which a balanced tree of the shards' remaining room finds;
where none does, a new shard is opened. With `capacity`, this keeps the number of shards of that capacity low. With
`shards`, it is repeated with capacities found by bisection, down to the least that so many shards suffice for, so that
their sizes are near equal; a group of a fair share or more takes a shard of its own, and the others share the rest.

Groups of one size are alike, so the packing needs only how many groups there are of each size, and it places a whole
run of them in a shard at once: the first one goes into the tightest shard, which then is even tighter and takes the next
as long as it fits. Sizes from 2^12 on are rounded up to 12 significant bits, which bounds the list of sizes that the
driver packs by about 2,000 for every doubling of the largest group, whatever the number of documents, and overstates a
size by at most 1 in 2,048. A group gets its shard from its rank among the groups of its size; ranks come from sorted
ranges (see ranks.py), so a common size is no hot key. Documents are joined to their groups by the text's hash; a group
that a third of all rows belong to is split by Spark as a skewed join key.

Defined results: NULL and empty texts are one group, with no bytes and the CRC-32 of no bytes, 0. A row's size is its
text's bytes plus one, so that empty rows count. Rows that repeat an id are rows of their own; slots follow the id in a
shard, NULL first. Texts that agree in size and a 64-bit hash count as equal: unlike texts would at worst stay together.
A group larger than `capacity` has a shard of its own. An empty table has no rows. Other columns are not read.
"""

from collections.abc import Iterator, Mapping
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm import common
from ledgermill.llm.ranks import ranked

SIGNIFICANT_BITS = 12


class Node(NamedTuple):
    key: tuple[int, int]
    left: "Node | None"
    right: "Node | None"
    height: int


def _node(key: tuple[int, int], left: Node | None, right: Node | None) -> Node:
    return Node(key, left, right, 1 + max(left.height if left else 0, right.height if right else 0))


def _lean(node: Node) -> int:
    return (node.left.height if node.left else 0) - (node.right.height if node.right else 0)


def _balanced(key: tuple[int, int], left: Node | None, right: Node | None) -> Node:
    """A node whose sides differ by one level at most, from sides that differ by two at most."""
    node = _node(key, left, right)
    if _lean(node) > 1:
        if _lean(left) < 0:
            left = _node(left.right.key, _node(left.key, left.left, left.right.left), left.right.right)
        return _node(left.key, left.left, _node(key, left.right, right))
    if _lean(node) < -1:
        if _lean(right) > 0:
            right = _node(right.left.key, right.left.left, _node(right.key, right.left.right, right.right))
        return _node(right.key, _node(key, left, right.left), right.right)
    return node


def _inserted(node: Node | None, key: tuple[int, int]) -> Node:
    if node is None:
        return Node(key, None, None, 1)
    if key < node.key:
        return _balanced(node.key, _inserted(node.left, key), node.right)
    return _balanced(node.key, node.left, _inserted(node.right, key))


def _removed(node: Node, key: tuple[int, int]) -> Node | None:
    if key < node.key:
        return _balanced(node.key, _removed(node.left, key), node.right)
    if key > node.key:
        return _balanced(node.key, node.left, _removed(node.right, key))
    if node.left is None or node.right is None:
        return node.left or node.right
    heir = node.right
    while heir.left:
        heir = heir.left
    return _balanced(heir.key, node.left, _removed(node.right, heir.key))


class Rooms:
    """The shards' remaining room in a balanced search tree."""

    def __init__(self):
        self._top: Node | None = None

    def add(self, room: int, shard: int) -> None:
        self._top = _inserted(self._top, (room, shard))

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Removes and returns (room, shard) with the least room of at least `size`."""
        node, best = self._top, None
        while node:
            if node.key >= (size, -1):
                node, best = node.left, node.key
            else:
                node = node.right
        if best is not None:
            self._top = _removed(self._top, best)
        return best


class Placed(NamedTuple):
    size: int
    shard: int
    groups: int


def best_fit_decreasing(counts: Mapping[int, int], capacity: int, most: int | None = None) -> list[Placed] | None:
    """Runs of equal groups with their shards; None when more than `most` shards are needed."""
    rooms, opened, out = Rooms(), 0, []
    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            found = rooms.take_tightest(size)
            if found is None:
                if opened == most:
                    return None
                found = (max(capacity, size), opened)
                opened += 1
            room, shard = found
            groups = min(left, room // size)
            rooms.add(room - groups * size, shard)
            out.append(Placed(size, shard, groups))
            left -= groups
    return out


def near_equal(counts: Mapping[int, int], shards: int) -> list[Placed]:
    """A packing into `shards` shards with the least capacity that bisection finds."""
    left, total, out = dict(counts), sum(size * n for size, n in counts.items()), []
    while left and shards > 1 and max(left) * shards >= total:
        size, shards = max(left), shards - 1
        out.append(Placed(size, shards, 1))
        total -= size
        left[size] -= 1
        if not left[size]:
            del left[size]
    if not left:
        return out
    low = max(-(-total // shards), max(left))
    high = low + max(left)  # where no shard had room, all would hold more than a fair share
    best = best_fit_decreasing(left, high, shards)
    while low < high:
        middle = (low + high) // 2
        found = best_fit_decreasing(left, middle, shards)
        if found is None:
            low = middle + 1
        else:
            best, high = found, middle
    return out + best


def size_class(size: str) -> Column:
    """The column rounded up to SIGNIFICANT_BITS bits."""
    step = f"shiftleft(1L, greatest(length(bin({size})) - {SIGNIFICANT_BITS}, 0))"
    return F.expr(f"({size} + {step} - 1) div {step} * {step}")


def _choose(batches: Iterator[pa.RecordBatch], placed: list[Placed]) -> Iterator[pa.RecordBatch]:
    """Shards by class and rank: a class's placements follow each other in rank."""
    by_class = sorted(range(len(placed)), key=lambda i: placed[i].size)
    sizes = np.array([placed[i].size for i in by_class], dtype=np.int64)
    shard = np.array([placed[i].shard for i in by_class], dtype=np.int32)
    groups = np.array([placed[i].groups for i in by_class], dtype=np.int64)
    ends = np.cumsum(groups)  # over all classes: a group's number is its class's start plus its rank
    starts = np.concatenate([[0], ends])
    classes, first = np.unique(sizes, return_index=True)
    for batch in batches:
        own = np.searchsorted(classes, batch.column("class").to_numpy())
        number = starts[first[own]] + batch.column("rank").to_numpy()
        at = np.searchsorted(ends, number, side="right")
        yield pa.RecordBatch.from_arrays(
            [batch.column("hash"), batch.column("size"), pa.array(shard[at])], names=["_hash", "_size", "shard"]
        )


def shard_documents(
    docs: DataFrame,
    shards: int | None = 8,
    capacity: int | None = None,
    id_column: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of docs: doc_id, size, text_crc32, shard (from 0) and slot (gapless from 0 in the shard).

    Give either `shards`, for so many shards of near-equal size, or `capacity`, for as few shards of at most so many
    bytes as best fit decreasing needs, with `shards=None`.
    """
    if (shards is None) == (capacity is None):
        raise ValueError("give either shards or capacity")
    filled = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"),
        (F.octet_length(filled) + 1).cast("bigint").alias("size"),
        F.crc32(filled).alias("text_crc32"),
        F.xxhash64(filled).alias("hash"),
    )
    rows = common.saved(rows, "sizes")
    groups = rows.groupBy("hash", "size").agg((F.count(F.lit(1)) * F.col("size")).alias("bytes"))
    groups = common.saved(groups.select("hash", "size", size_class("bytes").alias("class")), "groups")
    counts = {r["class"]: r["n"] for r in groups.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()}
    placed = best_fit_decreasing(counts, capacity) if shards is None else near_equal(counts, shards)
    numbered = ranked(groups, ["class"], ["hash", "size"])
    chosen = common.map_arrow(
        numbered.select("hash", "size", "class", "rank"),
        lambda batches: _choose(batches, placed),
        "_hash bigint, _size bigint, shard int",
    )
    chosen = common.saved(chosen, "chosen")
    same = (F.col("hash") == F.col("_hash")) & (F.col("size") == F.col("_size"))
    out = rows.join(chosen, same).select("doc_id", "size", "text_crc32", "shard", "hash")
    out = ranked(common.saved(out, "sharded"), ["shard"], ["doc_id", "hash"], "slot")
    return out.select("doc_id", "size", "text_crc32", "shard", "slot")
