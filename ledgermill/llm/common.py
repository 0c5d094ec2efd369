"""Words and hashes of Arrow text columns, tables in the shared folder, and connected components.

Words are the runs of bytes other than space and \\t..\\r, which is `[^\\x20\\x09-\\x0D]+` on UTF-8 text. All hashing
works on whole Arrow buffers with numpy: a word's hash is a polynomial over its bytes, taken from prefix sums modulo
2^64 and then mixed, so that no Python code runs per word.
"""

import atexit
import hashlib
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.sources.tables import shared_folder

#: Bytes of text worked on at once; longer texts are hashed in pieces of this size, and spans beyond it on their own.
BLOCK_BYTES = 1 << 20

_random = np.random.default_rng(20240613)
_BYTE = _random.integers(0, 2**64, 256, dtype=np.uint64)
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(int(_P), -1, 2**64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_cache: dict[str, np.ndarray] = {}


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _cache:
        _cache["up"], _cache["down"] = powers(_P, BLOCK_BYTES), powers(_P_INVERSE, BLOCK_BYTES)
    return _cache["up"], _cache["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash for each span data[start:end] of bytes; starts rise, spans don't overlap, empty spans get mix(0)."""
    out = np.zeros(len(starts), dtype=np.uint64)
    up, down = _powers()
    i = 0
    while i < len(starts):
        low = starts[i]
        j = int(np.searchsorted(ends, low + BLOCK_BYTES, side="right"))
        if j <= i:  # one span beyond the block size
            digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
            out[i] = int.from_bytes(digest, "little")
            i += 1
            continue
        part = _BYTE[data[low : ends[j - 1]]]
        part *= up[: len(part)]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(part, out=sums[1:])
        s, e = starts[i:j] - low, ends[i:j] - low
        out[i:j] = (sums[e] - sums[s]) * down[np.minimum(s, BLOCK_BYTES - 1)] + (e - s).astype(np.uint64)
        i = j
    return mix(out)


class Texts(NamedTuple):
    """Bytes of consecutive texts; text i is data[bounds[i]:bounds[i + 1]]."""

    data: np.ndarray
    bounds: np.ndarray

    def lower(self) -> "Texts":
        return Texts(_LOWER[self.data], self.bounds)

    def text(self, i: int) -> bytes:
        return self.data[self.bounds[i] : self.bounds[i + 1]].tobytes()


class Words(NamedTuple):
    """Words of consecutive texts in order; those of text i are first[i]:first[i + 1]."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def texts_of(column: pa.Array) -> Texts:
    """The bytes of an Arrow string column without copying them; NULL is an empty text."""
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if large else np.int32)
    bounds = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if column.buffers()[2] is None or bounds[-1] == bounds[0]:
        return Texts(np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64))
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[bounds[0] : bounds[-1]]
    return Texts(data, bounds - bounds[0])


def words_of(texts: Texts) -> Words:
    inside = np.zeros(len(texts.data) + 1, dtype=bool)
    np.logical_not(_SPACE[texts.data], out=inside[:-1])
    begins, finishes = inside.copy(), np.zeros_like(inside)
    begins[1:] &= ~inside[:-1]
    finishes[1:] = inside[:-1] & ~inside[1:]
    edges = texts.bounds[1:-1]  # a text ends a word also where the next text goes on without white space
    begins[edges] = inside[edges]
    cut = edges[edges > 0]
    finishes[cut] = inside[cut - 1]
    starts = np.flatnonzero(begins)
    return Words(starts, np.flatnonzero(finishes), np.searchsorted(starts, texts.bounds))


def row_blocks(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Slices of batches with at most BLOCK_BYTES of text, or one longer text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(text)
        bounds = texts_of(column).bounds
        low = 0
        while low < batch.num_rows:
            high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + BLOCK_BYTES, side="right")) - 1)
            part = batch.slice(low, high - low)
            yield part, texts_of(part.column(text))
            low = high


def gram_hashes(word_hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of n consecutive words."""
    count = max(0, len(word_hashes) - n + 1)
    out = np.zeros(count, dtype=np.uint64)
    for j in range(n):
        out = (out ^ word_hashes[j : j + count]) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return mix(out)


def sorted_within(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A copy in which each text's run of values is sorted."""
    out = values.copy()
    for low, high in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if high - low > 1:
            out[low:high].sort()
    return out


def between(mask: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(mask) + 1, dtype=np.int64)
    np.cumsum(mask, out=sums[1:])
    return sums[high] - sums[low]


def repeat_words(hashes: np.ndarray, n: int) -> int:
    """Words in n-word windows that occur at least twice."""
    grams = gram_hashes(hashes, n)
    if len(grams) < 2:
        return 0
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    if not same.any():
        return 0
    at = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    change = np.zeros(len(hashes) + 1, dtype=np.int32)
    np.add.at(change, at, 1)
    np.add.at(change, at + n, -1)
    return int((np.cumsum(change) > 0).sum())


_FOLLOWS = np.zeros(256, dtype=bool)
_FOLLOWS[0x80:0xC0] = True  # bytes of a character after its first


def inked(data: np.ndarray) -> np.ndarray:
    """Marks the first byte of each character that is part of a word."""
    return ~_SPACE[data] & ~_FOLLOWS[data]


def lines_of(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the lines (cut at \\n) of texts with any bytes, and the text of each."""
    data, bounds = texts
    starts = np.unique(np.concatenate([bounds[:-1], np.flatnonzero(data == 10) + 1]))
    starts = starts[starts < len(data)]
    ends = np.append(starts[1:], len(data))[: len(starts)]
    if len(ends):
        ends = np.where((ends > starts) & (data[np.maximum(ends - 1, 0)] == 10), ends - 1, ends)
    return starts, ends, np.searchsorted(bounds, starts, side="right") - 1


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


_shipped: set[str] = set()


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str):
    """mapInArrow, after sending this package to the executors once per application, as `--py-files` would."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent.parent
        folder = tempfile.mkdtemp()  # on the driver, which serves the file for as long as it runs
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))
        _shipped.add(context.applicationId)
    return df.mapInArrow(function, schema)


def saved(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: work before it isn't repeated, whatever executor is lost."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    # The driver's garbage keeps shuffle files of finished steps on the executors' disks; a small driver seldom collects.
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for all nodes of `links` (a, b: long); a component is named by its smallest node.

    Every round first links each node's larger neighbours to its smallest one, then each node's smaller neighbours to
    the smallest of them, until all links are stars around the smallest nodes. The number of rounds grows with the
    logarithm of the number of nodes. A node's neighbours are never gathered: both steps are a minimum per node,
    combined before its shuffle, written, and joined back to the links, so that the links of a large star's centre are
    split over tasks.
    """
    links = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    links = saved(links, "links")
    while True:
        # Stars: no node has two smaller neighbours, and none has both a smaller and a larger one.
        ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(
            links.select("b", F.lit(0), F.lit(1))
        )
        ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if ends.where("up > 1 OR up = 1 AND down = 1").isEmpty():
            break
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = saved(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = saved(large.distinct(), "links")
        lowest = saved(large.groupBy("a").agg(F.min("b").alias("m")), "lowest")
        small = large.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
        links = saved(small.unionAll(lowest.select("a", F.col("m").alias("b"))).distinct(), "links")
    stars = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionAll(stars.select(F.col("component").alias("node"), "component").distinct())
