"""Packing of documents into training sequences: dominance reduction, then best fit.

1. One pass tokenizes each document, appends an end id and cuts documents over `capacity` into pieces.
2. Pieces of equal length are alike to a packer, so the plan is made for the counts of at most `capacity` lengths, on
   the driver, whatever the number of documents. Sets that dominate every other use of their largest piece are fixed
   for good (Martello and Toth):
     - a piece that no other piece fits beside stays alone;
     - a piece and one that fills its sequence exactly;
     - a piece and the largest that fits beside it, where at most one other fits, or where no two that fit are
       together larger.
   Each of them is part of some best packing. The remainder is packed by best fit in order of falling length.
3. The plan is a list of patterns (lengths in a sequence, number of such sequences). Pieces are numbered within their
   length, by hashed buckets so that a common length is numbered in many tasks, and their number gives their place.

Defined results: NULL and empty texts are one end id. Rows that repeat an id are packed each. NULL ids are kept. Other
columns are not read. An empty table gives no rows.
"""

import os
import re
import unicodedata
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgermill.llm import common

#: Words that one call can encode together: Latin letters, then ASCII punctuation; one or two units of the tokenizer.
_PLAIN = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+([!-&(-/:-@\[-`{-~]*)")
#: Most words whose ids a Python worker keeps; beyond it, it starts anew.
CACHED_WORDS = 1 << 20

_loaded: dict[str, "WordIds"] = {}


class WordIds:
    """Token ids of words as little-endian bytes, encoded once each. The tokenizer drops white space and never joins
    what it separates, so a text's ids are those of its words in order."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        top = self.tokenizer.get_vocab_size()
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith("</w>") for i in range(top)])

    def encode(self, words: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4") for x in found]

    def learn(self, words: list[bytes]) -> None:
        if len(self.known) + len(words) > CACHED_WORDS:
            self.known.clear()
        plain, units, others = [], [], []
        for word in words:
            text = word.decode()
            match = _PLAIN.fullmatch(text)
            if match and unicodedata.is_normalized("NFC", text):
                plain.append(text)
                units.append(2 if match[1] else 1)
            else:
                others.append(text)
        for low in range(0, len(plain), 512):
            group = plain[low : low + 512]
            ids = self.encode([" ".join(group)])[0]
            closed = np.flatnonzero(self.ends[ids]) + 1  # a unit ends with the only token that ends a word
            at = np.cumsum(units[low : low + 512])
            if len(closed) != at[-1]:
                others += group
                continue
            for text, part in zip(group, np.split(ids, closed[at - 1]), strict=False):
                self.known[text.encode()] = part.tobytes()
        for low in range(0, len(others), 4096):
            group = others[low : low + 4096]
            for text, part in zip(group, self.encode(group), strict=True):
                self.known[text.encode()] = part.tobytes()

    def ids(self, text: bytes) -> bytes:
        words = text.split()
        known = self.known
        try:
            return b"".join([known[word] for word in words])
        except KeyError:
            pass
        parts = []
        for low in range(0, len(words), CACHED_WORDS // 4):
            group = words[low : low + CACHED_WORDS // 4]
            fresh = [word for word in set(group) if word not in known]
            if len(known) + len(fresh) > CACHED_WORDS:
                known.clear()
                fresh = list(set(group))
            self.learn(fresh)
            parts.append(b"".join([known[word] for word in group]))
        return b"".join(parts)


def _pieces(
    batches: Iterator[pa.RecordBatch], path: str, end_id: int, capacity: int, with_ids: bool
) -> Iterator[pa.RecordBatch]:
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    encoder, end = _loaded[path], np.uint32(end_id).astype("<u4").tobytes()
    for batch, texts in common.row_blocks(batches):
        row, piece, start, length, crc, ids = [], [], [], [], [], []
        for i in range(batch.num_rows):
            data = encoder.ids(texts.text(i)) + end
            for number, low in enumerate(range(0, len(data), 4 * capacity)):
                part = data[low : low + 4 * capacity]
                row.append(i)
                piece.append(number)
                start.append(low // 4)
                length.append(len(part) // 4)
                crc.append(zlib.crc32(part))
                if with_ids:
                    ids.append(np.frombuffer(part, dtype="<u4").astype(np.int32))
        out = [
            batch.column("id").take(pa.array(row, type=pa.int64())),
            pa.array(piece, type=pa.int32()),
            *[pa.array(x, type=pa.int64()) for x in (start, length, crc)],
        ]
        if with_ids:
            out.append(pa.array(ids, type=pa.list_(pa.int32())))
        yield pa.RecordBatch.from_arrays(out, names=[str(i) for i in range(len(out))])


Pattern = tuple[int, list[int]]


def reduced(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Patterns fixed by dominance, and the counts that remain."""
    left = {size: n for size, n in counts.items() if n}
    sizes = sorted(left)
    fixed: list[Pattern] = []

    def take(n: int, *lengths: int) -> None:
        fixed.append((n, list(lengths)))
        for length in lengths:
            left[length] -= n
        for length in set(lengths):
            if not left[length]:
                del left[length]
                sizes.remove(length)

    def smallest(most: int, without: int) -> list[int]:
        """The smallest pieces other than one of `without`, up to `most`."""
        out: list[int] = []
        for size in sizes:
            out += [size] * min(left[size] - (size == without), most - len(out))
            if len(out) == most:
                break
        return out

    for size in sorted(left, reverse=True):
        while left.get(size, 0):
            room = capacity - size
            others = smallest(3, size)
            if not others or others[0] > room:
                # Alone: also the last of its length, where only larger pieces are left.
                take(left[size] if size > room or left[size] == 1 else 1, size)
                continue
            if left.get(room, 0) > (room == size):
                take(left[size] // 2 if room == size else min(left[size], left[room]), size, room)
                continue
            at = bisect_right(sizes, room) - 1
            while sizes[at] == size and left[size] == 1:
                at -= 1
            best = sizes[at]
            only_one = len(others) < 2 or others[0] + others[1] > room
            only_two = len(others) < 3 or sum(others) > room
            if only_one or only_two and best >= _best_pair(sizes, left, size, room):
                take(left[size] // 2 if best == size else min(left[size], left[best]), size, best)
                continue
            break
    return fixed, left


def _best_pair(sizes: list[int], left: dict[int, int], without: int, room: int) -> int:
    """The largest sum of two pieces, other than one of `without`, that is at most `room`."""
    have = [s for s in sizes if left[s] > (s == without)]
    best, low, high = 0, 0, len(have) - 1
    while low <= high:
        total = have[low] + have[high]
        if low == high and left[have[low]] - (have[low] == without) < 2 or total > room:
            high -= 1
        else:
            best = max(best, total)
            low += 1
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best fit by falling length, over groups of sequences with the same content."""
    groups: dict[int, list[Pattern]] = {}
    rooms: list[int] = []  # rooms with groups, rising

    def put(room: int, pattern: Pattern) -> None:
        at = bisect_right(rooms, room)
        if not at or rooms[at - 1] != room:
            rooms.insert(at, room)
            groups[room] = []
        groups[room].append(pattern)

    def pop(room: int) -> Pattern:
        pattern = groups[room].pop()
        if not groups[room]:
            del groups[room]
            rooms.remove(room)
        return pattern

    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            at = bisect_right(rooms, size - 1)
            room = rooms[at] if at < len(rooms) else capacity
            fit = room // size
            have, content = pop(room) if at < len(rooms) else (-(-n // fit), [])
            full = min(have, n // fit)
            rest = min(n - full * fit, fit - 1) if full < have else 0
            if have > full + bool(rest):
                put(room, (have - full - bool(rest), content))
            if full:
                put(room - fit * size, (full, content + [size] * fit))
            if rest:
                put(room - rest * size, (1, content + [size] * rest))
            n -= full * fit + rest
    return [pattern for room in rooms for pattern in groups[room]]


def plan(counts: dict[int, int], capacity: int) -> list[Pattern]:
    fixed, left = reduced(counts, capacity)
    return fixed + best_fit(left, capacity)


def places(patterns: list[Pattern]) -> dict[int, np.ndarray]:
    """By length: rows (first number, first sequence, pieces a sequence, offset), in order of the first number."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for n, lengths in patterns:
        offset = 0
        for length in sorted(set(lengths), reverse=True):
            each = lengths.count(length)
            out.setdefault(length, []).append((used.get(length, 0), sequence, each, offset))
            used[length] = used.get(length, 0) + n * each
            offset += each * length
        sequence += n
    return {length: np.array(rows, dtype=np.int64) for length, rows in out.items()}


def _placed(batches: Iterator[pa.RecordBatch], where: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        length = batch.column("length").to_numpy(zero_copy_only=False)
        number = batch.column("number").to_numpy(zero_copy_only=False)
        sequence, offset = np.zeros(len(length), dtype=np.int64), np.zeros(len(length), dtype=np.int64)
        order = np.argsort(length, kind="stable")
        cuts = np.flatnonzero(np.diff(length[order])) + 1
        for group in np.split(order, cuts) if len(order) else []:
            rows = where[int(length[group[0]])]
            own = rows[np.searchsorted(rows[:, 0], number[group], side="right") - 1]
            nth = number[group] - own[:, 0]
            sequence[group] = own[:, 1] + nth // own[:, 2]
            offset[group] = own[:, 3] + nth % own[:, 2] * length[group]
        kept = [batch.column(name) for name in batch.schema.names if name != "number"]
        out = [*kept, pa.array(sequence), pa.array(offset)]
        yield pa.RecordBatch.from_arrays(out, names=[str(i) for i in range(len(out))])


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text: str = "text",
    capacity: int = 2048,
    end_id: int = 0,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and ids if `with_ids`.

    `tokenizer` is the path of a tokenizer file, the same on all machines."""
    spark = docs.sparkSession
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
    schema += ", ids array<int>" if with_ids else ""
    texts = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").alias("text"))
    pieces = common.saved(
        common.map_arrow(texts, lambda batches: _pieces(batches, tokenizer, end_id, capacity, with_ids), schema), "pieces"
    )
    counts = {row["length"]: row["n"] for row in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    where = places(plan(counts, capacity))
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), sum(counts.values()) // 200_000, 1)
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets))
    pieces = pieces.withColumn("bucket", bucket)
    first = pieces.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = first.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    numbered = pieces.withColumn("nth", F.row_number().over(within)).join(first, ["length", "bucket"])
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    numbered = numbered.select(*columns, (F.col("first") + F.col("nth") - 1).alias("number"))
    return common.map_arrow(
        numbered, lambda batches: _placed(batches, where), f"{schema}, sequence_id bigint, offset bigint"
    )
