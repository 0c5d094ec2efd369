"""Repeated passages by relative Lempel-Ziv factors over indexed reference blocks.

Every document is parsed from left to right into factors: stretches whose `window`-word windows all start in some
document with a smaller id. The reference is every block of every document; none is left out.

1. Blocks. Each window has an anchor, the run of `gram` words in it with the smallest hash (the last of equal ones).
   Consecutive windows with the same anchor form a block: the words from the first window's start to the last one's
   end. Both follow from the words alone, so equal windows have equal anchors wherever they stand. There is about one
   block to (window - gram + 2) / 2 words.
2. The index of blocks gives, per anchor and block hash, the smallest document. Anchors in a single document are dropped
   first. A block that occurs in an earlier document is a factor as a whole.
3. Factor boundaries. Where an anchor has several blocks, a window may be shared by blocks that differ around it. Only
   the first document of each block is looked at again: its windows are hashed one by one and matched with those of
   the anchor's other blocks. Windows of later copies of a block are decided in step 2 already.
4. The union of factors is cut out of each text.

Every step is a minimum per key, combined before its shuffle, and joins back to rows; a passage that a third of all
documents share never meets in one task, and no pairs of documents are formed. Hashes in keys have 128 bits in all.

Defined results: NULL and empty texts have no words. Rows that repeat a doc_id do not cut each other. Rows without
doc_id are kept whole and cut nothing. Other columns are neither read nor returned (`carry` passes them on).
"""

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm import common

_Q = np.uint64(0xC2B2AE3D27D4EB4F)
_Q_INVERSE = np.uint64(pow(int(_Q), -1, 2**64))
_LOW = np.uint64(0xFFFFFFFF)
_powers = {"up": np.ones(0, dtype=np.uint64), "down": np.ones(0, dtype=np.uint64)}


class _Runs:
    """Hashes of any run of words of a block of texts, from prefix sums."""

    def __init__(self, texts: common.Texts):
        self.words = common.words_of(texts)
        self.hashes = common.span_hashes(texts.data, self.words.starts, self.words.ends)
        n = len(self.hashes) + 1
        if len(_powers["up"]) < n:
            _powers["up"], _powers["down"] = common.powers(_Q, 2 * n), common.powers(_Q_INVERSE, 2 * n)
        self.sums = np.zeros(n, dtype=np.uint64)
        np.cumsum(self.hashes * _powers["up"][: n - 1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        value = (self.sums[end] - self.sums[start]) * _powers["down"][start]
        return common.mix(value + (end - start).astype(np.uint64))


def _text_keys(texts: common.Texts) -> np.ndarray:
    """A 32-bit hash of each text, which tells rows with the same id apart."""
    keys = common.span_hashes(texts.data, texts.bounds[:-1], texts.bounds[1:])
    return (keys & np.uint64(0x7FFFFFFF)).astype(np.int32)


def _blocks(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    width = window - gram + 1  # grams in a window
    for batch, texts in common.row_blocks(batches):
        runs = _Runs(texts)
        n = len(runs.hashes)
        if n < window:
            continue
        first = runs.words.first
        owner = np.repeat(np.arange(batch.num_rows), np.diff(first))
        at = np.arange(n - window + 1)
        valid = at + window <= first[owner[: len(at)] + 1]
        grams = runs.of(np.arange(n - gram + 1), np.arange(gram, n + 1))
        # Smallest upper half of the hash, then the last place: the place is kept in the lower half.
        key = (grams & ~_LOW) | (_LOW - np.arange(len(grams), dtype=np.uint64))
        reach, least = 1, key
        while 2 * reach <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        rest = width - reach
        least = np.minimum(least[: len(at)], least[rest : rest + len(at)])
        anchor = (_LOW - (least & _LOW)).astype(np.int64)
        at, anchor = at[valid], anchor[valid]
        if not len(at):
            continue
        opens = np.ones(len(at), dtype=bool)
        opens[1:] = (anchor[1:] != anchor[:-1]) | (owner[at[1:]] != owner[at[:-1]])
        start = at[opens]
        count = np.diff(np.append(np.flatnonzero(opens), len(at)))
        row = owner[start]
        block = runs.of(start, start + count - 1 + window)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id").take(pa.array(row)),
                pa.array(_text_keys(texts)[row]),
                pa.array((start - first[row]).astype(np.int32)),
                pa.array(count.astype(np.int32)),
                common.signed(grams[anchor[opens]]),
                common.signed(block),
            ],
            names=["id", "t", "start", "n", "anchor", "block"],
        )


def _windows(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch, texts in common.row_blocks(batches):
        runs, keys = _Runs(texts), _text_keys(texts)
        column = batch.column("blocks")
        offsets, flat = column.offsets.to_numpy(), column.values
        t, start, n = (flat.field(name).to_numpy(zero_copy_only=False) for name in ("t", "start", "n"))
        row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
        own = slice(offsets[0], offsets[-1])
        right = np.flatnonzero(keys[row] == t[own])
        row, index = row[right], right + offsets[0]
        row_of = np.repeat(row, n[index])
        which = np.repeat(index, n[index])
        nth = np.arange(len(which)) - np.repeat(np.cumsum(n[index]) - n[index], n[index])
        place = start[which] + nth
        at = runs.words.first[row_of] + place
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("id").take(pa.array(row_of)),
                pa.array(keys[row_of]),
                pa.array(place.astype(np.int32)),
                flat.field("anchor").take(pa.array(which)),
                common.signed(runs.of(at, at + window)),
            ],
            names=["id", "t", "start", "anchor", "hash"],
        )


def _cut(batches: Iterator[pa.RecordBatch], carry: Sequence[str], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch, texts in common.row_blocks(batches):
        keys = _text_keys(texts)
        column = batch.column("spans")
        n_words, n_removed, digests, kept_texts = [], [], [], []
        for i in range(batch.num_rows):
            text = texts.text(i)
            words = text.split()
            n = len(words)
            spans = column[i].values if column[i].is_valid else None
            removed = 0
            if spans is not None and len(spans):
                packed = spans.field("span").to_numpy()[spans.field("t").to_numpy() == keys[i]]
                change = np.zeros(n + 1, dtype=np.int32)
                np.add.at(change, packed >> 32, 1)
                np.add.at(change, packed & 0xFFFFFFFF, -1)
                gone = np.cumsum(change[:-1]) > 0
                removed = int(gone.sum())
                if removed:
                    words = [words[j] for j in np.flatnonzero(~gone).tolist()]
            joined = b" ".join(words)
            n_words.append(n)
            n_removed.append(removed)
            digests.append(hashlib.sha256(joined).hexdigest())
            if with_text:
                kept_texts.append(joined if removed else text)
        out = [batch.column(name) for name in carry]
        if with_text:
            out.append(pa.array(kept_texts, type=pa.binary()).cast(pa.string()))
        out += [pa.array(n_words, type=pa.int64()), pa.array(n_removed, type=pa.int64()), pa.array(digests, type=pa.string())]
        yield pa.RecordBatch.from_arrays(out, names=[str(i) for i in range(len(out))])


def repeated_spans(docs: DataFrame, id_column: str, text: str, window: int, gram: int) -> DataFrame:
    """(id, t, span): stretches of words to be cut, packed as start * 2^32 + end; t tells rows with one id apart."""
    texts = docs.where(F.col(f"`{id_column}`").isNotNull()).select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text")
    )
    schema = "id bigint, t int, start int, n int, anchor bigint, block bigint"
    blocks = common.saved(common.map_arrow(texts, lambda batches: _blocks(batches, window, gram), schema), "blocks")
    # What is counted per key is written before it is joined to the rows it was counted from: Spark splits a hot key of a
    # join only where no aggregate shares the join's stage.
    spread = blocks.groupBy("anchor").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    spread = common.saved(spread.where("low < high").select("anchor"), "spread")
    shared = blocks.join(spread, "anchor", "left_semi")
    shared = common.saved(shared, "shared")
    index = common.saved(shared.groupBy("anchor", "block").agg(F.min("id").alias("reference")), "index")
    factors = common.saved(shared.join(index, ["anchor", "block"]).drop("block"), "factors")
    several = index.groupBy("anchor").agg(F.count(F.lit(1)).alias("blocks")).where("blocks > 1")
    several = common.saved(several.select("anchor"), "several")
    edges = factors.where("id = reference").join(several, "anchor", "left_semi")
    edges = edges.groupBy("id").agg(F.collect_list(F.struct("t", "start", "n", "anchor")).alias("blocks"))
    windows = common.map_arrow(
        texts.join(edges, "id"),
        lambda batches: _windows(batches, window),
        "id bigint, t int, start int, anchor bigint, hash bigint",
    )
    windows = common.saved(windows, "windows")
    earliest = windows.groupBy("anchor", "hash").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    earliest = common.saved(earliest.where("low < high"), "earliest")
    late = windows.join(earliest, ["anchor", "hash"]).where("id > low")

    def packed(start: str, end: str):
        return F.expr(f"shiftleft(cast({start} as bigint), 32) + {end}").alias("span")

    whole = factors.where("id > reference").select("id", "t", packed("start", f"start + n - 1 + {window}"))
    return whole.unionAll(late.select("id", "t", packed("start", f"start + {window}")))


def cut_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    carry: Sequence[str] = (),
    with_text: bool = False,
    window: int = 50,
    gram: int = 20,
) -> DataFrame:
    """One row per row of docs: id, the columns of `carry`, kept_text if `with_text` (white space is kept where nothing
    is cut), n_words, n_removed and kept_sha256 of the kept words joined by spaces."""
    spans = repeated_spans(docs, id_column, text, window, gram)
    spans = spans.groupBy("id").agg(F.collect_list(F.struct("t", "span")).alias("spans"))
    spans = common.saved(spans, "spans").withColumnRenamed("id", "span_id")
    columns = [id_column, *carry]
    source = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)], F.col(f"`{text}`").alias("text"))
    kinds = ", ".join(f"{c} {kind}" for c, kind in source.dtypes if c != "text")
    joined = source.join(spans, F.col("c0") == F.col("span_id"), "left").drop("span_id")
    kept = [f"c{i}" for i in range(len(columns))]
    schema = f"{kinds}, {'kept_text string, ' if with_text else ''}n_words bigint, n_removed bigint, kept_sha256 string"
    out = common.map_arrow(joined, lambda batches: _cut(batches, kept, with_text), schema)
    return out.toDF(*columns, *out.columns[len(columns) :])
