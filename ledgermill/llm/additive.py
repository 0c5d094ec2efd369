"""Quality classifier: a generalised additive model with pairwise interactions.

One pass measures the features FEATURES of every text. The model is fitted on a bounded sample of labelled rows: every
feature is cut at quantiles into bins, and rounds of boosting visit the features in turn, each time adding a shallow
tree over the feature's bins to its lookup table. Then the `pairs` pairs of features whose grids explain most of the
remaining error get tables of their own, boosted in turn as well. A text's score is the logistic function of the sum
of its bins' entries: vectorised additions, each of which can be read off as the part a feature plays.

Defined results: NULL and empty texts have features of 0 and are scored like others. Rows that repeat an id are scored
each; as an example, such an id has its least features, and labels that repeat an id and label count once. Rows without
id or label are not learnt from. With no labels, or labels of one kind, the score is their smoothed frequency. Other
columns are not read.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm import common

FEATURES = (
    "log_words",
    "word_length",
    "symbol_share",
    "capital_share",
    "digit_share",
    "stops_per_word",
    "shouts_per_word",
    "bars_per_word",
    "repeat_line_share",
    "repeat_run_share",
    "distinct_share",
    "echo_share",
    "words_per_line",
    "closed_line_share",
    "foreign_share",
)


def _marks(characters: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(characters)] = True
    return out


_SYMBOL, _STOP, _BANG, _BAR = _marks(b"#*$%&<>@^~=_\\"), _marks(b".?;:,"), _marks(b"!"), _marks(b"|")
_DIGIT, _CLOSING = _marks(b"0123456789"), _marks(b".!?\"')")


def _features(texts: common.Texts) -> np.ndarray:
    data, bounds = texts
    words = common.words_of(texts)
    hashes = common.span_hashes(data, words.starts, words.ends)
    n_words = np.diff(words.first)
    low, high = bounds[:-1], bounds[1:]

    def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return part / np.maximum(whole, 1)

    def count(mask: np.ndarray) -> np.ndarray:
        return common.between(mask[data], low, high)

    chars = common.between(common.inked(data), low, high)
    capitals = common.between((data >= 65) & (data <= 90), low, high)
    smalls = common.between((data >= 97) & (data <= 122), low, high)
    starts, ends, owner = common.lines_of(texts)
    before = np.searchsorted(words.starts, ends)
    line_words = before - np.searchsorted(words.starts, starts)
    filled = line_words > 0
    line_hash = common.span_hashes(data, starts, ends)
    closed = np.zeros(len(starts), dtype=bool)
    closed[filled] = _CLOSING[data[words.ends[before[filled] - 1] - 1]]
    lines = np.bincount(owner[filled], minlength=len(n_words))
    closed_lines = np.bincount(owner[filled & closed], minlength=len(n_words))
    first = np.searchsorted(owner, np.arange(len(n_words) + 1))
    echo = np.zeros(len(hashes), dtype=bool)
    echo[1:] = hashes[1:] == hashes[:-1]
    repeat_lines, repeat_runs, distinct = (np.zeros(len(n_words)) for _ in range(3))
    for i in range(len(n_words)):
        own = hashes[words.first[i] : words.first[i + 1]]
        own_lines = line_hash[first[i] : first[i + 1]][filled[first[i] : first[i + 1]]]
        repeat_lines[i] = len(own_lines) - len(np.unique(own_lines))
        repeat_runs[i] = common.repeat_words(own, 8)
        distinct[i] = len(np.unique(own))
    return np.column_stack(
        [
            np.log1p(n_words),
            share(chars, n_words),
            share(count(_SYMBOL), chars),
            share(capitals, capitals + smalls),
            share(count(_DIGIT), chars),
            share(count(_STOP), n_words),
            share(count(_BANG), n_words),
            share(count(_BAR), n_words),
            share(repeat_lines, lines),
            share(repeat_runs, n_words),
            share(distinct, n_words),
            share(common.between(echo, words.first[:-1], words.first[1:]), n_words),
            share(n_words, lines),
            share(closed_lines, lines),
            share(common.between(data >= 0x80, low, high), high - low),
        ]
    )


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in common.row_blocks(batches):
        features = np.ascontiguousarray(_features(texts), dtype=np.float32)
        ends = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * len(FEATURES))
        lists = pa.ListArray.from_arrays(ends, pa.array(features.reshape(-1)))
        yield pa.RecordBatch.from_arrays([batch.column("id"), lists], names=["id", "features"])


class Model(NamedTuple):
    start: float
    cuts: list[np.ndarray]  # by feature
    tables: list[np.ndarray]  # by feature, a value per bin
    pairs: list[tuple[int, int, np.ndarray]]  # features and a value per pair of coarse bins

    def bins(self, features: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(c, features[:, i], side="right") for i, c in enumerate(self.cuts)])

    def scores(self, features: np.ndarray) -> np.ndarray:
        bins = self.bins(features)
        total = np.full(len(features), self.start)
        for i, table in enumerate(self.tables):
            total += table[bins[:, i]]
        for i, j, table in self.pairs:
            total += table[bins[:, i] * len(table) // len(self.tables[i]), bins[:, j] * len(table) // len(self.tables[j])]
        return 1 / (1 + np.exp(-total))


def _tree(gradient: np.ndarray, weight: np.ndarray, depth: int, least: float) -> np.ndarray:
    """A value per bin: a tree of splits that lower the loss most, with Newton steps in its leaves."""
    g, w = np.cumsum(gradient), np.cumsum(weight)
    if depth:
        left_g, left_w = g[:-1], w[:-1]
        right_g, right_w = g[-1] - left_g, w[-1] - left_w
        gain = left_g**2 / (left_w + 1) + right_g**2 / (right_w + 1)
        gain[(left_w < least) | (right_w < least)] = -1
        if len(gain) and gain.max() > g[-1] ** 2 / (w[-1] + 1) + 1e-9:
            cut = int(np.argmax(gain)) + 1
            parts = (slice(0, cut), slice(cut, None))
            return np.concatenate([_tree(gradient[p], weight[p], depth - 1, least) for p in parts])
    return np.full(len(gradient), g[-1] / (w[-1] + 1))


def fit(
    features: np.ndarray,
    labels: np.ndarray,
    most_bins: int = 64,
    coarse: int = 8,
    rounds: int = 150,
    pairs: int = 6,
    rate: float = 0.1,
    depth: int = 2,
) -> Model:
    n = len(FEATURES)
    share = (labels.sum() + 1) / (len(labels) + 2)
    start = float(np.log(share / (1 - share)))
    if not len(labels) or labels.min() == labels.max():
        return Model(start, [np.zeros(0)] * n, [np.zeros(1)] * n, [])
    levels = np.linspace(0, 1, most_bins + 1)[1:-1]
    cuts = [np.unique(np.quantile(features[:, i], levels)) for i in range(n)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    bins = Model(start, cuts, tables, []).bins(features)
    total = np.full(len(labels), start)
    least = max(1.0, 0.0005 * len(labels))

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    for _ in range(rounds):
        for i in range(n):
            g, w = slopes()
            size = len(tables[i])
            step = rate * _tree(np.bincount(bins[:, i], g, size), np.bincount(bins[:, i], w, size), depth, least / 4)
            tables[i] += step
            total += step[bins[:, i]]
    grid = np.column_stack([bins[:, i] * coarse // len(tables[i]) for i in range(n)])
    g, w = slopes()
    gains = []
    for i in range(n):
        for j in range(i + 1, n):
            cell = grid[:, i] * coarse + grid[:, j]
            cell_g, cell_w = np.bincount(cell, g, coarse**2), np.bincount(cell, w, coarse**2)
            gains.append((float((cell_g**2 / (cell_w + 1)).sum()), i, j))
    chosen = [(i, j, np.zeros((coarse, coarse))) for _, i, j in sorted(gains, reverse=True)[:pairs]]
    for _ in range(rounds // 3):
        for i, j, table in chosen:
            g, w = slopes()
            cell = grid[:, i] * coarse + grid[:, j]
            cell_g = np.bincount(cell, g, coarse**2).reshape(coarse, coarse)
            cell_w = np.bincount(cell, w, coarse**2).reshape(coarse, coarse)
            # A tree of one cut along the first feature and one along the second in each half.
            halves = _tree(cell_g.sum(axis=1), cell_w.sum(axis=1), 1, least / 4)
            step = np.zeros_like(table)
            for value in np.unique(halves):
                rows = halves == value
                step[rows] = rate * _tree(cell_g[rows].sum(axis=0), cell_w[rows].sum(axis=0), 1, least / 4)
            table += step
            total += step[grid[:, i], grid[:, j]]
    return Model(start, cuts, tables, chosen)


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, len(FEATURES)).astype(np.float64)


def _apply(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        scores = sent.value.scores(_matrix(batch.column("features")))
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores)], names=["id", "score"])


def additive_scores(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", sample_rows: int = 20_000
) -> DataFrame:
    """One row per row of docs: doc_id and score (0 to 1). `labels` has id and label (0/1), rows to learn from only; at
    most `sample_rows` of them, those whose ids have the smallest hashes, are used to fit."""
    source = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text"))
    measured = common.saved(common.map_arrow(source, _measure, "id bigint, features array<float>"), "features")
    labels = labels.where("id IS NOT NULL AND label IN (0, 1)").select("id", "label").distinct()
    sample = labels.orderBy(F.xxhash64("id"), "id", "label").limit(sample_rows)
    # One row per id, the least by features, so that an id which many rows share gives one example.
    rows = measured.join(F.broadcast(sample), "id").groupBy("id", "label").agg(F.min("features").alias("features"))
    rows = rows.orderBy("id", "label").toArrow()  # at most sample_rows rows
    features = _matrix(rows.column("features").combine_chunks()) if rows.num_rows else np.zeros((0, len(FEATURES)))
    model = fit(features, rows.column("label").to_numpy().astype(np.float64))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    scored = common.map_arrow(measured, lambda batches: _apply(batches, sent), "id bigint, score double")
    return scored.withColumnRenamed("id", "doc_id")
