"""Toxicity by nearest labelled examples: exact TF-IDF cosine over block-max inverted lists, and weighted votes.

1. Examples are a bounded sample of the labelled rows: per class the `per_class` rows whose ids have the smallest hashes.
2. Terms are words (A-Z lower-cased, outer punctuation dropped) and beginnings of longer words, so that
   inflected forms meet. There are two vector spaces. The telling one has the `terms` terms whose presence in examples
   tells most about the label, without those that chance alone could give among so many. The whole one has all terms of
   the examples that hold no telling term: at most `general` per class, each of at most `example_bytes` of text.
3. One pass over all texts writes the counts of their terms in both; document frequencies are summed from all of them.
4. In each space examples are sorted and cut into blocks of BLOCK; each term keeps the highest weight that it has in each
   block. A document visits blocks in order of their bound on the cosine and stops when the bound is below the k-th best,
   so its k nearest examples are exact. Texts with a telling term are searched there, all others over the whole space.
5. Votes are weighted by cosine and by the share of all labelled rows that an example stands for. A monotone table per
   space maps votes to frequencies of the label; it is fitted on the examples' own votes, each without itself.

Defined results: NULL, empty and other texts without a term get the frequency among such examples. Examples at equal
distance are taken by id. Rows that repeat an id are scored each; as an example, such an id has its shortest text. Labels
that repeat an id and label count once. Rows without id or label are no examples. With no examples the score is 0.5.
Other columns are not read.
"""

import hashlib
from collections import Counter
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm import common

BLOCK = 512
#: Digests of scored vectors that a Python worker remembers; copies and texts with one or two terms repeat them.
REMEMBERED = 50_000
EDGES = b".,;:!?\"'()[]{}*#$%&|<>-_"
#: Lengths in bytes of the beginnings of words that are terms too.
STEMS = (5, 7, 9)


def _terms(text: bytes) -> Counter[bytes]:
    """Counts of a lower-cased text's words and beginnings (marked by ^)."""
    out: Counter[bytes] = Counter()
    for word, n in Counter(text.split()).items():
        word = word.strip(EDGES)
        if word:
            out[word] += n
            for stem in STEMS:
                if len(word) > stem:
                    out[b"^" + word[:stem]] += n
    return out


def _example_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in common.row_blocks(batches):
        texts = texts.lower()
        found = [list(_terms(texts.text(i))) for i in range(batch.num_rows)]
        row = pa.array(np.repeat(np.arange(batch.num_rows), [len(x) for x in found]))
        terms = pa.array([term for x in found for term in x], type=pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("label").take(row), terms], names=["label", "term"])


def _numbers(text: bytes, get) -> dict[int, int]:
    """Numbers and counts of the known terms of a lower-cased text."""
    own: dict[int, int] = {}
    for word, n in Counter(text.split()).items():
        word = word.strip(EDGES)
        at = get(word)
        if at is not None:
            own[at] = own.get(at, 0) + n
        for stem in STEMS:
            if len(word) <= stem:
                break
            at = get(b"^" + word[:stem])
            if at is not None:
                own[at] = own.get(at, 0) + n
    return own


def _vectors(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    """Numbers of the known terms of each text, rising, and their counts."""
    get = sent.value.get
    for batch, texts in common.row_blocks(batches):
        texts = texts.lower()
        numbers, times, ends = [], [], [0]
        for i in range(batch.num_rows):
            own = _numbers(texts.text(i), get)
            at, n = (np.fromiter(x, dtype=np.int32, count=len(own)) for x in (own.keys(), own.values()))
            order = np.argsort(at)
            numbers.append(at[order])
            times.append(n[order])
            ends.append(ends[-1] + len(at))
        ends = pa.array(ends, type=pa.int32())
        lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x))) for x in (numbers, times)]
        yield pa.RecordBatch.from_arrays([batch.column("id"), *lists], names=["id", "terms", "times"])


def _frequencies(batches: Iterator[pa.RecordBatch], n_terms: int) -> Iterator[pa.RecordBatch]:
    """Per task: the vectors that hold each term, and at the end the number of all vectors."""
    counts = np.zeros(n_terms + 1, dtype=np.int64)
    for batch in batches:
        counts += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=n_terms + 1)
        counts[-1] += batch.num_rows
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["term", "n"])


class Index:
    """Examples in blocks: lists of (example, weight) per block and term, and the highest weight of each."""

    def __init__(self, idf: np.ndarray, ids: list[int], labels: np.ndarray, weights: np.ndarray, vectors: list):
        self.idf = idf
        found = [(self.vector(*v), ids[i], labels[i], weights[i]) for i, v in enumerate(vectors)]
        # Examples with the same strongest term share blocks, so that bounds differ between blocks.
        found.sort(key=lambda x: (int(x[0][0][np.argmax(x[0][1])]) if len(x[0][0]) else -1, x[1]))
        self.ids = np.array([x[1] for x in found], dtype=np.int64)
        self.labels = np.array([x[2] for x in found], dtype=np.float64)
        self.weights = np.array([x[3] for x in found], dtype=np.float64)
        self.vectors = [x[0] for x in found]
        blocks = -(-len(found) // BLOCK)
        self.highest = np.zeros((len(idf), blocks))
        self.lists: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # per block: first entry of each term, entries
        for b in range(blocks):
            own = self.vectors[b * BLOCK : (b + 1) * BLOCK]
            terms = np.concatenate([t for t, _ in own])
            order = np.argsort(terms, kind="stable")
            weights = np.concatenate([v for _, v in own])[order]
            places = np.repeat(np.arange(len(own)), [len(t) for t, _ in own])[order]
            self.lists.append((np.searchsorted(terms[order], np.arange(len(idf) + 1)), places, weights))
            np.maximum.at(self.highest[:, b], terms[order], weights)
        self.table = (np.zeros(1), np.full(1, 0.5))
        self.without_terms = 0.5

    def vector(self, terms: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        values = (1 + np.log(np.maximum(times, 1))) * self.idf[terms.astype(np.int64)]
        length = np.sqrt((values * values).sum())
        return terms, values / length if length else values

    def nearest(self, terms: np.ndarray, values: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the k nearest examples with a cosine above 0."""
        bounds = values @ self.highest[terms]
        places, cosines, kth = np.zeros(0, dtype=np.int64), np.zeros(0), 0.0
        for b in np.argsort(-bounds, kind="stable").tolist():
            if bounds[b] <= 0 or (len(places) == k and bounds[b] < kth - 1e-12):
                break
            first, entries, weights = self.lists[b]
            low, sizes = first[terms], first[terms + 1] - first[terms]
            at = np.repeat(low - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
            own = np.bincount(entries[at], np.repeat(values, sizes) * weights[at], BLOCK)
            if 0 <= without - b * BLOCK < BLOCK:
                own[without - b * BLOCK] = 0
            hit = np.flatnonzero(own > max(0.0, kth - 1e-12))
            places, cosines = np.append(places, hit + b * BLOCK), np.append(cosines, own[hit])
            order = np.lexsort((self.ids[places], -cosines))[:k]
            places, cosines = places[order], cosines[order]
            if len(places) == k:
                kth = cosines[-1]
        return places, cosines

    def vote(self, places: np.ndarray, cosines: np.ndarray) -> float:
        weight = cosines * self.weights[places]
        return float((weight * self.labels[places]).sum() / weight.sum())

    def calibrate(self, k: int) -> None:
        """Fits the monotone table by pooling neighbours that are out of order."""
        votes, at = [], []
        for i, (terms, values) in enumerate(self.vectors):
            if len(terms):
                places, cosines = self.nearest(terms, values, k, without=i)
                if len(places):
                    votes.append(self.vote(places, cosines))
                    at.append(i)
        rest = np.setdiff1d(np.arange(len(self.vectors)), at)
        everyone = self.weights.sum()
        prior = (self.weights * self.labels).sum() / everyone if everyone else 0.5
        w = self.weights[rest]
        self.without_terms = float(((w * self.labels[rest]).sum() + prior) / (w.sum() + 1))
        pools: list[list[float]] = []  # [upper vote, weight, labels]
        for i in np.argsort(votes, kind="stable").tolist():
            pools.append([votes[i], self.weights[at[i]], self.weights[at[i]] * self.labels[at[i]]])
            while len(pools) > 1 and (
                pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1] or pools[-2][0] == pools[-1][0]
            ):
                upper, w1, p1 = pools.pop()
                pools[-1] = [upper, pools[-1][1] + w1, pools[-1][2] + p1]
        if pools:
            upper, w1, p1 = np.array(pools).T
            self.table = (upper, (p1 + prior) / (w1 + 1))

    def judged(self, terms: np.ndarray, values: np.ndarray, k: int) -> tuple[float, list[int]]:
        """The score of a vector and the ids of its three nearest examples."""
        if not len(terms) or not len(self.ids):
            return self.without_terms, []
        places, cosines = self.nearest(terms, values, k)
        if not len(places):
            return self.without_terms, []
        return self.score(self.vote(places, cosines)), self.ids[places[:3]].tolist()

    def score(self, vote: float) -> float:
        upper, share = self.table
        return float(share[min(int(np.searchsorted(upper, vote - 1e-12)), len(share) - 1)])


def _score(batches: Iterator[pa.RecordBatch], sent, k: int) -> Iterator[pa.RecordBatch]:
    telling, whole = sent.value
    low = len(telling.idf)
    seen: dict[bytes, tuple[float, list[int]]] = {}
    for batch in batches:
        offsets = batch.column("terms").offsets.to_numpy()
        all_terms, all_times = (batch.column(name).values.to_numpy() for name in ("terms", "times"))
        scores, evidence = [], []
        for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            terms, times = all_terms[start:end], all_times[start:end]
            told = int(np.searchsorted(terms, low))
            index = telling if told else whole
            if told:
                terms, times = terms[:told], times[:told]
            key = hashlib.blake2b(terms.tobytes() + times.tobytes(), digest_size=16).digest()
            if key not in seen:
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen[key] = index.judged(*index.vector(terms if told else terms - low, times), k)
            score, ids = seen[key]
            scores.append(score)
            evidence.append(ids)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(scores, type=pa.float64()), pa.array(evidence, type=pa.list_(pa.int64()))],
            names=["id", "score", "evidence"],
        )


def _telling_terms(examples: DataFrame, pos: int, neg: int, terms: int, chance: float) -> list[bytes]:
    """The terms whose presence in examples tells most about the label, at most `terms`."""
    if not pos or not neg:
        return []
    found = common.map_arrow(examples.select("label", "text"), _example_terms, "label int, term binary")
    found = found.groupBy("term").agg(F.count_if(F.col("label") == 1).alias("a"), F.count_if(F.col("label") == 0).alias("b"))
    found = common.saved(found, "terms")
    # Evidence of each term against chance, as the exponent of a bound on its probability; a term counts if
    # chance would make one as telling among all terms with a probability of at most `chance`.
    a, b, share = F.col("a").cast("double"), F.col("b").cast("double"), pos / (pos + neg)
    part = [F.when(x > 0, x * F.log(x / (a + b) / F.lit(q))).otherwise(0.0) for x, q in ((a, share), (b, 1 - share))]
    found = found.withColumn("tie", part[0] + part[1]).where(F.octet_length("term") <= 64)
    found = found.where(F.col("tie") >= F.lit(log(max(1, found.count()) / chance)))
    return [bytes(row["term"]) for row in found.orderBy(F.desc("tie"), "term").limit(terms).select("term").collect()]


def _example_vectors(batches: Iterator[pa.RecordBatch], known: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    for batch, texts in common.row_blocks(batches):
        texts = texts.lower()
        found = [_numbers(texts.text(i), known.get) for i in range(batch.num_rows)]
        lists = [pa.array([list(f) for f in found]), pa.array([list(f.values()) for f in found])]
        lists = [x.cast(pa.list_(pa.int64())) for x in lists]
        sizes = pa.array(np.diff(texts.bounds))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("label"), *lists, sizes], names=["id", "label", "terms", "times", "size"]
        )


def neighbour_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    per_class: int = 4096,
    terms: int = 2048,
    chance: float = 0.01,
    k: int = 15,
    general: int = 512,
    example_bytes: int = 65_536,
) -> DataFrame:
    """One row per row of docs: doc_id, score (0 to 1) and evidence (ids of the three nearest examples). `labels`
    has id and label (0/1), rows to learn from only."""
    spark = docs.sparkSession
    source = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text"))
    labels = labels.where("id IS NOT NULL AND label IN (0, 1)").select("id", "label").distinct()
    classes = {row["label"]: row["n"] for row in labels.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [
        labels.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(per_class) for label in sorted(classes)
    ]
    chosen: list[bytes] = []
    rows: list = []
    texts: dict[int, bytes] = {}
    if parts:
        sample = parts[0] if len(parts) == 1 else parts[0].unionAll(parts[1])
        sample = F.broadcast(common.saved(sample, "sample"))  # at most 2 * per_class rows
        # One text per id, so that an id which many rows share gives one example.
        examples = source.join(sample, "id").groupBy("id", "label").agg(F.min(F.struct(F.octet_length("text"), "text")).alias("t"))
        examples = common.saved(examples.select("id", "label", "t.text"), "examples")
        sizes = {row["label"]: row["n"] for row in examples.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
        chosen = _telling_terms(examples, sizes.get(1, 0), sizes.get(0, 0), terms, chance)
        places = {term: i for i, term in enumerate(chosen)}
        kind = "id bigint, label int, terms array<bigint>, times array<bigint>, size bigint"
        rows = common.map_arrow(examples, lambda batches: _example_vectors(batches, places), kind)
        rows = rows.orderBy(F.xxhash64("id"), "id", "label").collect()  # at most 2 * per_class rows of `terms` terms
    # Examples without a telling term stand for the labelled rows without one.
    untold = {label: [r for r in rows if r["label"] == label and not r["terms"]] for label in classes}
    short = {label: [r for r in untold[label] if r["size"] <= example_bytes][:general] for label in classes}
    ids = [(r["id"],) for label in classes for r in short[label]]
    if ids:
        wanted = F.broadcast(spark.createDataFrame(sorted(set(ids)), "id bigint"))  # at most 2 * general ids
        for row in examples.join(wanted, "id").select("id", F.col("text").cast("binary")).distinct().collect():
            texts[row["id"]] = bytes(row["text"] or b"").lower()
    own_terms = {i: _terms(t) for i, t in texts.items()}
    rest = sorted({term for own in own_terms.values() for term in own}.difference(chosen))
    known = {term: i for i, term in enumerate([*chosen, *rest])}
    sent_terms = spark.sparkContext.broadcast(known)  # terms of a bounded sample of texts of bounded length
    kind = "id bigint, terms array<int>, times array<int>"
    vectors = common.saved(common.map_arrow(source, lambda batches: _vectors(batches, sent_terms), kind), "vectors")
    n_terms = len(known)
    found = common.map_arrow(vectors.select("terms"), lambda batches: _frequencies(batches, n_terms), "term bigint, n bigint")
    frequency = np.zeros(len(known) + 1)
    for row in found.groupBy("term").agg(F.sum("n").alias("n")).toArrow().to_pylist():
        frequency[row["term"]] = row["n"]
    idf = np.log((1 + frequency[-1]) / (1 + frequency[:-1])) + 1
    stands_for = {label: classes[label] / max(1, sum(r["label"] == label for r in rows)) for label in classes}

    def index(idf: np.ndarray, own: list, weights: dict[int, float], vectors: list) -> Index:
        labels = np.array([r["label"] for r in own], dtype=np.float64)
        out = Index(idf, [r["id"] for r in own], labels, np.array([weights[r["label"]] for r in own]), vectors)
        out.calibrate(k)
        return out

    def arrays(own: dict[int, int], low: int) -> tuple[np.ndarray, np.ndarray]:
        pairs = np.array(sorted(own.items()), dtype=np.int64).reshape(-1, 2)
        return pairs[:, 0] - low, pairs[:, 1]

    told = [arrays(dict(zip(r["terms"], r["times"], strict=True)), 0) for r in rows]
    telling = index(idf[: len(chosen)], rows, stands_for, told)
    few = [r for label in sorted(classes) for r in short[label]]
    weights = {label: stands_for[label] * len(untold[label]) / max(1, len(short[label])) for label in classes}
    whole_terms = [arrays({known[t]: n for t, n in own_terms[r["id"]].items()}, len(chosen)) for r in few]
    whole = index(idf[len(chosen) :], few, weights, whole_terms)
    if not few:
        whole.without_terms = telling.without_terms
    sent = spark.sparkContext.broadcast((telling, whole))
    scored = common.map_arrow(vectors, lambda batches: _score(batches, sent, k), "id bigint, score double, evidence array<bigint>")
    return scored.withColumnRenamed("id", "doc_id")
