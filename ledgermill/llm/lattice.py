"""Language-model scores from subword lattices.

Pieces and their scores come from an existing vocabulary; its scores are ranks, read as Zipf weights 1 / (rank + 2). One
expectation step over all training words re-weights the pieces by how often all segmentations use them. A word's
probability is the sum over all of its segmentations into pieces, by a forward recursion in log space; characters
without a piece fall back to their bytes. A text's probability is the product over its words, each followed by a word,
and of the end. Pieces do not cross words, so every distinct word is scored once.

The base score is an add-one unigram over words: sum of log10((c + 1) / (N + V + 1)), with one end token per text.

Word counts are summed per task before their shuffle. Texts look up at most `head_words` most frequent words in a table
of bounded size sent to all tasks; all other words of a text go through a join with the full table of words. Nothing is
dropped: the bound only decides which way a word takes.

Defined results: NULL and empty texts are one end token. Rows without id are learnt from and scored with a NULL id. Rows
that repeat an id are learnt from and scored each. With nothing to learn from, counts are 0 and every word is scored
by the vocabulary alone. Other columns are not read.
"""

from collections import Counter
from collections.abc import Iterator
from math import exp, log

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm import common

START = "▁"
#: Distinct words that a counting task holds before it passes their counts on.
HELD_WORDS = 200_000
#: Characters up to which a word's expected uses are found without logarithms.
SHORT = 12
LN10 = log(10)


class Lattice:
    """Log probabilities of pieces, and of bytes for characters that no piece covers."""

    def __init__(self, pieces: dict[str, float], byte: float):
        self.pieces, self.byte = pieces, byte
        self.longest = max(map(len, pieces), default=1)
        self.weights: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"weights": {}}

    def forward(self, word: str) -> list[float]:
        """Log probability of each prefix of START + word."""
        text = START + word
        get, longest = self.pieces.get, self.longest
        alpha = [0.0]
        for end in range(1, len(text) + 1):
            found = []
            for start in range(max(0, end - longest), end):
                p = get(text[start:end])
                if p is not None:
                    found.append(alpha[start] + p)
            if not found or text[end - 1] not in self.pieces:
                found.append(alpha[end - 1] + self.byte * len(text[end - 1].encode()))
            if len(found) == 1:
                alpha.append(found[0])
            else:
                top = max(found)
                alpha.append(top + log(sum([exp(x - top) for x in found])))
        return alpha

    def log_probability(self, word: str) -> float:
        return self.forward(word)[-1]

    def expected(self, word: str, count: float, into: dict[str, float]) -> float:
        """Adds the expected uses of pieces in `count` such words; returns those of single bytes."""
        if len(word) <= SHORT:
            return self._expected_short(START + word, count, into)
        text = START + word
        alpha = self.forward(word)
        total, get, in_bytes = alpha[-1], self.pieces.get, 0.0
        beta = [0.0] * (len(text) + 1)
        for start in range(len(text) - 1, -1, -1):
            found = []
            for end in range(start + 1, min(len(text), start + self.longest) + 1):
                p = get(piece := text[start:end])
                if p is not None:
                    tail = p + beta[end]
                    found.append(tail)
                    into[piece] = into.get(piece, 0.0) + count * exp(alpha[start] + tail - total)
            if text[start] not in self.pieces:
                width = len(text[start].encode())
                tail = self.byte * width + beta[start + 1]
                found.append(tail)
                in_bytes += count * width * exp(alpha[start] + tail - total)
            top = max(found)
            beta[start] = top if len(found) == 1 else top + log(sum([exp(x - top) for x in found]))
        return in_bytes


    def _expected_short(self, text: str, count: float, into: dict[str, float]) -> float:
        """The same with plain products, which cannot run out of range on a short text."""
        if not self.weights:
            self.weights = {piece: exp(p) for piece, p in self.pieces.items()}
        get, n, longest = self.weights.get, len(text), self.longest
        alpha, beta = [1.0] + [0.0] * n, [0.0] * n + [1.0]
        steps: list[tuple[int, int, str, float]] = []
        for start in range(n):
            before = alpha[start]
            if not before:
                continue
            for end in range(start + 1, min(n, start + longest) + 1):
                piece = text[start:end]
                p = get(piece)
                if p is not None:
                    steps.append((start, end, piece, p))
                    alpha[end] += before * p
                elif end == start + 1:
                    p = exp(self.byte * len(piece.encode()))
                    steps.append((start, end, "", p))
                    alpha[end] += before * p
        scale, in_bytes = count / alpha[n], 0.0
        for start, end, piece, p in reversed(steps):
            tail = p * beta[end]
            beta[start] += tail
            if piece:
                into[piece] = into.get(piece, 0.0) + scale * alpha[start] * tail
            else:
                in_bytes += scale * alpha[start] * tail * len(text[start].encode())
        return in_bytes


def vocabulary(path: str) -> Lattice:
    """The pieces of a sentencepiece model, weighted by the ranks that its scores give."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    weights = {
        model.id_to_piece(i): 1 / (2 - model.get_score(i))
        for i in ids
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    }
    byte = 1 / (2 + len(weights))
    total = sum(weights.values()) + 256 * byte
    return Lattice({piece: log(w / total) for piece, w in weights.items()}, log(byte / total))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    learnt: Counter[bytes] = Counter()
    others: Counter[bytes] = Counter()

    def rows() -> pa.RecordBatch:
        words = [*learnt, *others]
        counts = [*learnt.values(), *[0] * len(others)]
        totals = [*learnt.values(), *others.values()]
        learnt.clear()
        others.clear()
        columns = [pa.array(words, type=pa.binary()).cast(pa.string()), pa.array(counts, type=pa.int64())]
        return pa.RecordBatch.from_arrays([*columns, pa.array(totals, type=pa.int64())], names=["word", "c", "total"])

    for batch, texts in common.row_blocks(batches):
        texts = texts.lower()
        learn = batch.column("learn").to_pylist()
        for i in range(batch.num_rows):
            (learnt if learn[i] else others).update(texts.text(i).split())
        if len(learnt) + len(others) > HELD_WORDS:
            yield rows()
    yield rows()


def _expect(batches: Iterator[pa.RecordBatch], lattice) -> Iterator[pa.RecordBatch]:
    model, uses, in_bytes = lattice.value, {}, 0.0
    for batch in batches:
        for word, c in zip(batch.column("word").to_pylist(), batch.column("c").to_pylist(), strict=True):
            in_bytes += model.expected(word, c, uses)
    uses[""] = in_bytes
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(uses), type=pa.string()), pa.array(list(uses.values()), type=pa.float64())], names=["piece", "n"]
    )


def _score_words(batches: Iterator[pa.RecordBatch], lattice) -> Iterator[pa.RecordBatch]:
    model = lattice.value
    for batch in batches:
        scores = [model.log_probability(word) / LN10 for word in batch.column("word").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, type=pa.float64())], names=[*batch.schema.names, "lattice"])


def _look_up(batches: Iterator[pa.RecordBatch], head) -> Iterator[pa.RecordBatch]:
    get = head.value.table().get
    for batch, texts in common.row_blocks(batches):
        texts = texts.lower()
        n_words, known, base, score, tails = [], [], [], [], []
        for i in range(batch.num_rows):
            words = texts.text(i).split()
            n_known, b, s, tail = 0, 0.0, 0.0, []
            for word, n in Counter(words).items():
                have = get(word)
                if have is None:
                    tail.append((word.decode(), n))
                else:
                    n_known += n * have[0]
                    b += n * have[1]
                    s += n * have[2]
            n_words.append(len(words))
            known.append(n_known)
            base.append(b)
            score.append(s)
            tails.append(tail)
        offsets = pa.array([0, *map(len, tails)]).to_numpy().cumsum()
        words = pa.array([w for tail in tails for w, _ in tail], type=pa.string())
        times = pa.array([n for tail in tails for _, n in tail], type=pa.int64())
        tail = pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), pa.StructArray.from_arrays([words, times], ["word", "n"]))
        numbers = [pa.array(x, type=pa.int64()) for x in (n_words, known)]
        sums = [pa.array(x, type=pa.float64()) for x in (base, score)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("id"), batch.column("held_out"), *numbers, *sums, tail],
            names=["row", "id", "held_out", "n_words", "n_known", "base", "score", "tail"],
        )


class Head:
    """The most frequent words with their values, sent packed and unpacked once in each worker."""

    def __init__(self, words: pa.Table):
        self.words = words.combine_chunks()
        self.known: dict[bytes, tuple[int, float, float]] | None = None

    def __getstate__(self):
        return {"words": self.words, "known": None}

    def table(self) -> dict[bytes, tuple[int, float, float]]:
        if self.known is None:
            columns = [self.words.column(name).to_pylist() for name in ("known", "base", "score")]
            keys = self.words.column("word").cast(pa.binary()).to_pylist()
            self.known = dict(zip(keys, zip(*columns, strict=True), strict=True))
        return self.known


def _head(scored: DataFrame, most: int) -> Head:
    """At most `most` words of at most 40 characters: those above a frequency at which they are few enough. The
    frequency is found from counts per eighth of a power of two, so that nothing is sorted or sent beyond the bound."""
    short = scored.where("length(word) <= 40")
    step = F.floor(8 * F.log2("total"))
    sizes = {row["s"]: row["n"] for row in short.groupBy(step.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()}
    least, held = max(sizes, default=0) + 1, 0
    for size in sorted(sizes, reverse=True):
        held += sizes[size]
        if held > most:
            break
        least = size
    return Head(short.where(step >= least).select("word", "known", "base", "score").toArrow())


def held_out_by_id(id_column: str, parts: int, part: int) -> Column:
    """Whether an id's crc32 leaves the remainder `part`; NULL ids are not held out."""
    return F.coalesce(F.crc32(F.col(f"`{id_column}`").cast("string")) % parts == part, F.lit(False))


def lattice_scores(
    docs: DataFrame,
    held_out: Column,
    vocabulary_path: str,
    id_column: str = "doc_id",
    text: str = "text",
    head_words: int = 1 << 17,
    prior: float = 1000.0,
) -> DataFrame:
    """One row per row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10).

    `prior`: uses of pieces that the vocabulary's own weights count as, beside the expected ones."""
    spark = docs.sparkSession
    context = spark.sparkContext
    source = docs.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").alias("text"), held_out.alias("held_out")
    )
    counts = common.map_arrow(
        source.select("text", (~F.col("held_out")).alias("learn")), _count, "word string, c bigint, total bigint"
    )
    words = common.saved(counts.groupBy("word").agg(F.sum("c").alias("c"), F.sum("total").alias("total")), "words")
    seen = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    ends = source.where(~F.col("held_out")).count()
    n, v = seen[0] + ends, seen[1] + (ends > 0)
    below = log(n + v + 1) / LN10

    first = vocabulary(vocabulary_path)
    sent = context.broadcast(first)  # as large as the vocabulary
    uses = common.map_arrow(
        words.where("c > 0").select("word", "c"), lambda batches: _expect(batches, sent), "piece string, n double"
    )
    uses = {row["piece"]: row["n"] for row in uses.groupBy("piece").agg(F.sum("n").alias("n")).collect()}
    total = sum(uses.values()) + prior
    pieces = {piece: log((uses.get(piece, 0.0) + prior * exp(p)) / total) for piece, p in first.pieces.items()}
    byte = log((uses.get("", 0.0) / 256 + prior * exp(first.byte)) / total)
    model = context.broadcast(Lattice(pieces, byte))
    end = (ends + 1) / (n + 2)
    further = log(1 - end) / LN10
    scored = common.map_arrow(
        words, lambda batches: _score_words(batches, model), "word string, c bigint, total bigint, lattice double"
    )
    scored = scored.select(
        "word",
        "total",
        (F.col("c") > 0).cast("bigint").alias("known"),
        (F.log10(F.col("c") + 1) - F.lit(below)).alias("base"),
        (F.col("lattice") + F.lit(further)).alias("score"),
    )
    scored = common.saved(scored, "scored")
    table = context.broadcast(_head(scored, head_words))

    found = common.map_arrow(
        source.select(F.monotonically_increasing_id().alias("row"), "*"),
        lambda batches: _look_up(batches, table),
        f"""row bigint, id {source.schema["id"].dataType.simpleString()}, held_out boolean, n_words bigint,
        n_known bigint, base double, score double, tail array<struct<word: string, n: bigint>>""",
    )
    found = common.saved(found, "found")
    tail = found.select("row", F.explode("tail").alias("t")).select("row", "t.word", F.col("t.n").alias("n"))
    tail = tail.join(scored.drop("total"), "word").groupBy("row")
    tail = tail.agg(*[F.sum(F.col("n") * F.col(c)).alias(f"tail_{c}") for c in ("known", "base", "score")])
    out = found.drop("tail").join(tail, "row", "left")

    def with_tail(name: str, tail_name: str) -> Column:
        return F.col(name) + F.coalesce(tail_name, F.lit(0))

    return out.select(
        F.col("id").alias("doc_id"),
        "held_out",
        (F.col("n_words") + 1).alias("n_tokens"),
        (with_tail("n_known", "tail_known") + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (with_tail("base", "tail_base") + F.lit(log(ends + 1) / LN10 - below)).alias("base_score"),
        (with_tail("score", "tail_score") + F.lit(log(end) / LN10)).alias("score"),
    )
