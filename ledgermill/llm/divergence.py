"""How far the sources of a language diverge in their words, audited exactly.

A document's vector holds the count of each of its terms. Each language's vocabulary is fitted like a count vectorizer's
with a least document frequency and no limit of its size: the terms of at least `min_df` of its documents. Vectors are
summed per (language, source) over the vocabulary. From a group's sums, a term's smoothed probability, in units of 10^-9,
is p = 1 + floor(10^9 (count + 1) / (N + V)), and two probabilities diverge by f = floor((p - q)^2 / q).

Part `pair` has f summed over the vocabulary for each two sources of a language; part `term` the terms that a source uses
more than its language does, by f, up to `top_terms` of them.

The sums are sparse, and so is their evaluation. A term that a source lacks has the same p in it as all others it lacks,
so a pair's sum is made of
  - f over the terms that one of them has, against the other's p of a lacking term: from a histogram of the source's p,
    which has at most about 45,000 entries as all p add up to 10^9 + V;
  - f of two lacking terms, times the terms that neither has;
  - a correction for the terms that both have. It is summed up in blocks of terms, within which rows at a distance of
    1, 2, ... that have the same term are compared as whole arrays; a block returns a row per pair of sources.
No pair of rows of a term leaves its block. Vocabularies and sums stay in tables; nothing of them reaches the driver.
All arithmetic is on integers: products beyond 64 bits are decimals.

Defined results: NULL text, lang and source are ''. A group without terms has p of lacking terms throughout, and a
language without kept terms has pair values of 0 and no `term` rows. A source that is alone in its language has no
`pair` rows. An empty table has no rows. Document ids are not read: rows that repeat one count as documents of their
own. Other columns are not read.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgermill.llm import common

SCALE = 1_000_000_000
#: Sparse rows in a block of terms, on average.
BLOCK_ROWS = 50_000
#: Sources of a language whose pairs with all others one task forms, on average.
SOURCES_IN_A_TASK = 256

#: A-Z become a-z, other ASCII that is no letter becomes a space; the bytes of other characters stay.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents' sparse vectors, a row for each document and term."""
    for batch, texts in common.row_blocks(batches):
        terms, counts, sizes = [], [], []
        for i in range(batch.num_rows):
            vector = Counter(texts.text(i).translate(_TERM_BYTES).split())
            terms += vector.keys()
            counts += vector.values()
            sizes.append(len(vector))
        owner = pa.array(np.repeat(np.arange(batch.num_rows), sizes))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("lang").take(owner),
                batch.column("source").take(owner),
                pa.array(terms, pa.binary()).cast(pa.string()),
                pa.array(counts, pa.int64()),
            ],
            names=["lang", "source", "term", "n"],
        )


def probability(count: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + terms)), by decimals where 64 bits do not hold the product; NULL for an
    empty vocabulary."""
    return F.expr(f"""CASE WHEN {terms} = 0 THEN NULL
        WHEN {count} < 9000000000 THEN 1 + ({count} + 1) * {SCALE} div ({total} + {terms})
        ELSE 1 + CAST({count} + 1 AS DECIMAL(20,0)) * {SCALE}BD div ({total} + {terms}) END""")


def _diverging(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div {q}")


def _divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _codes(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    encoded = column.combine_chunks().dictionary_encode()
    return encoded.indices.to_numpy().astype(np.int64), encoded.dictionary


def _corrections(block: pa.Table) -> pa.Table:
    """For each two sources that share terms of the block: the sum over these of f, less what the histograms of the two
    count for them, plus the f of two lacking terms that they take off twice."""
    lang, langs = _codes(block["lang"])
    source, sources = _codes(block["source"])
    term, _ = _codes(block["term"])
    order = np.lexsort((source, term, lang))
    lang, source, term = lang[order], source[order], term[order]
    p, base = block["p"].to_numpy()[order], block["base"].to_numpy()[order]
    n = len(sources)
    codes, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
    distance = 1
    while True:
        i = np.flatnonzero((term[distance:] == term[:-distance]) & (lang[distance:] == lang[:-distance]))
        if not len(i):
            break
        j = i + distance
        both = [codes]
        values = [sums]
        for a, b in ((i, j), (j, i)):
            both.append((lang[a] * n + source[a]) * n + source[b])
            full, lacking = _divergence(p[a], p[b]), _divergence(base[a], base[b])
            values.append(full - _divergence(p[a], base[b]) - _divergence(base[a], p[b]) + lacking)
        codes, place = np.unique(np.concatenate(both), return_inverse=True)
        sums = np.zeros(len(codes), np.int64)
        np.add.at(sums, place, np.concatenate(values))
        distance += 1
    return pa.table(
        {
            "lang": langs.take(pa.array(codes // (n * n))),
            "source": sources.take(pa.array(codes // n % n)),
            "item": sources.take(pa.array(codes % n)),
            "value": pa.array(sums),
        }
    )


def _over(levels: str, p: str, q: str) -> Column:
    """The sum of f over a source's terms, from its histogram of p; `x.p` stands for an entry's."""
    f = f"({p} - {q}) * ({p} - {q}) div {q}"
    return F.expr(f"coalesce(aggregate({levels}, 0L, (sum, x) -> sum + x.n * ({f})), 0L)")


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def audit(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_df: int = 3,
    top_terms: int = 200,
) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item (a source or a term), value and rank, from 1 in each group and part."""
    filled = {"text": text, "lang": lang, "source": source}
    texts = docs.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(name) for name, c in filled.items()])
    vectors = common.map_arrow(texts, _vectors, "lang string, source string, term string, n bigint")
    sums = vectors.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("docs"))
    sums = common.saved(sums, "sums")
    vocabulary = sums.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
    vocabulary = common.saved(vocabulary.where(F.col("docs") >= min_df).drop("docs"), "vocabulary")
    sums = common.saved(sums.drop("docs").join(vocabulary, ["lang", "term"]), "sums")

    langs = vocabulary.groupBy("lang").agg(F.sum("lang_n").alias("lang_total"), F.count(F.lit(1)).alias("terms"))
    totals = sums.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = texts.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.na.fill(0, ["total", "lang_total", "terms"])
    groups = common.saved(groups.withColumn("base", probability("0L", "total", "terms")), "groups")
    rows = sums.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "base",
        probability("n", "total", "terms").alias("p"),
        probability("lang_n", "lang_total", "terms").alias("q"),
    )

    more = rows.where("p > q").select("lang", "source", F.col("term").alias("item"), _diverging("p", "q").alias("value"))
    terms = _ranked(more, "term").where(F.col("rank") <= top_terms)

    levels = rows.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("n"))
    levels = levels.groupBy("lang", "source").agg(F.collect_list(F.struct("p", "n")).alias("levels"), F.sum("n").alias("own"))
    blocks = -(-sums.count() // BLOCK_ROWS)
    block = F.pmod(F.xxhash64("lang", "term"), F.lit(max(1, blocks))).alias("block")
    shared = rows.select(block, "lang", "source", "term", "p", "base").groupBy("block")
    shared = shared.applyInArrow(_corrections, "lang string, source string, item string, value bigint")
    shared = shared.groupBy("lang", "source", "item").agg(F.sum("value").alias("correction"))

    # Where a language has many sources, the pairs of one of them are dealt over several tasks.
    many = groups.groupBy("lang").agg(F.expr(f"count(1) div {SOURCES_IN_A_TASK}").alias("slices"))
    sides = groups.join(levels, ["lang", "source"], "left").join(many, "lang")
    sides = common.saved(sides.select("lang", "source", "terms", "base", "levels", "own", "slices"), "sides")
    left = sides.withColumn("slice", F.pmod(F.xxhash64("source"), F.col("slices") + 1)).drop("slices")
    renamed = {"source": "item", "base": "item_base", "levels": "item_levels", "own": "item_own"}
    right = sides.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("bigint"), "slices")))
    right = right.select("lang", "slice", *[F.col(name).alias(new) for name, new in renamed.items()])
    pairs = left.join(right, ["lang", "slice"]).where("source != item").join(shared, ["lang", "source", "item"], "left")
    value = (
        _over("levels", "x.p", "item_base")
        + _over("item_levels", "base", "x.p")
        + F.expr("terms - coalesce(own, 0L) - coalesce(item_own, 0L)") * _diverging("base", "item_base")
        + F.coalesce("correction", F.lit(0))
    )
    pairs = pairs.select("lang", "source", "item", F.when(F.col("terms") > 0, value).otherwise(0).alias("value"))
    return _ranked(pairs, "pair").unionAll(terms)


def oracle(min_df: int = 3, top_terms: int = 200) -> str:
    """The same rows as SQL, with every kept term for every group."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    share = "(1 + {scale}::HUGEINT * ({0} + 1) // ({1} + v))::BIGINT"
    order = "PARTITION BY lang, source ORDER BY value DESC, item"
    return f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
                '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
        t AS MATERIALIZED (SELECT r, lang, source, unnest(terms) AS term FROM d),
        k AS MATERIALIZED (SELECT lang, term, count(*) AS total FROM t GROUP BY ALL HAVING count(DISTINCT r) >= {min_df}),
        c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL),
        g AS (SELECT DISTINCT lang, source FROM d),
        m AS (SELECT g.lang, g.source, k.term, k.total, coalesce(n, 0) AS n FROM g JOIN k ON k.lang = g.lang
            LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        s AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS own, sum(total) OVER (PARTITION BY lang, source) AS whole,
            count(*) OVER (PARTITION BY lang, source) AS v FROM m),
        p AS MATERIALIZED (SELECT lang, source, term, n, {share.format("n", "own", scale=SCALE)} AS p,
            {share.format("total", "whole", scale=SCALE)} AS q FROM s),
        pairs AS (SELECT a.lang, a.source, b.source AS item,
            sum((a.p - b.p)::HUGEINT * (a.p - b.p) // b.p)::BIGINT AS value
            FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        every AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
        more AS (SELECT lang, source, term AS item, ((p - q)::HUGEINT * (p - q) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q)
        SELECT lang, source, 'pair' AS part, item, value, (row_number() OVER ({order}))::INTEGER AS rank FROM every
        UNION ALL SELECT lang, source, 'term', item, value, (row_number() OVER ({order}))::INTEGER AS rank FROM more
        QUALIFY rank <= {top_terms}"""
