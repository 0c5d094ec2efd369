"""Mixing of documents to target shares of source, language and topic, by iterative proportional fitting.

Tokens are summed per cell (source, language, topic); from there on only cells are worked on. Each sweep scales the
cells' weights to the target shares of one dimension after the other; after some sweeps all three hold together. A
cell's rate is its fitted weight over its tokens, and a document is sampled with its cell's rate divided by the highest
rate, so that the sample has the target shares in expectation and no document is needed twice. The draw is a hash of
the id: the same document is drawn in every run and on every executor.

Targets are given per dimension as {value: share}, or are the table's own shares raised to `temper` (below 1: small
sources, languages and topics gain). Shares are scaled to sum to 1 over the values that occur.

Built-in DataFrame functions only. Sums per cell and per value are combined before their shuffle; the table of cells is
joined back to documents, which Spark does by broadcast while it is small and otherwise by a join that splits skewed
keys.

Defined results: NULL source, language or topic is the value ''. NULL and empty texts have no tokens; a cell without
tokens has rate 0, and its documents are not sampled. Values without a target have share 0. Rows that repeat an id get
the same draw; NULL ids are drawn as ''. Other columns pass through unchanged unless they clash with the added ones,
which replace them.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm import common

DIMENSIONS = ("mix_source", "mix_lang", "mix_topic")
WORD = r"[^\x20\x09-\x0D]+"


def token_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def form_topic(text: str, tokens: Column) -> Column:
    """A topic by form: tables, marked-up text, shouting, long and short prose."""

    def times(mark: str) -> Column:
        return F.length(text) - F.length(F.replace(F.col(text), F.lit(mark), F.lit("")))

    return (
        F.when(F.coalesce(tokens, F.lit(0)) == 0, "empty")
        .when(10 * times("|") >= tokens, "table")
        .when(10 * times("#") + 10 * times("$") >= tokens, "markup")
        .when(10 * times("!") >= tokens, "shout")
        .when(tokens >= 300, "long prose")
        .otherwise("short prose")
    )


def _shares(cells: DataFrame, name: str, temper: float, targets: Mapping[str, Mapping[str, float]]) -> DataFrame:
    per_value = cells.groupBy(name).agg(F.sum("n_tokens").cast("double").alias("own"))
    if name in targets:
        given = [F.lit(x) for pair in targets[name].items() for x in (pair[0], float(pair[1]))]
        share = F.coalesce(F.try_element_at(F.create_map(*given), F.col(name)), F.lit(0.0))
    else:
        share = F.pow("own", F.lit(temper))
    per_value = common.saved(per_value.select(name, share.alias("share")), "targets")
    total = per_value.agg(F.sum("share")).first()[0]
    return per_value.select(name, (F.col("share") / F.lit(total or 1.0)).alias("share"))


def fitted_cells(
    cells: DataFrame, temper: float, targets: Mapping[str, Mapping[str, float]], sweeps: int
) -> tuple[DataFrame, float]:
    """Cells with tokens, their fitted weight and rate, and the highest rate."""
    cells = common.saved(cells.where("n_tokens > 0").withColumn("weight", F.col("n_tokens").cast("double")), "cells")
    total = cells.agg(F.sum("n_tokens").cast("double")).first()[0] or 0.0
    shares = {name: _shares(cells, name, temper, targets) for name in DIMENSIONS}
    for _ in range(sweeps):
        for name in DIMENSIONS:
            have = cells.groupBy(name).agg(F.sum("weight").alias("have"))
            scale = have.join(shares[name], name).select(
                name, F.when(F.col("have") > 0, F.col("share") * F.lit(total) / F.col("have")).otherwise(0.0).alias("scale")
            )
            cells = cells.join(scale, name).withColumn("weight", F.col("weight") * F.col("scale")).drop("scale")
        cells = common.saved(cells, "cells")
    cells = cells.withColumn("rate", F.col("weight") / F.col("n_tokens"))
    return cells, cells.agg(F.max("rate")).first()[0] or 1.0


def mix_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    topic: Column | None = None,
    temper: float = 0.7,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    sweeps: int = 8,
) -> DataFrame:
    """All rows and columns of docs, and mix_source, mix_lang, mix_topic, n_tokens, mix_rate (the chance of being
    sampled) and sampled. `targets` has the dimensions' names as keys."""
    tokens = token_count(text)
    measured = docs.withColumn("n_tokens", tokens)
    measured = measured.withColumn("mix_topic", form_topic(text, F.col("n_tokens")) if topic is None else topic)
    measured = measured.withColumn("mix_source", F.coalesce(F.col(source), F.lit("")))
    measured = measured.withColumn("mix_lang", F.coalesce(F.col(lang), F.lit("")))
    measured = measured.withColumn("mix_topic", F.coalesce("mix_topic", F.lit("")))
    cells = measured.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("n_tokens"))
    cells, highest = fitted_cells(cells, temper, targets or {}, sweeps)
    rates = cells.select(*DIMENSIONS, (F.col("rate") / F.lit(highest)).alias("mix_rate"))
    draw = F.conv(F.substring(F.md5(F.coalesce(F.col(id_column).cast("string"), F.lit(""))), 1, 8), 16, 10)
    mixed = measured.drop("mix_rate").join(rates, list(DIMENSIONS), "left")
    mixed = mixed.withColumn("mix_rate", F.coalesce("mix_rate", F.lit(0.0)))
    return mixed.withColumn("sampled", draw.cast("double") / F.lit(2.0**32) < F.col("mix_rate"))


def oracle(temper: float = 0.7, sweeps: int = 8) -> str:
    """The same mix as SQL, with windows over the cells instead of joins."""
    counts = "length(text) - length(replace(text, '{0}', ''))"
    bar, hash_, dollar, bang = (f"10 * ({counts.format(x)})" for x in "|#$!")
    parts = [
        f"""WITH t AS (SELECT doc_id, text, coalesce(source, '') AS s, coalesce(lang, '') AS l,
            coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n FROM documents),
        m AS (SELECT doc_id, s, l, n, CASE WHEN n = 0 THEN 'empty' WHEN {bar} >= n THEN 'table'
            WHEN {hash_} + {dollar} >= n THEN 'markup' WHEN {bang} >= n THEN 'shout'
            WHEN n >= 300 THEN 'long prose' ELSE 'short prose' END AS p FROM t),
        c AS (SELECT s, l, p, sum(n)::DOUBLE AS n FROM m GROUP BY ALL HAVING sum(n) > 0),
        total AS (SELECT sum(n) AS n FROM c)"""
    ]
    for x in "slp":
        parts.append(
            f"q{x} AS (SELECT {x}, pow(sum(n), {temper}) / sum(pow(sum(n), {temper})) OVER () AS q FROM c GROUP BY {x})"
        )
    before = "SELECT s, l, p, n, n AS w FROM c"
    for k in range(sweeps):
        for x in "slp":
            parts.append(
                f"""w{k}{x} AS MATERIALIZED (SELECT s, l, p, b.n,
                w * q * total.n / sum(w) OVER (PARTITION BY {x}) AS w FROM ({before}) b JOIN q{x} USING ({x}), total)"""
            )
            before = f"SELECT * FROM w{k}{x}"
    return ", ".join(parts) + f""", r AS (SELECT s, l, p, (w / n) / max(w / n) OVER () AS rate FROM ({before}))
        SELECT doc_id, s AS mix_source, l AS mix_lang, p AS mix_topic, m.n AS n_tokens,
            round(coalesce(rate, 0), 6) AS mix_rate,
            ('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT / pow(2, 32) < coalesce(rate, 0) AS sampled
        FROM m LEFT JOIN r USING (s, l, p)"""
