"""The audit against plain Python over every kept term."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import functions as F

from ledgermill.llm import divergence
from tests.llm import helpers

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, min_df=3, top=200):
    """rows: (text, lang, source)"""
    docs = [((t or "").translate(helpers.LOWER), lang or "", source or "") for t, lang, source in rows]
    out = []
    for lang in sorted({d[1] for d in docs}):
        vectors = [(Counter(TERM.findall(t)), s) for t, own, s in docs if own == lang]
        df, sums = Counter(), defaultdict(Counter)
        for vector, source in vectors:
            df.update(vector.keys())
            sums[source].update(vector)
        kept = sorted(term for term, n in df.items() if n >= min_df)
        whole = Counter()
        for counts in sums.values():
            whole.update(counts)

        def p(counts, kept=kept):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // (total + len(kept)) for t in kept}

        shares, q = {source: p(sums[source]) for source in sums}, p(whole)
        for source, own in shares.items():
            pairs = [
                (other, sum((own[t] - x[t]) ** 2 // x[t] for t in kept)) for other, x in shares.items() if other != source
            ]
            terms = [(t, (own[t] - q[t]) ** 2 // q[t]) for t in kept if sums[source][t] and own[t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(found[:most])]
    return sorted(out)


def test_edge_cases_against_plain_python(spark):
    texts = helpers.edge_texts() + [(i, f"Straße ÉCOLE école naïve東京 don't w{i % 4} A-b_c" * (i % 3)) for i in range(200, 240)]
    docs = helpers.documents(spark, texts).withColumns({"n": F.lit("x"), "term": F.lit("y"), "value": F.lit("z")})
    got = divergence.audit(docs)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == plain(docs.select("text", "lang", "source").collect())


def test_groups_without_terms_and_languages_without_kept_terms(spark):
    rows = [("one two three", "a", "s1")] * 3 + [("1 2 3", "a", "s2"), (None, "a", None), ("", "b", "s1"), ("x", "b", "s2")]
    rows += [("alone alone", "c", "s1")] * 4
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    got = sorted(map(tuple, divergence.audit(docs).collect()))
    assert got == plain(rows)
    assert ("b", "s1", "pair", "s2", 0, 1) in got and not [r for r in got if r[0] == "c" and r[2] == "pair"]


def test_more_terms_than_are_reported_ties_and_many_slices(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_ROWS", 100)
    monkeypatch.setattr(divergence, "SOURCES_IN_A_TASK", 2)
    rnd = random.Random(2)
    words = ["".join(rnd.choices("abcdefghij", k=5)) for _ in range(900)]
    rows = [(" ".join(rnd.choices(words[k % 7 * 100 :], k=150)), "en", f"s{k % 7}") for k in range(100)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    got = sorted(map(tuple, divergence.audit(docs, top_terms=50).collect()))
    assert got == plain(rows, top=50)


def test_an_empty_table(spark):
    assert divergence.audit(helpers.documents(spark, [(1, "a")]).limit(0)).collect() == []


def test_probabilities_beyond_64_bits(spark):
    counts = [0, 5, 8_999_999_999, 9_000_000_000, 10**15]
    df = spark.createDataFrame([(n, 10**15 + 7, 12) for n in counts], "n long, total long, terms long")
    got = [r[0] for r in df.select(divergence.probability("n", "total", "terms")).collect()]
    assert got == [1 + 10**9 * (n + 1) // (10**15 + 19) for n in counts]


def test_corrections_are_pairs_of_a_term_once_each():
    block = pa.table({"lang": ["a"] * 5, "source": ["x", "y", "z", "x", "y"], "term": ["t", "t", "t", "u", "u"],
                      "p": pa.array([9, 4, 6, 3, 8]), "base": pa.array([1, 2, 3, 1, 2])})
    got = {(r["source"], r["item"]): r["value"] for r in divergence._corrections(block).to_pylist()}

    def f(p, q):
        return (p - q) ** 2 // q

    def part(p, bp, q, bq):
        return f(p, q) - f(p, bq) - f(bp, q) + f(bp, bq)

    assert len(got) == 6
    assert got["x", "y"] == part(9, 1, 4, 2) + part(3, 1, 8, 2)
    assert got["z", "y"] == part(6, 3, 4, 2)
    assert divergence._corrections(block.slice(0, 0)).num_rows == 0
