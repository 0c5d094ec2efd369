"""The manifest against a plain version that builds every tree in memory."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgermill.llm import manifest
from ledgermill.llm.ranks import ranked
from tests.llm import helpers


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf_of(row, text):
    fields = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in fields])


def tree(nodes):
    """The root, and for each node the (before, after) siblings of each level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[k : k + 8] for k in range(0, len(nodes), 8)]
        for i, place in enumerate(at):
            run, digit = runs[place // 8], place % 8
            paths[i].append(("".join(run[:digit]), "".join(run[digit + 1 :])))
            at[i] = place // 8
        nodes = [h(*run) for run in runs]
    return nodes[0], paths


def plain(rows):
    by_lang = defaultdict(list)
    for row in rows:
        by_lang[row.lang].append((row.doc_id is not None, row.doc_id, leaf_of(row, row.text), row))
    langs = sorted(by_lang, key=lambda name: (name is not None, (name or "").encode()))
    trees = []
    for lang in langs:
        by_lang[lang].sort(key=lambda x: (x[0], x[1] or 0, x[2]))
        trees.append(tree([leaf for _, _, leaf, _ in by_lang[lang]]))
    if not langs:
        return []
    root, upper = tree([subroot for subroot, _ in trees])
    out = []
    for lang, (subroot, paths), above in zip(langs, trees, upper, strict=True):
        for (_, _, leaf, row), path in zip(by_lang[lang], paths, strict=True):
            now = leaf
            if row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 3 == 0:
                now = leaf_of(row, row.text and row.text.translate(helpers.LOWER))
            for before, after in path + above:
                now = h(before, now, after)
            proof = h(*[before + after for before, after in path + above])
            out.append((row.doc_id, leaf, subroot, root, proof, now, now == root))
    return sorted(map(str, out))


def test_edge_cases_against_a_plain_version(spark):
    docs = helpers.documents(spark, helpers.edge_texts()).withColumn("grp", F.lit(1)).withColumn("rank", F.lit("x"))
    got = manifest.tamper_check(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    rows = got.collect()
    assert sorted(str(tuple(r)) for r in rows) == plain(docs.collect())
    assert {r.verified for r in rows} == {True, False}


@pytest.mark.parametrize("n", [1, 9, 65])
def test_heights(spark, n):
    rows = [(i, f"Text {i}", "en" if i < n else f"l{i}") for i in range(n + (n == 9) * 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs = docs.withColumns({"source": F.lit(None).cast("string"), "n_chars": F.length("text")})
    assert sorted(str(tuple(r)) for r in manifest.tamper_check(docs).collect()) == plain(docs.collect())


def test_an_empty_table_has_no_rows(spark):
    assert manifest.tamper_check(helpers.documents(spark, [(1, "a")]).limit(0)).collect() == []


def test_some_requests_descend_like_all(spark):
    built = manifest.build(helpers.documents(spark, helpers.edge_texts()))
    every = {(r.grp, r["rank"]): r for r in manifest.proofs(built).collect()}
    assert all(r.found == r.leaf for r in every.values())
    some = manifest.proofs(built, built.leaves.where("rank % 11 = 3")).collect()
    assert {(r.grp, r["rank"]): r for r in some} == {k: r for k, r in every.items() if k[1] % 11 == 3}


def test_repeated_rows_are_one_record(spark):
    """A third of all rows equal: their runs are one record, and every copy has its own place."""
    docs = helpers.documents(spark, [(1, "same")] * 1 + [(i, f"text {i}") for i in range(2, 400)])
    docs = docs.select("doc_id", "text", "n_chars", F.lit("en").alias("lang"), F.lit("s").alias("source"))
    copies = docs.where("doc_id = 1").join(spark.range(200).select(), how="cross")
    docs = docs.where("doc_id > 1").unionAll(copies)
    built = manifest.build(docs)
    assert built.records.count() < 25 + 52 + 10
    assert sorted(str(tuple(r)) for r in manifest.tamper_check(docs).collect()) == plain(docs.collect())


def test_ranks(spark):
    df = spark.createDataFrame([(g, x) for g in range(3) for x in [None, *range(40)] * (1 + g)], "g int, x int")
    got = defaultdict(list)
    for r in ranked(df, ["g"], ["x"]).collect():
        got[r.g].append((r["rank"], r.x is not None, r.x))
    for g, rows in got.items():
        rows.sort()
        assert [r[0] for r in rows] == list(range(41 * (1 + g)))
        assert [r[1:] for r in rows] == sorted((r[1:] for r in rows), key=lambda x: (x[0], x[1] or 0))
