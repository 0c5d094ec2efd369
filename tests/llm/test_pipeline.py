"""The pipeline's stages, each on what its predecessor kept, against plain versions; and the registered queries."""

import zlib

import duckdb
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from ledgermill.llm import common, mixing
from tests.llm import helpers
from tests.llm.test_line_rules import base_counts
from tests.llm.test_near_copies import brute_force as components
from tests.llm.test_substrings import brute_force as cuts


def test_stages_against_plain_versions(spark, tmp_path):
    table = helpers.documents(spark, helpers.edge_texts())
    table.write.parquet(str(tmp_path / "documents.parquet"))
    results = [spark.read.parquet(str(tmp_path / "documents.parquet"))]
    for name, stage in corpus_pipeline.STAGES:
        results.append(common.saved(stage(spark, results[-1], str(tmp_path)), name))
    assert all(df.columns == table.columns and df.dtypes == table.dtypes for df in results[:5])
    docs, clean, apart, cut, mixed, packed = (df.collect() for df in results)

    # Rows of one id are told apart by the text they came with.
    passing = [r for r in docs if not base_counts(r.text)[-1]]
    assert {r.doc_id for r in clean} <= {r.doc_id for r in passing}
    kept_lines = {(r.row, line) for r in docs for line in (r.text or "").split("\n")}
    assert all((r.row, line) in kept_lines for r in clean for line in r.text.split("\n"))
    prose = {r.row for r in passing if r.doc_id is None or r.doc_id >= 20}
    assert prose <= {r.row for r in clean}
    assert all(r.n_chars == len(r.text) for r in [*clean, *apart, *cut, *mixed])

    # Every row is a document of its own; of a group, a row with the smallest id stays.
    numbered = sorted(clean, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.row))
    groups = {}
    found = components([(n, r.text) for n, r in enumerate(numbered)], corpus_pipeline.SIMILAR_PERCENT)
    for r, group in zip(numbered, found, strict=True):
        groups.setdefault(group, []).append(r)
    group_of = {r.row: group for group, rows in groups.items() for r in rows}
    assert sorted(group_of[r.row] for r in apart) == sorted(groups)
    assert all(r.doc_id == groups[group_of[r.row]][0].doc_id for r in apart)
    assert 0 < len(apart) < len(clean)

    want = sorted(str((r.row, *c[1:3])) for r, c in zip(apart, cuts([(r.doc_id, r.text) for r in apart]), strict=True))
    before = {r.row: len(helpers.words(r.text)) for r in apart}
    got = sorted(str((r.row, before[r.row], before[r.row] - len(helpers.words(r.text)))) for r in cut)
    assert got == want

    connection = duckdb.connect()
    results[3].write.parquet(str(tmp_path / "cut"))
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/cut/*.parquet')")
    drawn = connection.execute(f"SELECT doc_id, n_tokens FROM ({mixing.oracle()}) WHERE sampled AND doc_id IS NOT NULL")
    assert sorted(drawn.fetchall()) == sorted((r.doc_id, len(helpers.words(r.text))) for r in mixed if r.doc_id is not None)

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = []
    for r in mixed:
        ids = [*tokenizer.encode(r.text, add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            part = np.array(ids[k : k + 2048], dtype="<u4")
            pieces.append((r.doc_id, k // 2048, k, len(part), zlib.crc32(part.tobytes())))
    assert sorted(map(str, pieces)) == sorted(str(tuple(r)[:5]) for r in packed)


def test_an_empty_table_passes_through(spark, tmp_path):
    helpers.documents(spark, [(1, "a")]).limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_all_queries_are_registered():
    names = list(__spark_entry__.queries())
    assert [n.split("_")[0] for n in names if n.startswith("op")] == [f"op{i}" for i in range(1, 14)]
    assert "pipeline" in names
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_dedup", "substring_dedup", "mixing", "packing",
    ]
