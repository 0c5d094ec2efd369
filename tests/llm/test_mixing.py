from collections import defaultdict

import duckdb

from ledgermill.llm import mixing
from tests.llm import helpers


def test_marginals_reach_the_targets_and_sampling_follows_rates(spark):
    texts = [(i, f"{'word ' * (5 + i % 40)}." + " | | |" * (i % 3 == 0)) for i in range(600)]
    docs = helpers.documents(spark, texts)
    targets = {"mix_lang": {"en": 0.5, "de": 0.2, "": 0.3}, "mix_source": {"s0": 0.6, "s1": 0.3, "": 0.1}}
    rows = mixing.mix_documents(docs, targets=targets, sweeps=30).collect()
    assert len(rows) == 600 and 0 < sum(r["sampled"] for r in rows) < 600
    expected, total = defaultdict(float), 0.0
    for r in rows:
        assert 0 <= r["mix_rate"] <= 1 + 1e-9
        weight = r["mix_rate"] * r["n_tokens"]
        total += weight
        for name in ("mix_lang", "mix_source"):
            expected[name, r[name]] += weight
    for name, shares in targets.items():
        for value, share in shares.items():
            assert abs(expected[name, value] / total - share) < 1e-3
    assert max(r["mix_rate"] for r in rows) > 1 - 1e-9


def test_edge_cases_against_sql(spark, tmp_path):
    docs = helpers.documents(spark, [(i, t) for i, t in helpers.edge_texts() if i is not None])
    docs.write.parquet(str(tmp_path / "documents"))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
    result = connection.execute(mixing.oracle())
    names = [c[0] for c in result.description]
    want = sorted(str(dict(zip(names, row, strict=True))) for row in result.fetchall())
    mixed = mixing.mix_documents(docs)
    assert set(docs.columns) <= set(mixed.columns)
    got = [{n: round(r[n], 6) if n == "mix_rate" else r[n] for n in names} for r in mixed.collect()]
    assert sorted(map(str, got)) == want


def test_null_ids_and_empty_tables(spark):
    docs = helpers.documents(spark, [(None, "a b c"), (1, None)])
    got = {r["doc_id"]: r for r in mixing.mix_documents(docs).collect()}
    assert got[1]["mix_rate"] == 0 and not got[1]["sampled"] and got[None]["mix_rate"] == 1
    assert mixing.mix_documents(docs.limit(0)).collect() == []


def test_no_python_in_the_plan(spark):
    plan = mixing.mix_documents(helpers.documents(spark, [(1, "a")]))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("MapInArrow", "MapInPandas", "PythonUDF", "ArrowEvalPython"))
