"""The pipeline's near_dedup against brute force at its own threshold of 0.80."""

import random

import corpus_pipeline
from tests.llm import helpers
from tests.llm.test_near_copies import shingles


def test_near_copies_from_80_percent_on_are_dropped(spark, tmp_path):
    rnd = random.Random(11)
    texts = []
    for group in range(30):
        base = [f"g{group}w{rnd.randrange(10**6)}" for _ in range(100)]
        changed = list(base)
        start = rnd.randrange(20, 60)
        changed[start : start + 2 + group % 10] = [f"x{rnd.randrange(10**6)}" for _ in range(2 + group % 10)]
        texts += [(2 * group, " ".join(base)), (2 * group + 1, " ".join(changed))]
    sets = {i: shingles(t) for i, t in texts}
    share = {(i, j): len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i in sets for j in sets if i < j}
    assert sum(0.8 <= x < 0.85 for x in share.values()) >= 3
    assert sum(0.7 <= x < 0.8 for x in share.values()) >= 3
    component = helpers.components(sorted(sets), [pair for pair, x in share.items() if x >= 0.8])
    got = corpus_pipeline.near_dedup(spark, helpers.documents(spark, texts), str(tmp_path))
    assert sorted(r.doc_id for r in got.collect()) == sorted(i for i in sets if component[i] == i)


def test_rows_of_one_id_are_documents_of_their_own(spark, tmp_path):
    a, z, q = ("one two three four five six seven eight nine", "other words that nobody else has at all", "short text")
    texts = [(1, a), (2, a), (2, z), (3, q), (4, z), (4, z), (None, q), (None, None), (None, ""), (5, "")]
    docs = helpers.documents(spark, texts)
    got = corpus_pipeline.near_dedup(spark, docs, str(tmp_path))
    assert got.dtypes == docs.dtypes
    kept = sorted((str(r.doc_id), str(r.text)) for r in got.collect())
    want = [(1, a), (2, z), (3, q), (None, None), (None, ""), (5, "")]
    assert kept == sorted((str(i), str(t)) for i, t in want)


def test_copies_under_one_id_leave_one(spark, tmp_path):
    near = ["w%d" % i for i in range(60)]
    texts = [(7, " ".join(near)), (7, " ".join(near)), (7, " ".join([*near[:59], "x"])), (6, "quite another text of six words")]
    got = corpus_pipeline.near_dedup(spark, helpers.documents(spark, texts), str(tmp_path)).collect()
    assert sorted(r.doc_id for r in got) == [6, 7]
