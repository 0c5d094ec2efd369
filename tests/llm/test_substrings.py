import hashlib

from ledgermill.llm.substrings import cut_repeats
from tests.llm import helpers


def brute_force(texts):
    first = {}
    for i, text in texts:
        own = helpers.words(text)
        for p in range(len(own) - 49):
            key = tuple(own[p : p + 50])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, text in texts:
        own = helpers.words(text)
        gone = [False] * len(own)
        for p in range(len(own) - 49):
            if i is not None and first[tuple(own[p : p + 50])] < i:
                gone[p : p + 50] = [True] * 50
        kept = " ".join(w for w, g in zip(own, gone, strict=True) if not g)
        out.append((i, len(own), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def test_edge_cases_against_brute_force(spark):
    texts = helpers.edge_texts()
    want = brute_force(texts)
    got = cut_repeats(helpers.documents(spark, texts), carry=["kept", "n_chars"], with_text=True).collect()
    rows = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got]
    assert sorted(map(str, rows)) == sorted(map(str, want))
    assert sum(r[2] for r in want) > 500
    by_id = {i: t for i, t in texts}
    for r in got:
        if not r["n_removed"] and r["doc_id"] not in (None, 90, 91):
            assert r["kept_text"] == (by_id[r["doc_id"]] or "")
        assert hashlib.sha256(" ".join(helpers.words(r["kept_text"])).encode()).hexdigest() == r["kept_sha256"]


def test_empty_table(spark):
    assert cut_repeats(helpers.documents(spark, [(1, "a")]).limit(0)).collect() == []
