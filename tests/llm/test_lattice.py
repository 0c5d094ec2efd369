import zlib
from collections import Counter
from math import exp, isclose, log, log10

import public_tokenizers
import pytest

from ledgermill.llm.lattice import Lattice, held_out_by_id, lattice_scores, vocabulary
from tests.llm import helpers

PATH = public_tokenizers.path("piece_bpe_32k.model")


def segmentations(text, pieces):
    if not text:
        yield 0.0
    for end in range(1, len(text) + 1):
        if text[:end] in pieces:
            for rest in segmentations(text[end:], pieces):
                yield pieces[text[:end]] + rest


def test_forward_sums_all_segmentations():
    pieces = {p: log(w) for p, w in {"▁": 0.1, "▁a": 0.2, "a": 0.1, "b": 0.1, "ab": 0.2, "aba": 0.05, "ba": 0.1}.items()}
    model = Lattice(pieces, log(0.001))
    for word in ("a", "ab", "abab", "babaab"):
        want = log(sum(map(exp, segmentations("▁" + word, pieces))))
        assert isclose(model.log_probability(word), want)
        uses = {}
        assert model.expected(word, 2.0, uses) == 0
        assert isclose(sum(len(p) * n for p, n in uses.items()), 2.0 * (1 + len(word)))
    assert isclose(model.log_probability("é"), log(0.1) + 2 * log(0.001))
    assert vocabulary(PATH).log_probability("x" * 5000) < -1000


def test_expected_uses_are_the_same_with_and_without_logarithms(monkeypatch):
    model = vocabulary(PATH)
    for word in ("the", "thing", "ñandú", "東京x", "a1-b2.", "x" * 12, "\x00\x01"):
        found = []
        for short in (12, 0):
            monkeypatch.setattr("ledgermill.llm.lattice.SHORT", short)
            uses = {}
            found.append((model.expected(word, 3.0, uses), uses))
        assert isclose(found[0][0], found[1][0], abs_tol=1e-12)
        assert found[0][1].keys() == found[1][1].keys()
        assert all(isclose(n, found[1][1][p], rel_tol=1e-9, abs_tol=1e-12) for p, n in found[0][1].items())


@pytest.mark.parametrize("head_words", [0, 50, 1 << 17])
def test_counts_and_base_scores_against_brute_force(spark, head_words):
    texts = helpers.edge_texts()
    tokens = [[*helpers.words((t or "").translate(helpers.LOWER)), None] for _, t in texts]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in texts]
    counts = Counter()
    for own, out in zip(tokens, held, strict=True):
        if not out:
            counts.update(own)
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for (i, _), own, out in zip(texts, tokens, held, strict=True):
        base = sum(log10((counts[w] + 1) / (n + v + 1)) for w in own)
        want[i, out, len(own), sum(counts[w] > 0 for w in own), n, round(base, 6)] += 1
    docs = helpers.documents(spark, texts)
    got = lattice_scores(docs, held_out_by_id("doc_id", 7, 2), PATH, head_words=head_words).collect()
    assert Counter((*tuple(r)[:5], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 for r in got)


def test_nothing_to_learn_from(spark):
    docs = helpers.documents(spark, [(1, "a b"), (2, None)])
    from pyspark.sql import functions as F

    got = {r["doc_id"]: r for r in lattice_scores(docs, F.lit(True), PATH).collect()}
    assert (got[1]["n_tokens"], got[1]["n_known"], got[1]["train_tokens"]) == (3, 0, 0)
    assert got[2]["base_score"] == 0 and got[1]["score"] < got[2]["score"] < 0
    assert lattice_scores(docs.limit(0), F.lit(False), PATH).collect() == []
