import math
import random
from collections import Counter

import numpy as np
import pytest

from ledgermill.llm.additive import FEATURES, additive_scores, fit
from ledgermill.llm.neighbours import EDGES, STEMS, Index, neighbour_scores
from tests.llm import helpers

LABELS = "id bigint, label int"


def test_nearest_examples_are_exact():
    rnd = np.random.default_rng(0)
    vectors = [
        (np.sort(rnd.choice(40, n, replace=False)), rnd.integers(1, 5, n).astype(float)) for n in rnd.integers(0, 8, 500)
    ]
    index = Index(1 + rnd.random(40), list(range(500)), rnd.integers(0, 2, 500).astype(float), np.ones(500), vectors)
    dense = np.zeros((500, 40))
    for i, (terms, values) in enumerate(index.vectors):
        dense[i, terms] = values
    for _ in range(50):
        n = int(rnd.integers(1, 8))
        terms, values = index.vector(np.sort(rnd.choice(40, n, replace=False)), rnd.integers(1, 5, n).astype(float))
        query = np.zeros(40)
        query[terms] = values
        all_cosines = dense @ query
        order = np.lexsort((index.ids, -np.round(all_cosines, 12)))[:9]
        order = order[all_cosines[order] > 0]
        places, cosines = index.nearest(terms, values, 9)
        np.testing.assert_allclose(cosines, all_cosines[order], atol=1e-9)
        assert len(places) == len(order)


def test_toxic_words_are_learnt_with_their_inflected_forms(spark):
    rnd = random.Random(3)
    stems = ("loweisen", "kragefor")
    rows, labels = [], []
    for i in range(300):
        words = helpers.prose(rnd, 60).split(" ")
        toxic = i % 5 == 0
        if toxic:
            words[rnd.randrange(60)] = rnd.choice(stems) + f"x{i}"
            words[rnd.randrange(60)] = "IDIOT!"
        rows.append((i, " ".join(words)))
        if i % 3:
            labels.append((i, int(toxic)))
    rows += [(1000, helpers.prose(rnd, 40) + " loweisennew"), (1001, helpers.prose(rnd, 40)), (None, None), (1002, "")]
    truth = {i: i % 5 == 0 for i in range(300)} | {1000: True, 1001: False, 1002: False, None: False}
    got = neighbour_scores(helpers.documents(spark, rows), spark.createDataFrame([*labels, (None, 1), (7, None)], LABELS))
    got = got.collect()
    assert len(got) == len(rows)
    assert all((r["score"] >= 0.5) == truth[r["doc_id"]] and 0 <= r["score"] <= 1 for r in got)
    assert all(e % 5 == 0 for r in got if r["doc_id"] == 1000 for e in r["evidence"])


def test_quality_is_learnt_from_form(spark):
    rnd = random.Random(4)
    rows, labels = [], []
    for i in range(300):
        text = helpers.prose(rnd, rnd.randrange(30, 120))
        if i % 3 == 0:
            text = text.upper() if i % 2 else text.replace(" ", " | ")
        rows.append((i, text))
        if i % 4:
            labels.append((i, int(i % 3 != 0)))
    rows += [(i and i + 1000, t) for i, t in helpers.edge_texts() if i is None or i < 20]
    got = additive_scores(helpers.documents(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(rows)
    known = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 300]
    assert sum((r["score"] >= 0.5) == (r["doc_id"] % 3 != 0) for r in known) >= 297
    assert all(0 <= r["score"] <= 1 for r in got)


@pytest.mark.parametrize("scores", [neighbour_scores, additive_scores])
def test_without_labels_and_without_rows(spark, scores):
    docs = helpers.documents(spark, [(1, "a b"), (2, None)])
    labels = spark.createDataFrame([], LABELS)
    assert [0 <= r["score"] <= 1 for r in scores(docs, labels).collect()] == [True, True]
    one_kind = spark.createDataFrame([(1, 1), (1, 1)], LABELS)
    assert len(scores(docs, one_kind).collect()) == 2
    assert scores(docs.limit(0), labels).collect() == []


def test_pairs_of_features_are_found():
    rnd = np.random.default_rng(1)
    features = rnd.random((4000, len(FEATURES)))
    labels = ((features[:, 2] > 0.5) ^ (features[:, 5] > 0.5)).astype(float)
    model = fit(features[:3000], labels[:3000])
    assert (2, 5) in [(i, j) for i, j, _ in model.pairs]
    assert ((model.scores(features[3000:]) >= 0.5) == labels[3000:]).mean() > 0.95


def plain_terms(text):
    out = Counter()
    for word in (text or "").translate(helpers.LOWER).split():
        word = word.encode().strip(EDGES)
        if word:
            out[word] += 1
            out.update(b"^" + word[:n] for n in STEMS if len(word) > n)
    return out


def plain_space(examples, terms, n_docs, frequency, k, prior, weights):
    """A function from a text's counts to its score and evidence, by dense products with all examples (id, label, counts)."""
    idf = {t: math.log((1 + n_docs) / (1 + frequency[t])) + 1 for t in terms}

    def vector(counts):
        out = {t: (1 + math.log(n)) * idf[t] for t, n in counts.items() if t in idf}
        length = math.sqrt(sum(x * x for x in out.values()))
        return {t: x / length for t, x in out.items()}

    vectors = [vector(counts) for _, _, counts in examples]

    def vote(own, without=None):
        cosines = [(sum(x * v.get(t, 0) for t, x in own.items()), i) for i, v in enumerate(vectors) if i != without]
        near = sorted((-round(c, 12), examples[i][0], i) for c, i in cosines if c > 0)[:k]
        top = sum(-c * weights[examples[i][1]] * examples[i][1] for c, _, i in near)
        return (top / sum(-c * weights[examples[i][1]] for c, _, i in near) if near else None), [e for _, e, _ in near[:3]]

    votes = [(vote(v, i)[0], weights[examples[i][1]], examples[i][1]) for i, v in enumerate(vectors)]
    silent = [(w, w * y) for v, w, y in votes if v is None]
    none = (sum(p for _, p in silent) + prior) / (sum(w for w, _ in silent) + 1)
    groups = {}
    for v, w, y in votes:
        if v is not None:
            w0, p0 = groups.get(round(v, 11), (0.0, 0.0))
            groups[round(v, 11)] = (w0 + w, p0 + w * y)
    order = sorted(groups)
    mean = lambda a, b: sum(groups[v][1] for v in order[a : b + 1]) / sum(groups[v][0] for v in order[a : b + 1])
    fits = [max(min(mean(a, b) for b in range(i, len(order))) for a in range(i + 1)) for i in range(len(order))]

    def score(counts):
        found, evidence = vote(vector(counts))
        if found is None:
            return none, []
        if not order:
            return 0.5, evidence
        at = min(sum(v < found - 1e-10 for v in order), len(order) - 1)
        pool = [v for v, fit in zip(order, fits, strict=True) if abs(fit - fits[at]) < 1e-9]
        return (sum(groups[v][1] for v in pool) + prior) / (sum(groups[v][0] for v in pool) + 1), evidence

    return score


@pytest.mark.parametrize("seed", [5, 6])
def test_toxicity_against_plain_search(spark, seed):
    rnd = random.Random(seed)
    texts = []
    for i in range(160):
        words = helpers.prose(rnd, rnd.randrange(1, 60), 150).split(" ")
        if i % 6 == 0:
            words[rnd.randrange(len(words))] = rnd.choice(["brall", "mudgeon!", "MUDGEONLY"])
        texts.append((i, " ".join(words)))
    texts += [(200, None), (201, ""), (202, "unheard"), (203, texts[7][1]), (204, texts[7][1]), (205, texts[6][1] * 400)]
    labels = {i: int(i % 6 == 0) for i, _ in texts if i % 4 and i != 205}
    # All labelled rows fit the sample, so the plain version needs no hashes.
    got = neighbour_scores(
        helpers.documents(spark, texts), spark.createDataFrame([*labels.items(), (1, 0)], LABELS), chance=0.5, k=7
    )
    got = {r["doc_id"]: (r["score"], r["evidence"]) for r in got.collect()}

    counts = {i: plain_terms(t) for i, t in texts}
    frequency = Counter(t for own in counts.values() for t in own)
    n = Counter(labels.values())
    tied = Counter(), Counter()
    for i, label in labels.items():
        tied[label].update(counts[i].keys())
    share, all_terms = n[1] / len(labels), set(tied[0]) | set(tied[1])
    chosen = set()
    for t in all_terms:
        a, b = tied[1][t], tied[0][t]
        tie = sum(x * math.log(x / (a + b) / q) for x, q in ((a, share), (b, 1 - share)) if x)
        if len(t) <= 64 and tie >= math.log(len([u for u in all_terms if len(u) <= 64]) / 0.5):
            chosen.add(t)
    assert len(chosen) > 1
    examples = [(i, label, counts[i]) for i, label in sorted(labels.items())]
    untold = [e for e in examples if not chosen & set(e[2])]
    rest = {t for e in untold for t in e[2]}
    prior = {1: share, 0: sum(label for _, label, _ in untold) / len(untold)}
    one = {0: 1.0, 1: 1.0}
    telling = plain_space(examples, chosen, len(texts), frequency, 7, prior[1], one)
    whole = plain_space(untold, rest, len(texts), frequency, 7, prior[0], one)
    for i, own in counts.items():
        score, evidence = (telling if chosen & set(own) else whole)(own)
        assert got[i][0] == pytest.approx(score, abs=1e-9), i
        assert got[i][1] == evidence, i
        assert bool(evidence) == bool(set(own) & (rest | chosen)), i


def test_an_id_of_many_rows_is_one_example(spark):
    rnd = random.Random(8)
    rows = [(1, helpers.prose(rnd, 30)) for _ in range(500)] + [(1, "short one"), (2, "brall brall"), (3, "short brall")]
    labels = spark.createDataFrame([(1, 0), (1, 0), (2, 1)], LABELS)
    got = neighbour_scores(helpers.documents(spark, rows), labels).collect()
    assert len(got) == len(rows)
    assert next(r["evidence"] for r in got if r["doc_id"] == 3) == [2, 1]


def test_quality_takes_one_row_of_an_id_that_many_share(spark):
    rnd = random.Random(9)
    rows = [(i, helpers.prose(rnd, 60) if i % 2 else "$$$ ### " * 20) for i in range(80)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(1, 1)] * 3, LABELS)
    once = additive_scores(helpers.documents(spark, rows), labels).collect()
    often = additive_scores(helpers.documents(spark, rows + [rows[1]] * 400), labels).collect()
    assert {(r["doc_id"], r["score"]) for r in once} == {(r["doc_id"], r["score"]) for r in often}
    assert len(often) == len(rows) + 400
