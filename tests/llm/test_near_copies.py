import random

import pytest

from ledgermill.llm.common import connected_components
from ledgermill.llm.near_copies import least_matches, near_copies
from tests.llm import helpers


def shingles(text):
    own = helpers.words((text or "").translate(helpers.LOWER))
    if not own:
        return frozenset()
    return frozenset(tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4)))


def brute_force(texts, percent=85):
    """The component of each row; rows with the same set are a node named by the smallest id."""
    node = {}
    for i, t in texts:
        if i is not None and shingles(t):
            node[shingles(t)] = min(node.get(shingles(t), i), i)
    links = [(node[x], node[y]) for x in node for y in node if 100 * len(x & y) >= percent * len(x | y)]
    component = helpers.components(sorted(node.values()), links)
    return [i if i is None or not shingles(t) else component[node[shingles(t)]] for i, t in texts]


def test_edge_cases_against_brute_force(spark):
    texts = helpers.edge_texts()
    want = [(i, len(shingles(t)), c, i == c) for (i, t), c in zip(texts, brute_force(texts), strict=True)]
    got = near_copies(helpers.documents(spark, texts)).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_a_large_group_of_near_copies_is_joined_through_hubs(spark):
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(3000)}" for _ in range(120)]
    texts = []
    for i in range(150):
        own = list(base)
        for _ in range(rnd.choice([0, 1, 1, 2, 3, 6])):
            own[rnd.randrange(len(own))] = f"x{rnd.randrange(10**6)}"
        texts.append((1000 - i, " ".join(own)))
    got = {r["doc_id"]: r["component_id"] for r in near_copies(helpers.documents(spark, texts)).collect()}
    assert got == {i: c for (i, _), c in zip(texts, brute_force(texts), strict=True)}


def test_empty_table(spark):
    assert near_copies(helpers.documents(spark, [(1, "a")]).limit(0)).collect() == []


def test_least_matches_leaves_out_almost_no_pair_at_the_threshold():
    assert 36 <= least_matches(64, 85) <= 42
    assert least_matches(64, 100) == 64


@pytest.mark.parametrize("seed", range(3))
def test_connected_components(spark, seed):
    rnd = random.Random(seed)
    links = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(40)] + [(i, i + 1) for i in range(100, 130)]
    got = connected_components(spark.createDataFrame(links, "a long, b long"))
    nodes = sorted({x for a, b in links if a != b for x in (a, b)})
    assert {r["node"]: r["component"] for r in got.collect()} == helpers.components(nodes, links)
