import re

import numpy as np
import pytest

from ledgermill.llm.pivots import near_vectors
from ledgermill.llm.queries import URL_RULES
from ledgermill.llm.url_rules import SPAM_PATTERNS, judge_urls, prefix_rule
from tests.llm import helpers

URLS = [
    None,
    "",
    "no scheme.org/es/",
    "http://example.org/es/1",
    "http://EXAMPLE.org/es/1?x=/en/1",
    "https://a.b.example.org/en/12#t",
    "https://example.org/en/2",
    "http://notexample.org/es/",
    "http://example.org",
    "http://example.org?q",
    "http://x.com/fr/",
    "http://x.com/FR/",
    "http://x.com/de/",
    "http://x.com:80/de/",
    "http://xcom/de/",
    "http://com/de/",
    "http://cheap-pills.example.net/",
    "http://spam.example.org/",
    "http://spamfree.example.net/",
    "ftp://x.net/a/casino\nb",
    "http://é.org/ü",
    "http://y.org://z.com/de/",
    "http://" + "x" * 5000 + ".com/de/",
    "http://a.$(b.com/de/\\E.*",
]


def brute_force(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = host.translate(helpers.LOWER)
    fitting = []
    for name, verdict in URL_RULES:
        rule_host, slash, rule_path = name.partition("/")
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(slash + rule_path):
            fitting.append((len(name), verdict == "block", name, verdict))
    if fitting:
        return host, path, max(fitting)[2], max(fitting)[3]
    bad = re.search(r"(^|[^a-z0-9])(spam|casino|cheap[^a-z0-9]pills)($|[^a-z0-9])", host)
    bad = bad or re.search(r"(^|[^A-Za-z0-9])casino($|[^A-Za-z0-9])", path)
    return host, path, None, "block" if bad else "allow"


def test_verdicts_against_brute_force(spark):
    rows = [(i % 20 if i % 7 else None, url, "x", "y") for i, url in enumerate(URLS * 2)]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string, verdict string")
    rules = [*[prefix_rule(*r) for r in URL_RULES], *SPAM_PATTERNS]
    got = judge_urls(pages, rules).collect()
    want = [(i, *brute_force(url)) for i, url, _, _ in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert judge_urls(pages.limit(0), rules).collect() == []
    assert len(judge_urls(pages, []).collect()) == len(rows)


def test_vectors_against_brute_force(spark):
    rnd = np.random.default_rng(2)
    rows = []
    for center in rnd.normal(size=(12, 32)):
        rows += [center + rnd.normal(size=32) * s for s in rnd.choice([0.0, 0.1, 0.2, 0.3], 12)]
    hot = rnd.normal(size=32)
    rows += [hot * rnd.uniform(0.5, 9) + rnd.normal(size=32) * 0.02 for _ in range(120)]
    vectors = [(i + 5, [float(x) for x in np.float32(v)]) for i, v in enumerate(rows)]
    odd = [(0, None), (1, []), (2, [0.0] * 32), (3, [float("nan")] * 32), (4, [None] * 32), (None, vectors[0][1])]
    odd += [(900, [float("inf")] + [1.0] * 31), (901, [1.0, 2.0]), (902, [2.0, 4.0]), (903, [1e30] * 32), (904, [1e-30] * 32)]
    frame = spark.createDataFrame(
        [(i, v, "x", 1) for i, v in vectors + odd], "vec_id long, embedding array<float>, label string, n_links int"
    ).repartition(4)
    got = {r["vec_id"]: r for r in near_vectors(frame, block=50).collect()}
    usable = vectors + [odd[7], odd[8], odd[9], odd[10]]
    links = []
    for n, (i, x) in enumerate(usable):
        for j, y in usable[:n]:
            if len(x) == len(y):
                a, b = np.array(np.float32(x), float), np.array(np.float32(y), float)
                if a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= 0.95:
                    links.append((i, j))
    component = helpers.components([i for i, _ in usable], links)
    want = {i: sum(i in link for link in links) for i, _ in usable}
    found = sum(got[i]["n_links"] for i in want)
    assert all(got[i]["n_links"] <= n for i, n in want.items())
    assert found >= 0.98 * 2 * len(links)
    assert [got[i]["component_id"] for i in component] == list(component.values())
    for i, _ in odd[:6]:
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert near_vectors(frame.limit(0)).collect() == []


@pytest.mark.parametrize("copies", [2])
def test_repeated_vector_ids_are_not_linked_with_each_other(spark, copies):
    frame = spark.createDataFrame([(1, [1.0, 0.0])] * copies + [(2, [1.0, 0.0])], "vec_id long, embedding array<float>")
    got = near_vectors(frame).collect()
    assert len(got) == copies + 1 and {r["component_id"] for r in got} == {1}
