"""Links of vectors where a third of all rows are near-copies or copies of one, against brute force."""

import numpy as np
import pytest

from ledgermill.llm.pivots import near_vectors


def links(vectors, ids):
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1)[:, None]
    out = np.zeros(ids.max() + 1, dtype=np.int64)
    for low in range(0, len(ids), 500):
        linked = (unit[low : low + 500] @ unit.T >= 0.95) & (ids[low : low + 500, None] != ids)
        np.add.at(out, ids[low : low + 500], linked.sum(axis=1))
    return out


@pytest.mark.parametrize("n", [3000, 12000])
def test_a_third_of_near_copies_is_found_at_two_sizes(spark, n):
    rnd = np.random.default_rng(n)
    vectors = rnd.normal(size=(n, 64))
    vectors[: n // 3] = rnd.normal(size=64) + rnd.normal(size=(n // 3, 64)) * 0.22
    vectors[n // 3 : n // 2] = vectors[0]
    vectors = np.float32(vectors)
    ids = rnd.permutation(n)
    rows = list(zip(ids.tolist(), vectors.tolist(), strict=True))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = {r["vec_id"]: r["n_links"] for r in near_vectors(frame).collect()}
    want = links(vectors, ids)
    assert all(got[i] <= want[i] for i in range(n))
    assert sum(got.values()) >= 0.999 * want.sum()


def test_repeated_ids_and_copies_are_counted_by_row(spark):
    x, y, z = [1.0, 0.0, 0.0], [1.0, 0.1, 0.0], [0.0, 1.0, 0.0]
    rows = [(1, x), (1, x), (2, x), (3, x), (3, y), (4, y), (5, z), (5, z), (6, z), (7, [2.0, 0.0, 0.0]), (8, None)]
    vectors, ids = np.array([v for _, v in rows[:-1]]), np.array([i for i, _ in rows[:-1]])
    want = links(vectors, ids)
    got = near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert sorted((r["vec_id"], r["n_links"]) for r in got) == sorted((i, int(want[i]) if i < 8 else 0) for i, _ in rows)
    assert {r["vec_id"]: r["component_id"] for r in got} == {1: 1, 2: 1, 3: 1, 4: 1, 5: 5, 6: 5, 7: 1, 8: 8}
