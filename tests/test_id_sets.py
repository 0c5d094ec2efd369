"""Sets of ids against plain sets and counts."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgermill.operators import id_sets
from ledgermill.operators.keys import repeated_keys

EDGES = [0, 1, 63, 64, 127, -1, -63, -64, -65, 2**31, 2**63 - 1, -(2**63)]


def sample(seed: int, spread: int) -> list[tuple]:
    rng = random.Random(seed)
    ids = [rng.randrange(-spread, spread) for _ in range(400)] + EDGES + rng.sample(EDGES, 3)
    rows = [(i, rng.choice([1, 2, None]), rng.choice("xy")) for i in ids]
    return rows + [(ids[0], 1, "x")] * 50 + [(None, 1, "x"), (None, None, "y")]


@pytest.mark.parametrize("spread", [100, 10**4, 2**62])
def test_counts_and_repeats(spark, spread):
    rows = sample(3, spread)
    df = spark.createDataFrame(rows, "id long, k int, m string").repartition(5)
    words = id_sets.id_words(df, "id", "k", "m")
    per_key, overall = defaultdict(set), {i for i, _, _ in rows} - {None}
    for i, k, _ in rows:
        per_key[k] |= {i} - {None}
    assert dict(map(tuple, id_sets.distinct_ids(words, "k").collect())) == {k: len(v) for k, v in per_key.items()}
    assert id_sets.distinct_ids(words).first().ids == len(overall)
    assert words.agg(F.sum(id_sets.ROWS)).first()[0] == len(rows)

    repeats = {i: n for i, n in Counter(i for i, _, _ in rows).items() if n > 1}
    assert dict(map(tuple, id_sets.repeated_ids(df, "id").collect())) == repeats
    assert dict(map(tuple, repeated_keys(df, "id").collect())) == repeats
    stored = id_sets.repeated_ids(df, "id", words)
    assert dict(map(tuple, stored.collect())) == repeats

    per_pair = Counter((k, i) for i, k, _ in rows if i is not None)
    surplus = Counter()
    for (k, _), n in per_pair.items():
        surplus[k] += n - 1
    got = dict(map(tuple, id_sets.surplus_rows(df, "id", words, "k").collect()))
    assert got == {k: n for k, n in surplus.items() if n}


def test_empty_tables_and_lone_nulls(spark):
    empty = spark.createDataFrame([], "id int, k int")
    assert id_sets.distinct_ids(id_sets.id_words(empty, "id")).first().ids == 0
    assert id_sets.distinct_ids(id_sets.id_words(empty, "id", "k"), "k").collect() == []
    assert id_sets.repeated_ids(empty, "id").collect() == []
    one = spark.createDataFrame([(None, 1)], "id int, k int")
    assert id_sets.repeated_ids(one, "id").collect() == []
    assert tuple(id_sets.distinct_ids(id_sets.id_words(one, "id", "k"), "k").first()) == (1, 0)


def test_ids_are_not_shuffled_when_none_repeats(spark, tmp_path):
    """Dense ids leave a scan as words, and the second pass is dropped at run time."""
    spark.range(0, 200_000, 1, 4).write.parquet(str(tmp_path / "t"))
    repeats = id_sets.repeated_ids(spark.read.parquet(str(tmp_path / "t")), "id")
    assert repeats.collect() == []
    plan = repeats._jdf.queryExecution().executedPlan()
    assert "isFinalPlan=true" in plan.toString()
    final = plan.toString().split("Initial Plan")[0]
    assert "Scan parquet" not in final or "EmptyRelation" in final
    words = id_sets.id_words(spark.read.parquet(str(tmp_path / "t")), "id")
    assert words.count() == 200_000 // 64
