"""Shards against a plain best-fit-decreasing packing, item by item."""

import bisect
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgermill.llm.shards import Rooms, best_fit_decreasing, near_equal, shard_documents, size_class
from tests.llm import helpers


def plain_loads(sizes, capacity):
    loads = []
    for size in sorted(sizes, reverse=True):
        fits = [i for i, load in enumerate(loads) if load + size <= capacity]
        if fits:
            best = max(fits, key=lambda i: loads[i])
            loads[best] += size
        else:
            loads.append(size)
    return sorted(loads)


def loads_of(placed):
    loads = Counter()
    for size, shard, groups in placed:
        loads[shard] += size * groups
    return sorted(loads.values())


@pytest.mark.parametrize("seed", range(40))
def test_runs_of_equal_groups_pack_like_single_ones(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([10, 50, 1000])
    sizes = [rnd.randint(1, rnd.choice([5, capacity, capacity + 5])) for _ in range(rnd.randint(0, 300))]
    placed = best_fit_decreasing(Counter(sizes), capacity)
    assert loads_of(placed) == plain_loads(sizes, capacity)
    assert Counter(size for size, _, n in placed for _ in range(n)) == Counter(sizes)
    shards = len(loads_of(placed))
    assert best_fit_decreasing(Counter(sizes), capacity, shards) == placed
    assert not shards or best_fit_decreasing(Counter(sizes), capacity, shards - 1) is None


@pytest.mark.parametrize("seed", range(20))
def test_near_equal_sizes(seed):
    rnd = random.Random(seed)
    sizes = [rnd.randint(1, 100) for _ in range(500)] + [rnd.choice([1, 5000, 40_000])] * (seed % 3)
    placed = near_equal(Counter(sizes), 8)
    assert Counter(size for size, _, n in placed for _ in range(n)) == Counter(sizes)
    assert {shard for _, shard, _ in placed} <= set(range(8))
    ordinary = loads_of([x for x in placed if x.size <= 100])
    alone = [size for size in sizes if size > 100 and size * 8 > sum(sizes)]
    assert len(ordinary) == 8 - len(alone)
    if not alone:
        ordinary = loads_of(placed)
    assert ordinary[-1] - ordinary[0] <= 8


def test_the_tree_finds_the_tightest_room_and_stays_balanced():
    rnd, rooms, have = random.Random(3), Rooms(), []
    for shard in range(3000):
        if have and rnd.random() < 0.4:
            size = rnd.randrange(500)
            at = bisect.bisect_left(have, (size, -1))
            assert rooms.take_tightest(size) == (have.pop(at) if at < len(have) else None)
        room = rnd.randrange(500) if shard % 2 else shard
        rooms.add(room, shard)
        bisect.insort(have, (room, shard))
    assert rooms._top.height <= 16


def test_size_classes(spark):
    sizes = [1, 2, 4095, 4096, 4097, 8191, 8193, 10**6 + 1, 2**40 + 1, 2**62 - 1]
    got = spark.createDataFrame([(s,) for s in sizes], "s long").select("s", size_class("s").alias("c")).collect()
    for r in got:
        assert r.s <= r.c <= r.s + r.s // 2048
        assert r.s >= 4096 or r.s == r.c
        assert bin(r.c).rstrip("0").count("") <= 15


def check(rows, texts):
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in texts)
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    slots, group = defaultdict(list), {}
    for r in rows:
        slots[r.shard].append((r.slot, r.doc_id is not None, r.doc_id))
        assert group.setdefault((r["size"], r.text_crc32), r.shard) == r.shard
    for own in slots.values():
        own.sort()
        assert [s for s, _, _ in own] == list(range(len(own)))
        assert [i for _, _, i in own] == [i for _, _, i in sorted(own, key=lambda x: (x[1], x[2] or 0))]


def test_edge_cases_into_eight_shards(spark):
    texts = helpers.edge_texts()
    docs = helpers.documents(spark, texts).withColumns({"size": F.lit("x"), "hash": F.lit("y"), "shard": F.lit(1)})
    rows = shard_documents(docs).collect()
    check(rows, texts)
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r["size"]
    large = sizes.pop(next(r.shard for r in rows if r.doc_id == 10))  # one text has more than all others
    assert large == len(dict(texts)[10]) + 1 and set(sizes) | {7} == set(range(8))
    assert max(sizes.values()) - min(sizes.values()) <= 60


def test_shards_of_a_capacity_and_a_hot_group(spark):
    rnd = random.Random(4)
    texts = [(i, "copy " * 20) for i in range(300)] + [(300 + i, "y" * rnd.randint(0, 400)) for i in range(600)]
    rows = shard_documents(helpers.documents(spark, texts), shards=None, capacity=2000).collect()
    check(rows, texts)
    groups = Counter()
    for _, t in texts:
        groups[t] += len(t) + 1
    rounded = [-(-g // 16) * 16 if g > 32768 else -(-g // 8) * 8 if g > 16384 else g for g in groups.values()]
    hot = next(r.shard for r in rows if r.doc_id == 0)
    assert {r.doc_id for r in rows if r.shard == hot} == set(range(300))
    assert len({r.shard for r in rows}) == len(plain_loads(rounded, 2000))


def test_an_empty_table_and_wrong_arguments(spark):
    docs = helpers.documents(spark, [(1, "a")])
    assert shard_documents(docs.limit(0)).collect() == []
    assert shard_documents(docs).count() == 1
    with pytest.raises(ValueError, match="either"):
        shard_documents(docs, shards=8, capacity=10)
