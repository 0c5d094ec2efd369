import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgermill.llm.packing import pack, plan, reduced
from tests.llm import helpers

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_edge_cases_against_the_tokenizer(spark):
    texts = helpers.edge_texts()
    tokenizer = Tokenizer.from_file(PATH)
    want = Counter()
    for i, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 2048):
            part = np.array(ids[k : k + 2048], dtype="<u4")
            want[i, k // 2048, k, len(part), zlib.crc32(part.tobytes())] += 1
    got = pack(helpers.documents(spark, texts), PATH, with_ids=True).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        assert len(r["ids"]) == r["length"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048


def test_empty_table(spark):
    assert pack(helpers.documents(spark, [(1, "a")]).limit(0), PATH).collect() == []


def fewest(sizes, capacity):
    """The fewest bins, by trying all placements."""
    best = len(sizes)

    def place(at, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if at == len(sizes):
            best = len(bins)
            return
        for k, free in enumerate(bins):
            if free >= sizes[at] and free not in bins[:k]:
                place(at + 1, [*bins[:k], free - sizes[at], *bins[k + 1 :]])
        place(at + 1, [*bins, capacity - sizes[at]])

    place(0, [])
    return best


@pytest.mark.parametrize("seed", range(60))
def test_reduction_keeps_an_optimum_and_the_plan_places_all(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([10, 13, 20])
    sizes = sorted((rnd.randint(1, capacity) for _ in range(rnd.randint(0, 9))), reverse=True)
    counts = dict(Counter(sizes))
    fixed, left = reduced(counts, capacity)
    rest = [size for size, n in left.items() for _ in range(n)]
    assert sum(n for n, _ in fixed) + fewest(sorted(rest, reverse=True), capacity) == fewest(sizes, capacity)
    patterns = plan(counts, capacity)
    placed = Counter(itertools.chain.from_iterable(lengths * n for n, lengths in patterns))
    assert placed == Counter(sizes) and all(sum(lengths) <= capacity for _, lengths in patterns)
    assert sum(n for n, _ in patterns) <= fewest(sizes, capacity) + 1
