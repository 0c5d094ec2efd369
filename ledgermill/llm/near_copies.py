"""Near-copies by an inverted join over MinHash signature coordinates.

A document's set holds its distinct runs of `run_words` words (A-Z lower-cased); with fewer words, the whole sequence.
Documents whose sets overlap by `percent` or more of their union are linked; links are confirmed on the full sets.

1. One pass hashes every set and takes `coordinates` minima of it. Documents with the same set become one node.
2. Nodes are posted under each (coordinate, value) pair, and pairs that only one node has are dropped. A link needs at
   least `t` equal coordinates (the chance that a pair at the threshold has fewer is below 1e-5), so two linked nodes
   share one of their rarest `coordinates - t + 1` postings. Only those lists, the prefix, are merged. The longest
   t - 1 lists of a node are skipped: its candidates' other coordinates are counted by comparing signatures.
3. Pairs with t or more equal coordinates are compared on their full sets.

A group of g near-copies shares its postings, and its g * g / 2 pairs are never formed. While lists hold many pairs of
nodes from different components, each list is only compared with one of its nodes, and the confirmed links are merged
into components; pairs within a component need no comparison. Then all pairs that remain between components are
compared, so no link between components is lost. Pairs are not formed either where their set sizes, and the runs that
only one of them has among all candidates, keep them below the threshold.

Defined results: NULL and empty texts have empty sets and link with nothing. Rows that repeat a doc_id are judged each by
their own text; sets of which an id is the smallest count as one node. Rows without doc_id link with nothing, and are
kept, with a NULL component. Other columns are not read.
"""

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm import common


def least_matches(coordinates: int, percent: int, miss: float = 1e-5) -> int:
    """The largest t such that a pair at the threshold has under t equal coordinates with a chance of at most `miss`."""
    share, below, t = percent / 100, 0.0, 0
    while True:
        below += comb(coordinates, t) * share**t * (1 - share) ** (coordinates - t)
        if below > miss:
            return max(1, t)
        t += 1


def _sets(texts: common.Texts, run_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the texts' word runs, sorted within each text, and the first of each text."""
    texts = texts.lower()
    words = common.words_of(texts)
    hashes = common.span_hashes(texts.data, words.starts, words.ends)
    n_words = np.diff(words.first)
    runs = common.gram_hashes(hashes, run_words)
    # A run that starts in the last words of a text would reach into the next one.
    owner = np.repeat(np.arange(len(n_words)), n_words)[: len(runs)]
    whole = np.arange(len(runs)) + run_words <= words.first[owner + 1]
    count = np.maximum(n_words - run_words + 1, 0)
    runs = runs[whole]
    short = np.flatnonzero((n_words > 0) & (n_words < run_words))
    if len(short):
        own = np.array([common.gram_hashes(hashes[words.first[i] : words.first[i + 1]], int(n_words[i]))[0] for i in short])
        runs = np.insert(runs, np.cumsum(count)[short], own)
        count[short] = 1
    first = np.concatenate([[0], np.cumsum(count)])
    runs = common.sorted_within(runs, first)
    fresh = np.ones(len(runs), dtype=bool)
    fresh[1:] = runs[1:] != runs[:-1]
    fresh[first[:-1][count > 0]] = True
    return runs[fresh], np.concatenate([[0], np.cumsum(fresh)])[first]


def _sketch(batches: Iterator[pa.RecordBatch], run_words: int, coordinates: int) -> Iterator[pa.RecordBatch]:
    random = np.random.default_rng(8)
    factors = random.integers(0, 2**63, coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = random.integers(0, 2**64, coordinates, dtype=np.uint64)
    for batch, texts in common.row_blocks(batches):
        runs, first = _sets(texts, run_words)
        size = np.diff(first)
        full = np.flatnonzero(size > 0)
        keys = np.zeros((2, len(size)), dtype=np.uint64)
        minima = np.zeros((len(full), coordinates), dtype=np.uint32)
        if len(full):
            at = first[:-1][full]
            keys[0, full] = np.add.reduceat(common.mix(runs), at)
            keys[1, full] = np.add.reduceat(common.mix(runs ^ np.uint64(0xA5A5A5A5A5A5A5A5)), at)
            mixed = common.mix(runs + np.uint64(77))
            for j in range(coordinates):
                low = np.minimum.reduceat(mixed * factors[j] + shifts[j], at)
                minima[:, j] = low >> np.uint64(32)
        lengths = np.zeros(len(size) + 1, dtype=np.int32)
        lengths[1:][full] = coordinates
        signature = pa.ListArray.from_arrays(
            pa.array(np.cumsum(lengths, dtype=np.int32)), pa.array(minima.reshape(-1).view(np.int32))
        )
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(size.astype(np.int64)), common.signed(keys[0]), common.signed(keys[1]), signature],
            names=["id", "n_shingles", "k1", "k2", "signature"],
        )


def _full_sets(batches: Iterator[pa.RecordBatch], run_words: int) -> Iterator[pa.RecordBatch]:
    for batch, texts in common.row_blocks(batches):
        runs, first = _sets(texts, run_words)
        sets = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), common.signed(runs))
        yield pa.RecordBatch.from_arrays([batch.column("id"), sets], names=["node", "runs"])


def list_number(at: Column, value: Column) -> Column:
    return F.shiftleft(at.cast("bigint"), 32) + value.cast("bigint")


def near_copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    run_words: int = 5,
    percent: int = 85,
    coordinates: int = 64,
) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, class_id (smallest id with the same set), component_id (smallest
    id reachable by links) and kept (doc_id = component_id)."""
    spark = docs.sparkSession
    t = least_matches(coordinates, percent)
    texts = docs.select(F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text"))
    sketch = common.map_arrow(
        texts,
        lambda batches: _sketch(batches, run_words, coordinates),
        "id bigint, n_shingles bigint, k1 bigint, k2 bigint, signature array<int>",
    )
    sketch = common.saved(sketch, "sketch")
    usable = sketch.where("n_shingles > 0 AND id IS NOT NULL")
    # What is counted per key is written before it is joined to the rows it was counted from: Spark splits a hot key of a
    # join only where no aggregate shares the join's stage.
    classes = common.saved(usable.groupBy("k1", "k2").agg(F.min("id").alias("node")), "classes")
    members = common.saved(sketch.select("id", "n_shingles", "k1", "k2").join(classes, ["k1", "k2"], "left"), "members")

    nodes = usable.join(members.where("id = node").select("k1", "k2", "node").distinct(), ["k1", "k2"])
    nodes = common.saved(nodes.where("id = node").select("node", "k1", "n_shingles", "signature").distinct(), "nodes")
    tokens = nodes.select("node", "k1", F.posexplode("signature").alias("at", "value"))
    shared = common.saved(tokens.groupBy("at", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
    lists = tokens.join(shared, ["at", "value"]).groupBy("node", "k1")
    lists = lists.agg(F.sort_array(F.collect_list(F.struct("n", "at", "value"))).alias("lists"))
    prefix = F.slice("lists", 1, F.size("lists") - (t - 1))
    numbers = F.transform(prefix, lambda p: list_number(p["at"], p["value"]))
    posts = lists.where(F.size("lists") >= t).select("node", "k1", numbers.alias("lists"), F.explode(prefix).alias("p"))
    posts = common.saved(posts.select("node", "k1", "lists", "p.at", "p.value"), "posts")
    signatures = nodes.join(posts.select("node", "k1").distinct(), ["node", "k1"], "left_semi")
    signatures = common.saved(signatures.select("node", "k1", "signature"), "signatures")
    runs = common.map_arrow(
        texts.join(signatures.select(F.col("node").alias("id")).distinct(), "id", "left_semi"),
        lambda batches: _full_sets(batches, run_words),
        "node bigint, runs array<bigint>",
    )
    runs = common.saved(runs, "runs")

    # Runs that no other candidate has bound what a node can share: at most size - own. A node whose own runs are too
    # many links with nothing.
    facts = runs.groupBy("node").agg(F.count(F.lit(1)).alias("texts"), F.max(F.size("runs")).alias("size"))
    own = runs.select("node", F.explode("runs").alias("run")).groupBy("run")
    own = own.agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node")).where("n = 1")
    own = own.groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    facts = facts.join(own, "node", "left")
    single = F.col("texts") == 1  # several texts of one id: no bound
    facts = facts.select(
        "node",
        F.when(single, F.col("size").cast("bigint")).otherwise(0).alias("size"),
        F.when(single, F.col("size") - F.coalesce("own", F.lit(0))).otherwise(1 << 40).alias("common"),
    ).where(f"100 * common >= {percent} * size")
    posts = common.saved(posts.join(facts, "node"), "posts")

    def sided(df: DataFrame, side: str) -> DataFrame:
        return df.toDF(*[f"{name}_{side}" for name in df.columns])

    def possible() -> Column:
        """Whether two nodes can reach the threshold with what they can share."""
        most = F.least("common_a", "common_b")
        return 100 * most >= percent * (F.col("size_a") + F.col("size_b") - most)

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Links (a, b) among pairs (node_a, k1_a, node_b, k1_b)."""
        for side in "ab":
            pairs = pairs.join(sided(signatures, side), [f"node_{side}", f"k1_{side}"])
        equal = F.aggregate(
            F.zip_with("signature_a", "signature_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x
        )
        pairs = pairs.where(equal >= t).select("node_a", "node_b").distinct()
        for side in "ab":
            pairs = pairs.join(sided(runs, side), f"node_{side}")
        both = F.size(F.array_intersect("runs_a", "runs_b"))
        either = F.size("runs_a") + F.size("runs_b") - both
        return pairs.where(100 * both >= percent * either).select(F.col("node_a").alias("a"), F.col("node_b").alias("b"))

    links, parts = None, None
    for round_number in range(5):
        placed = posts.withColumn("part", F.col("node"))
        if parts is not None:
            known = parts.select(F.col("node").alias("known"), "component")
            placed = posts.join(known, F.col("node") == F.col("known"), "left")
            placed = placed.withColumn("part", F.coalesce("component", "node")).drop("known", "component")
        # Leaves lists of a single part, and nodes too large for what they can share with the list's smallest.
        ends = placed.groupBy("at", "value").agg(
            F.min("part").alias("low"), F.max("part").alias("high"), F.min("size").alias("least")
        )
        ends = common.saved(ends.where("low < high"), "ends")
        placed = placed.join(ends, ["at", "value"])
        placed = placed.where(f"100 * common >= {percent} * (size + least - least(common, least))")
        placed = common.saved(placed.drop("low", "high", "least"), "placed")
        per_part = placed.groupBy("at", "value", "part").agg(F.count(F.lit(1)).cast("double").alias("n"))
        per_list = per_part.groupBy("at", "value").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("inner"))
        total = per_list.agg(F.sum("n"), F.sum((F.col("n") * F.col("n") - F.col("inner")) / 2)).first()
        if not total[0] or not total[1]:
            break
        # The first round always uses hubs where groups are large; later ones only where many pairs are left, as the
        # bounds on what a pair can share keep most of them from being formed.
        last = total[1] <= (4, 1000)[round_number > 0] * total[0] or round_number == 4
        same = (F.col("at_a") == F.col("at_b")) & (F.col("value_a") == F.col("value_b"))
        right = sided(placed, "b")
        if last:
            # A pair is formed in the first list that both are posted in. Where one of them has left that list,
            # they cannot be linked.
            first = F.array_min(F.array_intersect("lists_a", "lists_b")) == list_number(F.col("at_a"), F.col("value_a"))
            pairs = sided(placed, "a").join(right, same & (F.col("part_a") < F.col("part_b")) & possible() & first)
        else:
            # One node of each list against the others: the one with the largest part to share, then one of the last part.
            kept = [c for c in placed.columns if c not in ("at", "value", "lists")]
            shared = F.expr("1000 * common div greatest(size, 1)")
            rank = shared if round_number % 2 == 0 else F.col("part")
            best = F.struct(rank.alias("rank"), shared.alias("most"), (-F.col("node")).alias("tie"), *kept)
            hubs = placed.groupBy("at", "value").agg(F.max(best).alias("hub"))
            hubs = sided(hubs.select("at", "value", *[F.col(f"hub.{c}").alias(c) for c in kept]), "a")
            pairs = hubs.join(right, same & (F.col("part_a") != F.col("part_b")) & possible())
        pairs = pairs.select("node_a", "k1_a", "node_b", "k1_b").distinct()
        found = confirmed(pairs)
        links = common.saved(found if links is None else links.unionAll(found), "found")
        parts = common.saved(common.connected_components(links), "parts")
        if last:
            break
    if parts is None:
        component = members.withColumn("component", F.lit(None).cast("bigint"))
    else:
        component = members.join(parts.withColumnRenamed("component", "part"), members["node"] == parts["node"], "left")
        component = component.select(members["*"], F.col("part").alias("component"))
    component_id = F.when(F.col("id").isNotNull(), F.coalesce("component", "node", "id"))
    return component.select(
        F.col("id").alias("doc_id"),
        "n_shingles",
        F.when(F.col("id").isNotNull(), F.coalesce("node", "id")).alias("class_id"),
        component_id.alias("component_id"),
        F.coalesce(F.col("id") == component_id, F.lit(True)).alias("kept"),
    )
