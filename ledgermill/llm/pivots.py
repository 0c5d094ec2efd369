"""Near-copies of vectors by a pivot-permutation index.

1. Rows with the same vector become one node, which counts as so many rows; ids with several vectors keep nodes of their
   own. Copies are linked by this, without being compared.
2. Pivots are the nodes with the smallest hashes of their ids: `pivots_per_root` times the square root of the number of
   nodes, at most `most_pivots`, so that lists stay short as the table grows. A node that is closer than `apart` to an
   earlier pivot is passed over, up to twice the number: a large group of near-copies gives one pivot, not its share of
   the rows, because the order of pivots that are equally near is noise.
3. A vector is described by its `nearest` nearest pivots in order; of tied ones the earlier pivots count. Near vectors
   share most of them. Pairs that share `shared` or more are candidates: in any fixed order of the pivots, two such
   vectors share one of their first `nearest - shared + 1`, so each vector is posted in that many inverted lists only.
4. A list is cut into blocks of about `block` rows, and each pair of blocks is one group: a list of a third of all rows
   is spread over many tasks. A group's cosines are one product of double-precision matrices. A pair in several lists
   counts in the first one that it shares.
5. A group returns a count per vector and, for its links, each vector with the smallest one that it reaches, never the
   links of a vector one by one.

The index is approximate in step 3 only; the README has its measured recall.

Defined results: vectors that are NULL, empty or zero or hold NULL or non-finite components link with nothing. Vectors
of different lengths are not compared. Rows that repeat an id are not linked with each other and share their counts.
Rows without id link with nothing and are kept, with a NULL component. Other columns are not read.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm import common


def _matrices(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows with a usable vector and the vectors, scaled to length 1, by number of components."""
    offsets = column.offsets.to_numpy()
    size = np.diff(offsets)
    values = column.values.cast(pa.float64())
    flat = values.to_numpy(zero_copy_only=False)  # NULL becomes NaN
    for n in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero(size == n)
        vectors = flat[offsets[rows][:, None] + np.arange(n)]
        top = np.abs(vectors).max(axis=1)
        good = np.isfinite(top) & (top > 0)
        vectors = vectors[good] / top[good][:, None]
        yield rows[good], vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def _fit(pivots: np.ndarray, n: int) -> np.ndarray:
    """Pivots cut or filled with zeros to n components."""
    out = np.zeros((len(pivots), n))
    out[:, : min(n, pivots.shape[1])] = pivots[:, :n]
    return out


def _thinned(vectors: np.ndarray, most: int, apart: float) -> np.ndarray:
    """The first `most` vectors that are no closer than `apart` to an earlier one of them."""
    out, n = np.zeros((min(most, len(vectors)), vectors.shape[1])), 0
    for vector in vectors:
        if n == len(out):
            break
        if not n or (out[:n] @ vector).max() < apart:
            out[n] = vector
            n += 1
    return out[:n]


def _nearest(vectors: np.ndarray, pivots: np.ndarray, k: int) -> np.ndarray:
    """The k nearest pivots of each vector in rising order; of tied ones those with the smaller numbers."""
    out = []
    for low in range(0, len(vectors), 1024):
        closeness = vectors[low : low + 1024] @ pivots.T
        kth = -np.partition(-closeness, k - 1, axis=1)[:, k - 1 : k]
        taken, tied = closeness > kth, closeness == kth
        taken |= tied & (np.cumsum(tied, axis=1, dtype=np.int32) <= k - taken.sum(axis=1, keepdims=True))
        out.append(np.nonzero(taken)[1].reshape(-1, k))
    return np.concatenate(out) if out else np.zeros((0, k), dtype=np.int64)


def _describe(batches: Iterator[pa.RecordBatch], sent, nearest: int, shared: int) -> Iterator[pa.RecordBatch]:
    pivots = sent.value
    k = min(nearest, len(pivots))
    posted = k + 1 - min(k, max(shared, 2 * k - len(pivots)))  # any two vectors share 2 * k - len(pivots)
    for batch in batches:
        for rows, vectors in _matrices(batch.column("vector")):
            first = _nearest(vectors, _fit(pivots, vectors.shape[1]), k)[:, :posted].astype(np.int32)
            ends = np.arange(len(rows) + 1, dtype=np.int32) * first.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(first.reshape(-1)))
            taken = pa.array(rows)
            size = pa.array(np.full(len(rows), vectors.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(taken) for c in ("id", "weight", "times", "vector")), size, lists],
                names=["id", "weight", "times", "vector", "size", "lists"],
            )


def _smallest_reached(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest id that each row and each column reaches over True cells."""
    low = (left.copy(), right.copy())
    while True:
        rows = np.minimum(low[0], np.where(linked, low[1], np.iinfo(np.int64).max).min(axis=1))
        columns = np.minimum(low[1], np.where(linked, rows[:, None], np.iinfo(np.int64).max).min(axis=0))
        if (rows == low[0]).all() and (columns == low[1]).all():
            return low
        low = (rows, columns)


def _link(key: tuple[pa.Scalar, ...], table: pa.Table, least: float) -> pa.Table:
    """Counts and reached ids of one pair of blocks."""
    pivot, first_block, second_block = (key[i].as_py() for i in (0, 2, 3))
    table = table.combine_chunks()
    column = table.column("vector").chunk(0) if table.num_rows else pa.array([], pa.list_(pa.float32()))
    empty = pa.table({"id": pa.array([], pa.int64()), "n": pa.array([], pa.int64()), "low": pa.array([], pa.int64())})
    found = list(_matrices(column))
    if not found:
        return empty
    rows, vectors = found[0]
    ids = table.column("id").to_numpy()[rows]
    block = table.column("block").to_numpy()[rows]
    weight, times = (table.column(c).to_numpy()[rows] for c in ("weight", "times"))
    lists = table.column("lists").chunk(0)
    posted = lists.values.to_numpy()[lists.offsets.to_numpy()[:-1][rows][:, None] + np.arange(len(lists[0]))]
    a, b = np.flatnonzero(block == first_block), np.flatnonzero(block == second_block)
    linked = vectors[a] @ vectors[b].T >= least
    linked &= ids[a][:, None] != ids[b]
    x, y = np.nonzero(linked)
    for low in range(0, len(x), 1 << 16):
        # Lists rise; a pair belongs to the first pivot that both are posted under.
        p, q = posted[a[x[low : low + (1 << 16)]]], posted[b[y[low : low + (1 << 16)]]]
        earlier = ((p[:, :, None] == q[:, None, :]) & (p[:, :, None] < pivot)).any(axis=(1, 2))
        linked[x[low : low + (1 << 16)][earlier], y[low : low + (1 << 16)][earlier]] = False
    low_a, low_b = _smallest_reached(linked, ids[a], ids[b])
    n_a, n_b = (linked @ weight[b]) * times[a], (weight[a] @ linked) * times[b]
    if first_block == second_block:
        out = [(ids[a], n_a, np.minimum(low_a, low_b))]
    else:
        out = [(ids[a], n_a, low_a), (ids[b], n_b, low_b)]
    id_, n, low = (np.concatenate(c) for c in zip(*out, strict=True))
    some = n > 0
    return pa.table({"id": id_[some], "n": n[some].astype(np.int64), "low": low[some]})


def near_vectors(
    rows: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    least: float = 0.95,
    nearest: int = 12,
    shared: int = 3,
    pivots_per_root: float = 4.0,
    most_pivots: int = 16384,
    apart: float = 0.8,
    block: int = 1024,
) -> DataFrame:
    """One row per row: vec_id, n_links, component_id and kept."""
    spark = rows.sparkSession
    source = rows.select(
        F.col(f"`{id_column}`").cast("bigint").alias("id"), F.col(f"`{vector}`").alias("vector")
    )
    usable = source.where(
        """id IS NOT NULL AND exists(vector, x -> x != 0)
        AND forall(vector, x -> x IS NOT NULL AND abs(double(x)) < double('infinity'))"""
    )
    own = common.saved(usable.groupBy("id", "vector").agg(F.count(F.lit(1)).alias("own")), "own")
    several = own.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id", F.lit(True).alias("several"))
    own = own.join(several, "id", "left").withColumn("several", F.coalesce("several", F.lit(False)))
    own = own.withColumn("own_id", F.when(F.col("several"), F.col("id")).otherwise(0))
    same = ["vector", "several", "own_id"]
    nodes = own.groupBy(*same).agg(F.min("id").alias("node"), F.sum("own").alias("weight"))
    nodes = common.saved(nodes, "nodes")
    members = own.join(nodes, same).select("id", "several", "own", "node", "weight")
    members = common.saved(members, "members")
    n_pivots = int(min(most_pivots, max(32, pivots_per_root * nodes.count() ** 0.5)))
    sample = nodes.orderBy(F.xxhash64("node"), "node", "vector").limit(2 * n_pivots).select("vector").collect()
    found = list(_matrices(pa.array([r["vector"] for r in sample], pa.list_(pa.float64())))) if sample else []
    width = max((vectors.shape[1] for _, vectors in found), default=1)
    candidates = np.zeros((len(sample), width))
    for at, vectors in found:
        candidates[at, : vectors.shape[1]] = vectors
    pivots = _thinned(candidates, n_pivots, min(apart, least))
    if not len(pivots):
        pivots = np.ones((1, 1))
    sent = spark.sparkContext.broadcast(pivots)  # at most most_pivots vectors
    kind = source.schema["vector"].dataType.simpleString()
    times = F.when(F.col("several"), F.col("weight")).otherwise(1).cast("bigint").alias("times")
    described = common.map_arrow(
        nodes.select(F.col("node").alias("id"), "weight", times, "vector"),
        lambda batches: _describe(batches, sent, nearest, shared),
        f"id bigint, weight bigint, times bigint, vector {kind}, size int, lists array<int>",
    )
    described = common.saved(described, "described")
    posts = described.withColumn("pivot", F.explode("lists"))
    sizes = posts.groupBy("pivot", "size").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = sizes.select("pivot", "size", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    posts = posts.join(sizes, ["pivot", "size"])
    posts = posts.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    posts = posts.select("pivot", "size", "id", "weight", "times", "vector", "lists", "block", other)
    groups = posts.groupBy("pivot", "size", F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2"))
    found = groups.applyInArrow(lambda key, table: _link(key, table, least), "id bigint, n bigint, low bigint")
    found = common.saved(found, "links")
    counts = found.groupBy("id").agg(F.sum("n").alias("n")).withColumnRenamed("id", "node")
    parts = common.connected_components(found.select(F.col("id").alias("a"), F.col("low").alias("b")))
    facts = common.saved(counts.join(parts, "node", "full"), "facts")
    per_id = members.groupBy("id").agg(*[F.max(c).alias(c) for c in ("several", "own", "node", "weight")])
    per_id = per_id.join(facts, "node", "left")
    # A link of a node counts for each of its rows; nodes of ids with several vectors have counted theirs.
    near, copies = F.coalesce("n", F.lit(0)), F.col("weight") - F.col("own")
    n_links = F.when(F.col("several"), near).otherwise(F.col("own") * (copies + near))
    per_id = per_id.select("id", n_links.alias("n_links"), F.coalesce("component", "node").alias("component"))
    out = source.select("id").join(per_id, "id", "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias("vec_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
