"""A Merkle manifest of a dataset: trees of SHA-256 digests, and the proof that a row belongs to it.

Every row is a leaf, the digest of its columns. The leaves of each group, in ascending order of their id, form a tree
whose inner nodes are the digests of up to `FAN` consecutive nodes; the groups' roots, in order of their names, form one
more tree over them, whose root stands for the whole dataset.

The manifest is content-addressed: a table of records digest -> children's digests, each record once however often its
subtree occurs. A leaf request is a group and a rank in it. It descends from the root: the digits of the group's place
and then of the rank, in base FAN, say which child to take; the children not taken are collected, and the path, reversed,
is the proof from the leaf up. Requests descend together: a node that many of them pass is looked up once, so that N
requests take N / 8 look-ups in the last step and fewer in each step before it, and no record is hot at the top.

Ranks come from sorted ranges (see ranks.py), and no group is ever gathered: one with all rows costs what many small
ones cost. Only the tables' heights, the number of groups and the root reach the driver. A record repeated by copies of
whole rows is one record; requests that meet in it are spread by Spark's split of skewed join keys.

Defined results: a NULL field is '-', any other its length in UTF-8 bytes, ':' and its text, so that empty and NULL
differ. The NULL group comes first, and a NULL id before all others. Rows that repeat an id are ordered by their leaf;
rows equal in all columns have equal leaves and each its own place. A group of one leaf has that leaf as its root, and so
has a dataset of one group. An empty table has no rows and no root. Other columns are not read.
"""

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.llm import common
from ledgermill.llm.ranks import ranked

FAN = 8
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Manifest:
    """`leaves`: grp, rank, leaf and the kept columns. `records`: digest, children. `groups`: grp, place, height, subroot.
    `grp` is '' for the NULL group and '=' with the group's name for others."""

    leaves: DataFrame
    records: DataFrame
    groups: DataFrame
    root: str | None
    groups_height: int
    leaves_height: int


def digest_of(*texts: Column) -> Column:
    return F.sha2(F.concat(*texts), 256)


def field(column: Column) -> Column:
    text = column.cast("string")
    return F.when(column.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: dict[str, Column], columns: Sequence[str] = COLUMNS) -> Column:
    return digest_of(*[field(values[name]) for name in columns])


def height(nodes: Column) -> Column:
    """Levels above so many nodes: the powers of FAN that are less."""
    powers = F.array(*[F.lit(FAN**k).cast("bigint") for k in range(21)])
    return F.size(F.filter(powers, lambda power: power < nodes))


def _levels(nodes: DataFrame, n_levels: int) -> list[DataFrame]:
    """Levels of the trees from the bottom up, as (grp, left, place, digest, children): `left` nodes are in the level."""
    levels = [nodes]
    for _ in range(n_levels):
        runs = levels[-1].where("left > 1").groupBy("grp", "left", F.expr(f"place div {FAN}").alias("run"))
        children = F.transform(F.sort_array(F.collect_list(F.struct("place", "digest"))), lambda x: x["digest"])
        parents = runs.agg(children.alias("children")).select(
            "grp",
            F.expr(f"(left + {FAN - 1}) div {FAN}").alias("left"),
            F.col("run").alias("place"),
            F.sha2(F.array_join("children", ""), 256).alias("digest"),
            "children",
        )
        levels.append(common.saved(parents, "level"))
    return levels


def _roots(levels: list[DataFrame]) -> DataFrame:
    tops = [level.where("left = 1").select("grp", F.col("digest").alias("subroot")) for level in levels]
    return reduce(DataFrame.unionAll, tops)


def build(
    docs: DataFrame,
    columns: Sequence[str] = COLUMNS,
    id_column: str = "doc_id",
    group: str = "lang",
    keep: dict[str, Column] | None = None,
) -> Manifest:
    """The manifest of docs; `keep` gives columns that its leaves carry besides doc_id."""
    values = {name: F.col(f"`{name}`") for name in columns}
    owner = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit(""))
    own = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"),
        owner.alias("grp"),
        leaf_digest(values, columns).alias("leaf"),
        *[column.alias(name) for name, column in (keep or {}).items()],
    )
    leaves = common.saved(ranked(common.saved(own, "leaves"), ["grp"], ["doc_id", "leaf"]), "leaves")
    sizes = common.saved(leaves.groupBy("grp").agg(F.count(F.lit(1)).alias("n")), "groups")
    n_groups, tallest = sizes.agg(F.count(F.lit(1)), F.coalesce(F.max(height(F.col("n"))), F.lit(0))).first()

    nodes = leaves.join(sizes, "grp").select(
        "grp", F.col("n").alias("left"), F.col("rank").alias("place"), F.col("leaf").alias("digest")
    )
    levels = _levels(nodes, tallest)
    subroots = common.saved(_roots(levels).join(sizes, "grp"), "subroots")
    groups = ranked(subroots.withColumn("height", height(F.col("n"))).drop("n"), [], ["grp"], "place")
    groups = common.saved(groups, "groups")
    groups_height = 0
    while FAN**groups_height < n_groups:
        groups_height += 1
    top = groups.select(F.lit("").alias("grp"), F.lit(n_groups).alias("left"), "place", F.col("subroot").alias("digest"))
    top_levels = _levels(top, groups_height)
    root = _roots(top_levels).first()

    inner = [level.select("digest", "children") for level in [*levels[1:], *top_levels[1:]]]
    empty = docs.sparkSession.createDataFrame([], "digest string, children array<string>")
    records = common.saved(reduce(DataFrame.unionAll, inner, empty).distinct(), "records")
    return Manifest(leaves, records, groups, root and root["subroot"], groups_height, tallest)


def _segment(digit: Column) -> Column:
    """The children before and after the one taken."""
    return F.struct(
        F.array_join(F.slice("children", 1, digit), "").alias("before"),
        F.array_join(F.slice("children", digit + 2, FAN), "").alias("after"),
    )


def _step(frontier: DataFrame, records: DataFrame) -> DataFrame:
    """One level down: every node's children, with the others added to the path."""
    others = [name for name in frontier.columns if name not in ("digest", "place", "path")]
    opened = frontier.join(records, "digest").select(
        *others, "place", "path", "children", F.posexplode("children").alias("digit", "child")
    )
    return opened.select(
        *others,
        (F.col("place") * FAN + F.col("digit")).alias("place"),
        F.col("child").alias("digest"),
        F.concat("path", F.array(_segment(F.col("digit")))).alias("path"),
    )


def proofs(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """The requested leaves (rows of manifest.leaves; all of them by default) with `found`, the digest that the descent
    ends at, `subroot`, and `path`: from the leaf up, the digests before and after the one taken at each level."""
    leaves, records = manifest.leaves if requests is None else requests, manifest.records

    def on_the_way(frontier: DataFrame, level: int) -> DataFrame:
        if requests is None:
            return frontier
        ways = requests.select("grp", F.expr(f"rank div {FAN**level}").alias("place")).distinct()
        return frontier.join(ways, ["grp", "place"], "left_semi")

    start = leaves.sparkSession.range(1 if manifest.root else 0).select(
        F.lit(0).cast("bigint").alias("place"),
        F.lit(manifest.root).alias("digest"),
        F.array().cast("array<struct<before:string,after:string>>").alias("path"),
    )
    for _ in range(manifest.groups_height):
        start = _step(start, records)
    names = manifest.groups.select("place", "grp", "height")
    start = common.saved(start.join(names, "place").withColumn("subroot", F.col("digest")), "subroots")
    start = start.withColumn("place", F.lit(0).cast("bigint"))

    frontier = start.limit(0)
    for level in range(manifest.leaves_height, 1, -1):
        frontier = frontier.unionByName(start.where(F.col("height") == level))
        frontier = _step(on_the_way(frontier, level), records)
    frontier = on_the_way(frontier.unionByName(start.where("height = 1")), 1)
    single = start.where("height = 0").withColumn("children", F.array("digest"))
    lasts = common.saved(frontier.join(records, "digest").unionByName(single), "lasts")

    digit = F.expr(f"int(rank % {FAN})")
    lasts = lasts.withColumnsRenamed({"grp": "_grp", "place": "_run"}).drop("digest")
    found = leaves.join(lasts, (F.col("grp") == F.col("_grp")) & (F.expr(f"rank div {FAN}") == F.col("_run")))
    path = F.when(F.col("height") > 0, F.concat("path", F.array(_segment(digit)))).otherwise(F.col("path"))
    return found.select(
        *leaves.columns, F.get("children", digit).alias("found"), "subroot", F.reverse(path).alias("path")
    )


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path give."""
    return F.aggregate(path, leaf, lambda below, step: digest_of(step["before"], below, step["after"]))


def proof_digest(path: Column) -> Column:
    siblings = F.transform(path, lambda step: F.concat(step["before"], step["after"]))
    return F.sha2(F.array_join(siblings, ""), 256)


def tamper_check(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, leaf, subroot, root, proof_sha256, folded_root (from the leaf of a tampered copy
    of the row, where 3 divides the CRC-32 of its id, and the original siblings) and verified. A tampered copy has the
    A-Z of its text lower-cased; a NULL id is never tampered with."""
    values = {name: F.col(name) for name in COLUMNS}
    lowered = leaf_digest(values | {"text": F.translate("text", _UPPER, _LOWER)})
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, lowered)
    manifest = build(docs, keep={"tampered": tampered})
    proved = proofs(manifest).withColumn("root", F.lit(manifest.root))
    proved = proved.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return proved.select(
        "doc_id",
        F.col("found").alias("leaf"),
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def oracle(leaf_levels: int = 7, group_levels: int = 3) -> str:
    """The same rows as SQL, with windows for the ranks and joins level by level from the leaf up; for trees of up to
    so many levels."""
    fields = " || ".join(
        f"coalesce(strlen({name}::VARCHAR) || ':' || {name}::VARCHAR, '-')" for name in COLUMNS if name != "text"
    )
    text = "coalesce(strlen({0}) || ':' || {0}, '-')"
    lowered = f"translate(text, '{_UPPER}', '{_LOWER}')"
    shift = "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
    parts = [
        f"""WITH RECURSIVE bits(i, k, c) AS (SELECT i, 0, i::BIGINT FROM range(256) t(i)
            UNION ALL SELECT i, k + 1, {shift} FROM bits WHERE k < 8),
        crc AS MATERIALIZED (SELECT list(c ORDER BY i) AS of FROM bits WHERE k = 8),
        own AS MATERIALIZED (SELECT doc_id, coalesce('=' || lang, '') AS g, sha256({fields} || {text.format("text")}) AS leaf,
            CASE WHEN xor(list_reduce(list_prepend(4294967295::BIGINT,
                    list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ord(d)::BIGINT)),
                    lambda c, b: xor(c // 256, crc.of[xor(c % 256, b) + 1])), 4294967295) % 3 = 0
                THEN sha256({fields} || {text.format(lowered)}) END AS tampered FROM documents, crc),
        leaves AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
            count(*) OVER (PARTITION BY g) AS n FROM own),
        a0 AS (SELECT g, n, r AS p, leaf AS d FROM leaves)"""
    ]

    def levels(name: str, count: int) -> list[str]:
        """Runs (their nodes as a list) and their digests, level by level; the last level of a tree is its root."""
        out = []
        for k in range(count):
            out.append(
                f"""{name}r{k} AS MATERIALIZED (SELECT g, n, p // {FAN} AS p, list(d ORDER BY p) AS ds FROM {name}{k}
                WHERE n > 1 GROUP BY g, n, p // {FAN})"""
            )
            out.append(
                f"""{name}{k + 1} AS (SELECT g, (n + {FAN - 1}) // {FAN} AS n, p, sha256(array_to_string(ds, '')) AS d
                FROM {name}r{k})"""
            )
        tops = " UNION ALL ".join(f"SELECT g, d FROM {name}{k} WHERE n = 1" for k in range(count + 1))
        return [*out, f"{name}top AS MATERIALIZED ({tops})"]

    def climb(before: str, name: str, place: str, key: str, count: int) -> list[str]:
        """Adds the siblings of each level to `proof` and folds them into `now`."""
        out = []
        for k in range(count):
            at = f"({place} // {FAN**k}) % {FAN} + 1"
            ahead, behind = f"array_to_string(ds[:{at} - 1], '')", f"array_to_string(ds[{at} + 1:], '')"
            out.append(
                f"""{name}c{k} AS MATERIALIZED (SELECT b.* EXCLUDE (proof, now),
                proof || coalesce({ahead} || {behind}, '') AS proof,
                CASE WHEN ds IS NULL THEN now ELSE sha256({ahead} || now || {behind}) END AS now
                FROM {before} b LEFT JOIN {name}r{k} t ON t.g = {key} AND t.p = {place} // {FAN ** (k + 1)})"""
            )
            before = f"{name}c{k}"
        return out

    parts += levels("a", leaf_levels)
    parts.append(
        "b0 AS MATERIALIZED (SELECT '' AS g, count(*) OVER () AS n, row_number() OVER (ORDER BY g) - 1 AS p, d, g AS name FROM atop)"
    )
    parts += levels("b", group_levels)
    parts.append(
        """asked AS (SELECT doc_id, leaf, l.g AS grp, r, b0.p AS place, b0.d AS subroot, '' AS proof,
        coalesce(tampered, leaf) AS now FROM leaves l JOIN b0 ON b0.name = l.g)"""
    )
    parts += climb("asked", "a", "r", "b.grp", leaf_levels)
    parts += climb(f"ac{leaf_levels - 1}", "b", "place", "''", group_levels)
    return ", ".join(parts) + f""" SELECT doc_id, leaf, subroot, btop.d AS root, sha256(proof) AS proof_sha256,
        now AS folded_root, now = btop.d AS verified FROM bc{group_levels - 1}, btop"""
