"""Running totals that stay parallel when one group holds most of the rows.

A plain window puts each group into one task. That is right for groups of ordinary size, and it is what they
get here. A hot group is cut along its own order into chunks of about `chunk_rows` rows:

    day  ->  stretch of keys  ->  finer stretch of keys  ->  (only for one repeated key) stretch of handle hashes

A day with more rows is cut into stretches of equal width between its smallest and largest key, as many as its
row count asks for; a stretch that still has too many rows, where keys lie unevenly, is cut once more between
its own ends; and copies of one key are cut by a hash of their row handle. So the number of chunks follows the
number of rows, whether keys are dense, sparse or repeated.

The window runs per chunk, and every chunk adds the total of the chunks before it. These offsets come from
an aggregate that combines before its shuffle, and are again summed in two levels, days and chunks of a day.
Ordinary and hot groups share one shuffle of the wide rows; the offsets are joined on that same partitioning.

The lists of hot groups, cut days and cut stretches are broadcast. Each entry stands for more rows than its
limit, and the limits grow with the table, so that no list has more than MOST_ENTRIES entries. The limits
only choose a plan, never a result.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# A group with more rows is hot.
HOT_GROUP_ROWS = 2_000_000
# Rows a chunk of a hot group is meant to hold.
CHUNK_ROWS = 1_000_000
# Entries of a broadcast list, whatever the number of rows: a few MB.
MOST_ENTRIES = 50_000
# Stands for the group of rows without a group id. Parsed ids are never negative.
NO_GROUP = -1

DAY, STRETCH, FINER, COPIES = "_day", "_stretch", "_finer", "_copies"


@dataclass(frozen=True)
class RunningTotal:
    """Running sum of `value` per `group`, by `day` and then `key`.

    `day`, `key` and `within` are not NULL. The sum starts anew for each value of the columns `within`, such as the month:
    they are part of the group, so that a total per month takes no total over all months. `hot_rows=0` treats every group as hot: for columns known to have few, large
    groups. `handle` names columns that identify a row; give it where `key` may repeat, so that even the
    copies of one key are spread and get their totals in a fixed order.
    """

    name: str
    group: str
    value: str
    day: str = "transaction_date"
    key: str = "transaction_id"
    hot_rows: int = HOT_GROUP_ROWS
    chunk_rows: int = CHUNK_ROWS
    handle: tuple[str, str] | None = None
    within: tuple[str, ...] = ()
    most_entries: int = MOST_ENTRIES

    @property
    def slot(self) -> list[str]:
        return ["_slot", *self.within]

    @property
    def chunk(self) -> list[str]:
        return [*self.slot, DAY, STRETCH, FINER, *([COPIES] if self.handle else [])]

    def limits(self, rows: int) -> tuple[int, int]:
        """Rows above which a group is hot, and above which a part of it is cut."""
        least = -(-rows // self.most_entries)
        return max(self.hot_rows, least) if self.hot_rows else 0, max(self.chunk_rows, least)


class Chunks:
    """Marks rows with the chunk they belong to. The lists that decide it are made from `source` once."""

    def __init__(self, source: DataFrame, spec: RunningTotal, rows: int | None = None):
        self.spec = spec
        self.hot_rows, self.chunk_rows = spec.limits(source.count() if rows is None else rows)
        self.hot = None
        narrow = source.select(*self._needed(source))
        if self.hot_rows:
            sizes = narrow.groupBy(self._slot().alias("_slot"), *spec.within).agg(F.count(F.lit(1)).alias("_rows"))
            self.hot = sizes.where(F.col("_rows") > self.hot_rows).select(*spec.slot, F.lit(True).alias("_hot"))
        self.lists: list[DataFrame] = []
        levels = [(STRETCH, F.col(spec.key), F.lit(True)), (FINER, F.col(spec.key), F.col("_low") < F.col("_high"))]
        if spec.handle:
            levels.append((COPIES, self._copy_hash(), F.col("_one_key")))
        for level, place, useful in levels:
            on = [*spec.slot, DAY, *self._names()]
            parts = self.mark(narrow).where("_hot").groupBy(*on).agg(
                F.count(F.lit(1)).alias("_rows"),
                F.min(place).alias("_low"),
                F.max(place).alias("_high"),
                (F.min(spec.key) == F.max(spec.key)).alias("_one_key"),
            )
            # Half as many rows again as needed, so that chance does not push many stretches over the limit.
            cuts = F.ceil(F.col("_rows") * 1.5 / self.chunk_rows)
            # Both ends are halved first: their distance may not fit into 64 bits.
            width = (F.expr("_high div 2") - F.expr("_low div 2")) / cuts
            parts = parts.where((F.col("_rows") > self.chunk_rows) & useful)
            self.lists.append(parts.select(*on, F.col("_low").alias(f"{level}_low"), width.alias(f"{level}_width")))

    def _needed(self, source: DataFrame) -> list[str]:
        spec = self.spec
        return list(dict.fromkeys([spec.group, *spec.within, spec.day, spec.key, *(spec.handle or ())]))

    def _slot(self) -> Column:
        return F.coalesce(F.col(self.spec.group), F.lit(NO_GROUP))

    def _copy_hash(self) -> Column:
        return F.xxhash64(*self.spec.handle)

    def _names(self) -> list[str]:
        return [STRETCH, FINER, COPIES][: len(self.lists)]

    def mark(self, rows: DataFrame) -> DataFrame:
        """Adds the chunk columns. An ordinary group is one chunk with a NULL day, and has no offset."""
        spec = self.spec
        rows = rows.withColumn("_slot", self._slot())
        if self.hot is None:
            rows = rows.withColumn("_hot", F.lit(True))
        else:
            rows = rows.join(F.broadcast(self.hot), spec.slot, "left")
        rows = rows.withColumn(DAY, F.when(F.col("_hot"), F.col(spec.day)))
        for number, cuts in enumerate(self.lists):
            level = [STRETCH, FINER, COPIES][number]
            place = self._copy_hash() if level == COPIES else F.col(spec.key)
            low, width = F.col(f"{level}_low"), F.col(f"{level}_width")
            half = place.cast("bigint") / 2 - low / 2
            found = F.when(width > 0, F.floor(half / width)).otherwise(0).cast("bigint")
            on = [*spec.slot, DAY, *[STRETCH, FINER, COPIES][:number]]
            rows = rows.join(F.broadcast(cuts), on, "left").withColumn(level, F.coalesce(found, F.lit(0)))
            rows = rows.drop(f"{level}_low", f"{level}_width")
        return rows


def _offsets(source: DataFrame, chunks: Chunks) -> DataFrame:
    """Total of everything before each chunk of the hot groups."""
    spec, before = chunks.spec, (W.unboundedPreceding, -1)
    # The NULL tests are stated, or the optimizer adds them to one of the two uses of `totals` only, and the
    # shuffle below them is no longer shared.
    totals = (
        chunks.mark(source)
        .where(f"_hot AND {DAY} IS NOT NULL")
        .groupBy(*spec.chunk)
        .agg(F.sum(spec.value).alias("_total"))
    )
    in_day = W.partitionBy(*spec.slot, DAY).orderBy(*spec.chunk[len(spec.slot) + 1 :]).rowsBetween(*before)
    across_days = W.partitionBy(*spec.slot).orderBy(DAY).rowsBetween(*before)
    days = (
        totals.groupBy(*spec.slot, DAY)
        .agg(F.sum("_total").alias("_day_total"))
        .select(*spec.slot, DAY, F.sum("_day_total").over(across_days).alias("_earlier_days"))
    )
    earlier, same_day = F.col("_earlier_days"), F.col("_earlier_chunks")
    return (
        totals.select(*spec.chunk, F.sum("_total").over(in_day).alias("_earlier_chunks"))
        .join(days, [*spec.slot, DAY])
        .select(*spec.chunk, F.coalesce(earlier + same_day, earlier, same_day).alias("_before"))
    )


def with_running_total(rows: DataFrame, spec: RunningTotal, source: DataFrame | None = None) -> DataFrame:
    """`source` supplies the group sizes and chunk totals: the same rows at an earlier, cheaper stage. It is
    counted first, to scale the limits; when all rows together are within a chunk, groups get a plain window."""
    source = rows if source is None else source
    n_rows = source.count()
    copies = [F.xxhash64(*spec.handle), *spec.handle] if spec.handle else []
    ordered = W.orderBy(spec.day, spec.key, *copies).rowsBetween(W.unboundedPreceding, W.currentRow)
    if n_rows <= spec.chunk_rows:
        return rows.select(*rows.columns, F.sum(spec.value).over(ordered.partitionBy(spec.group, *spec.within)).alias(spec.name))
    chunks = Chunks(source, spec, n_rows)
    window = ordered.partitionBy(*spec.chunk)
    within, before = F.col("_within"), F.col("_before")
    summed = chunks.mark(rows).withColumn("_within", F.sum(spec.value).over(window))
    total = F.coalesce(before + within, within, before).cast(summed.schema["_within"].dataType)
    return summed.join(_offsets(source, chunks), spec.chunk, "left").select(*rows.columns, total.alias(spec.name))
