"""Running totals that are stored by month and carried from one month into the next.

A stored row has its group's running total since the beginning of its month. An index beside the rows has each group's
total per month, and a reader adds the totals of all earlier months to what is stored. So rows that arrive change nothing
outside their month:

- rows on days after all stored days of their month are totalled on their own, and start from the index's month-to-date;
- rows on earlier days, or rows that go away, have their month totalled again; later months only see another index.

The index is written in the same parts as the rows, and a month's parts add up. It has at most one entry per group and
month and part; sums over it are combined before they are shuffled. Where all groups together have few entries, as those
of a handful of products do, a reader broadcasts them and its wide rows stay where they are.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgermill.operators.running_total import MOST_ENTRIES, NO_GROUP, RunningTotal


@dataclass(frozen=True)
class CarriedTotal:
    """`total` says what is summed per group; `stored` is the column that has the total since the month's beginning."""

    total: RunningTotal
    stored: str

    @property
    def slot(self) -> Column:
        return F.coalesce(F.col(self.total.group), F.lit(NO_GROUP))


def month_of(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


def month_totals(rows: DataFrame, spec: CarriedTotal) -> DataFrame:
    """(kind, slot, month, total): the index entries of some rows. Totals of all kinds have one type."""
    totals = rows.groupBy(spec.slot.alias("slot"), month_of(F.col(spec.total.day)).alias("month"))
    totals = totals.agg(F.sum(spec.total.value).cast("decimal(38,4)").alias("total"))
    return totals.select(F.lit(spec.total.name).alias("kind"), "slot", "month", "total")


def _before(index: DataFrame, kind: str) -> DataFrame:
    """(slot, month, before): what each group has in earlier months, for the months that it has."""
    own = index.where(F.col("kind") == kind).groupBy("slot", "month").agg(F.sum("total").alias("total"))
    earlier = W.partitionBy("slot").orderBy("month").rowsBetween(W.unboundedPreceding, -1)
    return own.select("slot", "month", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))


def month_to_date(index: DataFrame, spec: CarriedTotal) -> DataFrame:
    """(slot, month, start): what the rows of the given index entries add up to, from which later rows of their months
    start."""
    own = index.where(F.col("kind") == spec.total.name)
    return own.groupBy("slot", "month").agg(F.sum("total").alias("start"))


def with_offset(rows: DataFrame, offsets: DataFrame, offset: str, spec: CarriedTotal, column: str, name: str) -> DataFrame:
    """rows with `name`: `column` and the group's offset of the row's month."""
    keyed = rows.withColumns({"_slot": spec.slot, "_month": month_of(F.col(spec.total.day))})
    renamed = offsets.select(F.col("slot").alias("_slot"), F.col("month").alias("_month"), F.col(offset).alias("_offset"))
    summed = (F.col(column) + F.coalesce("_offset", F.lit(0))).cast(rows.schema[column].dataType)
    joined = keyed.join(renamed, ["_slot", "_month"], "left")
    others = [c for c in rows.columns if c != name]
    return joined.select(*others, summed.alias(name))


def carried(rows: DataFrame, index: DataFrame, *specs: CarriedTotal, most_entries: int = MOST_ENTRIES) -> DataFrame:
    """Stored rows with the running totals over all months, in the place of the stored ones. The index is counted first:
    a kind with at most `most_entries` entries is broadcast, others are joined by group and month."""
    entries = {row.kind: row["count"] for row in index.groupBy("kind").count().collect()}
    out = rows
    for spec in specs:
        offsets = _before(index, spec.total.name)
        if entries.get(spec.total.name, 0) <= most_entries:
            offsets = F.broadcast(offsets)
        out = with_offset(out, offsets, "before", spec, spec.stored, spec.total.name).drop(spec.stored)
    return out
