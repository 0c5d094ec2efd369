"""The place of every row among the rows of its group, without bringing a group into one task.

Rows are dealt by ranges of (group, order) and sorted there, so that a range holds consecutive rows of a group. A row's
rank is its position in its range, less the position where the group begins there, plus the group's rows in earlier
ranges. Only counts per range and group are added up; a group of any size is spread over as many ranges as it fills.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgermill.llm import common

_POSITION_BITS = 33  # of monotonically_increasing_id: the position within the partition


def ranked(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "rank") -> DataFrame:
    """df with `name`, the row's rank from 0 within its group in ascending order, NULL first.

    Rows that tie in all of `order` get different ranks in the order in which they are read, and may lie in several
    ranges. `group` columns have no NULLs. `df` is a written table or narrow work on one.
    """
    keys = [*group, *order, "_tie"]
    dealt = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = common.saved(dealt.drop("_tie").withColumn("_at", F.monotonically_increasing_id()), "dealt")
    placed = placed.withColumns(
        {
            "_range": F.shiftright("_at", _POSITION_BITS),
            "_position": F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
        }
    ).drop("_at")
    on = ["_range", *group]
    counts = common.saved(placed.groupBy(*on).agg(F.min("_position").alias("_low"), F.count(F.lit(1)).alias("_n")), "ranges")
    earlier = W.partitionBy(*(group or [F.lit(0)])).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_low")
    shifts = common.saved(counts.select(*on, shift.alias("_shift")), "shifts")
    return placed.join(shifts, on).select(*df.columns, (F.col("_position") + F.col("_shift")).alias(name))
