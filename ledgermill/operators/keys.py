"""Key checks. Rows are counted per key before anything is joined, so a hot key is one row by then."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_per_key(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.col(column).alias("key")).agg(F.count(F.lit(1)).alias("rows"))


def repeated_keys(df: DataFrame, column: str) -> DataFrame:
    """Keys that occur more than once, with their row counts. NULL counts as a key."""
    return rows_per_key(df, column).where(F.col("rows") > 1)


def keys_without_parent(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child keys, with their row counts, that the parent lacks. A NULL key has no parent."""
    parents = parent.select(F.col(field).alias("key")).where(F.col("key").isNotNull())
    return rows_per_key(child, column).join(parents, "key", "left_anti")


def rows_without_parent(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """One row: how many child rows have no parent."""
    missing = keys_without_parent(child, column, parent, field)
    return missing.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
