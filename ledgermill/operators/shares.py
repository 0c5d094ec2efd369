"""Counts per label and their share of all rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def counts_by(df: DataFrame, label: Column, label_name: str, count_name: str) -> DataFrame:
    return df.groupBy(label.alias(label_name)).agg(F.count(F.lit(1)).alias(count_name))


def with_percentage(counts: DataFrame, count_name: str) -> DataFrame:
    """Adds the percentage of the total. The total is a scalar subquery over the small table of counts."""
    total = counts.agg(F.sum(count_name)).scalar().cast("decimal(20,0)")
    share = F.col(count_name).cast("decimal(20,0)") / total * 100
    return counts.withColumn("percentage", F.round(share, 2).cast("decimal(38,2)"))
