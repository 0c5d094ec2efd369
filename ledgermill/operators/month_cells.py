"""Mergeable sums per month, customer and product, from which reports and dimensions are made without the fact rows.

A cell has counts, sums, least and greatest values, which add up over months and parts of months. A table of cells that
is stored in month folders beside the fact lets a report read only the months it needs, and a refresh rewrite only the
months it touches. Distinct customers and products are exact, as both are keys of the cells. Distinct transaction ids
equal the row counts as long as ids are unique; where they are not, the caller gives the surplus of rows over ids
(operators/id_sets.py), which is taken off.
"""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.buckets import precise_average
from ledgermill.plans import marts
from ledgermill.plans.reports import MONTH

KEYS = ("customer_id", "product_id", "product_name")


def cells(rows: DataFrame) -> DataFrame:
    """The cells of clean fact rows, whose amounts are never NULL."""
    return rows.groupBy(*MONTH, *KEYS).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("total_amount").cast("decimal(38,4)").alias("spend"),
        F.sum("unit_price").cast("decimal(38,2)").alias("price_sum"),
        F.max("total_amount").alias("largest"),
        F.min("transaction_date").alias("first_day"),
        F.max("transaction_date").alias("last_day"),
    )


def monthly_revenue(table: DataFrame) -> DataFrame:
    """The same as reports.monthly_revenue."""
    months = table.groupBy(*MONTH).agg(F.sum("rows").alias("transaction_count"), F.sum("spend").alias("revenue"))
    average = precise_average(F.col("revenue"), F.col("transaction_count"))
    return months.select(
        *MONTH,
        "transaction_count",
        F.round("revenue", 2).cast("decimal(38,2)").alias("monthly_revenue"),
        F.round(average, 2).cast("decimal(38,2)").alias("avg_transaction_value"),
    ).orderBy(*[F.desc_nulls_first(column) for column in MONTH])


def year_month_coverage(table: DataFrame) -> DataFrame:
    counts = table.groupBy(*MONTH).agg(F.sum("rows").alias("records"))
    return counts.orderBy(*[F.asc_nulls_last(column) for column in MONTH])


def run_summary(table: DataFrame) -> DataFrame:
    """The same as reports.run_summary."""
    pairs = table.groupBy("customer_id", "product_id").agg(
        F.sum("rows").alias("rows"),
        F.sum("spend").alias("revenue"),
        F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"),
    )
    return pairs.agg(
        F.count_distinct("customer_id").alias("total_customers"),
        F.count_distinct("product_id").alias("total_products"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_transactions"),
        F.round(F.sum("revenue"), 2).cast("decimal(38,2)").alias("total_revenue"),
        F.min("first_day").alias("earliest_transaction"),
        F.max("last_day").alias("latest_transaction"),
    )


def dim_customer(table: DataFrame, as_of: dt.date | None = None, surplus: DataFrame | None = None) -> DataFrame:
    """The same as marts.dim_customer. `surplus` has (customer_id, surplus) where transaction ids repeat."""
    by_name = table.select("customer_id", "product_name", "rows", "first_day", "last_day")
    if surplus is not None:
        off = surplus.select("customer_id", (-F.col("surplus")).alias("rows"))
        by_name = by_name.unionByName(off, allowMissingColumns=True)
    return marts.customer_dimension(by_name, as_of)


def dim_product(table: DataFrame, surplus: DataFrame | None = None) -> DataFrame:
    """The same as marts.dim_product. `surplus` has (product_id, product_name, surplus) where transaction ids repeat."""
    known = table.where(F.col("product_id").isNotNull())
    per_customer = known.groupBy("product_id", "product_name", "customer_id").agg(
        F.sum("rows").alias("ids"),
        F.sum("rows").alias("prices"),
        F.sum("price_sum").alias("price_sum"),
        F.sum("spend").alias("revenue"),
    )
    if surplus is not None:
        off = surplus.where(F.col("product_id").isNotNull())
        off = off.select("product_id", "product_name", (-F.col("surplus")).alias("ids"))
        per_customer = per_customer.unionByName(off, allowMissingColumns=True)
    return marts.product_dimension(per_customer)
