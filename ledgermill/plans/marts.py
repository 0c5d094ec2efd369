"""Fact table and dimensions, built from the clean staging rows."""

import datetime as dt
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import buckets
from ledgermill.functions.buckets import precise_average
from ledgermill.functions.calendar import date_parts, days_since
from ledgermill.operators.running_total import CHUNK_ROWS, HOT_GROUP_ROWS, RunningTotal, with_running_total
from ledgermill.sources.tables import ROW_HANDLE, gathered


def _fact_columns() -> list[Column | str]:
    return [
        "transaction_id",
        "customer_id",
        "product_id",
        "product_name",
        "transaction_date",
        *date_parts(F.col("transaction_date")),
        "quantity",
        F.col("price").alias("unit_price"),
        "tax_amount",
        "total_amount",
        buckets.percent(F.col("tax_amount"), F.col("total_amount")).alias("tax_percentage"),
        buckets.volume_category(F.col("quantity")).alias("volume_category"),
        buckets.price_category(F.col("price")).alias("price_category"),
        "data_quality_flag",
        "processed_at",
        F.current_timestamp().alias("created_at"),
    ]


def fact_rows(stg: DataFrame, *others: str) -> DataFrame:
    """One row per transaction with date parts and buckets: everything but the running totals, no shuffle. `others` are
    columns of stg to keep besides."""
    return stg.where(F.col("transaction_id").isNotNull()).select(*_fact_columns(), *others)


def customer_spend(hot_rows: int = HOT_GROUP_ROWS, chunk_rows: int = CHUNK_ROWS) -> RunningTotal:
    """Many customers, most of them small: only hot ones are cut."""
    return RunningTotal(
        "customer_cumulative_spend", "customer_id", "total_amount", hot_rows=hot_rows, chunk_rows=chunk_rows
    )


def product_quantity(hot_rows: int = 0, chunk_rows: int = CHUNK_ROWS) -> RunningTotal:
    """A handful of products share all rows: every one is cut."""
    return RunningTotal(
        "product_cumulative_quantity", "product_id", "quantity", hot_rows=hot_rows, chunk_rows=chunk_rows
    )


def fact_transactions(
    stg: DataFrame,
    spend: RunningTotal | None = None,
    quantity: RunningTotal | None = None,
    by_month: bool = False,
) -> DataFrame:
    """Fact rows with running totals; rows of one day and group are totalled in the order of the transaction id.

    The totals come first and the derived columns last, so that only staging columns go through the shuffles:
    one per total, and one more with `by_month`, which gathers the rows for a table in month folders. Where
    `stg` carries a row handle (see `with_row_handle`), repeated ids are spread and ordered by it.
    """
    spend, quantity = spend or customer_spend(), quantity or product_quantity()
    if set(ROW_HANDLE) <= set(stg.columns):
        spend, quantity = replace(spend, handle=ROW_HANDLE), replace(quantity, handle=ROW_HANDLE)
    rows = stg.where(F.col("transaction_id").isNotNull())
    totalled = with_running_total(with_running_total(rows, spend), quantity, source=rows)
    if by_month:
        day = F.col("transaction_date")
        totalled = gathered(totalled.withColumns({"_year": F.year(day), "_month": F.month(day)}), "_year", "_month")
    return totalled.select(*_fact_columns(), spend.name, quantity.name)


def dim_customer(stg: DataFrame, as_of: dt.date | None = None, unique_ids: bool = False) -> DataFrame:
    """One row per customer.

    Grouping by name first keeps the large aggregate on hash aggregation and shrinks a hot customer before
    the shuffle: the greatest text per group would force a sort of all rows. `unique_ids` says that the
    uniqueness check on transaction ids has passed; a row count then equals the distinct count, without
    shuffling the ids.
    """
    by_name = stg.groupBy("customer_id", "product_name").agg(
        F.count("transaction_id").alias("rows"),
        F.min("transaction_date").alias("first_day"),
        F.max("transaction_date").alias("last_day"),
    )
    ids = None if unique_ids else stg.groupBy("customer_id").agg(F.count_distinct("transaction_id").alias("total_transactions"))
    return customer_dimension(by_name, as_of, ids)


def customer_dimension(by_name: DataFrame, as_of: dt.date | None = None, ids: DataFrame | None = None) -> DataFrame:
    """The customers from (customer_id, product_name, rows, first_day, last_day), of which there may be several for a
    customer and name. `ids` has the distinct ids per customer where they differ from the rows."""
    profile = by_name.groupBy("customer_id").agg(
        F.max("product_name").alias("last_purchased_product"),
        F.sum("rows").alias("rows"),
        F.min("first_day").alias("first_transaction_date"),
        F.max("last_day").alias("last_transaction_date"),
    )
    if ids is None:
        profile = profile.withColumnRenamed("rows", "total_transactions")
    else:
        ids = ids.withColumnRenamed("customer_id", "counted_id")
        profile = profile.join(ids, F.col("customer_id").eqNullSafe(F.col("counted_id"))).drop("counted_id")
    idle = days_since(F.col("last_transaction_date"), as_of)
    return profile.select(
        "customer_id",
        "last_purchased_product",
        "total_transactions",
        "first_transaction_date",
        "last_transaction_date",
        idle.alias("days_since_last_purchase"),
        buckets.customer_status(idle).alias("customer_status"),
        F.current_timestamp().alias("created_at"),
        F.current_timestamp().alias("updated_at"),
    )


def dim_product(stg: DataFrame, unique_ids: bool = False) -> DataFrame:
    """One row per product id and name; rows without an id are left out.

    Rows are first reduced to one per product and customer, which also makes the customers countable. The two
    distinct counts are not put into one aggregate, as that copies every row once per count.
    """
    known = stg.where(F.col("product_id").isNotNull())
    per_customer = known.groupBy("product_id", "product_name", "customer_id").agg(
        F.count("transaction_id").alias("ids"),
        F.count("price").alias("prices"),
        F.sum("price").alias("price_sum"),
        F.sum(F.col("quantity") * F.col("price")).alias("revenue"),
    )
    ids = None
    if not unique_ids:
        ids = known.groupBy("product_id", "product_name").agg(F.count_distinct("transaction_id").alias("distinct_ids"))
    return product_dimension(per_customer, ids)


def product_dimension(per_customer: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """The products from one row per product, name and customer. `ids` has the distinct ids per product and name where
    they differ from the rows."""
    stats = per_customer.groupBy("product_id", "product_name").agg(
        F.sum("ids").alias("total_transactions"),
        F.count("customer_id").alias("total_customers"),
        F.sum("prices").alias("prices"),
        F.sum("price_sum").alias("price_sum"),
        F.sum("revenue").alias("revenue"),
    )
    if ids is not None:
        same_product = (stats.product_id == ids.product_id) & stats.product_name.eqNullSafe(ids.product_name)
        stats = stats.join(ids, same_product).select(
            *[stats[name] for name in stats.columns if name != "total_transactions"],
            F.col("distinct_ids").alias("total_transactions"),
        )
    average = precise_average(F.col("price_sum"), F.col("prices"))
    return stats.select(
        "product_id",
        "product_name",
        "total_transactions",
        "total_customers",
        F.round(average, 2).cast("decimal(13,2)").alias("avg_unit_price"),
        F.round("revenue", 2).cast("decimal(32,2)").alias("total_revenue"),
        F.current_timestamp().alias("created_at"),
    )
