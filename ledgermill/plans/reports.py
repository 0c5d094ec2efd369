"""Reports over the layers. Each takes the tables it reads and returns a DataFrame."""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.functions.buckets import precise_average
from ledgermill.functions.calendar import today
from ledgermill.operators.keys import repeated_keys, rows_without_parent
from ledgermill.operators.shares import counts_by, with_percentage

MONTH = ("transaction_year", "transaction_month")


def row_count(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def layer_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(tbl, row_count) of every given table."""
    union = None
    for name, df in tables.items():
        counted = row_count(df, "row_count").select(F.lit(name).alias("tbl"), "row_count")
        union = counted if union is None else union.unionByName(counted)
    return union


def sample(df: DataFrame, n: int, columns: tuple[str, ...], key: str) -> DataFrame:
    """First n rows by key: a top-n per task, never a full sort."""
    return df.select(*columns).orderBy(F.asc_nulls_last(key)).limit(n)


def sample_raw(raw: DataFrame) -> DataFrame:
    return sample(raw, 3, tuple(raw.columns), "transaction_id")


def sample_staging(stg: DataFrame) -> DataFrame:
    return sample(stg, 5, ("transaction_id", "customer_id", "price", "data_quality_flag"), "transaction_id")


def sample_dim_customer(customers: DataFrame) -> DataFrame:
    columns = ("customer_id", "total_transactions", "customer_status", "days_since_last_purchase")
    return sample(customers, 5, columns, "customer_id")


def sample_fact(fact: DataFrame) -> DataFrame:
    columns = (
        "transaction_id",
        "customer_id",
        "transaction_date",
        "total_amount",
        "volume_category",
        "price_category",
    )
    return sample(fact, 5, columns, "transaction_id")


def issues_by_type(issues: DataFrame) -> DataFrame:
    return counts_by(issues, F.col("issue_type"), "issue_type", "issue_count")


def flag_distribution(df: DataFrame) -> DataFrame:
    counts = counts_by(df, F.col("data_quality_flag"), "data_quality_flag", "record_count")
    return counts.orderBy(F.asc_nulls_last("data_quality_flag"))


def high_flag_count(fact: DataFrame) -> DataFrame:
    return row_count(fact.where(F.col("data_quality_flag") == "HIGH"), "high_issues")


def status_distribution(customers: DataFrame) -> DataFrame:
    return counts_by(customers, F.col("customer_status"), "customer_status", "customer_count")


def monthly_revenue(fact: DataFrame) -> DataFrame:
    """Count, revenue and average per month, newest month first."""
    months = fact.groupBy(*MONTH).agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("total_amount").alias("revenue"),
        F.count("total_amount").alias("amounts"),
    )
    return months.select(
        *MONTH,
        "transaction_count",
        F.round("revenue", 2).cast("decimal(38,2)").alias("monthly_revenue"),
        F.round(precise_average(F.col("revenue"), F.col("amounts")), 2)
        .cast("decimal(38,2)")
        .alias("avg_transaction_value"),
    ).orderBy(*[F.desc_nulls_first(column) for column in MONTH])


def flag_percentage(fact: DataFrame) -> DataFrame:
    counts = counts_by(fact, F.col("data_quality_flag"), "data_quality_flag", "record_count")
    return with_percentage(counts, "record_count")


def missing_values(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count_if(F.col("transaction_id").isNull()).alias("null_transaction_id"),
        F.count_if(F.col("customer_id").isNull()).alias("null_customer_id"),
        F.count_if(F.col("transaction_date").isNull()).alias("null_date"),
        F.count_if(F.col("quantity").isNull()).alias("null_quantity"),
    )


def orphaned_facts(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Fact rows without a customer row, also those without a customer id."""
    orphans = rows_without_parent(fact, "customer_id", customers, "customer_id")
    return orphans.select(F.col("rows").alias("orphaned_facts"))


def duplicate_ids(fact: DataFrame) -> DataFrame:
    """One row per repeated transaction id: how often it occurs."""
    return repeated_keys(fact, "transaction_id").select(F.col("rows").alias("duplicate_ids"))


def fact_date_range(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.min("transaction_date").alias("earliest_date"),
        F.max("transaction_date").alias("latest_date"),
        F.count_distinct("transaction_date").alias("unique_dates"),
    )


def year_month_coverage(fact: DataFrame) -> DataFrame:
    counts = fact.groupBy(*MONTH).agg(F.count(F.lit(1)).alias("records"))
    return counts.orderBy(*[F.asc_nulls_last(column) for column in MONTH])


def recent_customer_spend(fact: DataFrame, customers: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Transactions and spend of the last 30 days per customer and status.

    Facts are summed per customer before the join: a hot customer is one row by then. The month filter follows
    from the day filter; it lets a fact table stored in month folders skip the older ones.
    """
    since = F.date_sub(today(as_of), 30)
    month = F.col("transaction_year") * 12 + F.col("transaction_month")
    spend = (
        fact.where((F.col("transaction_date") >= since) & (month >= F.year(since) * 12 + F.month(since)))
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("total_amount").alias("spend"))
    )
    return (
        spend.join(customers.select("customer_id", "customer_status"), "customer_id")
        .groupBy("customer_id", "customer_status")
        .agg(F.sum("rows").alias("transaction_count"), F.sum("spend").alias("total_spend"))
    )


def overall_statistics(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Six numbers in one row: one pass over the fact, one over the customers."""
    totals = fact.agg(
        F.count_distinct("product_id").alias("unique_products"),
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum("total_amount").alias("revenue"),
        F.count("total_amount").alias("amounts"),
        F.max("total_amount").alias("largest"),
    )
    return totals.select(
        row_count(customers, "unique_customers").scalar().alias("unique_customers"),
        "unique_products",
        "total_transactions",
        F.round("revenue", 2).cast("decimal(38,2)").alias("total_revenue"),
        F.round(precise_average(F.col("revenue"), F.col("amounts")), 2)
        .cast("decimal(38,2)")
        .alias("avg_transaction_amount"),
        F.round("largest", 2).cast("decimal(38,2)").alias("max_transaction_amount"),
    )


def run_summary(fact: DataFrame) -> DataFrame:
    """Six-number summary of a run.

    Facts are first reduced to one row per customer and product, so that the two distinct counts work on that
    small table and not on copies of every fact.
    """
    pairs = fact.groupBy("customer_id", "product_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("total_amount").alias("revenue"),
        F.min("transaction_date").alias("first_day"),
        F.max("transaction_date").alias("last_day"),
    )
    return pairs.agg(
        F.count_distinct("customer_id").alias("total_customers"),
        F.count_distinct("product_id").alias("total_products"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_transactions"),
        F.round(F.sum("revenue"), 2).cast("decimal(38,2)").alias("total_revenue"),
        F.min("first_day").alias("earliest_transaction"),
        F.max("last_day").alias("latest_transaction"),
    )


def latest_load_batch(raw: DataFrame) -> DataFrame:
    """Newest load day: its last load time and row count."""
    days = raw.groupBy(F.to_date("loaded_at").alias("load_day")).agg(
        F.max("loaded_at").alias("last_load_time"), F.count(F.lit(1)).alias("records_in_last_load")
    )
    return days.orderBy(F.desc_nulls_first("load_day")).limit(1).drop("load_day")
