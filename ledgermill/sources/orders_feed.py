"""The `orders` test table reshaped as raw transaction text with deterministic dirt (rules by order key)."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Load stamp and file name given to the reshaped rows.
LOADED_AT = "2001-08-02 01:00:00"
SOURCE_FILE = "orders.parquet"


def _money(total: Column, factor: str) -> Column:
    """Exact decimal arithmetic, so that the text does not depend on how an engine prints doubles."""
    return (total.cast("decimal(15,2)") * F.lit(factor).cast("decimal(6,5)")).cast("decimal(12,2)").cast("string")


def raw_from_orders(orders: DataFrame, *others: str) -> DataFrame:
    """`others` are columns of orders to keep besides."""
    k = F.col("o_orderkey")
    number = k.cast("string")
    customer = F.col("o_custkey").cast("string")
    day = F.col("o_orderdate").cast("date")
    letter = F.substring(F.lit("ABCDE"), (1 + k % 5).cast("int"), F.lit(1))
    return orders.select(
        F.when(k % 10 == 3, F.concat(F.lit("T"), number)).otherwise(number).alias("transaction_id"),
        F.when(k % 7 == 0, F.lit(None))
        .when(k % 7 == 1, customer)
        .otherwise(F.concat(customer, F.lit(".0")))
        .alias("customer_id"),
        F.when(k % 8 == 0, F.date_format(day, "dd-MM-yyyy"))
        .when(k % 97 == 0, "unknown")
        .otherwise(day.cast("string"))
        .alias("transaction_date"),
        F.when(k % 20 == 5, F.concat(F.lit("P"), (100 + k % 5).cast("string")))
        .when(k % 33 == 0, F.lit(None))
        .otherwise((101 + k % 5).cast("string"))
        .alias("product_id"),
        F.when(k % 19 != 0, F.concat(F.lit("Product "), letter)).alias("product_name"),
        F.when(k % 6 != 0, F.concat((1 + k % 5).cast("string"), F.lit(".0"))).alias("quantity"),
        F.when(k % 9 == 0, "Two Hundred").otherwise(_money(F.col("o_totalprice"), "0.001")).alias("price"),
        F.when(k % 11 == 0, "Fifteen").otherwise(_money(F.col("o_totalprice"), "0.00005")).alias("tax"),
        F.lit(LOADED_AT).cast("timestamp").alias("loaded_at"),
        F.lit(SOURCE_FILE).alias("source_file"),
        *others,
    )


def read_raw_from_orders(spark: SparkSession, folder: str) -> DataFrame:
    return raw_from_orders(spark.read.parquet(f"{folder}/orders.parquet"))
