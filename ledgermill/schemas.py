"""Fixed names, schemas and lookup values of the transaction data."""

from pyspark.sql import DataFrame
from pyspark.sql import types as T

RAW_COLUMNS = (
    "transaction_id",
    "customer_id",
    "transaction_date",
    "product_id",
    "product_name",
    "quantity",
    "price",
    "tax",
)

RAW_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in RAW_COLUMNS]
    + [T.StructField("loaded_at", T.TimestampType()), T.StructField("source_file", T.StringType())]
)

REJECTED_LINE_SCHEMA = T.StructType(
    [
        T.StructField("line", T.StringType()),
        T.StructField("problem", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("loaded_at", T.TimestampType()),
    ]
)

ISSUE_SCHEMA = T.StructType(
    [
        T.StructField("issue_id", T.LongType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("row_number", T.LongType()),
        T.StructField("issue_type", T.StringType()),
        T.StructField("issue_description", T.StringType()),
        T.StructField("raw_value", T.StringType()),
        T.StructField("corrected_value", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("discovered_at", T.TimestampType()),
        T.StructField("resolved", T.BooleanType()),
    ]
)


def require_schema(df: DataFrame, schema: T.StructType) -> None:
    """A table is only written with the names and types that its definition has."""
    have = [(f.name, f.dataType) for f in df.schema]
    want = [(f.name, f.dataType) for f in schema]
    if have != want:
        raise TypeError(f"columns {have} are not those of the table, {want}")


FACT_COLUMNS = (
    "transaction_id",
    "customer_id",
    "product_id",
    "product_name",
    "transaction_date",
    "transaction_year",
    "transaction_month",
    "transaction_quarter",
    "transaction_month_name",
    "transaction_day",
    "transaction_week",
    "quantity",
    "unit_price",
    "tax_amount",
    "total_amount",
    "tax_percentage",
    "volume_category",
    "price_category",
    "data_quality_flag",
    "processed_at",
    "created_at",
    "customer_cumulative_spend",
    "product_cumulative_quantity",
)

# The product catalogue used to fill a missing id or name.
PRODUCT_IDS = {
    "Product A": 101,
    "Product B": 102,
    "Product C": 103,
    "Product D": 104,
    "Product E": 105,
}

# The texts that the CSV loader reads as "no value".
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Labels written by the rules.
CLEAN_FLAG = "CLEAN"
VOLUME_LABELS = ("High Volume", "Medium Volume", "Low Volume")
PRICE_LABELS = ("Premium", "Standard", "Budget")
STATUS_LABELS = ("Active", "At Risk", "Inactive")
REJECTION_LABELS = ("NULL quantity", "NULL price", "NULL tax")
