"""Cell-level issue log: one row per raw cell that is missing or cannot be read. No shuffle.

Row order is never needed: `row_number` is the number in the raw transaction id (also for ids such as T1010),
and `issue_id` is unique by task and position, like a serial column.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.plans.staging import ID_TYPE, parsed_columns, product_id_of

TABLE_NAME = "customer_transactions_raw"

# HIGH: the row is dropped. MEDIUM: the row is rejected. LOW: the row is kept.
SEVERITY = {
    "transaction_id": "HIGH",
    "customer_id": "HIGH",
    "transaction_date": "HIGH",
    "product_id": "LOW",
    "quantity": "MEDIUM",
    "price": "MEDIUM",
    "tax": "MEDIUM",
}


def _bad(column: str) -> Column:
    return F.col(f"parsed_{column}").isNull()


def _cell(column: str) -> Column:
    raw = F.col(column)
    missing = raw.isNull()
    corrected = F.col("filled_product_id").cast("string") if column == "product_id" else F.lit(None).cast("string")
    return F.struct(
        F.lit(column).alias("column_name"),
        F.when(missing, "missing").otherwise("invalid").alias("issue_type"),
        F.when(missing, f"{column} is missing")
        .otherwise(F.concat(F.lit(f"{column} cannot be read: "), raw))
        .alias("issue_description"),
        raw.alias("raw_value"),
        corrected.alias("corrected_value"),
        F.lit(SEVERITY[column]).alias("severity"),
        _bad(column).alias("bad"),
    )


def issue_log(raw: DataFrame, id_type: str = ID_TYPE) -> DataFrame:
    parsed = parsed_columns(id_type)
    # Raw and typed values side by side, the typed ones through a one-row inline as in `flagged_rows`. Rows
    # without a bad cell leave before the rest is spread into cells.
    rows = raw.select(
        F.inline(F.array(F.struct(*[parsed[name].alias(f"parsed_{name}") for name in SEVERITY]))),
        *SEVERITY,
        product_id_of(F.col("product_name"), id_type).alias("filled_product_id"),
        F.regexp_extract("transaction_id", "([0-9]+)", 1).try_cast(id_type).alias("row_number"),
    )
    any_bad = F.lit(False)
    for column in SEVERITY:
        any_bad = any_bad | _bad(column)
    cells = rows.where(any_bad).select("row_number", F.inline(F.array(*[_cell(name) for name in SEVERITY])))
    return cells.where("bad").select(
        F.monotonically_increasing_id().alias("issue_id"),
        F.lit(TABLE_NAME).alias("table_name"),
        "column_name",
        "row_number",
        "issue_type",
        "issue_description",
        "raw_value",
        "corrected_value",
        "severity",
        F.current_timestamp().alias("discovered_at"),
        F.lit(False).alias("resolved"),
    )
