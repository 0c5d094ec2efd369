"""Raw text rows -> typed base rows -> clean rows and rejected rows. Narrow work only: no shuffle, no join."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.functions import parsing as P
from ledgermill.schemas import CLEAN_FLAG, PRODUCT_IDS, REJECTION_LABELS
from ledgermill.sources.tables import CLEAN, REJECTED, ROW_HANDLE

# Ids are BIGINT by default: at 10^12 transactions a 32-bit id would overflow and lose rows.
ID_TYPE = "bigint"


def parsed_columns(id_type: str = ID_TYPE) -> dict[str, Column]:
    """Typed value of every raw column, from the raw text alone (product fields not yet filled in)."""
    return {
        "transaction_id": P.whole_number(F.col("transaction_id"), id_type),
        "customer_id": P.float_styled_id(F.col("customer_id"), id_type),
        "transaction_date": P.two_format_date(F.col("transaction_date")),
        "product_id": P.whole_number(F.col("product_id"), id_type),
        "product_name": F.col("product_name"),
        "quantity": P.amount(F.col("quantity"), "decimal(10,2)"),
        "price": P.amount(F.col("price"), "decimal(12,2)"),
        "tax": P.amount(F.col("tax"), "decimal(12,2)"),
    }


def quality_flags() -> list[Column]:
    """Cell flags on the raw text."""
    return [
        P.is_missing(F.col("transaction_id")).alias("is_transaction_id_missing"),
        P.is_missing(F.col("customer_id")).alias("is_customer_id_missing"),
        P.is_missing(F.col("transaction_date")).alias("is_date_missing"),
        P.is_missing(F.col("product_id")).alias("is_product_id_missing"),
        P.is_missing(F.col("quantity")).alias("is_quantity_missing"),
        P.fails(F.col("transaction_id"), P.DIGITS).alias("has_invalid_transaction_id"),
        P.matches(F.col("price"), P.LETTERS).alias("has_non_numeric_price"),
        P.matches(F.col("tax"), P.LETTERS).alias("has_non_numeric_tax"),
    ]


def product_id_of(name: Column, id_type: str = ID_TYPE) -> Column:
    """Catalogue id of a product name. Five fixed entries: a CASE in generated code, cheaper than a join."""
    trimmed = F.trim(name)
    found = F.lit(None)
    for product, number in PRODUCT_IDS.items():
        found = F.when(trimmed == product, number).otherwise(found)
    return found.cast(id_type)


def product_name_of(number: Column) -> Column:
    found = F.lit(None)
    for product, known in PRODUCT_IDS.items():
        found = F.when(number == known, product).otherwise(found)
    return found.cast("string")


def has_row_keys() -> Column:
    """Rows without an id, customer or date are dropped; they go neither to staging nor to audit."""
    return (
        F.col("transaction_id").isNotNull()
        & F.col("customer_id").isNotNull()
        & F.col("transaction_date").isNotNull()
    )


# The columns that decide whether a row is dropped, clean or rejected. Every table but raw needs them all.
DECIDING = ("transaction_id", "customer_id", "transaction_date", "quantity", "price", "tax")


def flagged_rows(raw: DataFrame, id_type: str = ID_TYPE, *others: str) -> DataFrame:
    """Every raw row with typed columns and flags, before rows are dropped and product fields filled.

    The deciding columns pass through a one-row inline. Otherwise the optimizer copies their parsing into the
    row filters above: every pattern would run twice, and the generated method would outgrow the size up to
    which the JVM compiles it. `others` are columns of raw to keep besides.
    """
    parsed = parsed_columns(id_type)
    # One select: the flags read the raw text, the typed columns take over the same names.
    rows = raw.select(
        F.inline(F.array(F.struct(*[parsed[name].alias(name) for name in DECIDING]))),
        parsed["product_id"].alias("product_id"),
        parsed["product_name"].alias("product_name"),
        *quality_flags(),
        "loaded_at",
        "source_file",
        *others,
    )
    return rows.select(*parsed, *rows.columns[len(parsed) :])


def base_transactions(raw: DataFrame, id_type: str = ID_TYPE, *others: str) -> DataFrame:
    # Rows without key text can be dropped by the scan, before any pattern is tried on them.
    rows = flagged_rows(raw.where(has_row_keys()), id_type, *others).where(has_row_keys())
    # Again one select: the name is filled from the parsed id, not from the id filled from the name.
    filled = {
        "product_id": F.coalesce("product_id", product_id_of(F.col("product_name"), id_type)),
        "product_name": F.coalesce("product_name", product_name_of(F.col("product_id"))),
    }
    return rows.select(*[filled[name].alias(name) if name in filled else name for name in rows.columns])


_ROW = ("transaction_id", "customer_id", "transaction_date", "product_id", "product_name", "quantity", "price", "tax")

# First failing amount, or NULL for a clean row.
REJECTION_REASON = "CASE " + " ".join(
    f"WHEN {amount} IS NULL THEN '{label}'" for amount, label in zip(("quantity", "price", "tax"), REJECTION_LABELS, strict=True)
) + " END"

# SQL of the columns of both staging tables over the stored parsed rows; the catalog's views use the same text.
CLEAN_COLUMNS = (
    *_ROW,
    "quantity * price AS total_amount",
    "tax AS tax_amount",
    f"'{CLEAN_FLAG}' AS data_quality_flag",
    "loaded_at",
    "processed_at",
)
REJECTED_COLUMNS = (
    *_ROW,
    f"{REJECTION_REASON} AS rejection_reason",
    "loaded_at",
    "source_file",
    "processed_at AS audited_at",
)


def is_clean() -> Column:
    return F.col("quantity").isNotNull() & F.col("price").isNotNull() & F.col("tax").isNotNull()


def split_rows(base: DataFrame) -> DataFrame:
    """Clean and rejected rows as one table with an `outcome` column, to be stored in one folder per outcome:
    the raw text is read and parsed once for both."""
    return base.select(
        "*",
        F.current_timestamp().alias("processed_at"),
        F.when(is_clean(), CLEAN).otherwise(REJECTED).alias("outcome"),
    )


def _stamped(base: DataFrame) -> DataFrame:
    """Rows of a written table have their stamp."""
    return base if "processed_at" in base.columns else base.withColumn("processed_at", F.current_timestamp())


def stg_transactions(base: DataFrame) -> DataFrame:
    return clean_columns(base.where(is_clean()))


def audit_transactions(base: DataFrame) -> DataFrame:
    return rejected_columns(base.where(~is_clean()))


def clean_columns(clean: DataFrame) -> DataFrame:
    return _stamped(clean).selectExpr(*CLEAN_COLUMNS, *[name for name in ROW_HANDLE if name in clean.columns])


def rejected_columns(rejected: DataFrame) -> DataFrame:
    return _stamped(rejected).selectExpr(*REJECTED_COLUMNS)
