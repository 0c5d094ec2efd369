"""Small frames of the shapes the rules work on."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from ledgermill.schemas import RAW_COLUMNS, RAW_SCHEMA

GOOD = {
    "transaction_id": "1",
    "customer_id": "501.0",
    "transaction_date": "2023-07-11",
    "product_id": "101",
    "product_name": "Product A",
    "quantity": "2.0",
    "price": "76.27",
    "tax": "8.23",
}


def raw_frame(spark: SparkSession, *changes: dict) -> DataFrame:
    """One good raw row per given dict, with the dict's columns replaced."""
    stamp = (dt.datetime(2023, 7, 21), "transactions.csv")
    rows = [tuple({**GOOD, **change}[name] for name in RAW_COLUMNS) + stamp for change in changes]
    return spark.createDataFrame(rows, RAW_SCHEMA)


STG_SCHEMA = """transaction_id bigint, customer_id bigint, transaction_date date, product_id bigint,
    product_name string, quantity decimal(10,2), price decimal(12,2), tax decimal(12,2),
    total_amount decimal(23,4), tax_amount decimal(12,2), data_quality_flag string, loaded_at timestamp,
    processed_at timestamp"""


def stg_row(
    number: int,
    customer: int = 1,
    day: dt.date = dt.date(2023, 7, 11),
    product: int | None = 101,
    name: str | None = "Product A",
    quantity: str = "1.00",
    price: str = "10.00",
    tax: str = "0.50",
    flag: str | None = "CLEAN",
) -> tuple:
    q, p, t = Decimal(quantity), Decimal(price), Decimal(tax)
    stamp = dt.datetime(2023, 7, 21)
    return (number, customer, day, product, name, q, p, t, q * p, t, flag, stamp, stamp)


def stg_frame(spark: SparkSession, *rows: tuple) -> DataFrame:
    return spark.createDataFrame(list(rows), STG_SCHEMA)


def as_set(df: DataFrame) -> set[tuple]:
    rows = [tuple(row) for row in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)
