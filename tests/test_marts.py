import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgermill.functions.buckets import precise_average
from ledgermill.plans import marts
from ledgermill.schemas import FACT_COLUMNS
from tests.helpers import as_set, stg_frame, stg_row


def fact_row(spark, **fields):
    return marts.fact_rows(stg_frame(spark, stg_row(1, **fields))).first()


def test_date_parts(spark):
    row = fact_row(spark, day=dt.date(2023, 1, 1))
    assert (row.transaction_year, row.transaction_month, row.transaction_quarter) == (2023, 1, 1)
    assert (row.transaction_day, row.transaction_week) == (1, 52)
    assert row.transaction_month_name == "January  "
    assert fact_row(spark, day=dt.date(2023, 9, 30)).transaction_month_name == "September"


@pytest.mark.parametrize(
    "quantity, label",
    [("5", "High Volume"), ("4.99", "Medium Volume"), ("3", "Medium Volume"), ("2.99", "Low Volume"), ("0", "Low Volume")],
)
def test_volume(spark, quantity, label):
    assert fact_row(spark, quantity=quantity).volume_category == label


@pytest.mark.parametrize(
    "price, label", [("250", "Premium"), ("249.99", "Standard"), ("100", "Standard"), ("99.99", "Budget")]
)
def test_price_category(spark, price, label):
    assert fact_row(spark, price=price).price_category == label


def test_tax_percentage(spark):
    row = fact_row(spark, quantity="2", price="10", tax="5")
    assert row.tax_percentage == Decimal(25)
    assert fact_row(spark, quantity="0").tax_percentage is None


def test_fact_columns(spark):
    fact = marts.fact_transactions(stg_frame(spark, stg_row(1), stg_row(2)))
    assert tuple(fact.columns) == FACT_COLUMNS
    assert len(FACT_COLUMNS) == 23
    types = dict(fact.dtypes)
    assert types["customer_cumulative_spend"] == "decimal(33,4)"
    assert types["product_cumulative_quantity"] == "decimal(20,2)"
    assert types["tax_percentage"] == "decimal(38,20)"
    assert sorted(row.product_cumulative_quantity for row in fact.collect()) == [1, 2]


def rows_with_repeats(spark):
    return stg_frame(
        spark,
        stg_row(1, customer=1, day=dt.date(2023, 7, 1), product=101, name="Product A", price="0.01"),
        stg_row(2, customer=1, day=dt.date(2023, 7, 9), product=102, name="Product B"),
        stg_row(2, customer=1, day=dt.date(2023, 7, 3), product=102, name="Product B"),
        stg_row(3, customer=2, day=dt.date(2023, 5, 1), product=101, name=None),
        stg_row(4, customer=3, day=dt.date(2022, 7, 1), product=None, name=None),
    )


def test_dim_customer(spark):
    dim = marts.dim_customer(rows_with_repeats(spark), as_of=dt.date(2023, 7, 31)).drop("created_at", "updated_at")
    assert as_set(dim) == {
        (1, "Product B", 2, dt.date(2023, 7, 1), dt.date(2023, 7, 9), 22, "Active"),
        (2, None, 1, dt.date(2023, 5, 1), dt.date(2023, 5, 1), 91, "Inactive"),
        (3, None, 1, dt.date(2022, 7, 1), dt.date(2022, 7, 1), 395, "Inactive"),
    }


@pytest.mark.parametrize("idle, status", [(30, "Active"), (31, "At Risk"), (90, "At Risk"), (91, "Inactive"), (-5, "Active")])
def test_status_limits(spark, idle, status):
    day = dt.date(2023, 7, 31)
    stg = stg_frame(spark, stg_row(1, day=day - dt.timedelta(days=idle)))
    assert marts.dim_customer(stg, as_of=day).first().customer_status == status


def test_dim_product_with_repeats_and_missing_names(spark):
    dim = marts.dim_product(rows_with_repeats(spark)).drop("created_at")
    assert as_set(dim) == {
        (101, "Product A", 1, 1, Decimal("0.01"), Decimal("0.01")),
        (101, None, 1, 1, Decimal("10.00"), Decimal("10.00")),
        (102, "Product B", 1, 1, Decimal("10.00"), Decimal("20.00")),
    }
    types = dict(dim.dtypes)
    assert (types["avg_unit_price"], types["total_revenue"]) == ("decimal(13,2)", "decimal(32,2)")


def test_average_is_rounded_once(spark):
    # 0.004999999 is below the tie; by way of six decimals it would become 0.005000 and then 0.01.
    total, count = F.lit("49999.99").cast("decimal(22,2)"), F.lit(10_000_000)
    average = spark.range(1).select(F.round(precise_average(total, count), 2)).first()[0]
    assert average == Decimal("0.00")
    tie = [stg_row(1, price="88.14"), stg_row(2, price="88.15")]
    assert marts.dim_product(stg_frame(spark, *tie)).first().avg_unit_price == Decimal("88.15")


def test_unique_id_shortcut_gives_the_same_dimensions(spark):
    rows = [stg_row(i, customer=i % 7, product=101 + i % 3, name=f"Product {'ABC'[i % 3]}") for i in range(200)]
    stg = stg_frame(spark, *rows)
    day = dt.date(2023, 7, 31)
    stamps = ("created_at", "updated_at")
    for build in (lambda unique: marts.dim_customer(stg, day, unique), lambda unique: marts.dim_product(stg, unique)):
        assert as_set(build(True).drop(*stamps)) == as_set(build(False).drop(*stamps))
