import datetime as dt
from decimal import Decimal

import pytest

from ledgermill.plans import staging
from tests.helpers import raw_frame


def base_row(spark, **change):
    rows = staging.base_transactions(raw_frame(spark, change)).collect()
    return rows[0] if rows else None


def test_good_row(spark):
    row = base_row(spark)
    assert (row.transaction_id, row.customer_id, row.transaction_date) == (1, 501, dt.date(2023, 7, 11))
    assert (row.product_id, row.product_name) == (101, "Product A")
    assert (row.quantity, row.price, row.tax) == (Decimal("2.00"), Decimal("76.27"), Decimal("8.23"))
    assert not any(row[name] for name in row.asDict() if name.startswith(("is_", "has_")))


@pytest.mark.parametrize(
    "change",
    [
        {"transaction_id": "T1010"},
        {"transaction_id": None},
        {"customer_id": None},
        {"customer_id": "501.5"},
        {"transaction_date": "unknown"},
        {"transaction_date": "2023-13-45"},
    ],
)
def test_rows_without_keys_are_dropped(spark, change):
    assert base_row(spark, **change) is None


def test_product_id_from_trimmed_name(spark):
    row = base_row(spark, product_id="P100", product_name=" Product E ")
    assert (row.product_id, row.product_name) == (105, " Product E ")
    assert not row.is_product_id_missing


def test_product_name_from_id(spark):
    assert base_row(spark, product_id="103", product_name=None).product_name == "Product C"


def test_id_outside_the_catalogue_has_no_name(spark):
    row = base_row(spark, product_id="100", product_name=None)
    assert (row.product_id, row.product_name) == (100, None)


def test_name_outside_the_catalogue_has_no_id(spark):
    assert base_row(spark, product_id=None, product_name="Product Z").product_id is None


def test_known_values_are_not_replaced(spark):
    row = base_row(spark, product_id="100", product_name="Product E")
    assert (row.product_id, row.product_name) == (100, "Product E")


def test_both_product_fields_missing_is_kept(spark):
    row = base_row(spark, product_id=None, product_name=None)
    assert (row.product_id, row.product_name, row.is_product_id_missing) == (None, None, True)


def test_flags_read_the_raw_text(spark):
    flags = staging.flagged_rows(
        raw_frame(
            spark,
            {"transaction_id": "T1"},
            {"transaction_id": None},
            {"customer_id": None},
            {"transaction_date": None},
            {"product_id": None},
            {"quantity": None},
            {"price": "Two Hundred"},
            {"tax": "Fifteen"},
            {"price": "-5"},
        )
    ).collect()
    names = [name for name in flags[0].asDict() if name.startswith(("is_", "has_"))]
    assert [[name for name in names if row[name]] for row in flags] == [
        ["has_invalid_transaction_id"],
        ["is_transaction_id_missing"],
        ["is_customer_id_missing"],
        ["is_date_missing"],
        ["is_product_id_missing"],
        ["is_quantity_missing"],
        ["has_non_numeric_price"],
        ["has_non_numeric_tax"],
        [],
    ]


def test_split_and_first_reason(spark):
    base = staging.base_transactions(
        raw_frame(
            spark,
            {"transaction_id": "1"},
            {"transaction_id": "2", "quantity": None, "price": "Two Hundred"},
            {"transaction_id": "3", "price": "Two Hundred", "tax": "Fifteen"},
            {"transaction_id": "4", "tax": "Fifteen"},
        )
    )
    clean = staging.stg_transactions(base).collect()
    assert [(row.transaction_id, row.total_amount, row.data_quality_flag) for row in clean] == [
        (1, Decimal("152.5400"), "CLEAN")
    ]
    reasons = {row.transaction_id: row.rejection_reason for row in staging.audit_transactions(base).collect()}
    assert reasons == {2: "NULL quantity", 3: "NULL price", 4: "NULL tax"}


def test_types(spark):
    types = dict(staging.stg_transactions(staging.base_transactions(raw_frame(spark, {}))).dtypes)
    assert types["transaction_id"] == "bigint"
    assert types["quantity"] == "decimal(10,2)"
    assert types["price"] == types["tax_amount"] == "decimal(12,2)"
    assert types["total_amount"] == "decimal(23,4)"
    small = dict(staging.base_transactions(raw_frame(spark, {}), id_type="int").dtypes)
    assert small["transaction_id"] == small["customer_id"] == small["product_id"] == "int"
