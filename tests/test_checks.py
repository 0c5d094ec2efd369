import datetime as dt
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgermill.operators.issues import issue_log
from ledgermill.operators.keys import keys_without_parent, repeated_keys, rows_without_parent
from ledgermill.plans import checks
from ledgermill.plans.checks import DECLARED_TESTS, DataQualityError, TableTest
from ledgermill.schemas import ISSUE_SCHEMA
from tests.helpers import as_set, raw_frame, stg_frame, stg_row


def test_declared_tests_are_complete():
    assert len(DECLARED_TESTS) == 35
    assert Counter(test.kind for test in DECLARED_TESTS) == {
        "not_null": 23,
        "unique": 4,
        "accepted_values": 4,
        "relationships": 2,
        "null_key": 1,
        "repeated_key": 1,
    }


def test_each_kind_counts_what_it_says(spark):
    child = spark.createDataFrame([(1, "a"), (1, "x"), (2, "x"), (2, "y"), (None, None), (None, "a")], "k int, v string")
    parent = spark.createDataFrame([(1,), (None,)], "k int")
    tests = [
        TableTest("child", "not_null", "k"),
        TableTest("child", "not_null", "v"),
        TableTest("child", "unique", "k"),
        TableTest("child", "repeated_key", "k"),
        TableTest("child", "accepted_values", "v", ("a", "b")),
        TableTest("child", "relationships", "k", to="parent", field="k"),
        TableTest("child", "null_key", "k"),
        TableTest("parent", "unique", "k"),
    ]
    results = checks.run_tests({"child": child, "parent": parent}, tests)
    assert as_set(results) == {
        ("child", "not_null", "k", 2, "fail"),
        ("child", "not_null", "v", 1, "fail"),
        ("child", "unique", "k", 2, "fail"),
        ("child", "repeated_key", "k", 3, "fail"),
        ("child", "accepted_values", "v", 2, "fail"),
        ("child", "relationships", "k", 2, "fail"),
        ("child", "null_key", "k", 2, "fail"),
        ("parent", "unique", "k", 0, "pass"),
    }


def test_unknown_kind(spark):
    with pytest.raises(ValueError, match="unknown kind"):
        checks.run_tests({"t": spark.range(1)}, [TableTest("t", "magic", "id")])


def test_orphans_and_repeats(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (2,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    assert as_set(keys_without_parent(child, "k", parent, "k")) == {(2, 3), (None, 1)}
    assert rows_without_parent(child, "k", parent, "k").first().rows == 4
    assert rows_without_parent(parent, "k", child, "k").first().rows == 0
    assert as_set(repeated_keys(child, "k")) == {(1, 2), (2, 3)}


def test_named_checks_name_the_first_failing_one_in_order(spark):
    df = spark.range(10)
    listed = [("none", F.col("id") < 0), ("large", F.col("id") > 7), ("odd", F.col("id") % 2 == 1)]
    rows = checks.named_checks(df, listed).orderBy("position").collect()
    assert [(row.check_name, row.issues, row.status) for row in rows] == [
        ("none", 0, "pass"),
        ("large", 2, "fail"),
        ("odd", 5, "fail"),
    ]
    with pytest.raises(DataQualityError, match="check 'large' counts 2 bad rows"):
        checks.require_checks(df, listed)
    checks.require_checks(df, listed[:1])


def test_sql_checks(spark):
    spark.range(10).createOrReplaceTempView("ten")
    passing = ("none", "SELECT count(*) FROM ten WHERE id < 0")
    checks.require_sql_checks(spark, [passing, ("no row", "SELECT id FROM ten WHERE id < 0")])
    with pytest.raises(DataQualityError, match="second"):
        checks.require_sql_checks(
            spark,
            [passing, ("second", "SELECT count(*) FROM ten"), ("third", "SELECT no_such_column FROM ten")],
        )


@pytest.mark.parametrize("hours, status", [(24, "pass"), (24.001, "warn"), (48, "warn"), (48.001, "error")])
def test_freshness(spark, hours, status):
    now = dt.datetime(2023, 7, 21, 12)
    df = spark.createDataFrame([(now - dt.timedelta(hours=hours),), (dt.datetime(2000, 1, 1),)], "loaded_at timestamp")
    assert checks.freshness(df, now).first().status == status


def test_freshness_of_an_empty_table_is_an_error(spark):
    assert checks.freshness(spark.createDataFrame([], "loaded_at timestamp")).first().status == "error"


def test_flag_summary(spark):
    rows = [stg_row(1), stg_row(2, flag=None), stg_row(3, flag="HIGH")]
    summary = checks.flag_summary(stg_frame(spark, *rows))
    share = Decimal("33.33")
    assert [tuple(row) for row in summary.collect()] == [("CLEAN", 1, share), ("HIGH", 1, share), ("UNKNOWN", 1, share)]


def test_issue_log(spark):
    log = issue_log(
        raw_frame(
            spark,
            {},
            {"transaction_id": "T1010", "customer_id": None},
            {"transaction_id": "2", "product_id": "P100", "product_name": "Product E", "price": "Two Hundred"},
            {"transaction_id": "3", "product_id": None, "product_name": None, "transaction_date": "2023-13-45"},
            {"transaction_id": "4", "quantity": None, "tax": ""},
        )
    )
    assert [(f.name, f.dataType) for f in log.schema] == [(f.name, f.dataType) for f in ISSUE_SCHEMA]
    kept = ("column_name", "row_number", "issue_type", "raw_value", "corrected_value", "severity")
    assert as_set(log.select(*kept)) == {
        ("transaction_id", 1010, "invalid", "T1010", None, "HIGH"),
        ("customer_id", 1010, "missing", None, None, "HIGH"),
        ("product_id", 2, "invalid", "P100", "105", "LOW"),
        ("price", 2, "invalid", "Two Hundred", None, "MEDIUM"),
        ("product_id", 3, "missing", None, None, "LOW"),
        ("transaction_date", 3, "invalid", "2023-13-45", None, "HIGH"),
        ("quantity", 4, "missing", None, None, "MEDIUM"),
        ("tax", 4, "invalid", "", None, "MEDIUM"),
    }
    ids = [row.issue_id for row in log.collect()]
    assert len(set(ids)) == 8
    assert not any(row.resolved for row in log.collect())
