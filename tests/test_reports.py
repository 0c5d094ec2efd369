import datetime as dt
from decimal import Decimal

import pytest

from ledgermill.plans import marts, reports
from tests.helpers import as_set, stg_frame, stg_row

AS_OF = dt.date(2023, 7, 31)


@pytest.fixture(scope="module")
def stg(spark):
    return stg_frame(
        spark,
        stg_row(1, customer=1, day=dt.date(2023, 7, 30), quantity="2.00", price="10.01"),
        stg_row(2, customer=1, day=dt.date(2023, 7, 1), product=102, name="Product B"),
        stg_row(3, customer=1, day=dt.date(2023, 6, 30)),
        stg_row(4, customer=2, day=dt.date(2022, 12, 31), product=103, name="Product C", price="100.00"),
    )


@pytest.fixture(scope="module")
def fact(stg):
    return marts.fact_rows(stg)


@pytest.fixture(scope="module")
def customers(stg):
    return marts.dim_customer(stg, AS_OF)


def test_monthly_revenue_newest_first(fact):
    assert [tuple(row) for row in reports.monthly_revenue(fact).collect()] == [
        (2023, 7, 2, Decimal("30.02"), Decimal("15.01")),
        (2023, 6, 1, Decimal("10.00"), Decimal("10.00")),
        (2022, 12, 1, Decimal("100.00"), Decimal("100.00")),
    ]


def test_year_month_coverage_oldest_first(fact):
    assert [tuple(row) for row in reports.year_month_coverage(fact).collect()] == [(2022, 12, 1), (2023, 6, 1), (2023, 7, 2)]


def test_recent_spend_counts_exactly_thirty_days(fact, customers):
    got = reports.recent_customer_spend(fact, customers, AS_OF)
    assert as_set(got) == {(1, "Active", 2, Decimal("30.0200"))}


def test_recent_spend_over_the_turn_of_a_year(fact, customers):
    got = reports.recent_customer_spend(fact, customers, dt.date(2023, 1, 5))
    assert {row.customer_id: row.total_spend for row in got.collect()}[2] == Decimal("100.0000")


def test_overall_statistics(fact, customers):
    assert tuple(reports.overall_statistics(fact, customers).first()) == (
        2,
        3,
        4,
        Decimal("140.02"),
        Decimal("35.01"),
        Decimal("100.00"),
    )


def test_run_summary(fact):
    assert tuple(reports.run_summary(fact).first()) == (
        2,
        3,
        4,
        Decimal("140.02"),
        dt.date(2022, 12, 31),
        dt.date(2023, 7, 30),
    )


def test_run_summary_of_nothing(spark, fact):
    assert tuple(reports.run_summary(fact.limit(0)).first()) == (0, 0, 0, None, None, None)


def test_date_range(fact):
    assert tuple(reports.fact_date_range(fact).first()) == (dt.date(2022, 12, 31), dt.date(2023, 7, 30), 4)


def test_counts(spark, fact, customers):
    assert as_set(reports.layer_row_counts({"fact": fact, "customers": customers})) == {("fact", 4), ("customers", 2)}
    assert as_set(reports.status_distribution(customers)) == {("Active", 1), ("Inactive", 1)}
    assert as_set(reports.flag_percentage(fact)) == {("CLEAN", 4, Decimal("100.00"))}
    assert reports.high_flag_count(fact).first().high_issues == 0
    assert [tuple(row) for row in reports.flag_distribution(fact).collect()] == [("CLEAN", 4)]


def test_flag_order_puts_missing_last(spark):
    fact = marts.fact_rows(stg_frame(spark, stg_row(1, flag=None), stg_row(2, flag="B"), stg_row(3, flag="A")))
    assert [row.data_quality_flag for row in reports.flag_distribution(fact).collect()] == ["A", "B", None]


def test_orphans_and_duplicates(stg, fact, customers):
    assert reports.orphaned_facts(fact, customers).first().orphaned_facts == 0
    assert reports.orphaned_facts(fact, customers.where("customer_id = 2")).first().orphaned_facts == 3
    assert reports.duplicate_ids(fact).collect() == []
    assert [tuple(row) for row in reports.duplicate_ids(fact.union(fact)).collect()] == [(2,)] * 4


def test_samples(fact, stg, customers):
    assert [row.transaction_id for row in reports.sample_fact(fact).collect()] == [1, 2, 3, 4]
    assert reports.sample_staging(stg).columns == ["transaction_id", "customer_id", "price", "data_quality_flag"]
    assert [row.customer_id for row in reports.sample_dim_customer(customers).collect()] == [1, 2]


def test_missing_values(spark):
    df = spark.createDataFrame(
        [(1, None, None, 1), (None, None, None, None)],
        "transaction_id int, customer_id int, transaction_date date, quantity int",
    )
    assert tuple(reports.missing_values(df).first()) == (1, 2, 2, 1)


def test_latest_load_batch(spark):
    stamps = [dt.datetime(2023, 7, 20, 23), dt.datetime(2023, 7, 21, 1), dt.datetime(2023, 7, 21, 9)]
    raw = spark.createDataFrame([(stamp,) for stamp in stamps], "loaded_at timestamp")
    assert tuple(reports.latest_load_batch(raw).first()) == (stamps[2], 2)
