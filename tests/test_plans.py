"""Properties of the physical plans that matter at scale."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from ledgermill.plans import checks, marts, reports, staging
from ledgermill.plans.run import read_tables, write_marts, write_staging
from ledgermill.schemas import FACT_COLUMNS
from ledgermill.sources.raw_csv import load_raw
from ledgermill.sources.tables import Layout, gathered, overwrite
from tests.helpers import raw_frame
from verification.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
EAGER = ("csv_scan", "load_metadata", "raw_reload_idempotent", "raw_row_count", "declared_tests")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_small_tables(spark):
    """Plans as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    layout = Layout(str(tmp_path_factory.mktemp("plans")))
    days = [{"transaction_id": str(i), "transaction_date": f"2023-{1 + i % 12:02d}-15"} for i in range(48)]
    load_raw(raw_frame(spark, *days, {"transaction_id": "100", "price": "Two Hundred"}), layout.raw)
    write_staging(spark, layout)
    write_marts(spark, layout, dt.date(2023, 12, 31), staging.ID_TYPE)
    return layout, read_tables(spark, layout)


@pytest.mark.parametrize("name", [name for name in QUERIES if name not in EAGER])
def test_no_cross_product_and_no_python(spark, no_small_tables, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert not re.search("Cartesian|NestedLoop|Python|Pandas|ArrowEval", plan)


def test_staging_needs_no_shuffle(spark):
    for name in ("base_transactions", "stg_transactions", "audit_transactions", "dq_issues"):
        assert "Exchange" not in plan_of(QUERIES[name](spark, FOLDER))


def test_key_filters_reach_the_raw_scan(spark, stored):
    plan = plan_of(staging.base_transactions(spark.read.parquet(stored[0].raw)))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan).group(1)
    for column in ("transaction_id", "customer_id", "transaction_date"):
        assert f"IsNotNull({column})" in pushed


def test_patterns_run_once_per_row(spark, stored):
    plan = plan_of(staging.stg_transactions(staging.base_transactions(spark.read.parquet(stored[0].raw))))
    assert plan.count("RLIKE(quantity") == 1
    assert plan.count("RLIKE(price") == 1


def test_a_narrow_report_reads_narrow_columns(spark, stored):
    plan = plan_of(reports.flag_distribution(stored[1]["fact_transactions"]))
    assert "ReadSchema: struct<data_quality_flag:string>" in plan


def test_clean_rows_are_told_by_their_folder(spark, stored):
    plan = plan_of(stored[1]["stg_transactions"].groupBy("customer_id").count())
    assert re.search(r"PartitionFilters: \[.*outcome.*= clean", plan)
    assert "ReadSchema: struct<customer_id:bigint>" in plan


def test_recent_spend_skips_old_months(spark, stored):
    tables = stored[1]
    fact, customers = tables["fact_transactions"], tables["dim_customer"]
    df = reports.recent_customer_spend(fact, customers, dt.date(2023, 12, 31))
    assert re.search(r"PartitionFilters: \[.*transaction_year", plan_of(df))
    recent = fact.where("transaction_year * 12 + transaction_month >= 2023 * 12 + 12")
    assert 0 < len(recent.inputFiles()) <= len(fact.inputFiles())
    assert df.agg(F.sum("transaction_count")).first()[0] == 4


def test_fact_shuffles_its_rows_once_per_window(spark, stored, no_small_tables):
    cut = marts.customer_spend(chunk_rows=10), marts.product_quantity(chunk_rows=10)
    fact = marts.fact_transactions(stored[1]["stg_transactions"], *cut)
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window [sum(total_amount") == plan.count("Window [sum(quantity") == 1
    # Sorted merge joins take the windows as they are: the line below each join is the window itself.
    lines = plan.splitlines()
    below = [lines[i + 1] for i, line in enumerate(lines) if re.search(r"SortMergeJoin .*LeftOuter", line)]
    assert len(below) == 2
    assert all("Window [sum(" in line for line in below)


def test_a_table_within_a_chunk_needs_no_offsets(spark, stored, no_small_tables):
    plan = plan_of(marts.fact_transactions(stored[1]["stg_transactions"]))
    assert plan.count("Window [sum(total_amount") == plan.count("Window [sum(quantity") == 1
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan


def test_dimensions_copy_no_rows(spark, stored):
    stg = stored[1]["stg_transactions"]
    for dim in (marts.dim_customer(stg), marts.dim_product(stg), marts.dim_customer(stg, unique_ids=True)):
        assert "Expand" not in plan_of(dim)


def test_issue_log_spreads_only_bad_rows(spark):
    before, between, _ = plan_of(QUERIES["dq_issues"](spark, FOLDER)).split("Generate inline")
    assert "Filter" in before and "Filter" in between


def test_month_folders_take_one_more_shuffle_of_staging_columns(spark, stored):
    fact = marts.fact_transactions(stored[1]["stg_transactions"], by_month=True)
    assert tuple(fact.columns) == FACT_COLUMNS
    plan = plan_of(fact)
    rebalance = next(line for line in plan.splitlines() if "REBALANCE_PARTITIONS_BY_COL" in line)
    assert "_year" in rebalance and "_month" in rebalance
    assert plan.index("tax_percentage") < plan.index("REBALANCE_PARTITIONS_BY_COL") < plan.index("Window")


def test_a_large_month_is_split_over_files(spark, stored, tmp_path):
    """With a tiny advisory size, the one month that holds nearly all rows is written by several tasks."""
    rows = spark.range(200_000).select(
        F.when(F.col("id") < 10, 1).otherwise(2).alias("m"), F.hash("id").alias("x"), F.uuid().alias("y")
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        overwrite(gathered(rows.repartition(8), "m"), str(tmp_path / "t"), ("m",))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "t" / "m=1").glob("*.parquet"))) == 1
    assert len(list((tmp_path / "t" / "m=2").glob("*.parquet"))) > 3


def test_table_tests_shuffle_ids_once_and_read_the_fact_three_times(spark, stored, no_small_tables):
    plan = checks.run_tests(stored[1])._jdf.queryExecution().executedPlan().toString()
    by_id = re.findall(r"Exchange hashpartitioning\((?:key|transaction_id)#\d+L?[,)]", plan)
    keys = re.findall(r"keys=\[transaction_id#\d+L?[^\]]*\], functions=\[partial_count", plan)
    assert len(keys) == 2, keys  # staging and fact
    assert len(by_id) <= 4  # and the keys of the dimensions
    assert len(re.findall(r"FileScan parquet [^\n]*fact_transactions", plan)) <= 3
