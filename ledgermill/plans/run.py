"""One batch run: CSV -> raw -> staging -> marts -> tests -> summary. Every layer is a written table."""

import datetime as dt
import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from ledgermill.operators import issue_life
from ledgermill.operators.issues import issue_log
from ledgermill.operators.keys import repeated_keys
from ledgermill.plans import checks, marts, reports, staging
from ledgermill.schemas import FACT_COLUMNS, ISSUE_SCHEMA, require_schema
from ledgermill.sources.raw_csv import FAIL, LoadCounts, load_raw, read_csv
from ledgermill.sources.tables import (
    CLEAN,
    REJECTED,
    Layout,
    Warehouse,
    overwrite,
    read_table,
    with_row_handle,
)

log = logging.getLogger(__name__)

FACT_FOLDERS = ("transaction_year", "transaction_month")


@dataclass(frozen=True)
class SplitCounts:
    clean: int
    rejected: int


@dataclass(frozen=True)
class RunResult:
    loaded: LoadCounts
    split: SplitCounts
    repeated_ids: int
    test_results: list[Row]
    flags: list[Row]
    high_issues: int
    summary: Row
    freshness: Row | None = None


def write_staging(spark: SparkSession, layout: Layout, id_type: str = staging.ID_TYPE) -> SplitCounts:
    """Parses the raw table once and writes clean and rejected rows side by side."""
    counts = Observation("split")
    rows = staging.split_rows(staging.base_transactions(read_table(spark, layout.raw), id_type))
    observed = rows.observe(
        counts,
        F.count_if(F.col("outcome") == CLEAN).alias("clean"),
        F.count_if(F.col("outcome") == REJECTED).alias("rejected"),
    )
    overwrite(observed, layout.parsed, ("outcome",))
    return SplitCounts(**counts.get)


def _stored_outcome(spark: SparkSession, layout: Layout, outcome: str) -> DataFrame:
    """The rows of one outcome. The folder tells them apart: no amount has to be read and tested again."""
    return read_table(spark, layout.parsed).where(F.col("outcome") == outcome)


def read_staging(spark: SparkSession, layout: Layout) -> DataFrame:
    return staging.clean_columns(_stored_outcome(spark, layout, CLEAN))


def read_audit(spark: SparkSession, layout: Layout) -> DataFrame:
    return staging.rejected_columns(_stored_outcome(spark, layout, REJECTED))


def count_repeated_ids(stg: DataFrame) -> int:
    """Ids of staging rows that occur more than once: the outcome of the declared test, known before the marts."""
    return repeated_keys(stg.where(F.col("transaction_id").isNotNull()), "transaction_id").count()


def write_marts(spark: SparkSession, layout: Layout, as_of: dt.date | None, id_type: str, threads: int = 4) -> int:
    """Writes the marts and the issue log, which do not depend on each other, at the same time.

    Ids are checked for uniqueness first. When they are unique, the dimensions count rows instead of shuffling
    ids; when not, the running totals order and spread the repeated ids by the place where a row is stored.
    Returns the number of repeated ids.
    """
    stg = read_staging(spark, layout)
    repeated_ids = count_repeated_ids(stg)
    unique_ids = not repeated_ids
    fact_source = stg
    if not unique_ids:
        log.warning("transaction ids repeat")
        fact_source = with_stored_handle(spark, layout)
    jobs = (
        lambda: overwrite(marts.fact_transactions(fact_source, by_month=True), layout.fact, FACT_FOLDERS),
        lambda: overwrite(marts.dim_customer(stg, as_of, unique_ids), layout.dim_customer),
        lambda: overwrite(marts.dim_product(stg, unique_ids), layout.dim_product),
        lambda: _write_issues(spark, layout, id_type),
    )
    with ThreadPoolExecutor(threads) as pool:
        for done in [pool.submit(job) for job in jobs]:
            done.result()
    return repeated_ids


def _write_issues(spark: SparkSession, layout: Layout, id_type: str) -> None:
    """The log of cells holds what staging does not keep, so it reads the raw text once more."""
    issues = issue_log(read_table(spark, layout.raw), id_type)
    require_schema(issues, ISSUE_SCHEMA)
    overwrite(issues, layout.issues)


def _write_issue_life(spark: SparkSession, warehouse: Warehouse, layout: Layout) -> None:
    """Carries the issues of the last published run that kept them on to this one."""
    earlier = [kept.issue_life for kept in warehouse.kept_layouts() if warehouse.has(kept.issue_life)]
    life = read_table(spark, earlier[-1]) if earlier else None
    overwrite(issue_life.advance(life, read_table(spark, layout.issues), F.current_timestamp()), layout.issue_life)


def read_issue_life(spark: SparkSession, layout: Layout) -> DataFrame:
    """Issues over all runs: when each was first and last found, and when it was resolved."""
    return read_table(spark, layout.issue_life)


def with_stored_handle(spark: SparkSession, layout: Layout) -> DataFrame:
    """Staging rows with the handle of their stored row."""
    stored = with_row_handle(read_table(spark, layout.parsed)).where(F.col("outcome") == CLEAN)
    return staging.clean_columns(stored)


def read_tables(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """All tables by name."""
    return {
        "customer_transactions_raw": read_table(spark, layout.raw),
        "dq_issues": read_table(spark, layout.issues),
        "stg_transactions": read_staging(spark, layout),
        "audit_transactions": read_audit(spark, layout),
        "fact_transactions": read_table(spark, layout.fact, FACT_COLUMNS),
        "dim_customer": read_table(spark, layout.dim_customer),
        "dim_product": read_table(spark, layout.dim_product),
    }


def create_views(spark: SparkSession, layout: Layout) -> None:
    """Makes the tables available to spark.sql under their plain names, for this session."""
    for name, df in read_tables(spark, layout).items():
        df.createOrReplaceTempView(name)


def create_catalog(spark: SparkSession, layout: Layout) -> None:
    """Makes the tables of one run available under their layer names, such as marts.fact_transactions, for every
    session that shares the catalog. `run` does so again after each run when asked to."""
    sources = {
        "raw.customer_transactions_raw": layout.raw,
        "raw.dq_issues": layout.issues,
        "staging.stg_transactions": layout.parsed,
        "staging.audit_transactions": layout.parsed,
        "marts.fact_transactions": layout.fact,
        "marts.dim_customer": layout.dim_customer,
        "marts.dim_product": layout.dim_product,
    }
    selects = {
        "staging.stg_transactions": ", ".join(staging.CLEAN_COLUMNS) + " FROM {} WHERE outcome = " + f"'{CLEAN}'",
        "staging.audit_transactions": ", ".join(staging.REJECTED_COLUMNS) + " FROM {} WHERE outcome = " + f"'{REJECTED}'",
        "marts.fact_transactions": ", ".join(FACT_COLUMNS) + " FROM {}",
    }
    for layer in ("raw", "staging", "marts"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    for name, path in sources.items():
        select = selects.get(name, "* FROM {}").format(f"parquet.`{path}`")
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {select}")


def publish(
    warehouse: Warehouse, name: str, test_results: list[Row], fail_on_tests: bool = True, age: Row | None = None
) -> None:
    """The gate between the tables that a run has written and their readers.

    A run becomes the current one when all its tests pass, or when told to go on, with a mark that names the failed
    tests. Else it is noted as failed and raises; readers stay with the run before, as they do when the load is too old.
    """
    failed = [row for row in test_results if row.status == "fail"]
    problems = [f"{row.table_name}.{row.column_name} {row.check_name}: {row.failures} failures" for row in failed]
    for problem in problems:
        log.error(problem)
    reason = f"{len(failed)} of {len(test_results)} table tests failed" if failed and fail_on_tests else None
    if age is not None and age.status == "error":
        problems.append(f"the newest load is {age.age_hours} hours old")
        reason = reason or problems[-1]
    if reason:
        warehouse.fail(name, problems)
        raise checks.DataQualityError(reason)
    warehouse.commit(name, problems)


def current_layout(spark: SparkSession, root: str) -> Layout:
    """The tables of the last finished run."""
    return Warehouse(spark, root).current()


def run(
    spark: SparkSession,
    csv_path: str,
    root: str,
    as_of: dt.date | None = None,
    id_type: str = staging.ID_TYPE,
    fail_on_tests: bool = True,
    multi_line: bool = False,
    on_malformed: str = FAIL,
    catalog: bool = False,
    fresh_within_hours: tuple[int, int] | None = None,
) -> RunResult:
    """A full rebuild of all layers. Only counts and report rows reach the driver.

    The tables are written to a folder of this run and tested there; then it becomes the current one (see `publish`).
    Until then, readers keep the tables of the run before. `fresh_within_hours` (warn, error) also checks the age of the
    load. Time stamps are read and compared in UTC, whatever the session is set to.
    """
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        return _run(
            spark, csv_path, root, as_of, id_type, fail_on_tests, multi_line, on_malformed, catalog, fresh_within_hours
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def _run(
    spark: SparkSession,
    csv_path: str,
    root: str,
    as_of: dt.date | None,
    id_type: str,
    fail_on_tests: bool,
    multi_line: bool,
    on_malformed: str,
    catalog: bool,
    fresh_within_hours: tuple[int, int] | None,
) -> RunResult:
    warehouse = Warehouse(spark, root)
    name, layout = warehouse.new_run()
    rows = read_csv(spark, csv_path, multi_line, keep_problems=True)
    loaded = load_raw(rows, layout.raw, layout.rejected_lines, on_malformed)
    log.info("raw: %s", loaded)
    if loaded.lines_rejected:
        log.warning("%d lines set aside in %s", loaded.lines_rejected, layout.rejected_lines)
    split = write_staging(spark, layout, id_type)
    log.info("clean rows: %d, rejected rows: %d", split.clean, split.rejected)
    repeated_ids = write_marts(spark, layout, as_of, id_type)
    _write_issue_life(spark, warehouse, layout)
    tables = read_tables(spark, layout)
    known = {("stg_transactions", "unique", "transaction_id"): repeated_ids}
    test_results = checks.run_tests(tables, known=known).collect()
    age = None
    if fresh_within_hours:
        warn, error = fresh_within_hours
        age = checks.freshness(tables["customer_transactions_raw"], warn_hours=warn, error_hours=error).first()
    publish(warehouse, name, test_results, fail_on_tests, age)
    if catalog:
        create_catalog(spark, layout)
    fact = tables["fact_transactions"]
    flags = reports.flag_distribution(fact).collect()
    high = reports.high_flag_count(fact).first().high_issues
    if high > 0:
        log.warning("flag HIGH on %d fact rows", high)
    summary = reports.run_summary(fact).first()
    log.info("summary: %s", summary.asDict())
    return RunResult(loaded, split, repeated_ids, test_results, flags, high, summary, age)
