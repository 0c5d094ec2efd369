"""Declared table tests, named checks, freshness and the flag summary."""

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.operators.keys import rows_per_key
from ledgermill.operators.shares import counts_by, with_percentage
from ledgermill.schemas import PRICE_LABELS, REJECTION_LABELS, STATUS_LABELS, VOLUME_LABELS


class DataQualityError(ValueError):
    """A check found bad rows."""


@dataclass(frozen=True)
class TableTest:
    """A test of one column; it fails when it finds anything. `kind` says what is counted:

    not_null: NULL rows; unique: values seen more than once, NULL ignored; accepted_values: distinct values
    outside `values`, NULL ignored; relationships: non-NULL rows whose value is not in `to`.`field`;
    repeated_key: values seen more than once, NULL included; null_key: NULL rows (the last two are the
    stand-alone tests of the fact table).
    """

    table: str
    kind: str
    column: str
    values: tuple[str, ...] = ()
    to: str = ""
    field: str = ""


def _not_null(table: str, *columns: str) -> list[TableTest]:
    return [TableTest(table, "not_null", column) for column in columns]


DECLARED_TESTS: tuple[TableTest, ...] = (
    *_not_null("customer_transactions_raw", "transaction_id", "transaction_date"),
    TableTest("stg_transactions", "unique", "transaction_id"),
    *_not_null(
        "stg_transactions", "transaction_id", "customer_id", "transaction_date", "product_id", "quantity", "price"
    ),
    *_not_null("audit_transactions", "transaction_id", "rejection_reason"),
    TableTest("audit_transactions", "accepted_values", "rejection_reason", REJECTION_LABELS),
    TableTest("fact_transactions", "unique", "transaction_id"),
    *_not_null(
        "fact_transactions",
        "transaction_id",
        "customer_id",
        "product_id",
        "transaction_date",
        "quantity",
        "unit_price",
        "total_amount",
    ),
    TableTest("fact_transactions", "relationships", "customer_id", to="dim_customer", field="customer_id"),
    TableTest("fact_transactions", "relationships", "product_id", to="dim_product", field="product_id"),
    TableTest("fact_transactions", "accepted_values", "volume_category", VOLUME_LABELS),
    TableTest("fact_transactions", "accepted_values", "price_category", PRICE_LABELS),
    TableTest("dim_customer", "unique", "customer_id"),
    *_not_null("dim_customer", "customer_id", "total_transactions"),
    TableTest("dim_customer", "accepted_values", "customer_status", STATUS_LABELS),
    TableTest("dim_product", "unique", "product_id"),
    *_not_null("dim_product", "product_id", "product_name", "total_transactions", "avg_unit_price"),
    TableTest("fact_transactions", "null_key", "customer_id"),
    TableTest("fact_transactions", "repeated_key", "transaction_id"),
)


def _null_counts(df: DataFrame, tests: Sequence[TableTest]) -> DataFrame:
    """All NULL counts of one table from one pass over the columns it needs."""
    counts = df.agg(*[F.count_if(F.col(t.column).isNull()).alias(f"c{i}") for i, t in enumerate(tests)])
    cells = [
        F.struct(
            F.lit(t.table).alias("table_name"),
            F.lit(t.kind).alias("check_name"),
            F.lit(t.column).alias("column_name"),
            F.col(f"c{i}").alias("failures"),
        )
        for i, t in enumerate(tests)
    ]
    return counts.select(F.inline(F.array(*cells)))


def _key_counts(df: DataFrame, tests: Sequence[TableTest]) -> DataFrame:
    """Both kinds of repeated keys of one column, from one grouping of its rows."""
    counts = rows_per_key(df, tests[0].column).agg(
        F.count_if((F.col("rows") > 1) & F.col("key").isNotNull()).alias("unique"),
        F.count_if(F.col("rows") > 1).alias("repeated_key"),
    )
    cells = [
        F.struct(
            F.lit(t.table).alias("table_name"),
            F.lit(t.kind).alias("check_name"),
            F.lit(t.column).alias("column_name"),
            F.col(t.kind).alias("failures"),
        )
        for t in tests
    ]
    return counts.select(F.inline(F.array(*cells)))


def _value_counts(tables: dict[str, DataFrame], tests: Sequence[TableTest]) -> DataFrame:
    """Accepted values and relationships of one table, from one grouping by all the columns that they look at.

    The combinations are spread to one row per test and value, and summed per value before they meet the parents,
    so a hot key is one row at the join.
    """
    df = tables[tests[0].table]
    columns = list(dict.fromkeys(t.column for t in tests))
    combinations = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))
    cells = []
    for number, test in enumerate(tests):
        column = F.col(test.column)
        keep = ~column.isin(*test.values) if test.kind == "accepted_values" else column.isNotNull()
        cells.append(
            F.struct(
                F.lit(number).alias("number"),
                F.when(keep, column.cast("string")).alias("value"),
                F.col("rows"),
            )
        )
    values = combinations.select(F.inline(F.array(*cells))).where(F.col("value").isNotNull())
    values = values.groupBy("number", "value").agg(F.sum("rows").alias("rows"))
    parents = [
        tables[t.to].select(F.lit(n).alias("number"), F.col(t.field).cast("string").alias("value"))
        for n, t in enumerate(tests)
        if t.kind == "relationships"
    ]
    if parents:
        values = values.join(reduce(DataFrame.unionByName, parents), ["number", "value"], "left_anti")
    sums = []
    for number, test in enumerate(tests):
        own = F.col("number") == number
        sums.append(F.count_if(own) if test.kind == "accepted_values" else F.sum(F.when(own, F.col("rows"))))
    counts = values.agg(*[F.coalesce(x, F.lit(0)).alias(f"c{i}") for i, x in enumerate(sums)])
    cells = [
        F.struct(
            F.lit(t.table).alias("table_name"),
            F.lit(t.kind).alias("check_name"),
            F.lit(t.column).alias("column_name"),
            F.col(f"c{i}").alias("failures"),
        )
        for i, t in enumerate(tests)
    ]
    return counts.select(F.inline(F.array(*cells)))


def run_tests(
    tables: dict[str, DataFrame],
    tests: Sequence[TableTest] = DECLARED_TESTS,
    known: Mapping[tuple[str, str, str], int] | None = None,
) -> DataFrame:
    """(table_name, check_name, column_name, failures, status), one row per test, as a single Spark job.

    Each table is read at most three times: for NULLs, for each tested key, and for all values that are compared with
    lists or other tables. `known` has failures counted before, by table, kind and column.
    """
    known = known or {}
    groups: dict[tuple[str, ...], list[TableTest]] = {}
    parts = []
    for test in tests:
        if (test.table, test.kind, test.column) in known:
            failures = known[test.table, test.kind, test.column]
            cells = (F.lit(x) for x in (test.table, test.kind, test.column))
            row = tables[test.table].sparkSession.range(1)
            row = row.select(*cells, F.lit(failures).cast("bigint"))
            parts.append(row.toDF("table_name", "check_name", "column_name", "failures"))
        elif test.kind in ("not_null", "null_key"):
            groups.setdefault(("null", test.table), []).append(test)
        elif test.kind in ("unique", "repeated_key"):
            groups.setdefault(("key", test.table, test.column), []).append(test)
        elif test.kind in ("accepted_values", "relationships"):
            groups.setdefault(("value", test.table), []).append(test)
        else:
            raise ValueError(f"unknown kind of test: {test.kind}")
    for (kind, table, *_), group in groups.items():
        if kind == "null":
            parts.append(_null_counts(tables[table], group))
        elif kind == "key":
            parts.append(_key_counts(tables[table], group))
        else:
            parts.append(_value_counts(tables, group))
    status = F.when(F.col("failures") > 0, "fail").otherwise("pass")
    return reduce(DataFrame.unionByName, parts).withColumn("status", status)


def named_checks(df: DataFrame, checks: Sequence[tuple[str, Column]]) -> DataFrame:
    """Counts the rows that meet each bad-row condition, all in one pass: (position, check_name, issues, status)."""
    counts = df.agg(*[F.count_if(bad).alias(f"c{i}") for i, (_, bad) in enumerate(checks)])
    cells = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(name).alias("check_name"),
            F.col(f"c{i}").alias("issues"),
            F.when(F.col(f"c{i}") > 0, "fail").otherwise("pass").alias("status"),
        )
        for i, (name, _) in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*cells)))


def require_checks(df: DataFrame, checks: Sequence[tuple[str, Column]]) -> None:
    """Raises for the first failing check in the given order. The driver sees one row per check."""
    first = named_checks(df, checks).where("status = 'fail'").orderBy("position").first()
    if first is not None:
        raise DataQualityError(f"check {first.check_name!r} counts {first.issues} bad rows")


def sql_checks(spark: SparkSession, checks: Sequence[tuple[str, str]]) -> DataFrame:
    """Results of checks given as SQL, each of which counts issues in the first column of its first row: (position,
    check_name, issues, status). No row, or NULL, is no issue."""
    parts = []
    for position, (name, sql) in enumerate(checks, 1):
        found = spark.sql(sql).limit(1)
        found = found.toDF("issues", *[f"other{i}" for i in range(1, len(found.columns))])
        issues = found.agg(F.coalesce(F.max(F.col("issues").cast("bigint")), F.lit(0)).alias("issues"))
        status = F.when(F.col("issues") > 0, "fail").otherwise("pass")
        parts.append(
            issues.select(
                F.lit(position).alias("position"), F.lit(name).alias("check_name"), "issues", status.alias("status")
            )
        )
    return reduce(DataFrame.unionByName, parts)


def require_sql_checks(spark: SparkSession, checks: Sequence[tuple[str, str]]) -> None:
    """Runs SQL checks in order; each gives a count in its first row, and the first positive one raises."""
    for check in checks:
        row = sql_checks(spark, [check]).first()
        if row.status == "fail":
            raise DataQualityError(f"check {row.check_name!r} counts {row.issues} bad rows")


def freshness(
    df: DataFrame,
    as_of: dt.datetime | None = None,
    loaded_at: str = "loaded_at",
    warn_hours: int = 24,
    error_hours: int = 48,
) -> DataFrame:
    """Age of the newest row: (newest_load, age_hours, status), with status pass, warn or error.

    An `as_of` without offset is in the time zone of the session, like the stamps it is compared with.
    """
    now = F.current_timestamp() if as_of is None else F.lit(str(as_of)).cast("timestamp")
    seconds = F.unix_timestamp(now) - F.unix_timestamp(F.col("newest_load").cast("timestamp"))
    newest = df.agg(F.max(loaded_at).alias("newest_load")).withColumn("age_seconds", seconds)
    status = (
        F.when(F.col("age_seconds") > error_hours * 3600, "error")
        .when(F.col("age_seconds") > warn_hours * 3600, "warn")
        .when(F.col("age_seconds").isNotNull(), "pass")
        .otherwise("error")
    )
    return newest.select(
        "newest_load", F.floor(F.col("age_seconds") / 3600).cast("bigint").alias("age_hours"), status.alias("status")
    )


def flag_summary(df: DataFrame) -> DataFrame:
    """Rows and percentage per quality flag; a missing flag counts as UNKNOWN."""
    flag = F.coalesce("data_quality_flag", F.lit("UNKNOWN"))
    counts = counts_by(df, flag, "quality_flag", "record_count")
    return with_percentage(counts, "record_count").orderBy(F.asc_nulls_last("quality_flag"))
