import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgermill.plans import run as runs
from ledgermill.plans.checks import DataQualityError
from ledgermill.schemas import RAW_COLUMNS
from ledgermill.sources.raw_csv import MalformedCsvError

AS_OF = dt.date(2023, 8, 1)


def messy_lines(count: int, repeat_ids: bool = False) -> list[str]:
    """CSV lines with every kind of dirt, from a fixed seed."""
    rng = random.Random(5)
    lines = []
    for number in range(1, count + 1):
        day = dt.date(2023, 7, 10) + dt.timedelta(days=rng.randrange(11))
        letter = rng.randrange(5)
        text_id = f"T{number}" if rng.random() < 0.1 else str(number % 50 + 1 if repeat_ids else number)
        lines.append(
            ",".join(
                (
                    text_id,
                    "" if rng.random() < 0.14 else f"{rng.randrange(501, 510)}.0",
                    day.strftime("%d-%m-%Y" if rng.random() < 0.12 else "%Y-%m-%d"),
                    "P100" if rng.random() < 0.06 else str(101 + letter),
                    f"Product {'ABCDE'[letter]}",
                    "" if rng.random() < 0.16 else f"{rng.randrange(1, 6)}.0",
                    "Two Hundred" if rng.random() < 0.11 else f"{rng.randrange(5000, 30000) / 100}",
                    "Fifteen" if rng.random() < 0.09 else f"{rng.randrange(500, 3000) / 100}",
                )
            )
        )
    return lines


def csv_file(folder, lines) -> str:
    path = folder / "transactions.csv"
    path.write_text("\n".join([",".join(RAW_COLUMNS), *lines]) + "\n")
    return str(path)


@pytest.fixture(scope="module")
def finished(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("run")
    path = csv_file(folder, messy_lines(400))
    root = str(folder / "warehouse")
    first = runs.run(spark, path, root, AS_OF)
    again = runs.run(spark, path, root, AS_OF)
    return first, again, runs.read_tables(spark, runs.current_layout(spark, root)), root


def test_all_declared_tests_pass(finished):
    assert [row.status for row in finished[0].test_results] == ["pass"] * 35


def test_second_run_gives_the_same_numbers(finished):
    first, again, _, _ = finished
    assert (first.loaded, first.split, first.summary, first.flags) == (again.loaded, again.split, again.summary, again.flags)


def test_every_raw_row_is_accounted_for(finished):
    first, _, tables, _ = finished
    raw = tables["customer_transactions_raw"]
    dropped = raw.where("transaction_id LIKE 'T%' OR customer_id IS NULL").count()
    clean, rejected = tables["stg_transactions"].count(), tables["audit_transactions"].count()
    assert (clean, rejected) == (first.split.clean, first.split.rejected)
    assert raw.count() == first.loaded.rows_loaded == 400 == clean + rejected + dropped
    assert min(dropped, rejected, clean) > 0
    assert tables["fact_transactions"].count() == clean
    assert tables["dim_customer"].agg(F.sum("total_transactions")).first()[0] == clean
    assert tables["dim_product"].agg(F.sum("total_transactions")).first()[0] == clean


def test_running_totals_end_at_the_sum(finished):
    fact = finished[2]["fact_transactions"]
    for group, value, total in (
        ("customer_id", "total_amount", "customer_cumulative_spend"),
        ("product_id", "quantity", "product_cumulative_quantity"),
    ):
        ends = fact.groupBy(group).agg(F.sum(value).alias("s"), F.max(total).alias("m"))
        assert ends.where("s <> m").count() == 0


def test_columns_are_in_table_order(finished):
    fact = finished[2]["fact_transactions"]
    assert fact.columns[0] == "transaction_id" and fact.columns[5] == "transaction_year"
    assert len(fact.columns) == 23


def test_issue_log_covers_every_dropped_and_rejected_row(finished):
    tables = finished[2]
    issues = tables["dq_issues"]
    severe = issues.where("severity <> 'LOW'").select("row_number").distinct()
    clean = tables["stg_transactions"].select(F.col("transaction_id").alias("row_number"))
    assert severe.join(clean, "row_number").count() == 0
    assert severe.count() + clean.count() == 400
    assert issues.count() == issues.select("issue_id").distinct().count()


def test_views(spark, finished):
    runs.create_views(spark, runs.current_layout(spark, finished[3]))
    count = spark.sql("SELECT count(*) FROM fact_transactions f JOIN dim_product p USING (product_id)").first()[0]
    assert count == finished[0].split.clean


def test_layer_names(spark, finished):
    """The names users have in their SQL give the same rows as the tables of the run."""
    result, _, tables, root = finished
    runs.create_catalog(spark, runs.current_layout(spark, root))
    layers = {"stg": "staging", "audit": "staging", "fact": "marts", "dim": "marts", "customer": "raw", "dq": "raw"}
    for name, table in tables.items():
        view = spark.table(f"{layers[name.split('_')[0]]}.{name}")
        assert view.dtypes == table.dtypes
        assert view.exceptAll(table).isEmpty() and table.exceptAll(view).isEmpty()
    stored = spark.sql(
        """SELECT sum(total_transactions) AS n FROM marts.dim_customer
           WHERE customer_id IN (SELECT customer_id FROM marts.fact_transactions)"""
    )
    assert stored.first().n == result.split.clean


def test_repeated_ids_fail_the_tests_but_keep_every_row(spark, tmp_path):
    path = csv_file(tmp_path, messy_lines(200, repeat_ids=True))
    root = str(tmp_path / "warehouse")
    with pytest.raises(DataQualityError, match="3 of 35"):
        runs.run(spark, path, root, AS_OF)
    result = runs.run(spark, path, root, AS_OF, fail_on_tests=False)
    tables = runs.read_tables(spark, runs.current_layout(spark, root))
    fact = tables["fact_transactions"]
    assert fact.count() == result.split.clean
    assert "row_file" not in fact.columns
    ends = fact.groupBy("product_id").agg(F.sum("quantity").alias("s"), F.max("product_cumulative_quantity").alias("m"))
    assert ends.where("s <> m").count() == 0
    distinct_ids = tables["stg_transactions"].select("customer_id", "transaction_id").distinct().count()
    assert tables["dim_customer"].agg(F.sum("total_transactions")).first()[0] == distinct_ids


GOOD_LINES = ["2500,501.0,2023-07-11,101,Product A,2,1.50,0.10", "2502,501.0,2023-07-12,101,Product A,1,2.00,0.20"]
SURPLUS_COMMA = "2501,501.0,2023-07-11,101,Product A,2,1,200.50,60.10"
NINTH_FIELD = "2503,501.0,2023-07-11,101,Product A,2,1.50,0.10,x"
OPEN_QUOTE = '2504,501.0,2023-07-11,101,"Product A,2,1.50,0.10'
SHORT = "2505,501.0,2023-07-11"


@pytest.mark.parametrize("line", [SURPLUS_COMMA, NINTH_FIELD, OPEN_QUOTE])
def test_a_line_without_a_certain_reading_fails_the_run_and_changes_nothing(spark, tmp_path, line):
    root = str(tmp_path / "warehouse")
    runs.run(spark, csv_file(tmp_path, GOOD_LINES), root, AS_OF)
    with pytest.raises(MalformedCsvError, match="1 lines"):
        runs.run(spark, csv_file(tmp_path, [*GOOD_LINES, line]), root, AS_OF)
    assert runs.read_tables(spark, runs.current_layout(spark, root))["fact_transactions"].count() == 2


def test_quarantine_keeps_such_lines_out_of_all_layers(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    path = csv_file(tmp_path, [*GOOD_LINES, SURPLUS_COMMA, NINTH_FIELD, OPEN_QUOTE, SHORT])
    result = runs.run(spark, path, root, AS_OF, on_malformed="quarantine", fail_on_tests=False)
    assert (result.loaded.rows_loaded, result.loaded.rows_short, result.loaded.lines_rejected) == (3, 1, 3)
    layout = runs.current_layout(spark, root)
    kept = spark.read.parquet(layout.rejected_lines).collect()
    assert {(r.line, r.problem) for r in kept} == {
        (SURPLUS_COMMA, "surplus fields"),
        (NINTH_FIELD, "surplus fields"),
        (OPEN_QUOTE, "broken quote"),
    }
    assert {r.source_file for r in kept} == {"transactions.csv"}
    tables = runs.read_tables(spark, layout)
    ids = {r.transaction_id for r in tables["customer_transactions_raw"].collect()}
    assert ids == {"2500", "2502", "2505"}
    assert tables["fact_transactions"].count() == 2


def test_quoted_line_breaks_need_multi_line(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    path = csv_file(tmp_path, [GOOD_LINES[0], "2502,501.0,2023-07-12,106,\"Product\nF\",1,2.00,0.20"])
    with pytest.raises(MalformedCsvError):
        runs.run(spark, path, root, AS_OF)
    result = runs.run(spark, path, root, AS_OF, multi_line=True, fresh_within_hours=(24, 48))
    assert result.loaded.rows_loaded == result.split.clean == 2
    assert result.freshness.status == "pass"


def test_a_run_that_fails_half_way_leaves_the_tables_of_the_last(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "warehouse")
    for lines in (GOOD_LINES[:1], GOOD_LINES):
        runs.run(spark, csv_file(tmp_path, lines), root, AS_OF)
    real = runs.overwrite

    def broken(df, path, *rest):
        if "dim_product" in path:
            raise OSError("disk full")
        real(df, path, *rest)

    monkeypatch.setattr(runs, "overwrite", broken)
    with pytest.raises(OSError):
        runs.run(spark, csv_file(tmp_path, GOOD_LINES[:1]), root, AS_OF)
    monkeypatch.undo()
    assert runs.read_tables(spark, runs.current_layout(spark, root))["fact_transactions"].count() == 2
    runs.run(spark, csv_file(tmp_path, GOOD_LINES[:1]), root, AS_OF)
    folders = sorted(p.name for p in (tmp_path / "warehouse" / "runs").iterdir())
    assert len(folders) == 2 and folders == sorted(
        p.name for p in (tmp_path / "warehouse" / "committed").iterdir() if not p.name.endswith(".crc")
    )


def test_the_session_time_zone_is_restored(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        runs.run(spark, csv_file(tmp_path, GOOD_LINES), str(tmp_path / "w"), AS_OF)
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
