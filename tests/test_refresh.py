"""Refreshes against full rebuilds over the same files, and what they read and write."""

import datetime as dt
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from ledgermill.plans import refresh as refreshes
from ledgermill.plans import reports
from ledgermill.plans import run as runs
from ledgermill.plans.checks import DataQualityError
from ledgermill.plans.refresh import refresh, stored
from ledgermill.operators import carried_total, id_sets, month_cells
from ledgermill.operators.keys import repeated_keys
from ledgermill.schemas import RAW_COLUMNS
from ledgermill.sources.raw_csv import MalformedCsvError
from ledgermill.sources.tables import FAILED, PUBLISHED, PUBLISHED_WITH_FAILURES, Warehouse
from verification import queries

AS_OF = dt.date(2023, 12, 1)
STAMPS = ("loaded_at", "processed_at", "created_at", "updated_at", "audited_at", "discovered_at", "issue_id", "source_file")


def lines(first: int, count: int, start: dt.date, days: int, seed: int = 1) -> list[str]:
    rng, out = random.Random(seed), []
    for number in range(first, first + count):
        day = start + dt.timedelta(days=rng.randrange(days))
        letter = rng.randrange(5)
        product = "" if rng.random() < 0.05 else str(101 + letter)
        name = "" if rng.random() < 0.05 else f"Product {'ABCDE'[letter]}"
        quantity = "" if rng.random() < 0.1 else f"{rng.randrange(1, 6)}.0"
        customer = "" if rng.random() < 0.1 else f"{rng.randrange(501, 510)}.0"
        text = f"{number},{customer},{day},{product},{name},{quantity},{rng.randrange(5000, 30000) / 100},1.25"
        out.append(text if product or name else text.replace(",,", ",101,", 1))
    return out


def put(folder, name: str, rows: list[str]) -> None:
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([",".join(RAW_COLUMNS), *rows]) + "\n")
    stamp = time.time_ns() - 10**9 * 60 + put.count * 10**9  # no two versions of a file have one time
    put.count += 1
    os.utime(folder / name, ns=(stamp, stamp))


put.count = 0


def without_stamps(df):
    kept = df.drop(*STAMPS)
    return kept.select(*[F.col(c).cast("decimal(38,4)").alias(c) if t.startswith("decimal") else F.col(c) for c, t in kept.dtypes])


def assert_like_a_full_run(spark, folder, root, tmp_path, **options):
    full = str(tmp_path / f"full-{time.time_ns()}")
    runs.run(spark, str(folder), full, AS_OF, **options)
    want = runs.read_tables(spark, runs.current_layout(spark, full))
    got = stored(spark, root).tables()
    assert got.keys() == want.keys()
    for name in want:
        a, b = without_stamps(got[name]), without_stamps(want[name])
        assert a.columns == b.columns, name
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty(), name


def fact_files(root) -> dict[int, set[str]]:
    out: dict[int, set[str]] = {}
    for part in (root / "store" / "fact").iterdir():
        for file in part.rglob("*.parquet"):
            year, month = (int(p.name.partition("=")[2]) for p in (file.parent.parent, file.parent))
            out.setdefault(100 * year + month, set()).add(str(file))
    return out


JULY, AUGUST, SEPTEMBER = dt.date(2023, 7, 1), dt.date(2023, 8, 1), dt.date(2023, 9, 1)


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    """Two months loaded from two files."""
    tmp = tmp_path_factory.mktemp("refresh")
    folder, root = tmp / "in", tmp / "w"
    put(folder, "july.csv", lines(1, 150, JULY, 31))
    put(folder, "august.csv", lines(1001, 150, AUGUST, 20, seed=2))
    first = refresh(spark, str(folder), str(root), AS_OF, fail_on_tests=False)
    return tmp, folder, root, first


def changes(result) -> dict[int, list[str]]:
    out: dict[int, list[str]] = {}
    for row in result.months:
        out.setdefault(row.month, []).append(row.change)
    return out


def test_refreshes_step_by_step(spark, base):
    """One story, as each step needs the one before: nothing new, a later day, a late row, a changed and a removed file."""
    tmp, folder, root, first = base
    place = str(root)
    assert first.files == {"new": 2} and first.loaded.rows_loaded == 300
    assert changes(first) == {202307: ["created"], 202308: ["created"]}
    files = fact_files(root)

    again = refresh(spark, str(folder), place, AS_OF, fail_on_tests=False)
    assert again.files == {"same": 2} and again.loaded.rows_loaded == 0 and again.summary == first.summary
    assert changes(again) == {202307: ["kept"], 202308: ["kept"]}
    assert fact_files(root) == files

    put(folder, "august-end.csv", lines(2001, 60, dt.date(2023, 8, 21), 8, seed=3))
    later = refresh(spark, str(folder), place, AS_OF, fail_on_tests=False)
    assert later.files == {"same": 2, "new": 1} and later.loaded.rows_loaded == 60
    assert changes(later) == {202307: ["kept"], 202308: ["kept", "appended"]}
    assert fact_files(root)[202307] == files[202307] and fact_files(root)[202308] > files[202308]

    files = fact_files(root)
    put(folder, "late.csv", ["3001,501.0,2023-07-02,101,Product A,3.0,100.00,1.25"])
    put(folder, "september.csv", lines(4001, 40, SEPTEMBER, 5, seed=4))
    late = refresh(spark, str(folder), place, AS_OF, fail_on_tests=False)
    assert changes(late) == {202307: ["rewritten"], 202308: ["kept", "kept"], 202309: ["created"]}
    assert fact_files(root)[202308] == files[202308]
    assert_like_a_full_run(spark, folder, place, tmp, fail_on_tests=False)

    files = fact_files(root)
    put(folder, "september.csv", lines(5001, 30, SEPTEMBER, 9, seed=5))
    (folder / "late.csv").unlink()
    changed = refresh(spark, str(folder), place, AS_OF, fail_on_tests=False)
    assert changed.files == {"same": 3, "changed": 1, "removed": 1} and changed.loaded.rows_loaded == 30
    assert changes(changed) == {202307: ["rewritten"], 202308: ["kept", "kept"], 202309: ["rewritten"]}
    assert fact_files(root)[202308] == files[202308]
    assert_like_a_full_run(spark, folder, place, tmp, fail_on_tests=False)

    cells, rows = stored(spark, place).cells(), stored(spark, place).fact_rows()
    for name in ("monthly_revenue", "year_month_coverage", "run_summary"):
        assert getattr(month_cells, name)(cells).collect() == getattr(reports, name)(rows).collect()

    (folder / "september.csv").unlink()
    gone = refresh(spark, str(folder), place, AS_OF, fail_on_tests=False)
    assert changes(gone) == {202307: ["kept"], 202308: ["kept", "kept"]}


def test_old_parts_go_when_no_kept_run_names_them(spark, tmp_path):
    folder, root = tmp_path / "in", tmp_path / "w"
    for step in range(3):
        put(folder, "a.csv", lines(1, 20, JULY, 5, seed=step))
        refresh(spark, str(folder), str(root), AS_OF, fail_on_tests=False)
    for table in ("raw", "parsed", "fact", "totals", "cells", "ids"):
        assert len(list((root / "store" / table).iterdir())) == Warehouse.KEPT_RUNS
    assert len(list((root / "runs").iterdir())) == Warehouse.KEPT_RUNS
    assert not list((root / "runs").glob("*/work"))


def test_a_refresh_that_fails_its_tests_is_not_published(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "w")
    good = ["1,501.0,2023-07-01,101,Product A,3.0,100.00,1.25"]
    put(folder, "a.csv", good)
    refresh(spark, str(folder), root, AS_OF)
    put(folder, "b.csv", good)  # an id that another file has
    with pytest.raises(DataQualityError, match="3 of 35"):
        refresh(spark, str(folder), root, AS_OF)
    assert stored(spark, root).fact().count() == 1
    assert [s.state for s in Warehouse(spark, root).states()] == [PUBLISHED, FAILED]
    result = refresh(spark, str(folder), root, AS_OF, fail_on_tests=False)
    assert result.files == {"same": 1, "new": 1} and result.repeated_ids == 1
    assert stored(spark, root).fact().count() == 2
    assert stored(spark, root).tables()["dim_customer"].first().total_transactions == 1
    states = Warehouse(spark, root).states()
    assert [s.state for s in states] == [PUBLISHED, PUBLISHED_WITH_FAILURES]
    assert any("unique: 1 failures" in problem for problem in states[1].problems)


def test_repeated_ids_are_found_and_counted_from_the_stored_sets(spark, tmp_path):
    """An id in two months, one three times in a month, and an untouched month that no suspect word reaches."""
    folder, root = tmp_path / "in", str(tmp_path / "w")
    put(folder, "july.csv", lines(1, 80, JULY, 31))
    put(folder, "august.csv", lines(1001, 80, AUGUST, 31, seed=2))
    assert refresh(spark, str(folder), root, AS_OF, fail_on_tests=False).repeated_ids == 0
    assert stored(spark, root).suspect_months() == []
    again = "70,501.0,2023-09-0{},101,Product A,2.0,10.00,1.25"
    other = "9000,502.0,2023-09-03,102,Product B,2.0,10.00,1.25"
    july = "7000,503.0,2023-07-05,101,Product A,1.0,11.00,1.25"
    put(folder, "september.csv", [again.format(1), again.format(2), *[other] * 3])
    put(folder, "october.csv", [july, "7000,503.0,2023-10-05,101,Product A,1.0,11.00,1.25"])
    result = refresh(spark, str(folder), root, AS_OF, fail_on_tests=False)
    now = stored(spark, root)
    assert {part.month for part in now.suspect_months()} == {202307, 202309, 202310}
    want = {(r.key, r.rows) for r in repeated_keys(now.fact_rows(), "transaction_id").collect()}
    assert {tuple(r) for r in now.repeated_ids().collect()} == want and len(want) == 3 == result.repeated_ids
    assert_like_a_full_run(spark, folder, root, tmp_path, fail_on_tests=False)


def test_only_days_after_stored_ones_take_starts_and_words_are_merged_once(spark, tmp_path, monkeypatch):
    """A first load sums each month on its own: no wide rows are joined to starts. Unique ids take one pass over all words,
    besides the one over the words of the part."""
    folder, root, calls = tmp_path / "in", str(tmp_path / "w"), []
    for module, name in ((carried_total, "with_offset"), (id_sets, "suspects")):
        original = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, _f=original, _n=name: (calls.append(_n), _f(*a))[1])
    put(folder, "july.csv", lines(1, 60, JULY, 20))
    refresh(spark, str(folder), root, AS_OF, fail_on_tests=False)
    assert sorted(calls) == ["suspects", "suspects"]
    calls.clear()
    put(folder, "july-end.csv", lines(1001, 60, dt.date(2023, 7, 21), 8, seed=2))
    refresh(spark, str(folder), root, AS_OF, fail_on_tests=False)
    assert sorted(calls) == ["suspects", "suspects", "with_offset", "with_offset"]
    assert_like_a_full_run(spark, folder, root, tmp_path, fail_on_tests=False)


def test_few_offsets_are_broadcast_and_many_are_joined(spark, tmp_path):
    """Whatever Spark guesses of the index's size; the totals are the same."""
    folder, root = tmp_path / "in", str(tmp_path / "w")
    put(folder, "a.csv", lines(1, 200, JULY, 80))
    refresh(spark, str(folder), root, AS_OF, fail_on_tests=False)
    now, threshold = stored(spark, root), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = now.fact()
        many = carried_total.carried(now.stored_fact(), now.index(), *refreshes.totals(), most_entries=0)
        joins = [df._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") for df in (few, many)]
        many = many.select(*few.columns)
        assert joins == [2, 0] and few.exceptAll(many).isEmpty() and many.exceptAll(few).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_refresh_query_sees_tables_that_have_changed(spark, tmp_path):
    """Each call makes its own refreshes; one that went on with those of an earlier call would miss the new rows."""
    days = F.expr("timestamp_ntz'1995-01-01 00:00:00' + make_dt_interval(int(id * 11 % 2404)) AS o_orderdate")
    orders = spark.range(400).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"), F.lit(90_000.5).alias("o_totalprice"), days
    )
    orders.where("id < 200").write.parquet(f"{tmp_path}/orders.parquet")
    before = queries.refresh_fact(spark, str(tmp_path)).count()
    orders.where("id >= 200").write.mode("append").parquet(f"{tmp_path}/orders.parquet")
    assert 0 < before < queries.refresh_fact(spark, str(tmp_path)).count()


def test_malformed_lines_fail_a_refresh_or_are_set_aside(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "w")
    put(folder, "a.csv", ["1,501.0,2023-07-01,101,Product A,3.0,100.00,1.25", "2,501.0,2023-07-01,101,Product A,3,1,0,1,2"])
    with pytest.raises(MalformedCsvError):
        refresh(spark, str(folder), root, AS_OF)
    result = refresh(spark, str(folder), root, AS_OF, on_malformed="quarantine")
    assert (result.loaded.rows_loaded, result.loaded.lines_rejected) == (1, 1)


def test_an_empty_file_and_no_clean_rows(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "w")
    put(folder, "a.csv", [])
    result = refresh(spark, str(folder), root, AS_OF)
    assert result.files == {"new": 1} and result.months == [] and result.summary.total_transactions == 0
    assert stored(spark, root).fact().collect() == []
    put(folder, "b.csv", ["1,501.0,2023-07-01,101,Product A,,100.00,1.25"])
    result = refresh(spark, str(folder), root, AS_OF)
    assert result.files == {"same": 1, "new": 1} and result.split.rejected == 1 and result.months == []
    assert stored(spark, root).tables()["audit_transactions"].count() == 1


def test_a_dimension_row_keeps_when_it_was_created(spark):
    old_time, new_time = dt.datetime(2023, 1, 1), dt.datetime(2023, 2, 1)
    schema = "customer_id long, total_transactions long, created_at timestamp, updated_at timestamp"
    old = spark.createDataFrame([(1, 5, old_time, old_time), (2, 6, old_time, old_time), (4, 1, old_time, old_time)], schema)
    new = spark.createDataFrame([(1, 5, new_time, new_time), (2, 7, new_time, new_time), (3, 1, new_time, new_time)], schema)
    got = {tuple(r) for r in refreshes.merged_dimension(new, old, ("customer_id",)).collect()}
    assert got == {(1, 5, old_time, old_time), (2, 7, old_time, new_time), (3, 1, new_time, new_time)}


def test_a_second_refresh_scans_no_file(spark, tmp_path):
    """The plan of the list has no scan of file contents."""
    folder = tmp_path / "in"
    put(folder, "a.csv", lines(1, 5, JULY, 3))
    from ledgermill.sources.file_manifest import listing

    plan = listing(spark, str(folder))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]
