import datetime as dt

from pyspark.sql import functions as F

from ledgermill.operators.issue_life import advance, found_issues
from ledgermill.operators.issues import issue_log
from ledgermill.plans import run as runs
from tests.helpers import raw_frame

DAYS = [dt.datetime(2024, 1, day) for day in (1, 2, 3, 4)]


def lives(spark, *runs_of_rows):
    life = None
    for day, rows in zip(DAYS, runs_of_rows, strict=False):
        log = issue_log(raw_frame(spark, *rows))
        life = advance(life, log, F.lit(day))
    return {(r.column_name, r.row_number, r.raw_value): r for r in life.collect()}


def test_an_issue_is_opened_resolved_and_reopened(spark):
    bad_price = {"transaction_id": "1", "price": "Two Hundred"}
    no_customer = {"transaction_id": "2", "customer_id": None}
    good = {"transaction_id": "1"}
    price = ("price", 1, "Two Hundred")

    first = lives(spark, [bad_price, no_customer])
    assert {r.change for r in first.values()} == {"opened"} and not any(r.resolved for r in first.values())

    second = lives(spark, [bad_price, no_customer], [good, no_customer])
    row = second[price]
    assert (row.change, row.resolved, row.first_found, row.last_found, row.resolved_at) == (
        ("resolved", True, DAYS[0], DAYS[0], DAYS[1])
    )
    row = second["customer_id", 2, None]
    assert (row.change, row.resolved, row.first_found, row.last_found) == ("still open", False, DAYS[0], DAYS[1])

    third = lives(spark, [bad_price], [good], [good])[price]
    assert (third.change, third.resolved_at) == ("closed", DAYS[1])
    again = lives(spark, [bad_price], [good], [good], [bad_price])[price]
    assert (again.change, again.resolved, again.first_found, again.last_found, again.resolved_at) == (
        ("reopened", False, DAYS[0], DAYS[3], None)
    )


def test_another_wrong_value_is_another_issue(spark):
    seen = lives(spark, [{"transaction_id": "1", "tax": "x"}], [{"transaction_id": "1", "tax": "y"}])
    assert seen["tax", 1, "x"].change == "resolved" and seen["tax", 1, "y"].change == "opened"


def test_keys_are_stable_and_rows_without_an_id_are_counted(spark):
    rows = [{"transaction_id": None, "price": ""}] * 5 + [{"transaction_id": None, "price": None}]
    found = found_issues(issue_log(raw_frame(spark, *rows)))
    got = {(r.column_name, r.raw_value): r.occurrences for r in found.collect()}
    assert got == {("transaction_id", None): 6, ("price", ""): 5, ("price", None): 1}
    again = found_issues(issue_log(raw_frame(spark, *reversed(rows)).repartition(3)))
    assert {r.issue_key for r in found.collect()} == {r.issue_key for r in again.collect()}
    assert len({r.issue_key for r in found.collect()}) == 3


def test_no_issues(spark):
    good, bad = [{"transaction_id": "1"}], [{"transaction_id": "1", "tax": None}]
    assert lives(spark, good, good) == {}
    assert [r.change for r in lives(spark, good, bad).values()] == ["opened"]


def test_the_join_moves_one_row_per_issue(spark):
    log = issue_log(raw_frame(spark, {"transaction_id": "1", "tax": None}))
    life = advance(advance(None, log, F.lit(DAYS[0])), log, F.lit(DAYS[1]))
    plan = life._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join FullOuter") < plan.index("Aggregate")


def test_runs_carry_the_life_on(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "root")
    folder.mkdir()
    head = "transaction_id,customer_id,transaction_date,product_id,product_name,quantity,price,tax\n"
    good = "1,10,2023-07-01,100,Product A,2,10.00,1.00\n"
    for line in ("2,11,2023-07-02,101,Product B,1,Two,1.00\n", "2,11,2023-07-02,101,Product B,1,5.00,1.00\n"):
        (folder / "a.csv").write_text(head + good + line)
        runs.run(spark, str(folder), root, as_of=dt.date(2023, 8, 1), fail_on_tests=False)
    rows = runs.read_issue_life(spark, runs.current_layout(spark, root)).collect()
    assert [(r.column_name, r.raw_value, r.change, r.resolved) for r in rows] == [("price", "Two", "resolved", True)]
    assert rows[0].first_found < rows[0].resolved_at
