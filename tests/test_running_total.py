"""Running totals against a plain Python sum, with group sizes and limits that force every path."""

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgermill.operators.running_total import Chunks, RunningTotal, with_running_total
from ledgermill.plans import marts
from ledgermill.sources.tables import ROW_HANDLE, overwrite, read_table, with_row_handle
from tests.helpers import stg_frame, stg_row

SCHEMA = "id bigint, grp bigint, day date, amount decimal(10,2)"


def skewed_rows(seed: int, count: int = 1500) -> list[tuple]:
    """A third of the rows in group 1, a third of those on one day; some rows without group or amount."""
    rng = random.Random(seed)
    rows = []
    for number in rng.sample(range(10 * count), count):
        group = 1 if rng.random() < 0.34 else rng.choice([None, 2, 3, *range(10, 60)])
        offset = 5 if group == 1 and rng.random() < 0.5 else rng.randrange(30)
        amount = None if rng.random() < 0.1 else Decimal(rng.randrange(100_000)) / 100
        rows.append((number, group, dt.date(2023, 7, 1) + dt.timedelta(days=offset), amount))
    return rows


def expected(rows: list[tuple]) -> dict[int, Decimal | None]:
    groups = defaultdict(list)
    for number, group, day, amount in rows:
        groups[group].append((day, number, amount))
    totals = {}
    for members in groups.values():
        total = None
        for _, number, amount in sorted(members, key=lambda member: member[:2]):
            if amount is not None:
                total = amount if total is None else total + amount
            totals[number] = total
    return totals


@pytest.mark.parametrize("hot_rows, chunk_rows", [(10**9, 10**6), (0, 10**6), (0, 64), (100, 64), (100, 1), (25, 200)])
def test_every_split_gives_the_same_totals(spark, hot_rows, chunk_rows):
    rows = skewed_rows(seed=hot_rows + chunk_rows)
    spec = RunningTotal("total", "grp", "amount", "day", "id", hot_rows=hot_rows, chunk_rows=chunk_rows)
    got = with_running_total(spark.createDataFrame(rows, SCHEMA).repartition(5), spec)
    assert {row.id: row.total for row in got.collect()} == expected(rows)
    assert got.schema["total"].dataType.simpleString() == "decimal(20,2)"
    assert got.columns == ["id", "grp", "day", "amount", "total"]


@pytest.mark.parametrize("hot_rows, chunk_rows", [(10**9, 10**6), (10**9, 64), (0, 64), (60, 16), (25, 200)])
@pytest.mark.parametrize("handle", [None, ("id", "part")])
def test_totals_start_anew_within_a_part_of_a_group(spark, hot_rows, chunk_rows, handle):
    rows = skewed_rows(seed=hot_rows + chunk_rows)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("part", F.dayofmonth("day") % 3).repartition(5)
    spec = RunningTotal("total", "grp", "amount", "day", "id", hot_rows, chunk_rows, handle, within=("part",))
    got = with_running_total(df, spec)
    want = {}
    for part in range(3):
        want |= expected([row for row in rows if row[2].day % 3 == part])
    assert {row.id: row.total for row in got.collect()} == want
    assert got.columns == ["id", "grp", "day", "amount", "part", "total"]


def test_last_total_of_a_group_is_its_sum(spark):
    rows = [row for row in skewed_rows(seed=3) if row[3] is not None]
    df = spark.createDataFrame(rows, SCHEMA)
    spec = RunningTotal("total", "grp", "amount", "day", "id", hot_rows=50, chunk_rows=32)
    last = with_running_total(df, spec).groupBy("grp").agg(F.max("total").alias("last"))
    sums = df.groupBy("grp").agg(F.sum("amount").alias("last"))
    assert sorted(map(str, last.collect())) == sorted(map(str, sums.collect()))


def test_empty_input(spark):
    spec = RunningTotal("total", "grp", "amount", "day", "id", hot_rows=0)
    assert with_running_total(spark.createDataFrame([], SCHEMA), spec).collect() == []


def test_copies_of_one_key_are_spread_and_counted_once_each(spark, tmp_path):
    """A third of the rows share one id; with a row handle they are cut by their stored position."""
    rows = [stg_row(number, day=dt.date(2023, 7, 1 + number % 3), quantity="2.00") for number in range(40)]
    rows += [stg_row(7, day=dt.date(2023, 7, 2), quantity="1.00")] * 60
    path = str(tmp_path / "rows")
    overwrite(stg_frame(spark, *rows).repartition(3), path)
    stored = with_row_handle(read_table(spark, path))
    quantity = marts.product_quantity(hot_rows=0, chunk_rows=8)
    fact = marts.fact_transactions(stored, marts.customer_spend(hot_rows=10, chunk_rows=8), quantity)
    assert not set(ROW_HANDLE) & set(fact.columns)
    got = fact.collect()
    assert len(got) == 100
    second_day = [row for row in got if row.transaction_date == dt.date(2023, 7, 2)]
    # Ids below 7 come first, then all rows of id 7, then the larger ids.
    before_day = sum(row.quantity for row in got if row.transaction_date == dt.date(2023, 7, 1))
    lower = sum(row.quantity for row in second_day if row.transaction_id < 7)
    copies = sorted(row.product_cumulative_quantity for row in second_day if row.transaction_id == 7)
    assert copies[-1] == before_day + lower + 2 + 60
    assert len(set(copies)) == len(copies) == 61
    assert max(row.product_cumulative_quantity for row in got) == sum(row.quantity for row in got)
    assert max(row.customer_cumulative_spend for row in got) == sum(row.total_amount for row in got)
    again = {(r.transaction_id, r.quantity, r.product_cumulative_quantity) for r in fact.collect()}
    assert again == {(r.transaction_id, r.quantity, r.product_cumulative_quantity) for r in got}


@pytest.mark.parametrize("ids", ["dense", "sparse", "repeated", "clustered", "one"])
def test_chunks_follow_the_rows_whatever_the_ids(spark, ids):
    """One product and three days: about rows / chunk size chunks, none much above the chunk size."""
    keys = {
        "dense": F.col("n"),
        "sparse": F.abs(F.xxhash64("n")),
        "repeated": F.expr("n div 2"),
        "clustered": F.when(F.col("n") % 2 == 0, F.col("n")).otherwise((1 << 62) + F.col("n")),
        "one": F.lit(7).cast("bigint"),
    }
    rows = spark.range(60_000).select(F.col("id").alias("n")).select(
        keys[ids].alias("id"),
        F.lit(1).alias("grp"),
        F.date_add(F.lit(dt.date(2023, 7, 1)), (F.col("n") % 3).cast("int")).alias("day"),
        F.lit(Decimal("1.00")).alias("amount"),
        F.lit("file").alias("file"),
        F.col("n").alias("position"),
    )
    spec = RunningTotal("total", "grp", "amount", "day", "id", hot_rows=0, chunk_rows=500, handle=("file", "position"))
    sizes = [row["count"] for row in Chunks(rows, spec).mark(rows).groupBy(*spec.chunk).count().collect()]
    assert sum(sizes) == 60_000
    assert len(sizes) <= 3 * 60_000 / 500 + 3
    assert max(sizes) <= 600
    totals = with_running_total(rows, spec).agg(F.max("total"), F.count_distinct("total")).first()
    assert tuple(totals) == (Decimal("60000.00"), 60_000)


def test_lists_stay_within_their_bound(spark):
    """The limits grow with the table, so the number of entries does not."""
    spec = RunningTotal("total", "grp", "amount", "day", "id", hot_rows=1, chunk_rows=1, most_entries=10)
    assert spec.limits(1000) == (100, 100)
    assert RunningTotal("t", "g", "v").limits(10**12) == (20_000_000, 20_000_000)
    rows = spark.createDataFrame(skewed_rows(seed=9), SCHEMA)
    chunks = Chunks(rows, spec)
    assert all(part.count() <= 10 for part in [chunks.hot, *chunks.lists])
    got = with_running_total(rows, spec)
    assert {row.id: row.total for row in got.collect()} == expected(skewed_rows(seed=9))
