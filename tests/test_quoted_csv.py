"""Quoted line breaks in files that are cut into many byte ranges, against Python's reader and Spark's own in one task."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from ledgermill.schemas import RAW_COLUMNS
from ledgermill.sources import quoted_csv
from ledgermill.sources.quoted_csv import read_quoted_csv
from ledgermill.sources.raw_csv import PROBLEM, MalformedCsvError, read_csv

NAMES = ["A", 'two\nlines', 'a, "b"\n\n c', '""', '\n', "long " * 30 + "\n" + "x\n" * 40, 'end "quote"', "é\n名", 'w\r\nx']


@pytest.fixture
def small_ranges(spark):
    names = {"spark.sql.files.maxPartitionBytes": "397", "spark.sql.files.openCostInBytes": "0"}
    old = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name, value in old.items():
        spark.conf.set(name, value)


def write(path, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as file:
        writer = csv.writer(file, lineterminator=end)
        writer.writerow(RAW_COLUMNS)
        writer.writerows(rows)


def sample(seed, count):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        rows.append([f"{seed}-{i}", "501.0", "2023-07-11", "101", rng.choice(NAMES), "2.0", "76.27", rng.choice(["1.5", "8"])])
    return rows


def values(df):
    return sorted(tuple(row) for row in df.select("transaction_id", "product_name", "tax", "source_file").collect())


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_like_one_task(spark, tmp_path, small_ranges, end):
    folder = tmp_path / "in"
    folder.mkdir()
    want = []
    for seed in range(3):
        rows = sample(seed, 150)
        write(folder / f"{seed}.csv", rows, end)
        want += [(r[0], r[4], r[7], f"{seed}.csv") for r in rows]
    write(folder / "empty.csv", [], end)
    assert quoted_csv._lines(spark, str(folder)).select(*quoted_csv.RANGE).distinct().count() > 60
    got = read_quoted_csv(spark, str(folder), keep_problems=True, keep_path=True)
    one_task = read_csv(spark, str(folder), multi_line=True, keep_problems=True, keep_path=True)
    assert got.columns == one_task.columns and got.dtypes == one_task.dtypes
    assert got.where(F.col(PROBLEM).isNotNull()).isEmpty()
    # Values stay as written; the reader in one task makes \r\n in a value \n where records end with \r\n.
    written = {i: (n.strip(" "), t, f) for i, n, t, f in want if n.strip(" ")}
    assert {r.transaction_id: (r.product_name.strip(" "), r.tax, r.source_file) for r in got.collect() if r.product_name} == written
    other = values(one_task.na.fill("-"))
    mine = values(got.na.fill("-"))
    if end == "\r\n":
        mine = [tuple(x.replace("\r\n", "\n") for x in row) for row in mine]
    assert mine == other


def test_short_rows_and_surplus_fields_are_told(spark, tmp_path, small_ranges):
    good = ",".join(["1", "501", "2023-07-11", "101", '"a\nb"', "2", "3", "1"])
    short = "2,501,2023-07-11"
    surplus = ",".join(["3", "501", "2023-07-11", "101", '"a\nb"', "2", "3", "1", "9"])
    (tmp_path / "a.csv").write_text("\n".join([",".join(RAW_COLUMNS), good, "", short, surplus, ""]))
    got = read_quoted_csv(spark, str(tmp_path / "a.csv"), keep_problems=True)
    assert {r.transaction_id: r[PROBLEM] for r in got.collect()} == {"1": None, "2": "missing fields", "3": "surplus fields"}


def test_other_headers_and_open_quotes_fail(spark, tmp_path, small_ranges):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "a.csv", sample(1, 5))
    (folder / "b.csv").write_text(",".join(reversed(RAW_COLUMNS)) + "\n1,2,3,4,5,6,7,8\n")
    with pytest.raises(Exception, match="the header is not"):
        read_quoted_csv(spark, str(folder)).collect()
    (folder / "b.csv").write_text(",".join(RAW_COLUMNS) + '\n1,"2\n' + "x,y\n" * 2000)
    with pytest.raises(MalformedCsvError, match="not closed"):
        read_quoted_csv(spark, str(folder), most_characters=4000)
    with pytest.raises(ValueError, match="columns missing"):
        (tmp_path / "c.csv").write_text("a,b\n1,2\n")
        read_quoted_csv(spark, str(tmp_path / "c.csv"))


def test_lines_are_shuffled_by_range_only(spark, tmp_path, small_ranges):
    write(tmp_path / "a.csv", sample(2, 200))
    plan = quoted_csv.marked_lines(quoted_csv._lines(spark, str(tmp_path / "a.csv")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in text.splitlines() if "Exchange" in line and "Broadcast" not in line]
    assert all("hashpartitioning(file" in line for line in shuffles) and "SinglePartition" not in text
