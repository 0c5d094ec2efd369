import pytest
from pyspark.sql import functions as F

from ledgermill.schemas import RAW_COLUMNS
from ledgermill.sources.raw_csv import load_raw, read_csv
from ledgermill.sources.tables import overwrite, read_table, shared_folder, with_row_handle
from tests.helpers import as_set, raw_frame

HEADER = ",".join(RAW_COLUMNS)


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def texts(df):
    return [tuple(row) for row in df.select(*RAW_COLUMNS).collect()]


def test_everything_is_text_and_empty_is_null(spark, tmp_path):
    path = write(tmp_path / "a.csv", HEADER, "1001,501.0,2023-07-11,101,Product A,,76.270,NA")
    df = read_csv(spark, path)
    assert texts(df) == [("1001", "501.0", "2023-07-11", "101", "Product A", None, "76.270", None)]
    row = df.first()
    assert row.source_file == "a.csv"
    assert row.loaded_at is not None


def test_columns_go_by_name(spark, tmp_path):
    order = list(reversed(RAW_COLUMNS))
    path = write(tmp_path / "a.csv", ",".join([*order, "extra"]), "8,7,6,5,4,3,2,1,x")
    assert texts(read_csv(spark, path)) == [("1", "2", "3", "4", "5", "6", "7", "8")]


def test_missing_column_fails(spark, tmp_path):
    path = write(tmp_path / "a.csv", HEADER.replace(",tax", ""), "1,2,3,4,5,6,7")
    with pytest.raises(ValueError, match="tax"):
        read_csv(spark, path)


def test_second_file_with_another_column_order_fails(spark, tmp_path):
    write(tmp_path / "a.csv", HEADER, "1,2,3,4,5,6,7,8")
    write(tmp_path / "b.csv", ",".join(reversed(RAW_COLUMNS)), "1,2,3,4,5,6,7,8")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(tmp_path)).collect()


def test_quotes(spark, tmp_path):
    path = write(tmp_path / "a.csv", HEADER, '1,2,3,4,"Product ""A"", blue",6,7,8', '2,2,3,4,"",6,7,8')
    names = sorted((row[0], row[4]) for row in texts(read_csv(spark, path)))
    assert names == [("1", 'Product "A", blue'), ("2", None)]


def test_line_break_in_quotes(spark, tmp_path):
    path = write(tmp_path / "a.csv", HEADER, '1,2,3,4,"Product\nA",6,7,8')
    assert [row[4] for row in texts(read_csv(spark, path, multi_line=True))] == ["Product\nA"]


def test_load_counts_rows_and_malformed_lines(spark, tmp_path):
    path = write(tmp_path / "a.csv", HEADER, "1,2,3,4,5,6,7,8", "2,2,3", "3,2,3,4,5,6,7,8,9")
    target = str(tmp_path / "raw")
    counts = load_raw(read_csv(spark, path, keep_problems=True), target, str(tmp_path / "bad"), "quarantine")
    assert (counts.rows_loaded, counts.rows_short, counts.lines_rejected) == (2, 1, 1)
    assert [r.line for r in read_table(spark, str(tmp_path / "bad")).collect()] == ["3,2,3,4,5,6,7,8,9"]
    stored = read_table(spark, target)
    assert stored.columns == [*RAW_COLUMNS, "loaded_at", "source_file"]
    assert ("2", "2", "3", None, None, None, None, None) in texts(stored)


def test_a_table_is_written_with_its_own_columns_only(spark, tmp_path):
    with pytest.raises(TypeError):
        load_raw(raw_frame(spark, {}).drop("tax"), str(tmp_path / "raw"))
    with pytest.raises(ValueError):
        load_raw(raw_frame(spark, {}), str(tmp_path / "raw"), on_malformed="ignore")


def test_reload_replaces(spark, tmp_path):
    target = str(tmp_path / "raw")
    for _ in range(2):
        assert load_raw(raw_frame(spark, {}, {"transaction_id": "2"}), target).rows_loaded == 2
    assert read_table(spark, target).count() == 2


def test_row_handle_is_unique_and_stable(spark, tmp_path):
    target = str(tmp_path / "t")
    overwrite(spark.range(100).select((F.col("id") % 3).alias("k")).repartition(4), target)
    handles = with_row_handle(read_table(spark, target)).select("row_file", "row_index")
    first = as_set(handles)
    assert len(first) == 100
    assert as_set(handles.repartition(7)) == first


def test_shared_folder_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert one.startswith(base) and one != two
