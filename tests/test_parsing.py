import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgermill.functions import parsing as P


def evaluate(spark, expression, texts):
    rows = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "i int, text string")
    return [row.value for row in rows.select("i", expression(F.col("text")).alias("value")).orderBy("i").collect()]


def test_transaction_id(spark):
    texts = ["1001", "007", "T1010", None, "1e3", "12\n", "", " 12", "-5", "+5", "9" * 30]
    got = evaluate(spark, lambda c: P.whole_number(c, "bigint"), texts)
    assert got == [1001, 7] + [None] * 9


def test_small_id_type_gives_null_beyond_its_range(spark):
    assert evaluate(spark, lambda c: P.whole_number(c, "int"), ["2147483647", "2147483648"]) == [2147483647, None]
    assert evaluate(spark, lambda c: P.whole_number(c, "bigint"), ["2147483648"]) == [2147483648]


def test_customer_id(spark):
    texts = ["501.0", "501", "501.5", "501.00", ".0", "501.", "C501", "501.0\n", "10.0", None]
    got = evaluate(spark, lambda c: P.float_styled_id(c, "bigint"), texts)
    assert got == [501, 501, None, None, None, None, None, None, 10, None]


def test_dates(spark):
    texts = ["18-07-2023", "2023-07-18", "07/18/2023", "2023-13-45", "2023-02-30", "31-02-2023", "unknown", None]
    july = dt.date(2023, 7, 18)
    assert evaluate(spark, P.two_format_date, texts) == [july, july] + [None] * 6


def test_leap_day(spark):
    assert evaluate(spark, P.two_format_date, ["29-02-2024", "2023-02-29"]) == [dt.date(2024, 2, 29), None]


@pytest.mark.parametrize(
    "text, value",
    [
        ("5.", "5.00"),
        ("3.0", "3.00"),
        ("3", "3.00"),
        ("1.005", "1.01"),
        ("1.004", "1.00"),
        ("0", "0.00"),
        ("-1", None),
        ("", None),
        (".5", None),
        ("1,000", None),
        ("Two Hundred", None),
        ("99999999999", None),
        (None, None),
    ],
)
def test_quantity(spark, text, value):
    got = evaluate(spark, lambda c: P.amount(c, "decimal(10,2)"), [text])
    assert got == [None if value is None else Decimal(value)]


def test_flag_expressions_never_give_null(spark):
    texts = ["12", "T12", None, ""]
    assert evaluate(spark, lambda c: P.fails(c, P.DIGITS), texts) == [False, True, False, True]
    assert evaluate(spark, lambda c: P.matches(c, P.LETTERS), texts) == [False, True, False, False]


def test_null_tokens(spark):
    texts = ["", "NA", "null", "None", "n/a", "-nan", "nano", "0", None]
    got = evaluate(spark, lambda c: P.blank_to_null(c, ("", "NA", "null", "None", "n/a", "-nan")), texts)
    assert got == [None] * 6 + ["nano", "0", None]
