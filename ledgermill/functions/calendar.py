"""Date parts and day distances."""

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names, blank-padded to the width of the longest one.
MONTH_NAMES = (
    "January",
    "February",
    "March",
    "April",
    "May",
    "June",
    "July",
    "August",
    "September",
    "October",
    "November",
    "December",
)
MONTH_NAME_WIDTH = 9


def month_name(day: Column) -> Column:
    """A look-up in a constant array: a date pattern would run a formatter on every row."""
    names = F.array(*[F.lit(name.ljust(MONTH_NAME_WIDTH)) for name in MONTH_NAMES])
    return F.element_at(names, F.month(day))


def date_parts(day: Column) -> list[Column]:
    return [
        F.year(day).alias("transaction_year"),
        F.month(day).alias("transaction_month"),
        F.quarter(day).alias("transaction_quarter"),
        month_name(day).alias("transaction_month_name"),
        F.dayofmonth(day).alias("transaction_day"),
        F.weekofyear(day).alias("transaction_week"),
    ]


def today(as_of: dt.date | None) -> Column:
    """The reporting day: fixed when given, so that a rerun gives the same rows; else the current day."""
    return F.current_date() if as_of is None else F.lit(as_of)


def days_since(day: Column, as_of: dt.date | None) -> Column:
    return F.datediff(today(as_of), day)
