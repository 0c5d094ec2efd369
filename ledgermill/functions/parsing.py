"""Guarded casts from raw text. Text that does not fit the pattern becomes NULL, never an error.

Patterns are anchored with \\A and \\z: in Java regex `$` also matches before a final newline, which would
let '12\\n' through. Casts are `try_cast`, so text that fits the pattern but not the type (a 13th month, an
id with 30 digits) is NULL as well; the issue log reports it.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted text forms.
DIGITS = r"\A[0-9]+\z"
DIGITS_OR_POINT_ZERO = r"\A[0-9]+(\.0)?\z"
PLAIN_NUMBER = r"\A[0-9]+\.?[0-9]*\z"
YEAR_FIRST = r"\A\d{4}-\d{2}-\d{2}\z"
DAY_FIRST = r"\A\d{2}-\d{2}-\d{4}\z"
LETTERS = "[A-Za-z]"


def whole_number(text: Column, as_type: str) -> Column:
    return F.when(text.rlike(DIGITS), text.try_cast(as_type))


def float_styled_id(text: Column, as_type: str) -> Column:
    """'501.0' and '501' are both 501; '501.5' is NULL."""
    # substring_index gives the same first part as split_part, without building an array per row.
    return F.when(text.rlike(DIGITS_OR_POINT_ZERO), F.substring_index(text, ".", 1).try_cast(as_type))


def two_format_date(text: Column) -> Column:
    """YYYY-MM-DD or DD-MM-YYYY. The second is put in ISO order, as ISO casts skip the slow pattern parser."""
    day_first_as_iso = F.concat_ws(
        "-", F.substring(text, 7, 4), F.substring(text, 4, 2), F.substring(text, 1, 2)
    )
    return (
        F.when(text.rlike(YEAR_FIRST), text).when(text.rlike(DAY_FIRST), day_first_as_iso).try_cast("date")
    )


def amount(text: Column, as_type: str) -> Column:
    """Unsigned number with an optional fraction, rounded half away from zero to the scale of the type."""
    return F.when(text.rlike(PLAIN_NUMBER), text.try_cast(as_type))


def is_missing(text: Column) -> Column:
    return text.isNull()


def matches(text: Column, pattern: str) -> Column:
    """True on a match, False otherwise, also for NULL."""
    return F.coalesce(text.rlike(pattern), F.lit(False))


def fails(text: Column, pattern: str) -> Column:
    """True for text that does not match; NULL text is not a failure."""
    return F.coalesce(~text.rlike(pattern), F.lit(False))


def blank_to_null(text: Column, tokens: tuple[str, ...]) -> Column:
    return F.when(~text.isin(*tokens), text)
