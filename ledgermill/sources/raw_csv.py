"""CSV files -> raw text rows -> raw Parquet table.

Lines with too few fields are kept, with NULL for the fields that lack. Lines with too many fields, or with a quote that
is not closed, have no certain reading: by default they fail the load, and on demand they are set aside with their text.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.functions.parsing import blank_to_null
from ledgermill.schemas import NULL_TOKENS, RAW_COLUMNS, RAW_SCHEMA, REJECTED_LINE_SCHEMA, require_schema
from ledgermill.sources.tables import overwrite

PROBLEM, LINE = "_problem", "_line"
MISSING, SURPLUS, BROKEN = "missing fields", "surplus fields", "broken quote"
FAIL, QUARANTINE = "fail", "quarantine"


class MalformedCsvError(ValueError):
    """Lines that cannot be read with certainty."""


@dataclass(frozen=True)
class LoadCounts:
    rows_loaded: int
    rows_short: int = 0
    lines_rejected: int = 0


def _problem(header: list[str]) -> Column:
    """What is wrong with a record, from its text where the reader flags it, else from its values."""
    line = F.regexp_replace(F.col(LINE), r'(^|,)"(?:[^"]|"")*"(?=,|[\r\n]*$)', "$1")
    fields = F.length(line) - F.length(F.replace(line, F.lit(","))) + 1
    open_quote = F.lit(False)
    for name in header:
        value = F.col(f"`{name}`")
        open_quote = open_quote | F.coalesce(value.startswith('"') & ~(value.endswith('"') & (F.length(value) > 1)), F.lit(False))
    return (
        F.when(line.rlike('(^|,)"') | open_quote, BROKEN)
        .when(F.col(LINE).isNull(), F.lit(None))
        .when(fields > len(header), SURPLUS)
        .otherwise(MISSING)
    )


def csv_header(spark: SparkSession, path: str | list[str], multi_line: bool = False) -> list[str]:
    """The column names of the first file."""
    return spark.read.options(header=True, quote='"', escape='"', multiLine=multi_line).csv(path).columns


def raw_rows(
    rows: DataFrame, header: list[str], file: Column, file_name: Column, keep_problems: bool, keep_path: bool
) -> DataFrame:
    """The raw columns, stamps and what is asked for of parsed records."""
    extra: list[Column] = []
    if keep_problems:
        whole = F.coalesce(F.col(LINE), F.concat_ws(",", *[F.coalesce(F.col(f"`{name}`"), F.lit("")) for name in header]))
        extra = [_problem(header).alias(PROBLEM), whole.alias(LINE)]
    if keep_path:
        extra.append(file.alias("source_path"))
    return rows.select(
        *[blank_to_null(F.col(name), NULL_TOKENS).alias(name) for name in RAW_COLUMNS],
        F.current_timestamp().alias("loaded_at"),
        file_name.alias("source_file"),
        *extra,
    )


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    multi_line: bool = False,
    keep_problems: bool = False,
    keep_path: bool = False,
) -> DataFrame:
    """Rows of one CSV file, a folder of them or a list of files, all columns as text, picked by header name.

    No types are inferred. The header names come from the first file only, so every other file is checked
    against them (`enforceSchema=False`): a file with other columns or another order fails the load instead of
    filling the wrong columns. `multi_line` allows newlines inside quotes, but then a file is not split; large
    files are read by `quoted_csv.read_quoted_csv`. `keep_problems` adds, for records without a certain or full reading,
    what is wrong with them and their text; without it such records are read as far as they go. `keep_path` adds the
    file's full path as `source_path`.
    """
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line}
    header = csv_header(spark, path, multi_line)
    missing = [name for name in RAW_COLUMNS if name not in header]
    if missing:
        raise ValueError(f"columns missing in {path}: {', '.join(missing)}")
    text = T.StructType([T.StructField(name, T.StringType()) for name in header])
    if keep_problems:
        text = text.add(LINE, T.StringType())
        options["columnNameOfCorruptRecord"] = LINE
    rows = spark.read.options(**options, enforceSchema=False).schema(text).csv(path)
    return raw_rows(rows, header, F.col("_metadata.file_path"), F.col("_metadata.file_name"), keep_problems, keep_path)


def rejected_lines(rows: DataFrame) -> DataFrame:
    """The text of the records that are not loaded, with file and reason."""
    return rows.where(F.col(PROBLEM).isin(SURPLUS, BROKEN)).select(
        F.col(LINE).alias("line"), F.col(PROBLEM).alias("problem"), "source_file", "loaded_at"
    )


def load_raw(
    rows: DataFrame, path: str, rejected_path: str = "", on_malformed: str = FAIL, schema: T.StructType = RAW_SCHEMA
) -> LoadCounts:
    """Writes the raw table. The counts are observed on the write itself: no second pass.

    Records with surplus fields or a broken quote are never written to it. With `on_malformed="fail"` they make the
    load fail; give a `path` that no reader uses yet. With "quarantine" their text goes to `rejected_path`, which takes
    a second pass over the files, only if there are any.
    """
    if on_malformed not in (FAIL, QUARANTINE):
        raise ValueError(f"on_malformed is {on_malformed!r}; it may be {FAIL!r} or {QUARANTINE!r}")
    counts = Observation("raw load")
    checked = PROBLEM in rows.columns
    problem = F.col(PROBLEM) if checked else F.lit(None)
    bad = F.coalesce(problem.isin(SURPLUS, BROKEN), F.lit(False))
    observed = rows.observe(
        counts,
        F.count_if(~bad).alias("rows_loaded"),
        F.count_if(F.coalesce(problem == MISSING, F.lit(False))).alias("rows_short"),
        F.count_if(bad).alias("lines_rejected"),
    )
    written = (observed.where(~bad) if checked else observed).drop(PROBLEM, LINE)
    require_schema(written, schema)
    overwrite(written, path)
    found = LoadCounts(**counts.get)
    if found.lines_rejected and on_malformed == FAIL:
        raise MalformedCsvError(
            f"{found.lines_rejected} lines with surplus fields or a broken quote; read quoted line breaks with "
            "multi_line, or set such lines aside with on_malformed='quarantine'"
        )
    if rejected_path and checked:
        lines = rejected_lines(rows) if found.lines_rejected else rejected_lines(rows.limit(0))
        require_schema(lines, REJECTED_LINE_SCHEMA)
        overwrite(lines, rejected_path)
    return found
