"""CSV files whose values may hold line breaks, read by many tasks.

Whether a line break ends a record depends on all quotes before it in the file, which is why Spark reads a file with
`multiLine` in one task. Here each byte range tells whether its number of quotes is odd, and a running sum over a file's
ranges, one small row each, tells which of them begin inside quotes. Within a range a running sum over its lines
does the same per line. So every line knows whether it begins a record, and which one it goes on with otherwise, also
where a record spans ranges. Only records of more than one line are put together again; then Spark's own reader parses each
record's text.

    lines of byte ranges -> odd quotes per range -> running sum over ranges -> running sum over lines -> records -> parse

A file is read twice and its lines are shuffled once, by range, so a task holds a range whatever the file's length. The marked
lines are written to the shared scratch folder before records are put together.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from ledgermill.schemas import RAW_COLUMNS
from ledgermill.sources.raw_csv import LINE, MalformedCsvError, csv_header, raw_rows
from ledgermill.sources.tables import overwrite, read_table, shared_folder

RANGE = ("file", "range_start")
#: A record of more characters than this is a quote that was never closed, not a value.
MOST_CHARACTERS = 16 * 1024 * 1024


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Physical lines with their byte range; `at` orders the lines of a range."""
    line = F.col("value")
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("range_start"),
        F.monotonically_increasing_id().alias("at"),
        ((F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))) % 2).alias("odd"),
        line.alias("line"),
    )


def _before(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def marked_lines(lines: DataFrame) -> DataFrame:
    """The lines with `inside` (the line begins inside quotes) and `record`: the `at` of the line in its range that begins
    its record, NULL where that is in an earlier range."""
    ranges = lines.groupBy(*RANGE).agg((F.sum("odd") % 2).alias("odd"))
    per_file = _before(Window.partitionBy("file").orderBy("range_start"))
    starts = ranges.select(*RANGE, (F.coalesce(F.sum("odd").over(per_file), F.lit(0)) % 2).alias("start"))
    in_range = Window.partitionBy(*RANGE).orderBy("at")
    inside = (F.col("start") + F.coalesce(F.sum("odd").over(_before(in_range)), F.lit(0))) % 2 == 1
    known = lines.join(starts, list(RANGE)).withColumn("inside", inside)
    so_far = in_range.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return known.withColumn("record", F.max(F.when(~F.col("inside"), F.col("at"))).over(so_far)).drop("start")


def records(marked: DataFrame, most_characters: int = MOST_CHARACTERS) -> DataFrame:
    """(file, file_name, first, text): the text of each record, and whether it is its file's first one."""
    first = (F.col("range_start") == 0) & ~F.col("inside")
    ranges = marked.groupBy(*RANGE).agg(F.max("record").alias("last"), F.min(F.when(first, F.col("at"))).alias("head"))
    per_file = Window.partitionBy("file").orderBy("range_start")
    ranges = ranges.select(
        *RANGE, "head", F.last("last", ignorenulls=True).over(_before(per_file)).alias("earlier")
    )
    known = marked.join(ranges, list(RANGE))
    known = known.withColumn("record", F.coalesce("record", "earlier"))
    head = F.coalesce(F.col("record") == F.col("head"), F.lit(False))
    alone = ~F.col("inside") & (F.col("odd") == 0)
    single = known.where(alone).select("file", "file_name", head.alias("first"), F.col("line").alias("text"))
    parts = known.where(~alone).groupBy("file", "file_name", "record")
    sizes = parts.agg(F.sum(F.length("line") + 1).alias("characters")).where(F.col("characters") > most_characters)
    long = sizes.select("file", "characters").head()
    if long:
        raise MalformedCsvError(f"a record of {long.characters} characters in {long.file}: a quote is not closed")
    whole = parts.agg(
        F.max(head).alias("first"), F.array_sort(F.collect_list(F.struct("range_start", "at", "line"))).alias("lines")
    )
    text = F.array_join(F.col("lines.line"), "\n")
    return single.unionByName(whole.select("file", "file_name", "first", text.alias("text")))


def _all_text(names: list[str]) -> str:
    return ", ".join(f"`{name.replace('`', '``')}` string" for name in names)


def _checked_header(first: Column, text: Column, header: list[str]) -> Column:
    """True for rows; the first record of a file is left out, and must be the header."""
    schema = _all_text([f"c{i}" for i in range(len(header))])
    fields = F.from_csv(text, schema, {"quote": '"', "escape": '"'})
    same = F.lit(True)
    for i, name in enumerate(header):
        same = same & fields[f"c{i}"].eqNullSafe(F.lit(name))
    wrong = F.raise_error(F.concat(F.lit(f"the header is not {','.join(header)}: "), text)).cast("boolean")
    return F.when(~first, F.lit(True)).when(same, F.lit(False)).otherwise(wrong)


def read_quoted_csv(
    spark: SparkSession,
    path: str | list[str],
    keep_problems: bool = False,
    keep_path: bool = False,
    most_characters: int = MOST_CHARACTERS,
) -> DataFrame:
    """The rows that `read_csv` gives with `multi_line`, with the same meaning of its other parameters.

    Records end with \\n or \\r\\n outside of quotes. Line breaks in values stay as written, whereas Spark's reader makes
    \\r\\n in them \\n where records end with \\r\\n. Quotes count in pairs, also within a value that does not begin with
    one: a lone quote there makes the lines up to the next one a record with a broken quote. Empty lines are left out. A
    record of more than `most_characters` in several lines fails the read, as the rest of a file after a quote that is not
    closed must not become one row.
    """
    header = csv_header(spark, path)
    missing = [name for name in RAW_COLUMNS if name not in header]
    if missing:
        raise ValueError(f"columns missing in {path}: {', '.join(missing)}")
    marked_path = shared_folder(spark, "marked-lines")
    overwrite(marked_lines(_lines(spark, path)), marked_path)
    found = records(read_table(spark, marked_path), most_characters)
    found = found.withColumn("text", F.regexp_replace("text", "\r$", "")).where("text != ''")
    found = found.where(_checked_header(F.col("first"), F.col("text"), header))
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    if keep_problems:
        options["columnNameOfCorruptRecord"] = LINE
    parsed = found.select(F.from_csv("text", _all_text([*header, LINE] if keep_problems else header), options).alias("row"), "file", "file_name")
    rows = parsed.select("row.*", F.col("file").alias("_file"), F.col("file_name").alias("_file_name"))
    return raw_rows(rows, header, F.col("_file"), F.col("_file_name"), keep_problems, keep_path)
