"""Exact sets of integer ids that merge: 64 ids to a word of bits, with the number of rows that fell into it.

A word is the id without its last six bits. Its bits say which of its 64 ids occur, and two words of one number merge by
OR, so sets that are stored per month or file give exact distinct counts over any of them without the ids. Ids that
follow each other, as transaction numbers do within a file, shrink 64-fold before the first shuffle; ids spread
over the whole range cost one word of 24 bytes each, no more than the ids themselves would with their counts. (Bitmaps of
32,768 bits would be half as large for dense ids, and 4 KB for each id of a sparse set.)

A word with more rows than bits holds an id that occurs more than once. Only rows of such words are grouped by their id,
so finding repeated ids shuffles words first and then as many rows as there are suspects.

NULL ids have one word of their own, whose number and bits are NULL. They are not counted as ids, but repeat like a key.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.operators.keys import rows_per_key

WORD, BITS, ROWS = "word", "bits", "word_rows"


def word_of(id_column: Column) -> Column:
    return F.shiftright(id_column.cast("bigint"), 6)


def id_words(rows: DataFrame, column: str, *keys: str) -> DataFrame:
    """The words of the ids in `column`, per combination of the keys."""
    number = F.col(column).cast("bigint")
    low = number.bitwiseAND(F.lit(63)).cast("int")
    bit = F.when(number.isNotNull(), F.call_function("shiftleft", F.lit(1).cast("bigint"), low))
    words = rows.select(*keys, word_of(number).alias(WORD), bit.alias("bit")).groupBy(*keys, WORD)
    return words.agg(F.bit_or("bit").alias(BITS), F.count(F.lit(1)).alias(ROWS))


def merged(words: DataFrame, *keys: str) -> DataFrame:
    """One row per combination of the keys and word. Keys of the words that are not named are merged over."""
    return words.groupBy(*keys, WORD).agg(F.bit_or(BITS).alias(BITS), F.sum(ROWS).alias(ROWS))


def distinct_ids(words: DataFrame, *keys: str, name: str = "ids") -> DataFrame:
    """The exact number of ids per combination of the keys, 0 where all are NULL; one row in all without keys."""
    count = F.coalesce(F.sum(F.bit_count(BITS).cast("bigint")), F.lit(0).cast("bigint"))
    return merged(words, *keys).groupBy(*keys).agg(count.alias(name))


def suspects(words: DataFrame) -> DataFrame:
    """The numbers of the words that hold an id more than once."""
    return merged(words).where(F.col(ROWS) > F.coalesce(F.bit_count(BITS), F.lit(1))).select(WORD)


def words_numbered(words: DataFrame, numbers: DataFrame) -> DataFrame:
    wanted = numbers.select(F.col(WORD).alias("_wanted"))
    return words.join(wanted, F.col(WORD).eqNullSafe(F.col("_wanted")), "left_semi")


def rows_of_words(rows: DataFrame, column: str, numbers: DataFrame) -> DataFrame:
    """The rows whose id lies in one of the words. Without any word, Spark drops the scan of the rows at run time."""
    wanted = numbers.select(F.col(WORD).alias("_wanted"))
    return rows.join(wanted, word_of(F.col(column)).eqNullSafe(F.col("_wanted")), "left_semi")


def repeated_ids(rows: DataFrame, column: str, words: DataFrame | None = None) -> DataFrame:
    """(key, rows) of the ids that occur more than once, as `keys.repeated_keys` has them. `words` are those of the rows,
    if they are stored; all rows are read for them otherwise."""
    found = suspects(id_words(rows, column) if words is None else words)
    return rows_per_key(rows_of_words(rows, column, found), column).where(F.col("rows") > 1)


def surplus_rows(rows: DataFrame, column: str, words: DataFrame, *keys: str) -> DataFrame:
    """(keys, surplus): by how much the rows with an id outnumber the ids, for the combinations of keys where they do. So
    a row count less its surplus is a distinct count, and only rows of suspect words are read for it."""
    own = rows_of_words(rows, column, suspects(words)).where(F.col(column).isNotNull())
    per_id = own.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("n"))
    return per_id.where("n > 1").groupBy(*keys).agg(F.sum(F.col("n") - 1).alias("surplus"))
