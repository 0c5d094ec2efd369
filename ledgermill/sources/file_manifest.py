"""Which files a raw table was loaded from, so that a later load reads only what is new.

A manifest has a row per file: path, length, modification time, the batch that its rows were written in, and how many
they are. A batch is a folder that never changes once written. A later load lists the files, without opening any, and
joins the list to the manifest: files that are new or have another length or time are read into a batch of their own,
and the new manifest points to it; all others keep their place. Rows count as long as the manifest points to their file
and batch, so a changed file replaces exactly its own rows, a file that is gone takes its rows along, and a reader of an
older manifest still sees what it saw.

A file that is rewritten with equal length and time is not seen as changed. One that changes between listing and reading
is read once more by the next load.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NEW, CHANGED, SAME, REMOVED = "new", "changed", "same", "removed"

MANIFEST_SCHEMA = "path string, length bigint, modified timestamp, batch string, rows bigint, state string"


def empty_manifest(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], MANIFEST_SCHEMA)


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modified, location) of all files below a folder, or of one file. Contents are not read; `location`
    is the name to read the file by."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(
        F.col("_metadata.file_path").alias("path"),
        "length",
        F.col("modificationTime").alias("modified"),
        F.col("path").alias("location"),
    )


def compared(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """The listed files and those of the manifest that are gone, with `state` and, for files of the manifest, the batch
    and rows that they had."""
    had = manifest.where(F.col("state") != REMOVED).select(
        "path", F.col("length").alias("_length"), F.col("modified").alias("_modified"), "batch", "rows"
    )
    same = (F.col("length") == F.col("_length")) & (F.col("modified") == F.col("_modified"))
    state = (
        F.when(F.col("length").isNull(), REMOVED).when(F.col("_length").isNull(), NEW).when(same, SAME).otherwise(CHANGED)
    )
    return files.join(had, "path", "full_outer").withColumn("state", state).drop("_length", "_modified")


def renewed(files: DataFrame, batch: str, counts: DataFrame) -> DataFrame:
    """The manifest after the new and changed files were read into `batch`; `counts` has the rows per path. Removed files
    stay in it once, without rows, to tell what happened."""
    read = F.col("state").isin(NEW, CHANGED)
    found = files.join(counts.select("path", F.col("rows").alias("_rows")), "path", "left")
    return found.select(
        "path",
        "length",
        "modified",
        F.when(read, batch).when(F.col("state") == SAME, F.col("batch")).alias("batch"),
        F.when(read, F.coalesce("_rows", F.lit(0))).when(F.col("state") == SAME, F.col("rows")).otherwise(0).alias("rows"),
        "state",
    )


def live_rows(spark: SparkSession, store: str, manifest: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of a store of batches that the manifest points to. They have `source_path`."""
    live = manifest.where(F.col("state") != REMOVED).select("batch", F.col("path").alias("source_path"))
    batches = [row.batch for row in manifest.where("rows > 0").select("batch").distinct().collect()]
    full = T.StructType([*schema.fields, T.StructField("batch", T.StringType())])
    if not batches:
        return spark.createDataFrame([], full)
    folders = [f"{store}/batch={batch}" for batch in batches]
    rows = spark.read.schema(full).option("basePath", store).parquet(*folders)
    return rows.join(live, ["batch", "source_path"], "left_semi").select(*full.names)
