"""The life of an issue over runs: opened, still open, resolved, reopened.

The issue log numbers its cells anew in each run. Here an issue is known by its content (table, column, row, kind and raw
value), through a digest that is the same in every run. Cells that agree in all of these are one issue with a count, so
that rows without an id, however many, are one row per value before the runs are joined.

`advance` joins the issues known so far with those of the newest log: one grouping of the log, combined before its
shuffle, and one full outer join on the digest, which is unique on both sides and never NULL.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTENT = ("table_name", "column_name", "row_number", "issue_type", "raw_value")
OPENED, STILL_OPEN, RESOLVED, REOPENED, CLOSED = "opened", "still open", "resolved", "reopened", "closed"


def issue_key() -> Column:
    """A digest of an issue's content; NULLs are left out under their names, so no two contents read alike."""
    return F.sha2(F.to_json(F.struct(*CONTENT)), 256)


def found_issues(log: DataFrame) -> DataFrame:
    """One row per issue of a log, with the number of cells it was found in."""
    found = log.groupBy(*CONTENT, "severity").agg(F.count(F.lit(1)).alias("occurrences"))
    return found.select(issue_key().alias("issue_key"), *found.columns)


def advance(life: DataFrame | None, log: DataFrame, run_at: Column) -> DataFrame:
    """The issues known after a run. `life` is this function's result for the run before (None: there was none), `log`
    the run's issue log. Issues that are no longer found stay as resolved; their count is the last one above 0.

    `change` says what this run did: opened, still open, resolved, reopened, or closed (resolved earlier)."""
    now = found_issues(log)
    if life is None:
        never = F.lit(None).cast("timestamp")
        return now.select(
            *now.columns,
            run_at.alias("first_found"),
            run_at.alias("last_found"),
            never.alias("resolved_at"),
            F.lit(False).alias("resolved"),
            F.lit(OPENED).alias("change"),
        )
    before = F.col("before.issue_key").isNotNull()
    found = F.col("now.issue_key").isNotNull()
    was_resolved = F.col("before.resolved")
    both = life.alias("before").join(now.alias("now"), F.col("before.issue_key") == F.col("now.issue_key"), "full_outer")
    return both.select(
        F.coalesce("now.issue_key", "before.issue_key").alias("issue_key"),
        *[F.coalesce(f"now.{name}", f"before.{name}").alias(name) for name in now.columns[1:]],
        F.coalesce("before.first_found", run_at).alias("first_found"),
        F.when(found, run_at).otherwise(F.col("before.last_found")).alias("last_found"),
        F.when(~found, F.coalesce("before.resolved_at", run_at)).alias("resolved_at"),
        (~found).alias("resolved"),
        F.when(~before, OPENED)
        .when(found & was_resolved, REOPENED)
        .when(found, STILL_OPEN)
        .when(was_resolved, CLOSED)
        .otherwise(RESOLVED)
        .alias("change"),
    )
