"""A batch run that reads only new files and rewrites only the months they touch.

Below the root, `store/` holds what refreshes share and never change: batches of raw and parsed rows, one per load, and
parts of the fact in month folders, with the index of its running totals, the cells of its reports and the sets of its
ids. A run's own folder says which of them count: the manifest of files, and the parts that each month is made of. So
publication is the same switch as for a full run, readers of the run before keep their tables, and a refresh that breaks
off leaves only folders that no manifest names; the next one removes them.

    new or changed files -> a batch of raw rows -> a batch of parsed rows -> months touched
        days after all of a month's stored days:   one more part with the new rows
        earlier days, changed or removed files:    a new part with all rows of the month
        all other months:                          keep their files

Running totals are stored since the month's beginning and carried over months by the index (operators/carried_total.py).
Dimensions and the summary come from the cells (operators/month_cells.py). Ids are stored as sets of bits per month
(operators/id_sets.py): their uniqueness over all months is checked on these, and fact rows of untouched months are read
only where an id may repeat. The driver sees the paths of new files, and a row per month and part. Table tests read the
new batch and the touched months.
"""

import datetime as dt
import logging
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import lru_cache

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermill.operators import carried_total as carry
from ledgermill.operators import id_sets, month_cells
from ledgermill.operators.carried_total import CarriedTotal, month_of
from ledgermill.operators.issues import issue_log
from ledgermill.operators.running_total import with_running_total
from ledgermill.plans import checks, marts, staging
from ledgermill.plans.run import FACT_FOLDERS, SplitCounts, publish
from ledgermill.schemas import FACT_COLUMNS, RAW_SCHEMA
from ledgermill.sources import file_manifest as manifests
from ledgermill.sources.file_manifest import CHANGED, NEW, REMOVED
from ledgermill.sources.raw_csv import FAIL, LoadCounts, load_raw, read_csv
from ledgermill.sources.tables import CLEAN, REJECTED, Layout, Store, Warehouse, gathered, overwrite, read_table

log = logging.getLogger(__name__)

#: Identify a stored row; they order and spread the rows of repeated ids.
HANDLE = ("source_path", "row_id")
RAW_BATCH_SCHEMA = T.StructType([*RAW_SCHEMA.fields, T.StructField("source_path", T.StringType())])

KEPT, APPENDED, REWRITTEN, CREATED = "kept", "appended", "rewritten", "created"
MONTHS_SCHEMA = "month int, part string, last_day date, rows bigint, change string"


def totals() -> tuple[CarriedTotal, CarriedTotal]:
    spend, quantity = marts.customer_spend(), marts.product_quantity()
    return CarriedTotal(spend, "spend_in_month"), CarriedTotal(quantity, "quantity_in_month")


@dataclass(frozen=True)
class RefreshResult:
    files: dict[str, int]
    loaded: LoadCounts
    split: SplitCounts
    months: list[Row]
    repeated_ids: int
    test_results: list[Row]
    summary: Row


@contextmanager
def utc(spark: SparkSession) -> Iterator[None]:
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


# --- stored tables -----------------------------------------------------------------------------------------------


def _parsed(raw: DataFrame, id_type: str) -> DataFrame:
    rows = staging.split_rows(staging.base_transactions(raw, id_type, "source_path"))
    return rows.withColumn("row_id", F.monotonically_increasing_id())


def _new_fact_rows(parsed: DataFrame) -> DataFrame:
    clean = parsed.where(F.col("outcome") == CLEAN).selectExpr(*staging.CLEAN_COLUMNS, *HANDLE)
    return marts.fact_rows(clean, *HANDLE)


@lru_cache(maxsize=4)
def _parsed_schema(spark: SparkSession, id_type: str) -> T.StructType:
    return _parsed(spark.createDataFrame([], RAW_BATCH_SCHEMA), id_type).schema


@lru_cache(maxsize=4)
def _fact_schema(spark: SparkSession, id_type: str) -> T.StructType:
    rows = _new_fact_rows(spark.createDataFrame([], _parsed_schema(spark, id_type)))
    return T.StructType(
        [
            *rows.schema.fields,
            T.StructField("spend_in_month", T.DecimalType(33, 4)),
            T.StructField("quantity_in_month", T.DecimalType(20, 2)),
        ]
    )


@lru_cache(maxsize=4)
def _cells_schema(spark: SparkSession, id_type: str) -> T.StructType:
    return month_cells.cells(spark.createDataFrame([], _fact_schema(spark, id_type))).schema


def _parts(spark: SparkSession, store: Store, table: str, months: list[Row], schema: T.StructType) -> DataFrame:
    """Rows of some months' parts."""
    root = store.folder(table)
    paths = [f"{root}/part={m.part}/transaction_year={m.month // 100}/transaction_month={m.month % 100}" for m in months]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*paths).select(*schema.names)


def _by_month(index: DataFrame) -> DataFrame:
    return index.withColumns(
        {"transaction_year": F.expr("int(month div 100)"), "transaction_month": F.expr("int(month % 100)")}
    )


_INDEX_SCHEMA = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("slot", T.LongType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("total", T.DecimalType(38, 4)),
        *[T.StructField(name, T.IntegerType()) for name in FACT_FOLDERS],
    ]
)


_IDS_SCHEMA = T.StructType(
    [
        T.StructField(id_sets.WORD, T.LongType()),
        T.StructField(id_sets.BITS, T.LongType()),
        T.StructField(id_sets.ROWS, T.LongType()),
        *[T.StructField(name, T.IntegerType()) for name in FACT_FOLDERS],
    ]
)


class Stored:
    """The tables of one published refresh."""

    def __init__(self, spark: SparkSession, layout: Layout, store: Store, id_type: str = staging.ID_TYPE):
        self.spark, self.layout, self.store, self.id_type = spark, layout, store, id_type
        self.files = read_table(spark, layout.files)
        self.months = sorted(read_table(spark, layout.months).collect(), key=lambda row: (row.month, row.part))

    def raw(self) -> DataFrame:
        return manifests.live_rows(self.spark, self.store.folder("raw"), self.files, RAW_BATCH_SCHEMA)

    def parsed(self) -> DataFrame:
        schema = _parsed_schema(self.spark, self.id_type)
        return manifests.live_rows(self.spark, self.store.folder("parsed"), self.files, schema)

    def stored_fact(self, months: list[Row] | None = None) -> DataFrame:
        schema = _fact_schema(self.spark, self.id_type)
        return _parts(self.spark, self.store, "fact", self.months if months is None else months, schema)

    def index(self, months: list[Row] | None = None) -> DataFrame:
        return _parts(self.spark, self.store, "totals", self.months if months is None else months, _INDEX_SCHEMA)

    def fact_rows(self) -> DataFrame:
        """The fact without running totals: no join."""
        return self.stored_fact().select(*[c for c in FACT_COLUMNS if c not in [t.total.name for t in totals()]])

    def fact(self) -> DataFrame:
        return carry.carried(self.stored_fact(), self.index(), *totals()).select(*FACT_COLUMNS)

    def cells(self, months: list[Row] | None = None) -> DataFrame:
        schema = _cells_schema(self.spark, self.id_type)
        return _parts(self.spark, self.store, "cells", self.months if months is None else months, schema)

    def ids(self, months: list[Row] | None = None) -> DataFrame:
        """The words of the transaction ids (operators/id_sets.py) of each part and month."""
        return _parts(self.spark, self.store, "ids", self.months if months is None else months, _IDS_SCHEMA)

    def suspect_months(self) -> list[Row]:
        """The parts of months that have rows whose id may occur more than once."""
        numbers = id_sets.suspects(self.ids())
        months = id_sets.words_numbered(self.ids(), numbers).select(*FACT_FOLDERS).distinct().collect()
        found = {100 * row.transaction_year + row.transaction_month for row in months}
        return [part for part in self.months if part.month in found]

    def repeated_ids(self) -> DataFrame:
        """(key, rows) of the transaction ids that occur more than once."""
        return id_sets.repeated_ids(self.stored_fact(self.suspect_months()), "transaction_id", self.ids())

    def surplus(self, *keys: str) -> DataFrame:
        """(keys, surplus) where rows outnumber transaction ids."""
        return id_sets.surplus_rows(self.stored_fact(self.suspect_months()), "transaction_id", self.ids(), *keys)

    def tables(self) -> dict[str, DataFrame]:
        """All tables by name, like those of a full run."""
        parsed = self.parsed()
        return {
            "customer_transactions_raw": self.raw().select(*RAW_SCHEMA.names),
            "dq_issues": issue_log(self.raw(), self.id_type),
            "stg_transactions": staging.clean_columns(parsed.where(F.col("outcome") == CLEAN)),
            "audit_transactions": staging.rejected_columns(parsed.where(F.col("outcome") == REJECTED)),
            "fact_transactions": self.fact(),
            "dim_customer": read_table(self.spark, self.layout.dim_customer),
            "dim_product": read_table(self.spark, self.layout.dim_product),
        }


def stored(spark: SparkSession, root: str, id_type: str = staging.ID_TYPE) -> Stored:
    """The tables of the last published refresh."""
    warehouse = Warehouse(spark, root)
    return Stored(spark, warehouse.current(), Store(warehouse.root), id_type)


def _previous(spark: SparkSession, warehouse: Warehouse, store: Store, id_type: str) -> Stored | None:
    layouts = [layout for layout in warehouse.kept_layouts()[-1:] if warehouse.has(layout.months)]
    return Stored(spark, layouts[0], store, id_type) if layouts else None


# --- the steps of a refresh --------------------------------------------------------------------------------------


def _load(
    spark: SparkSession, layout: Layout, store: Store, name: str, locations: list[str], id_type: str, on_malformed: str
) -> tuple[LoadCounts, SplitCounts, DataFrame, DataFrame]:
    """Reads the files into a batch of raw rows and one of parsed rows."""
    raw_path, parsed_path = f"{store.folder('raw')}/batch={name}", f"{store.folder('parsed')}/batch={name}"
    if not locations:
        empty = spark.createDataFrame([], RAW_BATCH_SCHEMA)
        return LoadCounts(0), SplitCounts(0, 0), empty, spark.createDataFrame([], _parsed_schema(spark, id_type))
    rows = read_csv(spark, locations, keep_problems=True, keep_path=True)
    loaded = load_raw(rows, raw_path, layout.rejected_lines, on_malformed, RAW_BATCH_SCHEMA)
    raw = read_table(spark, raw_path)
    counts = Observation("split")
    parsed = _parsed(raw, id_type)
    observed = parsed.observe(
        counts,
        F.count_if(F.col("outcome") == CLEAN).alias("clean"),
        F.count_if(F.col("outcome") == REJECTED).alias("rejected"),
    )
    overwrite(observed, parsed_path, ("outcome",))
    stored_rows = spark.read.schema(parsed.schema).parquet(parsed_path)
    return loaded, SplitCounts(**counts.get), raw, stored_rows


def _days_by_month(rows: DataFrame) -> dict[int, Row]:
    day = F.col("transaction_date")
    months = rows.groupBy(month_of(day).alias("month"))
    found = months.agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count(F.lit(1)).alias("rows"))
    return {row.month: row for row in found.collect()}


def _changes(old: list[Row], new: dict[int, Row], dead: set[int]) -> dict[int, str]:
    """What happens to each month."""
    last: dict[int, dt.date] = {}
    for part in old:
        last[part.month] = max(last.get(part.month, part.last_day), part.last_day)
    out = {}
    for month in last.keys() | new.keys():
        if month not in last:
            out[month] = CREATED
        elif month in dead or (month in new and new[month].first_day <= last[month]):
            out[month] = REWRITTEN
        else:
            out[month] = APPENDED if month in new else KEPT
    return out


def _at_once(*jobs: Callable[[], None]) -> None:
    """Runs jobs that don't depend on each other, so that the short stages of one don't leave the others' cores idle."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        for done in [pool.submit(job) for job in jobs]:
            done.result()


def _write_fact(
    spark: SparkSession, layout: Layout, store: Store, name: str, rows: DataFrame, kept_index: DataFrame | None
) -> None:
    """Writes the ids and the rows with their totals since the month's beginning."""
    words = id_sets.id_words(rows, "transaction_id", *FACT_FOLDERS).select(*_IDS_SCHEMA.names)
    ids_path = f"{store.folder('ids')}/part={name}"
    overwrite(gathered(words, *FACT_FOLDERS), ids_path, FACT_FOLDERS)
    repeated = id_sets.suspects(spark.read.schema(_IDS_SCHEMA).parquet(ids_path)).count()
    out = rows
    for spec in totals():
        running = replace(spec.total, name=spec.stored, within=FACT_FOLDERS, handle=HANDLE if repeated else None)
        out = with_running_total(out, running, source=rows)
        if kept_index is not None:
            starts_path = layout.work(f"starts-{spec.stored}")
            overwrite(carry.month_to_date(kept_index, spec), starts_path)
            out = carry.with_offset(out, read_table(spark, starts_path), "start", spec, spec.stored, spec.stored)
    overwrite(gathered(out, *FACT_FOLDERS), f"{store.folder('fact')}/part={name}", FACT_FOLDERS)


def _write_months(
    spark: SparkSession, layout: Layout, store: Store, name: str, rows: DataFrame, kept_index: DataFrame | None
) -> None:
    """Writes the part of this run: fact rows with their totals since the month's beginning, index, cells and sets of ids.
    `kept_index` has the index of the parts that stay before the new rows in their months, if there are any."""
    specs = totals()
    own = carry.month_totals(rows, specs[0]).unionByName(carry.month_totals(rows, specs[1]))
    tables = {"totals": _by_month(own), "cells": month_cells.cells(rows)}

    def write(table: str) -> None:
        overwrite(gathered(tables[table], *FACT_FOLDERS), f"{store.folder(table)}/part={name}", FACT_FOLDERS)

    _at_once(
        lambda: _write_fact(spark, layout, store, name, rows, kept_index),
        lambda: write("totals"),
        lambda: write("cells"),
    )


def merged_dimension(new: DataFrame, old: DataFrame | None, keys: tuple[str, ...]) -> DataFrame:
    """New rows of a dimension with the times of the old ones: `created_at` is when a key first appeared, and `updated_at`
    when its row last changed."""
    if old is None:
        return new
    facts = [c for c in new.columns if c not in (*keys, "created_at", "updated_at")]
    before = old.select(*[F.col(c).alias(f"_{c}") for c in old.columns])
    same_key, unchanged = F.lit(True), F.col("_created_at").isNotNull()
    for key in keys:
        same_key = same_key & F.col(key).eqNullSafe(F.col(f"_{key}"))
    for column in facts:
        unchanged = unchanged & F.col(column).eqNullSafe(F.col(f"_{column}"))
    times = {"created_at": F.coalesce("_created_at", "created_at")}
    if "updated_at" in new.columns:
        times["updated_at"] = F.when(unchanged, F.col("_updated_at")).otherwise(F.col("updated_at"))
    return new.join(before, same_key, "left").select(*[times.get(c, F.col(c)).alias(c) for c in new.columns])


def _write_dimensions(layout: Layout, now: Stored, before: Stored | None, as_of: dt.date | None, unique: bool) -> None:
    spark = now.spark
    customers = month_cells.dim_customer(now.cells(), as_of, None if unique else now.surplus("customer_id"))
    products = month_cells.dim_product(now.cells(), None if unique else now.surplus("product_id", "product_name"))
    old_customers = read_table(spark, before.layout.dim_customer) if before else None
    old_products = read_table(spark, before.layout.dim_product) if before else None
    _at_once(
        lambda: overwrite(merged_dimension(customers, old_customers, ("customer_id",)), layout.dim_customer),
        lambda: overwrite(merged_dimension(products, old_products, ("product_id", "product_name")), layout.dim_product),
    )


def _remove_unnamed(spark: SparkSession, warehouse: Warehouse, store: Store, name: str) -> None:
    """Deletes batches and parts that no kept run names, except those of runs that are newer than this one."""
    used: set[str] = set()
    for layout in warehouse.kept_layouts():
        if warehouse.has(layout.months):
            used |= {row.part for row in read_table(spark, layout.months).select("part").distinct().collect()}
            batches = read_table(spark, layout.files).where("batch IS NOT NULL").select("batch").distinct()
            used |= {row.batch for row in batches.collect()}
    for table in ("raw", "parsed", "fact", "totals", "cells", "ids"):
        for folder in warehouse.parts(f"store/{table}"):
            own = folder.partition("=")[2]
            if own < name and own not in used:
                warehouse.remove(f"{store.folder(table)}/{folder}")


def refresh(
    spark: SparkSession,
    csv_path: str,
    root: str,
    as_of: dt.date | None = None,
    id_type: str = staging.ID_TYPE,
    fail_on_tests: bool = True,
    on_malformed: str = FAIL,
) -> RefreshResult:
    """Brings all layers up to the files now below `csv_path`. The first refresh of a root reads them all."""
    with utc(spark):
        return _refresh(spark, csv_path, root, as_of, id_type, fail_on_tests, on_malformed)


def _refresh(
    spark: SparkSession,
    csv_path: str,
    root: str,
    as_of: dt.date | None,
    id_type: str,
    fail_on_tests: bool,
    on_malformed: str,
) -> RefreshResult:
    warehouse = Warehouse(spark, root)
    store = Store(warehouse.root)
    name, layout = warehouse.new_run()
    before = _previous(spark, warehouse, store, id_type)
    had = before.files if before else manifests.empty_manifest(spark)

    # The list is written before it is used: files may arrive meanwhile.
    overwrite(manifests.compared(manifests.listing(spark, csv_path), had), layout.work("files"))
    files = read_table(spark, layout.work("files"))
    states = {row.state: row["count"] for row in files.groupBy("state").count().collect()}
    locations = [row.location for row in files.where(F.col("state").isin(NEW, CHANGED)).select("location").collect()]
    loaded, split, raw, parsed = _load(spark, layout, store, name, locations, id_type, on_malformed)
    log.info("files: %s; %s", states, loaded)
    counts = raw.groupBy(F.col("source_path").alias("path")).agg(F.count(F.lit(1)).alias("rows"))
    overwrite(manifests.renewed(files, name, counts), layout.files)

    new_rows = _new_fact_rows(parsed)
    dead = files.where(F.col("state").isin(CHANGED, REMOVED)).select(F.col("path").alias("source_path"))
    own_months = new_rows.groupBy(F.col("source_path"), month_of(F.col("transaction_date")).alias("month"))
    file_months = own_months.agg(F.count(F.lit(1)).alias("rows"))
    dead_months: set[int] = set()
    if before:
        old_months = read_table(spark, before.layout.file_months)
        if states.get(CHANGED) or states.get(REMOVED):
            gone = old_months.join(dead, "source_path", "left_semi").select("month").distinct()
            dead_months = {row.month for row in gone.collect()}
        file_months = file_months.unionByName(old_months.join(dead, "source_path", "left_anti"))
    overwrite(file_months, layout.file_months)

    old = before.months if before else []
    changes = _changes(old, _days_by_month(new_rows), dead_months)
    again = [part for part in old if changes[part.month] == REWRITTEN]
    parts = [replace_change(part, KEPT) for part in old if changes[part.month] in (KEPT, APPENDED)]
    touched = new_rows
    if again:
        had_rows = before.stored_fact(again).join(dead, "source_path", "left_anti")
        touched = had_rows.select(*new_rows.columns).unionByName(new_rows)
    if set(changes.values()) - {KEPT}:
        overwrite(touched, layout.work("touched"))
        touched = read_table(spark, layout.work("touched"))
        appended = [part for part in old if changes[part.month] == APPENDED]
        kept_index = before.index(appended) if appended else None
        _write_months(spark, layout, store, name, touched, kept_index)
        parts += [
            Row(month=month, part=name, last_day=row.last_day, rows=row.rows, change=changes[month])
            for month, row in sorted(_days_by_month(touched).items())
        ]
    overwrite(spark.createDataFrame(parts, MONTHS_SCHEMA), layout.months)

    now = Stored(spark, layout, store, id_type)
    # Mostly no word is suspect, which one pass over the words tells; the others' ids take several.
    repeated_ids = now.repeated_ids().count() if id_sets.suspects(now.ids()).count() else 0
    _write_dimensions(layout, now, before, as_of, not repeated_ids)
    tables = {
        "customer_transactions_raw": raw,
        "stg_transactions": staging.clean_columns(parsed.where(F.col("outcome") == CLEAN)),
        "audit_transactions": staging.rejected_columns(parsed.where(F.col("outcome") == REJECTED)),
        "fact_transactions": touched,
        "dim_customer": read_table(spark, layout.dim_customer),
        "dim_product": read_table(spark, layout.dim_product),
    }
    ids = (("stg_transactions", "unique"), ("fact_transactions", "unique"), ("fact_transactions", "repeated_key"))
    known = {(table, kind, "transaction_id"): repeated_ids for table, kind in ids}
    test_results = checks.run_tests(tables, known=known).collect()
    publish(warehouse, name, test_results, fail_on_tests)
    warehouse.remove(layout.work(""))
    _remove_unnamed(spark, warehouse, store, name)
    summary = month_cells.run_summary(now.cells()).first()
    log.info("summary: %s", summary.asDict())
    return RefreshResult(states, loaded, split, now.months, repeated_ids, test_results, summary)


def replace_change(part: Row, change: str) -> Row:
    return Row(**(part.asDict() | {"change": change}))
