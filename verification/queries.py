"""One query per operator, over the whole test tables. `orders` plays the raw transactions (see orders_feed).

Time stamps of the run itself are left out of the results, and decimal ratios are rounded as doubles, so that
every column can be compared with another engine.
"""

import contextlib
import datetime as dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.operators import id_sets, month_cells
from ledgermill.operators.issue_life import advance
from ledgermill.operators.issues import issue_log
from ledgermill.operators.keys import keys_without_parent, repeated_keys, rows_without_parent
from ledgermill.operators.running_total import with_running_total
from ledgermill.plans import checks, marts, reports, staging
from ledgermill.plans.refresh import MONTHS_SCHEMA, refresh, stored
from ledgermill.plans.run import publish, read_audit, read_staging, read_tables, write_marts, write_staging
from ledgermill.schemas import RAW_COLUMNS
from ledgermill.sources.orders_feed import raw_from_orders, read_raw_from_orders
from ledgermill.sources.quoted_csv import read_quoted_csv
from ledgermill.sources.raw_csv import QUARANTINE, load_raw, read_csv
from ledgermill.sources.tables import (
    ROW_HANDLE,
    Layout,
    Warehouse,
    overwrite,
    read_table,
    shared_folder,
    with_row_handle,
)

AS_OF = dt.date(2001, 8, 2)
EVENTS_AS_OF = dt.datetime(2024, 2, 1)

Query = Callable[[SparkSession, str], DataFrame]


def raw(spark: SparkSession, folder: str) -> DataFrame:
    return read_raw_from_orders(spark, folder)


def base(spark: SparkSession, folder: str) -> DataFrame:
    return staging.base_transactions(raw(spark, folder))


def stg(spark: SparkSession, folder: str) -> DataFrame:
    return staging.stg_transactions(base(spark, folder))


def fact_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The fact without running totals, for the queries that do not read them."""
    return marts.fact_rows(stg(spark, folder))


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return marts.dim_customer(stg(spark, folder), AS_OF)


def events_as_load(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet").withColumnRenamed("ts", "loaded_at")


def with_repeats(df: DataFrame) -> DataFrame:
    """Input for the key checks: every fiftieth id occurs twice."""
    return df.unionByName(df.where(F.col("transaction_id") % 50 == 1))


def with_high_flags(fact: DataFrame) -> DataFrame:
    """Input for the flag reports: large amounts are flagged HIGH."""
    flag = F.when(F.col("total_amount") >= 1500, "HIGH").otherwise(F.col("data_quality_flag"))
    return fact.withColumn("data_quality_flag", flag)


def known_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Input for the foreign key checks: some customers are missing."""
    return customers(spark, folder).where(F.col("customer_id") % 13 != 0)


def known_products(spark: SparkSession, folder: str) -> DataFrame:
    return marts.dim_product(stg(spark, folder)).where(~F.col("product_id").isin(104, 105))


# --- sources ---------------------------------------------------------------------------------------------


def raw_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return raw(spark, folder).select(*RAW_COLUMNS)


def _as_csv(spark: SparkSession, folder: str) -> str:
    path = shared_folder(spark, "transactions-csv")
    raw_transactions(spark, folder).write.option("header", True).mode("overwrite").csv(path)
    return path


def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    return read_csv(spark, _as_csv(spark, folder)).select(*RAW_COLUMNS)


def load_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return read_csv(spark, _as_csv(spark, folder)).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("loaded_at").alias("stamped_rows"),
        F.count_distinct("loaded_at").alias("load_times"),
        F.count_if(F.col("source_file").endswith(".csv")).alias("rows_with_file"),
    )


def raw_reload_idempotent(spark: SparkSession, folder: str) -> DataFrame:
    """The content after two loads into one place."""
    path = shared_folder(spark, "raw")
    for _ in range(2):
        load_raw(raw(spark, folder), path)
    return read_table(spark, path).select(*RAW_COLUMNS)


def raw_row_count(spark: SparkSession, folder: str) -> DataFrame:
    counts = load_raw(raw(spark, folder), shared_folder(spark, "raw"))
    return spark.range(1).select(F.lit(counts.rows_loaded).cast("bigint").alias("rows_loaded"))


def _as_lines(spark: SparkSession, folder: str) -> str:
    """The transactions as CSV lines, some of them damaged by rules on the order key."""
    rows = raw_transactions(spark, folder).withColumn("k", F.regexp_extract("transaction_id", "[0-9]+", 0).cast("bigint"))
    cells = [F.coalesce(name, F.lit("")) for name in RAW_COLUMNS]
    damaged = (
        F.when(F.col("k") % 50 == 0, F.concat_ws(",", *cells[:6], F.lit("1"), *cells[6:]))
        .when(F.col("k") % 77 == 0, F.concat_ws(",", *cells[:4], F.concat(F.lit('"'), cells[4]), *cells[5:]))
        .when(F.col("k") % 90 == 1, F.concat_ws(",", *cells[:5]))
        .otherwise(F.concat_ws(",", *cells))
    )
    path = shared_folder(spark, "damaged-csv")
    options = {"header": True, "quote": "", "sep": "\u0001", "emptyValue": ""}
    rows.select(damaged.alias(",".join(RAW_COLUMNS))).write.options(**options).csv(path)
    return path


def csv_malformed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines set aside by a load, and what is wrong with them."""
    rows = read_csv(spark, _as_lines(spark, folder), keep_problems=True)
    rejected = shared_folder(spark, "rejected")
    load_raw(rows, shared_folder(spark, "raw"), rejected, QUARANTINE)
    return read_table(spark, rejected).select("line", "problem")


def csv_load_without_malformed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """What the same load keeps; short lines have NULLs."""
    rows = read_csv(spark, _as_lines(spark, folder), keep_problems=True)
    path = shared_folder(spark, "raw")
    load_raw(rows, path, shared_folder(spark, "rejected"), QUARANTINE)
    return read_table(spark, path).select(*RAW_COLUMNS)


def _as_multi_line(spark: SparkSession, folder: str) -> str:
    """The transactions as CSV files in which some names hold a line break, a comma and quotes."""
    odd = F.concat(F.col("product_name"), F.lit('\n"large", blue'))
    rows = raw_transactions(spark, folder)
    rows = rows.withColumn("product_name", F.when(F.col("product_id") == "102", odd).otherwise(F.col("product_name")))
    path = shared_folder(spark, "multi-line-csv")
    rows.write.options(header=True, quote='"', escape='"').csv(path)
    return path


def csv_multi_line(spark: SparkSession, folder: str) -> DataFrame:
    """Such names read back as one value each."""
    read = read_csv(spark, _as_multi_line(spark, folder), multi_line=True, keep_problems=True)
    target = shared_folder(spark, "raw")
    load_raw(read, target)
    return read_table(spark, target).select(*RAW_COLUMNS)


def csv_multi_line_split(spark: SparkSession, folder: str) -> DataFrame:
    """The same, with each file read by many tasks."""
    target = shared_folder(spark, "raw")
    load_raw(read_quoted_csv(spark, _as_multi_line(spark, folder), keep_problems=True), target)
    return read_table(spark, target).select(*RAW_COLUMNS)


# --- staging ---------------------------------------------------------------------------------------------

KEYS = ("transaction_id", "customer_id", "transaction_date", "product_id", "product_name")
AMOUNTS = ("quantity", "price", "tax")
FLAGS = (
    "is_transaction_id_missing",
    "is_customer_id_missing",
    "is_date_missing",
    "is_product_id_missing",
    "is_quantity_missing",
    "has_invalid_transaction_id",
    "has_non_numeric_price",
    "has_non_numeric_tax",
)


def base_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return base(spark, folder).select(*KEYS, *AMOUNTS, *FLAGS, "source_file")


def quality_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per combination of flags, over all raw rows, also those that are dropped later."""
    flagged = staging.flagged_rows(raw(spark, folder))
    return flagged.groupBy(*FLAGS).agg(F.count(F.lit(1)).alias("row_count"))


def stg_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return stg(spark, folder).select(*KEYS, *AMOUNTS, "total_amount", "tax_amount", "data_quality_flag")


def audit_transactions(spark: SparkSession, folder: str) -> DataFrame:
    rejected = staging.audit_transactions(base(spark, folder))
    return rejected.select(*KEYS, *AMOUNTS, "rejection_reason", "source_file")


# --- marts -----------------------------------------------------------------------------------------------


def fact_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return comparable_fact(marts.fact_transactions(stg(spark, folder)))


def comparable_fact(fact: DataFrame) -> DataFrame:
    return fact.drop("processed_at", "created_at").withColumns(
        {
            "tax_percentage": F.round(F.col("tax_percentage").cast("double"), 6),
            "customer_cumulative_spend": F.col("customer_cumulative_spend").cast("decimal(38,4)"),
            "product_cumulative_quantity": F.col("product_cumulative_quantity").cast("decimal(38,2)"),
        }
    )


def dim_customer(spark: SparkSession, folder: str) -> DataFrame:
    return customers(spark, folder).drop("created_at", "updated_at")


def dim_product(spark: SparkSession, folder: str) -> DataFrame:
    return marts.dim_product(stg(spark, folder)).drop("created_at")


def customer_cumulative_spend(spark: SparkSession, folder: str) -> DataFrame:
    spend = with_running_total(fact_rows(spark, folder), marts.customer_spend())
    return spend.select(
        "transaction_id", "customer_id", F.col("customer_cumulative_spend").cast("decimal(38,4)").alias("spend")
    )


def product_cumulative_quantity(spark: SparkSession, folder: str) -> DataFrame:
    """Over all base rows, so that rows without product or quantity take part."""
    total = with_running_total(base(spark, folder), marts.product_quantity())
    return total.select(
        "transaction_id", "product_id", F.col("product_cumulative_quantity").cast("decimal(38,2)").alias("total")
    )


def customer_cumulative_spend_split(spark: SparkSession, folder: str) -> DataFrame:
    """The same totals with limits so small that most groups are cut; limits choose a plan, not a result."""
    spend = with_running_total(fact_rows(spark, folder), marts.customer_spend(hot_rows=3, chunk_rows=2))
    return spend.select(
        "transaction_id", "customer_id", F.col("customer_cumulative_spend").cast("decimal(38,4)").alias("spend")
    )


def product_cumulative_quantity_split(spark: SparkSession, folder: str) -> DataFrame:
    total = with_running_total(base(spark, folder), marts.product_quantity(hot_rows=0, chunk_rows=2))
    return total.select(
        "transaction_id", "product_id", F.col("product_cumulative_quantity").cast("decimal(38,2)").alias("total")
    )


def running_total_sparse_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Ids spread over 62 bits, all products cut."""
    sparse = F.col("transaction_id") * F.lit(1_000_003 * 1_000_003)
    rows = base(spark, folder).withColumn("transaction_id", sparse)
    total = with_running_total(rows, marts.product_quantity(hot_rows=0, chunk_rows=3))
    return total.select(
        "transaction_id", "product_id", F.col("product_cumulative_quantity").cast("decimal(38,2)").alias("total")
    )


def running_total_repeated_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Every row stored twice, with a row handle: the totals after all copies of an id."""
    path = shared_folder(spark, "twice")
    rows = base(spark, folder)
    overwrite(rows.unionAll(rows), path)
    spec = replace(marts.product_quantity(hot_rows=0, chunk_rows=3), handle=ROW_HANDLE)
    total = with_running_total(with_row_handle(read_table(spark, path)), spec)
    ends = total.groupBy("transaction_id", "product_id").agg(F.max("product_cumulative_quantity").alias("total"))
    return ends.select("transaction_id", "product_id", F.col("total").cast("decimal(38,2)").alias("total"))


# --- checks ----------------------------------------------------------------------------------------------


def check_not_null(spark: SparkSession, folder: str) -> DataFrame:
    columns = ("transaction_id", "customer_id", "transaction_date", "product_id", "product_name", *AMOUNTS)
    tests = [checks.TableTest("base", "not_null", column) for column in columns]
    return checks.run_tests({"base": base(spark, folder)}, tests)


def check_unique(spark: SparkSession, folder: str) -> DataFrame:
    tables = {"stg": with_repeats(stg(spark, folder)), "dim_customer": customers(spark, folder)}
    tests = [
        checks.TableTest("stg", "unique", "transaction_id"),
        checks.TableTest("dim_customer", "unique", "customer_id"),
    ]
    return checks.run_tests(tables, tests)


def check_accepted_values(spark: SparkSession, folder: str) -> DataFrame:
    tables = {"fact": fact_rows(spark, folder)}
    tests = [
        checks.TableTest("fact", "accepted_values", "volume_category", ("High Volume",)),
        checks.TableTest("fact", "accepted_values", "price_category", ("Premium", "Standard", "Budget")),
    ]
    return checks.run_tests(tables, tests)


def rel_fact_customer(spark: SparkSession, folder: str) -> DataFrame:
    facts = fact_rows(spark, folder).where(F.col("customer_id").isNotNull())
    missing = keys_without_parent(facts, "customer_id", known_customers(spark, folder), "customer_id")
    return missing.select(F.col("key").alias("customer_id"), F.col("rows").alias("row_count"))


def rel_fact_product(spark: SparkSession, folder: str) -> DataFrame:
    facts = fact_rows(spark, folder).where(F.col("product_id").isNotNull())
    missing = rows_without_parent(facts, "product_id", known_products(spark, folder), "product_id")
    return missing.select(F.col("rows").alias("failures"))


def fact_null_customer(spark: SparkSession, folder: str) -> DataFrame:
    """Over rows whose customer is unset where the id is a multiple of 40."""
    some_unset = F.when(F.col("transaction_id") % 40 != 0, F.col("customer_id")).alias("customer_id")
    rows = fact_rows(spark, folder).select("transaction_id", some_unset, "total_amount")
    return rows.where(F.col("customer_id").isNull())


def stored_tables(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], int]:
    """All layers written by the same steps as a batch run, so that later steps do not parse the text again, and
    the number of repeated ids."""
    layout = Layout(shared_folder(spark, "warehouse"))
    load_raw(raw(spark, folder), layout.raw)
    write_staging(spark, layout)
    repeated_ids = write_marts(spark, layout, AS_OF, staging.ID_TYPE)
    return read_tables(spark, layout), repeated_ids


def declared_tests(spark: SparkSession, folder: str) -> DataFrame:
    """All 35 tests over the written tables."""
    tables, repeated_ids = stored_tables(spark, folder)
    return checks.run_tests(tables, known={("stg_transactions", "unique", "transaction_id"): repeated_ids})


def source_freshness(spark: SparkSession, folder: str) -> DataFrame:
    """Freshness of the events as a loaded table, two days after the last full day."""
    return checks.freshness(events_as_load(spark, folder), EVENTS_AS_OF)


def named_checks(spark: SparkSession, folder: str) -> DataFrame:
    return checks.named_checks(
        fact_rows(spark, folder),
        [
            ("negative amounts", F.col("total_amount") < 0),
            ("large amounts", F.col("total_amount") >= 1500),
            ("no product", F.col("product_id").isNull()),
        ],
    )


def sql_checks(spark: SparkSession, folder: str) -> DataFrame:
    fact_rows(spark, folder).createOrReplaceTempView("checked_fact")
    return checks.sql_checks(
        spark,
        [
            ("negative amounts", "SELECT count(*) FROM checked_fact WHERE total_amount < 0"),
            ("large amounts", "SELECT count(*) FROM checked_fact WHERE total_amount >= 1500"),
            ("no row", "SELECT transaction_id FROM checked_fact WHERE total_amount < 0"),
            ("NULL", "SELECT sum(quantity) FROM checked_fact WHERE total_amount < 0"),
        ],
    )


def dq_flag_summary(spark: SparkSession, folder: str) -> DataFrame:
    """With some flags HIGH and some unset."""
    flagged = with_high_flags(fact_rows(spark, folder))
    unset = F.when(F.col("volume_category") != "High Volume", F.col("data_quality_flag"))
    return checks.flag_summary(flagged.withColumn("data_quality_flag", unset))


def dq_issues(spark: SparkSession, folder: str) -> DataFrame:
    return issue_log(raw(spark, folder)).drop("issue_id", "discovered_at")


# --- publication and refreshes ---------------------------------------------------------------------------


def publication_states(spark: SparkSession, folder: str) -> DataFrame:
    """Three runs through the gate: good rows, repeated ids, and repeated ids that are let through. After each, what its
    marker says and how many rows readers see."""
    root = shared_folder(spark, "publication")
    warehouse, out = Warehouse(spark, root), []
    tests = [
        checks.TableTest("stg_transactions", "unique", "transaction_id"),
        checks.TableTest("stg_transactions", "not_null", "customer_id"),
    ]
    good = raw(spark, folder)
    bad = good.unionAll(good.where(F.col("transaction_id").endswith("1")))
    for step, rows, keep_going in ((1, good, False), (2, bad, False), (3, bad, True)):
        name, layout = warehouse.new_run()
        load_raw(rows, layout.raw)
        write_staging(spark, layout)
        results = checks.run_tests({"stg_transactions": read_staging(spark, layout)}, tests).collect()
        with contextlib.suppress(checks.DataQualityError):
            publish(warehouse, name, results, fail_on_tests=not keep_going)
        state = next(s for s in warehouse.states() if s.name == name)
        visible = read_staging(spark, warehouse.current())
        out.append(visible.agg(F.count(F.lit(1)).alias("visible_rows"), F.count_distinct("transaction_id").alias("visible_ids")))
        out[-1] = common_columns(out[-1], step=step, state=state.state, problems=len(state.problems))
    return out[0].unionAll(out[1]).unionAll(out[2])


def common_columns(df: DataFrame, **values: int | str) -> DataFrame:
    return df.select(*[F.lit(value).alias(name) for name, value in values.items()], "*")


# The parts in which the transactions arrive as files.
STRAY_MONTH, LATE_MONTH, WRONG_YEAR, NEW_FROM = 199503, 199605, 1998, "2001-07-16"


def _arrivals(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Raw rows with the file they come in, for the first load and for the third: a file per year, of which one first
    lacks prices, a stray copy of a month that goes away, late rows of a month, and the newest days."""
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    day, key = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    month = F.year(day) * 100 + F.month(day)
    arrival = (
        F.when(day >= F.lit(NEW_FROM).cast("date"), "new")
        .when((month == LATE_MONTH) & (key % 5 == 2), "late")
        .otherwise(F.year(day).cast("string"))
    )

    def lines(rows: DataFrame, file: Column) -> DataFrame:
        marks = rows.select("*", file.alias("file"), (key % 3 == 0).alias("third"), (month == STRAY_MONTH).alias("stray"))
        return raw_from_orders(marks, "file", "third", "stray").drop("loaded_at", "source_file")

    final = lines(orders, arrival)
    no_price = (F.col("file") == str(WRONG_YEAR)) & F.col("third")
    first = final.where(~F.col("file").isin("new", "late"))
    first = first.withColumn("price", F.when(no_price, "pending").otherwise(F.col("price")))
    other_id = F.when(F.col("transaction_id").startswith("T"), F.col("transaction_id"))
    other_id = other_id.otherwise(F.concat(F.lit("77000000"), F.lpad("transaction_id", 10, "0")))
    copies = final.where("stray").withColumns({"transaction_id": other_id, "file": F.lit("stray")})
    return first.unionByName(copies), final


def _put_files(spark: SparkSession, rows: DataFrame, target: str) -> None:
    """One CSV file per value of `file`, in the place of an older one of that name."""
    staged = shared_folder(spark, "arrivals")
    files = rows.select(*RAW_COLUMNS, "file").repartition("file")
    files.write.partitionBy("file").option("header", True).csv(staged)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    system = path(staged).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(path(target))
    for status in system.listStatus(path(staged)):
        name = status.getPath().getName()
        if name.startswith("file="):
            (part,) = [x.getPath() for x in system.listStatus(status.getPath()) if x.getPath().getName().endswith(".csv")]
            place = path(f"{target}/{name.partition('=')[2]}.csv")
            system.delete(place, False)
            system.rename(part, place)


def refreshed(spark: SparkSession, folder: str) -> tuple[str, list[DataFrame]]:
    """A root after three refreshes (all files, nothing new, all kinds of changes), and the tables of files and months of
    each. Every call makes its own, so that each query does its whole job whenever it is run."""
    place, root = shared_folder(spark, "files"), shared_folder(spark, "refreshed")
    first, final = _arrivals(spark, folder)
    seen = []
    for load in (1, 2, 3):
        if load == 1:
            _put_files(spark, first, place)
        elif load == 3:
            _put_files(spark, final.where(F.col("file").isin("new", "late", str(WRONG_YEAR))), place)
            stray = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{place}/stray.csv")
            stray.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(stray, False)
        result = refresh(spark, place, root, AS_OF, fail_on_tests=False)
        now = stored(spark, root)
        files = now.files.groupBy("state").agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("row_count"))
        months = spark.createDataFrame(now.months, MONTHS_SCHEMA)
        months = months.groupBy("month", "change").agg(F.sum("rows").alias("row_count"), F.count(F.lit(1)).alias("parts"))
        counts = {"load": load, "rows_read": result.loaded.rows_loaded}
        for name, table in (("load-files", files), ("load-months", months)):
            path = shared_folder(spark, name)
            overwrite(common_columns(table, **counts), path)
            seen.append(read_table(spark, path))
    return root, seen


def refresh_files(spark: SparkSession, folder: str) -> DataFrame:
    """What each load found: files by state with their rows, and the rows it read."""
    _, seen = refreshed(spark, folder)
    return seen[0].unionAll(seen[2]).unionAll(seen[4])


def refresh_months(spark: SparkSession, folder: str) -> DataFrame:
    """What each load did to every month."""
    _, seen = refreshed(spark, folder)
    return seen[1].unionAll(seen[3]).unionAll(seen[5]).drop("rows_read")


def refresh_raw(spark: SparkSession, folder: str) -> DataFrame:
    """The raw rows after all loads: those of the files as they are now."""
    root, _ = refreshed(spark, folder)
    return stored(spark, root).tables()["customer_transactions_raw"].select(*RAW_COLUMNS)


def refresh_fact(spark: SparkSession, folder: str) -> DataFrame:
    """The fact after all loads, with running totals carried over the months."""
    root, _ = refreshed(spark, folder)
    return comparable_fact(stored(spark, root).fact())


def refresh_monthly_revenue(spark: SparkSession, folder: str) -> DataFrame:
    """From the stored cells: no fact row is read."""
    root, _ = refreshed(spark, folder)
    return month_cells.monthly_revenue(stored(spark, root).cells())


def refresh_dim_product(spark: SparkSession, folder: str) -> DataFrame:
    root, _ = refreshed(spark, folder)
    return stored(spark, root).tables()["dim_product"].drop("created_at")


def refresh_run_summary(spark: SparkSession, folder: str) -> DataFrame:
    root, _ = refreshed(spark, folder)
    return month_cells.run_summary(stored(spark, root).cells())


# --- reports ---------------------------------------------------------------------------------------------


def layer_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Over staging as it is written, and the marts that follow from it."""
    layout = Layout(shared_folder(spark, "warehouse"))
    load_raw(raw(spark, folder), layout.raw)
    write_staging(spark, layout)
    rows = read_staging(spark, layout)
    tables = {
        "customer_transactions_raw": read_table(spark, layout.raw),
        "stg_transactions": rows,
        "audit_transactions": read_audit(spark, layout),
        "fact_transactions": marts.fact_rows(rows),
        "dim_customer": marts.dim_customer(rows, AS_OF),
        "dim_product": marts.dim_product(rows),
    }
    return reports.layer_row_counts(tables)


def sample_raw(spark: SparkSession, folder: str) -> DataFrame:
    return reports.sample_raw(raw_transactions(spark, folder))


def sample_staging(spark: SparkSession, folder: str) -> DataFrame:
    return reports.sample_staging(stg(spark, folder))


def sample_dim_customer(spark: SparkSession, folder: str) -> DataFrame:
    return reports.sample_dim_customer(customers(spark, folder))


def sample_fact(spark: SparkSession, folder: str) -> DataFrame:
    return reports.sample_fact(fact_rows(spark, folder))


def dq_issue_count(spark: SparkSession, folder: str) -> DataFrame:
    return reports.row_count(issue_log(raw(spark, folder)), "issue_count")


def issue_life(spark: SparkSession, folder: str) -> DataFrame:
    """The life of all issues after three runs, each of which finds some that others don't."""
    log = issue_log(raw(spark, folder))
    number = F.coalesce("row_number", F.lit(1))
    runs = (number % 2 != 0, F.col("column_name") != "price", number % 5 != 0)
    life = None
    for day, found in enumerate(runs, 1):
        life = advance(life, log.where(found), F.lit(dt.datetime(2024, 1, day)))
    stamps = ("first_found", "last_found", "resolved_at")
    return life.drop("issue_key").withColumns({name: F.to_date(name) for name in stamps})


def issues_by_type(spark: SparkSession, folder: str) -> DataFrame:
    return reports.issues_by_type(issue_log(raw(spark, folder)))


def flag_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return reports.flag_distribution(with_high_flags(fact_rows(spark, folder)))


def high_flag_count(spark: SparkSession, folder: str) -> DataFrame:
    return reports.high_flag_count(with_high_flags(fact_rows(spark, folder)))


def status_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return reports.status_distribution(customers(spark, folder))


def monthly_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return reports.monthly_revenue(fact_rows(spark, folder))


def dq_flag_percentage(spark: SparkSession, folder: str) -> DataFrame:
    return reports.flag_percentage(with_high_flags(fact_rows(spark, folder)))


def missing_values(spark: SparkSession, folder: str) -> DataFrame:
    return reports.missing_values(base(spark, folder))


def orphaned_facts(spark: SparkSession, folder: str) -> DataFrame:
    return reports.orphaned_facts(fact_rows(spark, folder), known_customers(spark, folder))


def duplicate_ids(spark: SparkSession, folder: str) -> DataFrame:
    repeats = repeated_keys(with_repeats(fact_rows(spark, folder)), "transaction_id")
    return repeats.select(F.col("key").alias("transaction_id"), F.col("rows").alias("duplicate_ids"))


def repeated_ids_by_words(spark: SparkSession, folder: str) -> DataFrame:
    """The same as duplicate_ids, with only the rows of words that hold an id twice grouped by their id."""
    repeats = id_sets.repeated_ids(with_repeats(fact_rows(spark, folder)), "transaction_id")
    return repeats.select(F.col("key").alias("transaction_id"), F.col("rows").alias("duplicate_ids"))


def _repeats_by_month(spark: SparkSession, folder: str, *keys: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fact rows with repeated ids, and their cells and words as they are stored per month."""
    rows = with_repeats(fact_rows(spark, folder))
    words = id_sets.id_words(rows, "transaction_id", *reports.MONTH, *keys)
    stored_tables = []
    for name, table in (("cells", month_cells.cells(rows)), ("words", words)):
        path = shared_folder(spark, f"month-{name}")
        overwrite(table, path, reports.MONTH)
        stored_tables.append(read_table(spark, path))
    return rows, *stored_tables


def product_distinct_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct transaction ids per product from the words of its months."""
    _, _, words = _repeats_by_month(spark, folder, "product_id")
    return id_sets.distinct_ids(words, "product_id", name="distinct_ids")


def dim_customer_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """The dimension from stored months, over rows whose ids repeat."""
    rows, cells, words = _repeats_by_month(spark, folder)
    surplus = id_sets.surplus_rows(rows, "transaction_id", words, "customer_id")
    return month_cells.dim_customer(cells, AS_OF, surplus).drop("created_at", "updated_at")


def dim_product_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """The dimension from stored months, over rows whose ids repeat."""
    rows, cells, words = _repeats_by_month(spark, folder)
    surplus = id_sets.surplus_rows(rows, "transaction_id", words, "product_id", "product_name")
    return month_cells.dim_product(cells, surplus).drop("created_at")


def fact_date_range(spark: SparkSession, folder: str) -> DataFrame:
    return reports.fact_date_range(fact_rows(spark, folder))


def year_month_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return reports.year_month_coverage(fact_rows(spark, folder))


def recent_customer_spend(spark: SparkSession, folder: str) -> DataFrame:
    spend = reports.recent_customer_spend(fact_rows(spark, folder), customers(spark, folder), AS_OF)
    return spend.withColumn("total_spend", F.col("total_spend").cast("decimal(38,4)"))


def overall_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return reports.overall_statistics(fact_rows(spark, folder), customers(spark, folder))


def run_summary(spark: SparkSession, folder: str) -> DataFrame:
    return reports.run_summary(fact_rows(spark, folder))


def latest_load_batch(spark: SparkSession, folder: str) -> DataFrame:
    return reports.latest_load_batch(events_as_load(spark, folder))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        raw_transactions,
        csv_scan,
        load_metadata,
        raw_reload_idempotent,
        raw_row_count,
        csv_malformed_lines,
        csv_load_without_malformed_lines,
        csv_multi_line,
        csv_multi_line_split,
        base_transactions,
        quality_flags,
        stg_transactions,
        audit_transactions,
        fact_transactions,
        dim_customer,
        dim_product,
        customer_cumulative_spend,
        product_cumulative_quantity,
        customer_cumulative_spend_split,
        product_cumulative_quantity_split,
        running_total_sparse_ids,
        running_total_repeated_ids,
        check_not_null,
        check_unique,
        check_accepted_values,
        rel_fact_customer,
        rel_fact_product,
        fact_null_customer,
        declared_tests,
        source_freshness,
        named_checks,
        sql_checks,
        dq_flag_summary,
        publication_states,
        refresh_files,
        refresh_months,
        refresh_raw,
        refresh_fact,
        refresh_monthly_revenue,
        refresh_dim_product,
        refresh_run_summary,
        dq_issues,
        dq_issue_count,
        issues_by_type,
        issue_life,
        layer_row_counts,
        sample_raw,
        sample_staging,
        sample_dim_customer,
        sample_fact,
        flag_distribution,
        high_flag_count,
        status_distribution,
        monthly_revenue,
        dq_flag_percentage,
        missing_values,
        orphaned_facts,
        duplicate_ids,
        repeated_ids_by_words,
        product_distinct_ids,
        dim_customer_by_month,
        dim_product_by_month,
        fact_date_range,
        year_month_coverage,
        recent_customer_spend,
        overall_statistics,
        run_summary,
        latest_load_batch,
    )
}
