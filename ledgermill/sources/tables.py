"""Where the tables live, and how they are written and read."""

import atexit
import contextlib
import re
import tempfile
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLEAN, REJECTED = "clean", "rejected"


@dataclass(frozen=True)
class Layout:
    """Folders of one run's tables: raw, staging and marts layers below a root that all executors can reach."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw/customer_transactions_raw"

    @property
    def rejected_lines(self) -> str:
        return f"{self.root}/raw/rejected_lines"

    @property
    def issues(self) -> str:
        return f"{self.root}/raw/dq_issues"

    @property
    def issue_life(self) -> str:
        return f"{self.root}/raw/dq_issue_life"

    @property
    def parsed(self) -> str:
        return f"{self.root}/staging/parsed_transactions"

    @property
    def fact(self) -> str:
        return f"{self.root}/marts/fact_transactions"

    @property
    def dim_customer(self) -> str:
        return f"{self.root}/marts/dim_customer"

    @property
    def dim_product(self) -> str:
        return f"{self.root}/marts/dim_product"

    # What a refresh keeps about the shared store: the files it was loaded from, and the parts each month is made of.

    @property
    def files(self) -> str:
        return f"{self.root}/manifest/files"

    @property
    def file_months(self) -> str:
        return f"{self.root}/manifest/file_months"

    @property
    def months(self) -> str:
        return f"{self.root}/manifest/months"

    def work(self, name: str) -> str:
        """A table that only this run reads."""
        return f"{self.root}/work/{name}"


@dataclass(frozen=True)
class Store:
    """Folders that all refreshes below a root share. They write new batches and parts into them and change none."""

    root: str

    def folder(self, table: str) -> str:
        return f"{self.root}/store/{table}"


PUBLISHED, PUBLISHED_WITH_FAILURES, FAILED, UNFINISHED = "published", "published with failures", "failed", "unfinished"


@dataclass(frozen=True)
class RunState:
    name: str
    state: str
    problems: tuple[str, ...] = ()


class Warehouse:
    """Runs below one root. Each run writes a folder of its own; its tables are tested there, and only then it becomes
    the current one, by a marker file: readers see all tables of one run, and a run that breaks off or fails its tests
    changes nothing. The marker of a run that is published in spite of failed tests says what failed. A failed run's
    tables stay for inspection until the next one is published."""

    KEPT_RUNS = 2

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._spark = spark
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        path = self._path(f"{self.root}/{folder}")
        if not self._files.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self._files.listStatus(path))

    def new_run(self) -> tuple[str, Layout]:
        name = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        return name, Layout(f"{self.root}/runs/{name}")

    def current(self) -> Layout:
        committed = self._names("committed")
        if not committed:
            raise FileNotFoundError(f"no finished run below {self.root}")
        return Layout(f"{self.root}/runs/{committed[-1]}")

    def _mark(self, folder: str, name: str, problems: Sequence[str]) -> None:
        marker = self._files.create(self._path(f"{self.root}/{folder}/{name}"), False)
        marker.writeBytes("\n".join(problems))
        marker.close()

    def fail(self, name: str, problems: Sequence[str]) -> None:
        """Notes why the run is not published."""
        self._mark("failed", name, problems)

    def commit(self, name: str, problems: Sequence[str] = ()) -> None:
        """Makes the run current, and removes all older runs but the previous one, failed ones included."""
        self._mark("committed", name, problems)
        kept = self._names("committed")[-self.KEPT_RUNS :]
        for folder in ("committed", "failed", "runs"):
            for old in self._names(folder):
                if old < name and old not in kept:
                    self.remove(f"{self.root}/{folder}/{old}")

    def remove(self, folder: str) -> None:
        self._files.delete(self._path(folder), True)

    def states(self) -> list[RunState]:
        """The runs below the root, oldest first, with what their markers say."""
        committed, failed = self._names("committed"), self._names("failed")
        out = []
        for name in self._names("runs"):
            folder = "committed" if name in committed else "failed" if name in failed else None
            if folder is None:
                out.append(RunState(name, UNFINISHED))
                continue
            lines = self._spark.read.text(f"{self.root}/{folder}/{name}").collect()
            problems = tuple(line.value for line in lines if line.value)
            state = FAILED if folder == "failed" else PUBLISHED_WITH_FAILURES if problems else PUBLISHED
            out.append(RunState(name, state, problems))
        return out

    def kept_layouts(self) -> list[Layout]:
        return [Layout(f"{self.root}/runs/{name}") for name in self._names("committed")]

    def parts(self, folder: str) -> list[str]:
        return self._names(folder)

    def has(self, path: str) -> bool:
        return self._files.exists(self._path(path))


def overwrite(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Full rebuild of a table: a retry replaces rows, it never adds them."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(path)


def gathered(df: DataFrame, *columns: str) -> DataFrame:
    """Rows ready to be written in one folder per value of the columns. The rebalance gives each folder few
    files of the advisory size: it splits a large folder over several tasks and merges small ones, which a
    plain repartition would not."""
    return df.hint("rebalance", *[F.col(name) for name in columns])


def read_table(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    """`columns` restores an order that month folders have changed."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def with_row_handle(df: DataFrame) -> DataFrame:
    """Adds a handle unique per stored row (file, position in it), stable however often a task reruns."""
    return df.select(
        "*", F.col("_metadata.file_path").alias("row_file"), F.col("_metadata.row_index").alias("row_index")
    )


ROW_HANDLE = ("row_file", "row_index")


_scratch: list[tuple[SparkSession, str]] = []


def _remove_scratch() -> None:
    """Deletes this process's scratch tables when it ends, as long as its session still runs."""
    for spark, path in _scratch:
        context = spark.sparkContext
        if context._jsc is None or context._jsc.sc().isStopped():
            continue
        with contextlib.suppress(Py4JError):  # the JVM may be gone already
            place = context._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder that all executors can reach, below the cluster's checkpoint folder; it goes when the process
    ends. Where none is set and Spark runs in one process, as in tests, it is a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        base = tempfile.gettempdir()
    if not _scratch:
        atexit.register(_remove_scratch)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _scratch.append((spark, path))
    return path
