"""Written intermediate tables in the shared folder that the cluster names."""

from __future__ import annotations

import tempfile
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary, WeakSet

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# The folder of the job at hand, where it has one of its own.
_JOB: ContextVar[str | None] = ContextVar("scratch job", default=None)
# The folders made so far, by application.
_ROOTS: dict[str, str] = {}
# Tables that materialize() has written and read back.
_WRITTEN: WeakSet[DataFrame] = WeakSet()
# What was watched while they were written.
_SEEN: WeakKeyDictionary[DataFrame, dict] = WeakKeyDictionary()
# Rows of tables, as far as they are known.
_ROWS: WeakKeyDictionary[DataFrame, int] = WeakKeyDictionary()


def scratch_root(spark: SparkSession) -> str:
    """The application's folder below `spark.checkpoint.dir`; a local session without that setting gets
    a temporary one. It is deleted when the application ends."""
    application = spark.sparkContext.applicationId
    if application not in _ROOTS:
        root, local = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master.startswith("local")
        if not root:
            if not local:
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            root = tempfile.mkdtemp(prefix="touchline-")
        root = f"{root.rstrip('/')}/touchline/{application}"
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if not local and system.getScheme() == "file":
            warnings.warn(f"{root} is a plain folder: every executor must see the same one", stacklevel=2)
        system.mkdirs(path)
        system.deleteOnExit(path)
        _ROOTS[application] = root
    return _ROOTS[application]


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder of the job at hand (of the application, outside a job), not made yet."""
    return f"{_JOB.get() or scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(
    df: DataFrame, name: str, partition_by: str | None = None, watch: dict[str, Column] | None = None
) -> DataFrame:
    """Write a table and read it back: lineage ends here, and a lost executor costs a re-read.

    Parquet rather than a checkpoint, so that later readers scan only the columns (and with
    `partition_by`, the folders) they use. `watch` = {name: aggregate} is taken of the rows while they are
    written, and the rows are counted (with `{}`, no more than that); see `watched` and `rows_of`.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, name)
    seen = Seen(df, watch)
    writer = seen.rows.write.option("compression", "zstd")
    writer = writer.partitionBy(partition_by) if partition_by else writer
    writer.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    _WRITTEN.add(table)
    if watch is not None:
        _SEEN[table] = seen.values()
        with_rows(table, _SEEN[table].get("_rows", 0))
    return table


class Seen:
    """Aggregates of a table, taken by the tasks that write it and merged with their results: no pass
    over the rows of their own. Write `rows`, then ask for `values()`."""

    def __init__(self, df: DataFrame, watch: dict[str, Column] | None):
        self.watch, self.observation = watch, Observation()
        taken = [F.count(F.lit(1)).alias("_rows"), *[value.alias(name) for name, value in (watch or {}).items()]]
        self.rows = df if watch is None else df.observe(self.observation, *taken)

    def values(self) -> dict:
        """{name: value}, and the number of rows as `_rows`."""
        return {} if self.watch is None else self.observation.get


def watched(table: DataFrame) -> dict:
    """What materialize() has watched while it wrote this table."""
    return _SEEN[table]


def with_rows(table: DataFrame, rows: int) -> DataFrame:
    """The table, whose rows are known from now on."""
    _ROWS[table] = rows
    return table


def rows_of(table: DataFrame) -> int:
    """The rows of a table: as counted while it was written, or by a job of its own, once."""
    if table not in _ROWS:
        with_rows(table, table.count())
    return _ROWS[table]


# Plans of these nodes alone cost a scan, so that running them twice is no harm.
_PLAIN_NODES = {"Project", "Filter", "LogicalRelation", "LocalRelation", "Range", "LogicalRDD"}


def settled(df: DataFrame, name: str) -> DataFrame:
    """df, written first unless it is no more than a scan: for work that reads its input more than once."""
    nodes, found = [df._jdf.queryExecution().optimizedPlan()], set()
    while nodes:
        node = nodes.pop()
        found.add(node.nodeName().split(" ")[0])
        children = node.children()
        nodes += [children.apply(at) for at in range(children.size())]
    return df if found <= _PLAIN_NODES else materialize(df, name)


def part_of_written(df: DataFrame) -> DataFrame:
    """df, a selection of a table that materialize() has returned, which then counts as written itself."""
    _WRITTEN.add(df)
    return df


def is_written(df: DataFrame) -> bool:
    """Whether a table is one that materialize() has returned, or a selection of one."""
    return df in _WRITTEN


def delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder that this package has written, wherever it is stored."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch_job(spark: SparkSession) -> Iterator[None]:
    """A folder for all scratch tables of one job, deleted when the job ends, well or badly."""
    folder = f"{scratch_root(spark)}/job-{uuid.uuid4().hex}"
    outer = _JOB.set(folder)
    try:
        yield
    finally:
        _JOB.reset(outer)
        delete(spark, folder)


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application has written so far, before it ends; its DataFrames are void then."""
    delete(spark, scratch_root(spark))
