"""Shared helpers: written intermediates, deterministic words, files on shared storage.

Text conventions of all operators here: a null text is an empty text; words are
the runs of characters other than space and \\x09-\\x0D, which is what
`bytes.split()` gives on UTF-8.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regfacts.session import work_folder


class Workspace:
    """Written intermediates of one operator run in the shared folder.

    Every table is written once and read back, so that a lost executor costs a
    re-read and each branch reads only its own columns. `drop` removes tables
    that no later step reads.
    """

    def __init__(self, spark: SparkSession, name: str, batch_rows: int | None = None, drop_shuffles: bool = False):
        """`batch_rows`: rows that a worker gets at once while a table is written; by default the session's.

        `drop_shuffles`: Spark removes a write's shuffle files when it ends, not when the driver collects garbage.
        """
        self.spark, self.batch_rows, self.drop_shuffles = spark, batch_rows, drop_shuffles
        # Spark takes a plain path to be on the default file system: tasks must open it there too
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}")
        self.root = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
        rows, settings = batch_rows or self.batch_rows, {}
        if rows:
            settings["spark__sql__execution__arrow__maxRecordsPerBatch"] = str(rows)
        if self.drop_shuffles:
            settings["spark__sql__classic__shuffleDependency__fileCleanup__enabled"] = "true"
        with conf(self.spark, **settings):
            df.write.mode("errorifexists").option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a qualified path and the path on it; a plain path is local."""
    if "://" not in path and not path.startswith("file:"):
        return pafs.LocalFileSystem(), path
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(path)


def utf8(column: pa.Array) -> list[bytes]:
    """A text column as bytes; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that a step holds few texts at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def batches_of(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes sum to `limit` or little more."""
    start = total = 0
    for i, n in enumerate(sizes):
        total += n
        if total >= limit:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def runs(*keys: np.ndarray) -> np.ndarray:
    """Start positions of the runs of equal keys in sorted columns, and the length at the end."""
    n = len(keys[0])
    if not n:
        return np.zeros(1, np.int64)
    change = np.zeros(n, bool)
    change[0] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    return np.append(np.flatnonzero(change), n)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], limit: int) -> Iterator[pa.Table]:
    """Tables of whole key groups from batches sorted by the keys, each of `limit` rows or little more.

    The caller bounds a group, so a table is bounded too, whatever the size of a batch.
    """
    held: list[pa.RecordBatch] = []
    rows = 0

    def split(last: bool) -> tuple[pa.Table | None, list[pa.RecordBatch]]:
        table = pa.Table.from_batches(held).combine_chunks()
        if last:
            return table, []
        change = np.zeros(table.num_rows, bool)
        for k in keys:
            v = table.column(k).to_numpy()
            change[1:] |= v[1:] != v[:-1]
        cut = np.flatnonzero(change)
        if not len(cut):
            return None, table.to_batches()
        return table.slice(0, cut[-1]), table.slice(cut[-1]).combine_chunks().to_batches()

    goal = limit
    for batch in slices(batches, limit):
        held.append(batch)
        rows += batch.num_rows
        if rows >= goal:
            table, held = split(False)
            rows = sum(b.num_rows for b in held)
            goal = max(limit, 2 * rows)
            if table is not None:
                yield table
    if rows:
        yield split(True)[0]


def table_rows(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def one_row_an_id(docs: DataFrame) -> DataFrame:
    """Of the rows of one doc_id that with the text of smallest hash; a hot id sends a row a task."""
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")
    return docs.withColumn("__nth", F.row_number().over(first)).where("__nth = 1").drop("__nth")


def spread(df: DataFrame) -> DataFrame:
    """Let a table of a few large row groups be read by all cores.

    Only for tables with fewer scan tasks than cores; their rows are dealt once.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


#: Files that one task takes, and tasks at most.
FILES_A_TASK, MOST_TASKS = 4, 100_000


def dealt_files(files: DataFrame, *keys: str) -> DataFrame:
    """Rows that name files, or ranges of them, dealt by their count.

    A row is small, its work is not: left to itself, adaptive execution merges
    all rows into one task. The number of tasks is explicit, which it keeps.
    """
    tasks = -(-files.count() // FILES_A_TASK)
    cores = files.sparkSession.sparkContext.defaultParallelism
    return files.repartition(min(MOST_TASKS, max(tasks, cores)), *keys)


def arrow_schema(ddl_type: str) -> pa.DataType:
    return {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
            "boolean": pa.bool_(), "binary": pa.binary()}[ddl_type]


def record_batch(ddl: str, columns: list) -> pa.RecordBatch:
    """A batch with the names and types of a DDL string such as 'a long, b string'."""
    names, types = zip(*(part.split() for part in ddl.split(",")), strict=True)
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, arrow_schema(t)) for c, t in zip(columns, types, strict=True)],
        names=list(names))


@contextlib.contextmanager
def conf(spark: SparkSession, **values: str):
    """Set session settings for a block and put the old ones back."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def null_safe(column: str) -> F.Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
