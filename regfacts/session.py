"""Session settings and the shared working folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Defaults for a session made here. A cluster's own settings win where set.
# Generated methods beyond 8000 bytes are never compiled by the JVM and run an
# order of magnitude slower; with this limit Spark splits such steps instead.
TUNING = {"spark.sql.codegen.hugeMethodLimit": "8000"}
DEFAULTS = {
    **TUNING,
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName("regfacts")
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Runtime settings for a session that was made elsewhere."""
    for key, value in TUNING.items():
        spark.conf.set(key, value)
    return spark


#: Partitions that shuffles begin with under adaptive execution; `spread` raises it for large tables.
FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def deal(df: DataFrame, *keys: str) -> DataFrame:
    """Shuffle by `keys` for steps that sort a partition several times at once.

    After a large scan the partitions are as many as its pieces, twice over: adaptive
    execution would join them by the bytes of the shuffle, beyond what a task can sort.
    """
    pieces = df.sparkSession.conf.get(FIRST_PARTITIONS, None)
    return df.repartition(2 * int(pieces), *keys) if pieces else df.repartition(*keys)


#: Bytes of a scan, as the planner estimates them, that one task gets.
SPREAD_BYTES = 1 << 20


def spread(df: DataFrame, bytes_each: int = SPREAD_BYTES) -> DataFrame:
    """Spread a scan over all cores, and over more tasks the larger it is.

    Rows grow on their way, so a task that gets a whole file split would sort and
    group more than it has memory for, and spill. The shuffles behind begin with as
    many partitions; adaptive execution joins those that turn out small. A table of
    enough files is left as it is: no shuffle.
    """
    pieces = _pieces(df, bytes_each)
    return df.repartition(pieces) if len(df.inputFiles()) < pieces else df


def _planned_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _pieces(df: DataFrame, bytes_each: int) -> int:
    """Tasks for a scan; shuffles behind it begin with as many partitions at least."""
    spark = df.sparkSession
    pieces = max(spark.sparkContext.defaultParallelism, -(-_planned_bytes(df) // bytes_each))
    if pieces > int(spark.conf.get(FIRST_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(FIRST_PARTITIONS, str(pieces))
    return pieces


def spread_join(df: DataFrame, other: DataFrame, key: str, other_key: str) -> DataFrame:
    """`spread(df)` joined with `other` on one key.

    Where the planner would not broadcast `other`, rows are spread by the key: the join uses
    that shuffle, and rows do not move a second time.
    """
    on = F.col(key) == F.col(other_key)
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if _planned_bytes(other) <= limit:
        return spread(df).join(other, on)
    pieces = _pieces(df, SPREAD_BYTES)
    return df.repartition(pieces, key).join(other.repartition(pieces, other_key), on)


_LOCAL_FOLDERS: dict[str, str] = {}


def work_folder(spark: SparkSession) -> str:
    """The folder all executors share: the cluster's checkpoint folder.

    Only where none is set and driver and executors are one process (tests, a
    laptop) a temporary one is chosen, once per application. A cluster without
    the setting is an error: its executors would not see each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="regfacts-")
    return _LOCAL_FOLDERS[app]


def settle(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Cuts the lineage where several later branches read the same rows, so that
    they are computed once, and fixes values that a re-run could change. The
    copy is columnar: each branch reads only its own columns.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark)}/settled-{uuid.uuid4().hex}"
    # half the bytes of the default codec where rows hold hashes
    writer = df.write.mode("errorifexists").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Values of a partition column that go into a filter as literals.
PRUNE_VALUES = 10_000


def touched_by(stored: DataFrame, batch: DataFrame, by: str) -> DataFrame:
    """`stored` without partitions of `by` that the batch has no row of.

    The values become literals of the filter, so the scan lists and reads only
    their folders. Beyond PRUNE_VALUES values `stored` is returned as it is:
    callers still join on the key.
    """
    values = [r[0] for r in batch.select(by).distinct().limit(PRUNE_VALUES + 1).collect()]
    if len(values) > PRUNE_VALUES:
        return stored
    hit = F.col(by).isin([v for v in values if v is not None])
    return stored.filter(hit | F.col(by).isNull() if None in values else hit)


#: Bounds of a broadcast side: its rows, and the bytes that `row_bytes` adds up.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20


def row_bytes(df: DataFrame) -> Column:
    """About the bytes that a row of `df` takes in memory: 8 a column, and what texts, lists and maps hold."""
    flat = (T.NumericType, T.BooleanType, T.DatetimeType)
    size = F.lit(8 * len(df.columns)).cast("bigint")
    for field in df.schema:
        if not isinstance(field.dataType, flat):
            held = F.col("`" + field.name.replace("`", "``") + "`")
            held = held if isinstance(field.dataType, T.BinaryType) else held.cast("string")
            size = size + F.coalesce(F.octet_length(held), F.lit(0))
    return size


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only if `df` is within both bounds.

    `df` is written once; rows and bytes are counted on the copy, and the copy is
    what is joined, so the input does not run again. Beyond a bound the copy is
    returned without a hint, and the join is a shuffle join with adaptive skew
    handling.
    """
    copy = settle(df)
    rows, size = copy.agg(F.count("*"), F.sum(row_bytes(copy))).first()
    return F.broadcast(copy) if rows <= max_rows and (size or 0) <= max_bytes else copy
