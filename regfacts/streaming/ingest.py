"""Points files that land in a folder -> canonical rows, each key once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from regfacts import fixed
from regfacts.functions import natural_key
from regfacts.operators.merge import new_rows
from regfacts.plans.normalize import normalize_points
from regfacts.session import settle, touched_by
from regfacts.sources.readers import bronze
from regfacts.sources.records import columns_of, file_splits, numbered, records


def append_new(
    batch: DataFrame, out_dir: str, key: Sequence[str], order: Sequence[str]
) -> None:
    """Append the rows of a batch whose key is not stored; first one wins.

    Running a batch again adds nothing, so a batch that is repeated after a lost
    driver is harmless. Only the stored partitions of the batch's dates are read,
    and only their keys.
    """
    spark = batch.sparkSession
    batch = settle(batch)
    existing = None
    if _has_rows(spark, out_dir):
        dates = batch.select("reference_date").distinct()
        stored = touched_by(spark.read.schema(batch.schema).parquet(out_dir), dates, "reference_date")
        existing = stored.join(
            dates,
            stored["reference_date"].eqNullSafe(dates["reference_date"]),
            "left_semi",
        )
    fresh = new_rows(batch, existing, key, order)
    fresh.hint("rebalance", "reference_date").write.mode("append").partitionBy(
        "reference_date"
    ).parquet(out_dir)


def _has_rows(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


def stream_append(
    stream: DataFrame,
    out_dir: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame],
    order: Sequence[str],
) -> StreamingQuery:
    """Work off a stream in micro-batches: prepare the rows, append those with a new key.

    `prepare` gives canonical rows plus the columns of `order`.
    """

    def load(batch: DataFrame, _: int) -> None:
        rows = prepare(batch)
        append_new(rows.select(natural_key(rows).alias("fact_key"), "*"), out_dir,
                   ["fact_key"], order)

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_ingest(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    columns: Sequence[str] = fixed.BRONZE_COLUMNS,
    normalize: Callable[[DataFrame], DataFrame] = normalize_points,
) -> StreamingQuery:
    """Normalize all points files that have landed since the last run and append them.

    Fills depend on the order inside a file only, and a file is never split over
    two batches. Stops when the folder is worked off.
    """
    files = (
        spark.readStream.option("lineSep", "\n")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{fixed.POINTS_SUFFIX}")
        .text(in_dir)
        .select("value", "_metadata")
    )

    def prepare(batch: DataFrame) -> DataFrame:
        # written first: line numbers must not change between the reads of a batch
        lines = settle(numbered(batch))
        splits = file_splits(lines)
        return normalize(settle(bronze(columns_of(records(lines, splits), columns), columns)))

    return stream_append(files, out_dir, checkpoint, prepare, ["source_file", "line"])
