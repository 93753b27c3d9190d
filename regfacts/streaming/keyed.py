"""Incremental loading with the stored keys in Spark's streaming state store.

A micro-batch is prepared, cut to the first row of each key and landed; a second,
stateful stream takes the landed rows and keeps those whose key its state has not
seen. The stored table is never read: a batch costs its own rows and look-ups in the
state, which lies in RocksDB on the executors and is checkpointed by its changes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from regfacts.functions import natural_key
from regfacts.operators.windows import keep_first

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def unique_stream(spark: SparkSession, landed: str, rows: T.StructType, out_dir: str, checkpoint: str,
                  key: str = "fact_key", horizon: str | None = None) -> StreamingQuery:
    """Append landed rows whose key is new; stops when the folder is worked off.

    Without a `horizon` a key is held for good. With one (such as '400 days') keys whose
    `reference_date` lies that far behind the newest are dropped from the state; a
    row that late may then come in twice, which is what bounds the state.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    stream = spark.readStream.schema(rows).option("recursiveFileLookup", True).parquet(landed)
    if horizon is None:
        unique = stream.dropDuplicates([key])
    else:
        timed = stream.withColumn("_time", F.col("reference_date").cast("timestamp"))
        unique = timed.withWatermark("_time", horizon).dropDuplicatesWithinWatermark([key]).drop("_time")
    return (
        unique.writeStream.format("parquet").partitionBy("reference_date").outputMode("append")
        .option("path", out_dir).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_append_keyed(
    stream: DataFrame,
    out_dir: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame],
    order: Sequence[str],
    horizon: str | None = None,
) -> StreamingQuery:
    """Work off a stream in micro-batches; of equal keys the row of the earliest batch stays, once.

    `prepare` gives canonical rows plus the columns of `order`, which decides inside a
    batch. A batch that is run again after a crash lands again and is dropped by the
    state. The number of state partitions is that of the first start.
    """
    landed = f"{checkpoint}/landed"

    def load(batch: DataFrame, number: int) -> None:
        rows = prepare(batch)
        first = keep_first(rows.select(natural_key(rows).alias("fact_key"), "*"), ["fact_key"], order)
        first.write.mode("overwrite").parquet(f"{landed}/batch-{number}")
        # one landed batch a run: an earlier batch is in the state before a later one is read
        unique_stream(batch.sparkSession, landed, first.schema, out_dir, f"{checkpoint}/keys", horizon=horizon).awaitTermination()

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", f"{checkpoint}/read")
        .trigger(availableNow=True)
        .start()
    )
