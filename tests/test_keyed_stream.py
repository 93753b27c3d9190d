"""Keys in the state store: later batches, restarts, repeated batches and a bounded state."""

import datetime

from regfacts.streaming import stream_append_keyed, unique_stream

ROWS = ("entity_name string, template string, row string, column string, cell string, reference_date date, "
        "fact_value double, seq long")
DAY = datetime.date(2025, 12, 31)


def rows(*values, day=DAY):
    return [(e, "T", "1", None, None, day, v, n) for n, (e, v) in enumerate(values)]


def test_batches_restart_and_the_stored_table_is_not_read(spark, tmp_path):
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))

    def run():
        stream = spark.readStream.schema(ROWS).option("recursiveFileLookup", True).parquet(source)
        stream_append_keyed(stream, out, state, lambda batch: batch, ["seq"]).awaitTermination()
        return sorted((r["entity_name"], r["fact_value"]) for r in spark.read.parquet(out).collect())

    def land(n, *values):
        spark.createDataFrame(rows(*values), ROWS).write.parquet(f"{source}/{n}")

    land(0, ("a", 1.0), ("a", 2.0), ("b", 3.0))
    assert run() == [("a", 1.0), ("b", 3.0)]
    land(1, ("a", 9.0), ("c", 4.0), ("c", 5.0))
    assert run() == [("a", 1.0), ("b", 3.0), ("c", 4.0)]
    assert run() == [("a", 1.0), ("b", 3.0), ("c", 4.0)]  # nothing new
    # a landed batch that is written again under other file names adds nothing
    landed = spark.read.parquet(f"{state}/landed/batch-1")
    landed.write.parquet(f"{state}/landed/again")
    unique_stream(spark, f"{state}/landed", landed.schema, out, f"{state}/keys").awaitTermination()
    assert spark.read.parquet(out).count() == 3


def test_a_horizon_drops_old_keys_from_the_state(spark, tmp_path):
    landed, out, state = (str(tmp_path / x) for x in ("landed", "out", "state"))
    schema = "fact_key string, reference_date date"
    for n, (key, day) in enumerate([("k1", DAY), ("k2", DAY + datetime.timedelta(days=900)), ("k2", DAY + datetime.timedelta(days=900))]):
        spark.createDataFrame([(key, day)], schema).write.parquet(f"{landed}/{n}")
        frame = spark.read.parquet(f"{landed}/{n}")
        query = unique_stream(spark, landed, frame.schema, out, state, horizon="400 days")
        query.awaitTermination()
    held = query.lastProgress["stateOperators"][0]["numRowsTotal"]
    assert spark.read.parquet(out).count() == 2 and held == 1
