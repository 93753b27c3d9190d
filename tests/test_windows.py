"""Fills against brute force, with chunks of every size."""

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from regfacts.operators import windows
from regfacts.operators.windows import Fill

ROW = st.tuples(
    st.sampled_from(["f1", "f2"]), st.sampled_from(["a", "b", None]),
    st.sampled_from([None, None, "x", "y"]), st.sampled_from([None, None, "p"]),
)


def brute(rows, back):
    pdf = pd.DataFrame(rows, columns=["f", "k", "v", "w"]).astype(object)
    out = {}
    for f in {r[0] for r in rows}:
        index = [i for i, r in enumerate(rows) if r[0] == f]
        forward, seen, last_w = {}, {}, None
        for i in index:
            key = rows[i][1]
            seen[key] = rows[i][2] if rows[i][2] is not None else seen.get(key)
            last_w = rows[i][3] if rows[i][3] is not None else last_w
            forward[i] = seen[key]
            out[i] = [seen[key], last_w]
        if back:
            for i in index:
                if forward[i] is None:
                    later = [
                        forward[j] for j in index
                        if j > i and forward[j] is not None
                        and (back == "part" or rows[j][1] == rows[i][1])
                    ]
                    out[i][0] = later[0] if later else None
    assert len(pdf) == len(out)
    return [tuple(out[i]) for i in range(len(rows))]


@pytest.mark.parametrize("back", [None, "part", "group"])
@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(ROW, min_size=1, max_size=40), size=st.sampled_from([1, 3, 100]))
def test_fill_equals_brute_force(spark, rows, size, back):
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], "line int, f string, k string, v string, w string"
    ).withColumn("chunk", F.floor(F.col("line") / size))
    filled = windows.fill_all(df, [Fill(["v"], ["k"], back), Fill(["w"])], ["f"])
    got = [(r["v"], r["w"]) for r in filled.orderBy("line").collect()]
    assert got == brute(rows, back)


def test_backward_fill_crosses_groups(spark):
    df = spark.createDataFrame(
        [(0, "f", "a", None), (1, "f", "a", None), (2, "f", "b", None), (3, "f", "b", "z")],
        "line int, f string, k string, v string",
    ).withColumn("chunk", F.lit(0))
    over_part = windows.ffill_then_bfill(df, ["v"], ["f"], ["k"]).orderBy("line").collect()
    in_group = windows.ffill_then_bfill(df, ["v"], ["f"], ["k"], "group").orderBy("line").collect()
    assert [r["v"] for r in over_part] == ["z"] * 4
    assert [r["v"] for r in in_group] == [None, None, "z", "z"]


def test_chunk_by_range_follows_the_order(spark):
    df = spark.range(1000).select(F.lit("f").alias("f"), F.col("id").alias("line"))
    spans = (
        windows.chunk_by_range(df, ["f"], ["line"], 5).groupBy("chunk")
        .agg(F.min("line").alias("a"), F.max("line").alias("b")).orderBy("chunk").collect()
    )
    assert len(spans) > 1
    assert all(x["b"] < y["a"] for x, y in zip(spans, spans[1:]))


def test_first_and_last_wins(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), (None, 1, "c")],
                               "k string, n int, v string")
    assert {r["v"] for r in windows.keep_first(df, ["k"], ["n"]).collect()} == {"a", "c"}
    assert {r["v"] for r in windows.keep_last(df, ["k"], ["n"]).collect()} == {"b", "c"}


def test_rank_is_limited_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("k"), "id")
    plan = windows.keep_first(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
