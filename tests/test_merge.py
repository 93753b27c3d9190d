"""Merging, coverage and bookkeeping on small frames."""

import pytest
from pyspark.sql import functions as F

from regfacts.operators import aggregates as agg
from regfacts.operators import joins, merge, project
from regfacts.schema import NATURAL_KEY
from regfacts.session import broadcast_if_small


def facts(spark, rows):
    schema = ", ".join(f"{c} string" for c in NATURAL_KEY) + ", n int"
    return spark.createDataFrame([(e, "t", "r", None, None, "2025-12-31", n) for e, n in rows], schema)


def test_incremental_keeps_repeats_of_new_keys(spark):
    new, old = facts(spark, [("a", 1), ("b", 2), ("b", 3)]), facts(spark, [("a", 0)])
    append, skipped = joins.split_incremental(new, old)
    assert sorted(r["n"] for r in append.collect()) == [2, 3]
    assert [r["n"] for r in skipped.collect()] == [1]
    assert joins.split_incremental(new, None)[1].count() == 0
    combined, _, _ = merge.append_incremental(new, old)
    assert combined.count() == 3
    keys, count = merge.skipped_keys(facts(spark, [("a", 1), ("a", 2)]), old)
    assert keys.count() == 1 and count.first()[0] == 2


def test_upserts(spark):
    new = spark.createDataFrame([("k", 1, "x"), ("k", 2, "y"), ("m", 3, "z")], "k string, o int, v string")
    old = spark.createDataFrame([("m", 0, "old"), ("q", 0, "old")], "k string, o int, v string")
    table, counts = merge.upsert_ignore(new, old, ["k"], ["o"])
    assert {(r["k"], r["v"]) for r in table.collect()} == {("k", "x"), ("m", "old"), ("q", "old")}
    assert counts.first().asDict() == {"inserted": 1, "skipped": 2}
    again, counts = merge.upsert_ignore(new, table, ["k"], ["o"])
    assert again.count() == 3 and counts.first()["inserted"] == 0
    replaced = merge.upsert_replace(new, old, ["k"], ["o"])
    assert {(r["k"], r["v"]) for r in replaced.collect()} == {("k", "y"), ("m", "z"), ("q", "old")}


def test_upsert_columns_leaves_the_others(spark):
    old = spark.createDataFrame([("a", 1, True), ("b", 2, False)], "k string, n int, flag boolean")
    new = spark.createDataFrame([("a", 5), ("c", 7)], "k string, n int")
    got = {tuple(r) for r in merge.upsert_columns(new, old, ["k"], ["n"]).collect()}
    assert got == {("a", 5, True), ("b", 2, False), ("c", 7, None)}


def test_coverage_gaps_over_two_codes(spark):
    entities = spark.createDataFrame([("t", "e1"), ("t", "e2")], "template_code string, entity string")
    codes = spark.createDataFrame([("t", "1", "1"), ("t", "1", "2")], "template_code string, row_code string, col string")
    there = spark.createDataFrame([("t", "e1", "1", "1")] * 3, "template_code string, entity string, row_code string, col string")
    got = joins.coverage_gaps(entities, codes, there, code_cols=("row_code", "col"))
    assert {tuple(r)[1:] for r in got.collect()} == {("e1", "1", "2"), ("e2", "1", "1"), ("e2", "1", "2")}


def test_runnable_templates(spark):
    names = spark.createDataFrame([("A - x",), ("B - x",), ("C - x",)], "template string")
    manifest = spark.createDataFrame([("A", "complete"), ("B", "failed")], "template_code string, status string")

    def run(**kw):
        return {r["template_code"] for r in project.runnable_templates(manifest, names, **kw).collect()}

    assert run() == {"A", "B", "C"}
    assert run(resume=True) == {"B", "C"}
    assert run(failed_only=True) == {"B"}


def test_run_status(spark):
    log = [("K_1", None, False, 5), ("K_2", "x", None, None), ("K_2", None, False, 1),
           ("K_3", None, False, 0), ("K_83.01", None, False, 0)]
    df = spark.createDataFrame(log, "template_code string, error string, restart_token boolean, rows int")
    got = {r["template_code"]: r["status"] for r in agg.run_status(df, broken=["K_83.01"]).collect()}
    assert got == {"K_1": "complete", "K_2": "partial", "K_3": "failed", "K_83.01": "skipped"}


def test_broadcast_is_bound(spark):
    def hinted(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    assert hinted(broadcast_if_small(spark.range(10), 10))
    assert not hinted(broadcast_if_small(spark.range(11), 10))


@pytest.mark.parametrize("kind, expected", [("open_key", ["a = b"]), ("column", ["10"])])
def test_distinct_codes(spark, kind, expected):
    df = spark.createDataFrame([("a = b", "10"), ("x", "nan"), ("x", None)], "Row string, Column string")
    assert [r["code"] for r in agg.distinct_codes(df, kind).collect()] == expected


def test_union_and_unmatched(spark):
    a = spark.range(2).select("id", F.lit(None).cast("string").alias("Category"))
    b = spark.range(1).select("id", F.lit("c").alias("Category"), F.lit(1).alias("more"))
    rows = joins.unmatched_union({"a.csv": a, "b.csv": b})
    assert rows.columns == ["source_file", "id", "Category", "more"] and rows.count() == 2
