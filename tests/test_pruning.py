"""Merges read only the partitions they touch; sheets are read by their own headers."""

import pytest
from pyspark.sql import functions as F

from regfacts.operators import joins, project
from regfacts.session import touched_by
from regfacts.streaming import ingest


def test_stored_partitions_are_pruned_by_literals(spark, tmp_path):
    rows = spark.sql("select * from values (1, 'a'), (2, 'b'), (3, cast(null as string)) as t(id, reference_date)")
    rows.write.partitionBy("reference_date").parquet(str(tmp_path / "t"))
    stored = spark.read.schema(rows.schema).parquet(str(tmp_path / "t"))
    some = touched_by(stored, rows.filter("id < 2"), "reference_date")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(reference_date" in plan and "= a)" in plan
    assert [r.id for r in some.collect()] == [1]
    assert {r.id for r in touched_by(stored, rows.filter("id > 1"), "reference_date").collect()} == {2, 3}
    assert touched_by(stored, rows.filter("id > 3"), "reference_date").count() == 0


def test_batches_are_appended_once(spark, tmp_path):
    out = str(tmp_path / "out")
    schema = "k string, reference_date string, n int"
    first = spark.createDataFrame([("a25", "2025", 1), ("b", None, 2)], schema)
    again = spark.createDataFrame([("a25", "2025", 3), ("b", None, 4), ("a26", "2026", 5)], schema)
    for batch in (first, again, again):
        ingest.append_new(batch, out, ["k"], ["n"])
    got = spark.read.schema(schema).parquet(out)
    assert {(r.k, r.reference_date, r.n) for r in got.collect()} == {("a25", "2025", 1), ("b", None, 2), ("a26", "2026", 5)}
    assert got.count() == 3


def test_an_unreadable_store_is_an_error(spark, tmp_path):
    (tmp_path / "out").mkdir()
    (tmp_path / "out" / "part-0.parquet").write_bytes(b"this is no table")
    batch = spark.createDataFrame([("a", "2025", 1)], "k string, reference_date string, n int")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        ingest.append_new(batch, str(tmp_path / "out"), ["k"], ["n"])


def test_sheets_are_read_by_their_own_headers(spark):
    cells = {"w1": ["LEI", "Name", "", "Name"], "w2": ["Name", "LEI"]}
    below = {"w1": ["L1", "N1", "x", "N2"], "w2": ["N3", "L3"]}
    rows = [(w, "s", r, c, v) for r, of in ((1, cells), (2, below)) for w, vs in of.items() for c, v in enumerate(vs)]
    grid = spark.createDataFrame(rows, "workbook string, sheet string, r int, c int, value string")
    got = project.promote_header(grid, 1)
    assert got.columns == ["workbook", "sheet", "r", "LEI", "Name", "Unnamed: 2", "Name.1"]
    assert {tuple(r)[0:1] + tuple(r)[3:] for r in got.collect()} == {
        ("w1", "L1", "N1", "x", "N2"), ("w2", "L3", "N3", None, None)}


def test_unexpected_codes_are_no_gaps(spark):
    entities = spark.createDataFrame([("t", "e")], "template_code string, entity string")
    codes = spark.createDataFrame([("t", "1"), ("t", None)], "template_code string, row_code string")
    there = spark.createDataFrame([("t", "e", "9"), ("t", "e", None)], "template_code string, entity string, row_code string")
    assert [r.row_code for r in joins.coverage_gaps(entities, codes, there).collect()] == ["1"]
    # expectations may be derived from the same facts
    same = there.filter(F.col("row_code").isNotNull())
    assert joins.coverage_gaps(entities, same.select("template_code", "row_code"), same).count() == 0
