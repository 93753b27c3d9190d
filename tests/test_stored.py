"""Reports, published folders, bucketed tables, checked broadcasts, set-aside cells, mixed layouts."""

import json

import pytest
from pyspark.sql import functions as F

from regfacts.operators.project import detect_layout
from regfacts.session import broadcast_if_small, row_bytes
from regfacts.sources import writers
from regfacts.sources.bucketed import entity_salts, publish_buckets
from regfacts.sources.readers import scan_grid


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_a_report_is_one_sorted_document(spark, tmp_path):
    records = spark.createDataFrame([("b", None), ("a", ["x"]), ("b", ["y"])], "template string, notes array<string>")
    summary = records.agg(F.count("*").alias("files"))
    writers.write_report(writers.assemble_report(summary, records, ["template"]), str(tmp_path / "r"))
    lines = [ln for f in (tmp_path / "r").glob("part-*") for ln in f.read_text().splitlines()]
    assert [json.loads(ln) for ln in lines] == [{"summary": {"files": 3}, "records": [
        {"template": "a", "notes": ["x"]}, {"template": "b", "notes": None}, {"template": "b", "notes": ["y"]}]}]
    empty = writers.assemble_report(summary, records.filter("false"), ["template"]).first()
    assert empty.records == [] and empty.summary.files == 3
    with pytest.raises(ValueError, match="one document"):
        writers.assemble_report(summary, records, ["template"], max_bytes=10)


def test_a_failed_write_leaves_the_files_before(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_csv(spark.range(3), path)
    with pytest.raises(Exception, match="broken"):
        writers.write_csv(spark.range(9).select(F.when(F.col("id") > 7, F.raise_error(F.lit("broken"))).otherwise("x")), path)
    assert spark.read.option("header", True).csv(path).count() == 3
    writers.write_csv(spark.range(5), path)
    assert spark.read.option("header", True).csv(path).count() == 5


def test_broadcasts_are_bounded_in_bytes(spark):
    wide = spark.range(10).select("id", F.repeat(F.lit("x"), 1000).alias("text"), F.array(F.lit("y")).alias("list"))
    assert "strategy=broadcast" in plan_of(broadcast_if_small(wide))
    assert "strategy=broadcast" not in plan_of(broadcast_if_small(wide, max_bytes=9000))
    assert wide.agg(F.sum(row_bytes(wide))).first()[0] > 10_000
    assert broadcast_if_small(wide.filter("false")).count() == 0


FACTS = "fact_id string, lei string, value int"


def star(spark, root, name):
    rows = [(f"f{i}", "hot" if i < 40 else None if i < 70 else f"e{i}", i) for i in range(100)]
    facts = spark.createDataFrame(rows, FACTS)
    bridge = spark.createDataFrame([(f"f{i}", "d", str(i)) for i in range(0, 100, 3)], "fact_id string, name string, of string")
    banks = spark.createDataFrame([("hot", "GR"), ("e71", "ES"), ("none", "FR")], "lei string, home string")
    return rows, publish_buckets(facts, bridge, banks, root, name, buckets=8)


def test_bucketed_joins_have_no_exchange(spark, tmp_path):
    rows, stored = star(spark, str(tmp_path / "s"), "star_test")
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for df in (stored.facts_with_entity(), stored.facts_with_dimensions(), stored.facts().groupBy("fact_id").count()):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        got = {r.fact_id: (r.lei, r.home) for r in stored.facts_with_entity().collect()}
        homes = {"hot": "GR", "e71": "ES"}
        assert got == {f: (lei, homes.get(lei)) for f, lei, _ in rows}
        assert stored.facts_with_entity().count() == 100
        assert stored.facts_with_dimensions().agg(F.count("of")).first()[0] == 34
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)
    hot = {r.lei: r.salts for r in entity_salts(stored.facts(), 8).collect()}
    assert hot == {"hot": 4, None: 3}
    largest = stored.table("fact_by_entity").groupBy("lei", "salt").count().agg(F.max("count")).first()[0]
    assert largest < 40


def test_an_empty_star_has_buckets(spark, tmp_path):
    none = spark.createDataFrame([], FACTS)
    stored = publish_buckets(none, none.select("fact_id", F.lit("n").alias("name")), none.select("lei", F.lit("x").alias("home")),
                             str(tmp_path / "s"), "star_empty", buckets=4)
    assert stored.facts_with_entity().count() == 0 and stored.facts_with_dimensions().count() == 0


def test_cells_without_a_place_are_set_aside(spark, tmp_path):
    (tmp_path / "g.csv").write_text("workbook,sheet_no,sheet,r,c,value\nb,0,s,1,2,x\nb,0,s,1.5,2,y\n,0,s,1,2,z\nb,0,,1,2,w\n"
                                    "b,0,s,,2,v\nb,0,s,1,2,\nb,0,s,99999999999,2,u\nb,zero,s,3,4,t\n")
    scan = scan_grid(spark, str(tmp_path), "csv")
    assert [tuple(r) for r in scan.cells.orderBy("r").collect()] == [("b", 0, "s", 1, 2, "x"), ("b", None, "s", 3, 4, "t")]
    assert {(r.value, r.reason) for r in scan.rejected.collect()} == {
        ("y", "no place"), ("z", "no workbook"), ("w", "no sheet"), ("v", "no place"), ("u", "no place")}
    assert all(r.source_path.endswith("g.csv") for r in scan.rejected.collect())
    scan.cells.write.parquet(str(tmp_path / "p"))
    again = scan_grid(spark, str(tmp_path / "p"))
    assert again.cells.count() == 2 and again.rejected.count() == 0 and again.cells.schema == scan.cells.schema


def test_a_layout_counts_all_entities_or_the_first(spark):
    lei = "ABCDEFGHIJ0123456789"
    rows = [("f", i, lei if i < 10 else "Bank") for i in range(25)] + [("none", 0, None)]
    df = spark.createDataFrame(rows, "source_file string, line int, Entity string")
    found = lambda first: {r.source_file: r.layout for r in detect_layout(df, first=first).select("source_file", "layout").distinct().collect()}
    assert found(None) == {"f": "legacy", "none": "legacy"}
    assert found(10) == {"f": "lei", "none": "legacy"}
