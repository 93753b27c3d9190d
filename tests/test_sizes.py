"""What keeps tasks, shuffles and the driver within bounds as tables grow."""

from pyspark.sql import functions as F

from regfacts import fixtures as fx
from regfacts import queries as catalog
from regfacts import functions as fn
from regfacts.operators import merge, responses, windows
from regfacts.plans import dictionary as layouts
from regfacts.plans import validate
from regfacts.session import deal, spread
from regfacts.sources import bucketed


def test_a_large_scan_is_spread_by_its_bytes(spark, tmp_path):
    path, begin = str(tmp_path / "t"), "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = spark.conf.get(begin, None)
    spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h")).coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    size = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    try:
        assert spread(df, size // 40).rdd.getNumPartitions() >= 40
        assert int(spark.conf.get(begin, None) or spark.conf.get("spark.sql.shuffle.partitions")) >= 40
        # and a step that sorts its partitions several times has twice as many, which are not joined
        assert deal(spark.range(9).toDF("id"), "id").rdd.getNumPartitions() >= 80
        # small ones go over the cores, as before
        assert spread(df, 10 * size).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    finally:
        spark.conf.unset(begin) if before is None else spark.conf.set(begin, before)


def test_ids_as_bytes_come_back_as_they_were(spark):
    texts = ["a" * 64, "0123456789abcdef" * 4, "0123456789ABCDEF" * 4, "x" * 64, "", "é", "a" * 63, "a" * 64 + "-2", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", fn.packed_id("t").alias("b"))
    rows = df.select("t", fn.plain_id("b").alias("back"), F.octet_length("b").alias("n")).collect()
    assert [r.back for r in rows] == texts
    assert [r.n for r in rows][:3] == [33, 33, 65]
    assert df.select("b").distinct().count() == len(texts)


def test_buckets_grow_with_the_facts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bucketed, "BUCKET_ROWS", 10)
    facts = spark.range(100).select(F.concat(F.lit("f"), "id").alias("fact_id"), F.lit("e").alias("lei"))
    banks = spark.createDataFrame([("e", "GR")], "lei string, home string")
    made = lambda f: f.select("fact_id", F.lit("d").alias("name"))
    stored = bucketed.publish_buckets(facts, made, banks, str(tmp_path / "s"), "star_grown", buckets=2)
    assert len(stored.facts().inputFiles()) == 10
    assert stored.facts_with_dimensions().filter("name = 'd'").count() == 100
    assert stored.facts_with_entity().filter("home = 'GR'").count() == 100


def test_a_fact_keeps_its_date_beside_its_dimensions_without_a_join(spark):
    facts = spark.createDataFrame([("a", "x = 1 | y = 2", "2025"), ("b", None, "2025")], "fact_id string, open_key string, d string")
    bridge = merge.explode_dimensions(facts, "d")
    assert "Join" not in bridge._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in bridge.collect()) == [("a", "x", "1", "2025"), ("a", "y", "2", "2025")]


def test_the_points_are_read_once_for_records_and_summary(spark):
    names = "source_file string, Entity string, Module string, Cell string, Row string, Column string, FactValue string"
    points = spark.createDataFrame([("K_01.00_data_points.csv", "e", "m", "c", "10", "20", "1")], names)
    dictionary = spark.createDataFrame([("K_01.00", "10", "20")], "template_code string, row_code string, col_code string")
    records, summary = validate.validation_report(points, dictionary)
    assert len(records.inputFiles()) > 0
    assert summary.first()["total_rows"] == records.first()["rows"] == 1


def test_csv_files_of_a_table_in_one_file_are_several(spark, tmp_path):
    rows = [(i, i, "FOP"[i % 3], 1.5 * i, "1-URGENT") for i in range(300)]
    names = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"
    spark.createDataFrame(rows, names).coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    root = fx.points_folder(spark, str(tmp_path))
    assert len(spark.read.text(f"{root}/F").inputFiles()) > 1
    assert catalog.scan_quoted_files(spark, str(tmp_path)).count() == 300


def _customers(spark, tmp_path, n=40):
    rows = [(i, f"c{i}", 0, float(i), "BUILDING" if i % 2 else "OTHER") for i in range(n)]
    names = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    spark.createDataFrame(rows, names).coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    return str(tmp_path)


def test_deep_responses_of_one_file_are_several_tasks(spark, tmp_path):
    made = fx.deep_responses(spark, _customers(spark, tmp_path))
    assert made.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_walked_groups_do_not_hold_the_groups_below(spark, tmp_path):
    assert "item" not in responses.NODES
    rows = catalog.flatten_any_data_sets(spark, _customers(spark, tmp_path)).collect()
    assert len(rows) == 20 * 3 + 20 * 2
    assert {r["pos"] for r in rows} == {0, 1, 2}


def test_flatten_any_sends_no_rows_to_the_driver(spark, tmp_path):
    rows = [(i, i, "FOP"[i % 3], 1.5 * i, "1-URGENT") for i in range(30)]
    names = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"
    spark.createDataFrame(rows, names).write.parquet(str(tmp_path / "orders.parquet"))
    df = catalog.flatten_any(spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan
    assert df.count() == 10 * 2 + 10 + 10 * 2


def _points_tables(spark, folder, lines):
    """The tables behind the points: one supplier, one nation, parts of sizes 1, 10 and 45."""
    row = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, " \
          "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_shipdate date"
    tables = {
        "lineitem": ([(o, p, 1, n, 1.0, 20.0, 0.05, 0.02, flag, None) for o, p, n, flag in lines], row),
        "supplier": ([(1, "Bank", 1)], "s_suppkey long, s_name string, s_nationkey int"),
        "nation": ([(1, "GR")], "n_nationkey int, n_name string"),
        "region": ([(0, "R")], "r_regionkey int, r_name string"),
        "part": ([(1, "B", "T", 1), (2, "B", "T", 10), (3, "B", "T", 45), (4, "B", "T", None)],
                 "p_partkey long, p_brand string, p_type string, p_size int"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_the_dictionary_lists_the_measures_of_distinct_lines_only(spark, tmp_path, monkeypatch):
    sf = _points_tables(spark, tmp_path, [(o, p, n, "N") for o in range(3) for p in (1, 2, 3, 4) for n in (1, 5)])
    seen = []
    monkeypatch.setattr(fx, "settle", lambda df: seen.append(df) or df)
    cells = {(r.template_code, r.row_code, r.col_code) for r in fx.cell_dictionary(spark, sf).collect()}
    codes = ("10", "20.0", "0030", "40")
    assert cells == {("K_60.00", "10", "10"), *[("K_101.00", "10", c) for c in codes], *[("K_45.00", "OPEN_0007", c) for c in codes]}
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    # the measures are unnested above an aggregate of the lines
    assert "Aggregate" in plan[plan.index("Generate"):]


def test_the_summary_builds_the_dictionary_once(spark, tmp_path, monkeypatch):
    sf = _points_tables(spark, tmp_path, [(1, 1, 1, "N"), (1, 1, 1, "N"), (2, 2, 5, "R")])
    made, plain = [], fx.cell_dictionary
    monkeypatch.setattr(fx, "cell_dictionary", lambda *a: made.append(a) or plain(*a))
    row = catalog.validation_summary(spark, sf).first()
    assert len(made) == 1
    assert (row.files, row.total_rows, row.total_duplicate_fact_keys, row.errors) == (2, 12, 4, 1)


def test_codes_are_normalized_per_text_and_file_not_per_point(spark):
    names = "source_file string, Entity string, Module string, Cell string, Row string, Column string, FactValue string"
    file = "K_01.00_data_points.csv"
    points = spark.createDataFrame(
        [(file, "e", "m", "c", r, "20", v) for r in ("10", " 10 ", "10.0", None, "") for v in ("1", "2", "2")], names)
    known = spark.createDataFrame([("K_01.00", "10", "20")], "template_code string, row_code string, col_code string")
    records = validate.validate(points, known)
    row = records.first()
    assert (row.rows, row.facts_mapped, row.malformed_facts, row.duplicate_fact_keys) == (15, 9, 6, 7)
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    # the points are counted below the patterns
    assert "Aggregate [" in plan[plan.rindex("RLIKE"):]


GRID = "workbook string, sheet_no int, sheet string, r int, c int, value string"


def _sheet(name, cells):
    return [("x_CODISPILLAR3_y.xlsx", 0, name, r, c, v) for r, c, v in cells]


def test_the_header_is_found_without_sorting_the_cells(spark):
    body = [(r, c, "x") for r in range(6, 12) for c in (4, 5)]
    grid = spark.createDataFrame([
        # two titles: the upper one counts; label and number meet in row 7: data start below the label
        *_sheet("a", [(2, 0, "low"), (0, 0, " "), (1, 0, " top "), (5, 3, "0010"), (6, 9, "(q)"), (7, 1, "Rows"), (7, 2, "1"), *body]),
        # no code in the usual rows: the row with the most, the upper of equals; a number before any label
        *_sheet("b", [(20, 3, "0010"), (30, 3, "0010"), (30, 4, "0020"), (40, 3, "0010"), (40, 4, "0020"), (33, 2, "7"), (35, 1, "Rows")]),
        # neither label nor number nor title
        *_sheet("c", [(3, 3, "0010"), (9, 4, None), (None, 7, "0010"), (4, None, "0010")]),
    ], GRID)
    found = {r.sheet: (r.n_rows, r.template_name, r.codes_row, r.data_start, r.prop_col) for r in windows.locate_header(grid).collect()}
    assert found == {"a": (12, "top", 5, 8, 9), "b": (41, "b", 30, 33, 8), "c": (10, "c", 3, 4, 8)}
    assert windows.locate_header(grid).schema["data_start"].dataType.simpleString() == "int"
    plan = windows._sheets_with_header(grid)._jdf.queryExecution().executedPlan().toString()
    lowest = [line for line in plan.splitlines() if "Aggregate(" in line][-1]
    assert "HashAggregate" in lowest


def test_a_dictionary_reads_its_cells_once(spark, monkeypatch):
    cells = [(4, 3, "Amount"), (5, 3, "0010"), (7, 1, "Rows"), (8, 1, "one"), (8, 2, "10"), (8, 3, "4 EUR"), (9, 5, "x")]
    grid = spark.createDataFrame(_sheet("K_01.00.a", cells), GRID)
    settled, plain = [], layouts.settle
    monkeypatch.setattr(layouts, "settle", lambda df: settled.append(df.columns) or plain(df))
    made = layouts.build_dictionary(grid)
    assert settled[0] == [*grid.columns, "module_name"]
    assert [(r.row_code, r.col_code) for r in made.collect()] == [("0010", "0010")]
    assert "ExistingRDD" not in made._jdf.queryExecution().optimizedPlan().toString()
