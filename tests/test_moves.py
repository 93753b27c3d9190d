"""Rows move as seldom, and as narrow, as their step allows."""

from pyspark.sql import functions as F

from regfacts import fixtures as fx
from regfacts import functions as fn
from regfacts.operators import windows
from regfacts.plans import silver
from regfacts.session import settle, spread_join
from regfacts.sources import bucketed, writers
from regfacts.sources.keyed_table import KeyedTable


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _facts(spark, ids):
    rows = [(i, "2025", f"t{n % 3}", f"lei{n}", "x = 1" if n % 2 else None, "f", n) for n, i in enumerate(ids)]
    names = "fact_id string, reference_date string, template_code string, lei string, open_key string, source_file string, line long"
    return spark.createDataFrame(rows, names)


def test_only_facts_of_repeated_ids_are_shuffled(spark):
    once = settle(_facts(spark, [f"i{n}" for n in range(50)]))
    assert "Exchange" not in _plan(silver.distinct_facts(once))
    twice = settle(_facts(spark, [f"i{n % 45}" for n in range(50)] + [None, None]))
    found = {(r.fact_id, r.lei) for r in silver.distinct_facts(twice).collect()}
    assert found == {(f"i{n % 45}", f"lei{n}") for n in range(5, 50)} | {(None, "lei51")}


def test_last_rows_are_the_same_with_and_without_a_filter(spark, monkeypatch):
    rows = [(f"k{n % 700}" if n % 9 else None, n % 2, n) for n in range(3000)]
    df = settle(spark.createDataFrame(rows + [(f"o{n}", 0, n) for n in range(2000)], "k string, j int, n long"))
    expected = sorted(map(tuple, windows.keep_last(df, ["k", "j"], ["n"]).collect()), key=str)
    for bitmaps in (windows.FILTER_BITMAPS, 1, 0):
        monkeypatch.setattr(windows, "FILTER_BITMAPS", bitmaps)
        assert sorted(map(tuple, windows.keep_last_of_few(df, ["k", "j"], ["n"]).collect()), key=str) == expected


def test_packed_texts_come_back_as_they_were(spark):
    texts = ["", None, "\x1f", "\x1b", "\x1bN", "\x1b0\x1f1", "é\x1b1", "plain", "\x1f\x1f", "|"]
    rows = [(a, 1, b, c) for a in texts for b in texts for c in ("k", None)]
    df = spark.createDataFrame(rows, "a string, n int, b string, k string")
    packed = fn.pack_texts(df, ["k"])
    assert len(packed.columns) == 3
    back = fn.unpack_texts(packed.repartition(3, "k"), df)
    assert back.columns == df.columns
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)
    # bytes that are no UTF-8 too
    raw = df.select(F.unhex(F.lit("ff41")).cast("string").alias("a"), F.lit("b").alias("b"))
    assert fn.unpack_texts(fn.pack_texts(raw), raw).select(F.hex(F.col("a").cast("binary"))).first()[0] == "FF41"


def test_wide_rows_are_packed_for_their_shuffles(spark, tmp_path):
    facts = _facts(spark, [f"i{n}" for n in range(9)]).drop("source_file", "line")
    for part, keys in (("by_id", ["fact_id"]), ("by_lei", ["lei"])):
        bucketed.save_buckets(facts, f"moves_{part}", str(tmp_path / part), keys, 2)
        assert sorted(spark.table(f"moves_{part}").select(*facts.columns).collect(), key=str) == sorted(facts.collect(), key=str)
    table = KeyedTable(spark, str(tmp_path / "keyed"), "fact_id", ("reference_date", "template_code"))
    table.merge(facts)
    stored = table.read().select(*[F.col(c).cast("string") for c in facts.columns])
    assert sorted(stored.collect(), key=str) == sorted(facts.collect(), key=str)


def test_facts_of_a_first_load_are_written_once(spark, tmp_path, monkeypatch):
    facts = _facts(spark, [f"i{n}" for n in range(8)]).drop("source_file", "line")
    small = {
        "dim_run": "run_id string", "extraction_manifest": "reference_date string, template_code string",
        "dim_institution": "lei string", "dim_template": "template_code string",
        "dim_cell": "template_code string, row_code string, col_code string"}
    tables = {name: spark.createDataFrame([], schema) for name, schema in small.items()}
    star = writers.Star(**tables, fact=facts, fact_dimension=facts)
    kept, write = [], writers.settle
    monkeypatch.setattr(writers, "settle", lambda df, *by: kept.append(df.columns) or write(df, *by))
    writers.write_star(star, str(tmp_path / "star"))
    assert not [c for c in kept if "fact_id" in c]
    at = str(tmp_path / "star")
    assert sorted(r.fact_id for r in writers.stored(spark, at, "fact").collect()) == [f"i{n}" for n in range(8)]
    bridge = writers.stored(spark, at, "fact_dimension")
    assert sorted((r.fact_id, str(r.reference_date)) for r in bridge.collect()) == [(f"i{n}", "2025") for n in (1, 3, 5, 7)]


def test_a_join_beyond_a_broadcast_moves_rows_once(spark, tmp_path):
    for name, key in (("l", "l_key"), ("p", "p_key")):
        spark.range(1000).toDF(key).write.parquet(str(tmp_path / name))
    rows, other = spark.read.parquet(str(tmp_path / "l")), spark.read.parquet(str(tmp_path / "p"))
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    try:
        assert "BroadcastHashJoin" in _plan(spread_join(rows, other, "l_key", "p_key"))
        spark.conf.set(limit, "1")
        joined = spread_join(rows, other, "l_key", "p_key")
        assert _plan(joined).count("Exchange") == 2 and joined.count() == 1000
    finally:
        spark.conf.set(limit, before)


def test_order_lines_are_the_same_whatever_is_broadcast(spark, tmp_path):
    spark.createDataFrame([(n, n % 7, 1, 1, "N", 1.0, 2.0, 0.1, 0.2, None) for n in range(60)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_shipdate date").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "Bank", 1)], "s_suppkey long, s_name string, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(1, "GR")], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(n, f"B{n}", "T", n) for n in range(6)],
        "p_partkey long, p_brand string, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before, found = spark.conf.get(limit), []
    try:
        for value in (before, "1"):
            spark.conf.set(limit, value)
            found.append(sorted(fx.order_lines(spark, str(tmp_path)).select("l_orderkey", "p_brand").collect()))
    finally:
        spark.conf.set(limit, before)
    assert found[0] == found[1] and len(found[0]) == 52
