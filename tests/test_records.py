"""CSV records over file splits: quoted line breaks, headers, files that are set aside."""

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from regfacts import fixed
from regfacts.sources import readers
from regfacts.sources.records import columns_of, file_splits, read_lines, records


@pytest.fixture
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(n) for n in names]

    def use(size):
        for n in names:
            spark.conf.set(n, str(size))

    yield use
    for n, v in zip(names, old):
        spark.conf.set(n, v)


def csv_text(rows, names, end="\n"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator=end)
    writer.writerows([names, *rows])
    return out.getvalue()


def test_eight_splits_of_one_file_with_quoted_breaks(spark, tmp_path, small_splits):
    rng = random.Random(1)
    odd = ["a\nb", 'say "x"', "\n\n", '"', "plain", ",", "", "é\n" * 40, 'x"\n"y']
    rows = [[str(i), rng.choice(odd), rng.choice(odd)] for i in range(400)]
    text = csv_text(rows, ["id", "u", "v"]).encode()
    (tmp_path / "f.csv").write_bytes(text)
    small_splits(len(text) // 8 + 1)
    lines = read_lines(spark, str(tmp_path / "f.csv"))
    assert lines.rdd.getNumPartitions() == 8
    splits = file_splits(lines)
    assert splits.count() == 8 and splits.filter("inside").count() > 0
    got = columns_of(records(lines, splits), ["id", "u", "v"]).orderBy("line").collect()
    # an empty value is null, as in any CSV read by Spark
    assert [[r["id"], r["u"] or "", r["v"] or ""] for r in got] == rows
    assert len({r["chunk"] for r in got}) > 4 and all(r["chunk"] == r["line"]["block"] for r in got)


def test_a_record_longer_than_splits(spark, tmp_path, small_splits):
    rows = [["1", "x\n" * 3000], ["2", "y"], ["3", "\n" * 500 + '"'], ["4", "z"]]
    (tmp_path / "f.csv").write_bytes(csv_text(rows, ["id", "u"]).encode())
    small_splits(1000)
    lines = read_lines(spark, str(tmp_path / "f.csv"))
    got = columns_of(records(lines, file_splits(lines)), ["id", "u"]).orderBy("line").collect()
    assert [[r["id"], r["u"]] for r in got] == rows


def test_carriage_returns_blank_lines_and_byte_order_mark(spark, tmp_path):
    text = "﻿" + csv_text([["1", "a\r\nb"], ["2", "c"]], ["id", "u"], "\r\n") + "\r\n  \n3,d"
    (tmp_path / "f.csv").write_text(text, encoding="utf-8", newline="")
    lines = read_lines(spark, str(tmp_path / "f.csv"))
    got = columns_of(records(lines, file_splits(lines)), ["id", "u", "absent"]).orderBy("line").collect()
    assert [(r["id"], r["u"].replace("\r", ""), r["absent"]) for r in got] == [("1", "a\nb", None), ("2", "c", None), ("3", "d", None)]


def test_shapes_and_rejected_files(spark, tmp_path):
    names = list(fixed.BRONZE_COLUMNS)
    (tmp_path / "a_data_points.csv").write_text(csv_text([["1"] * 9], names))
    (tmp_path / "b_data_points.csv").write_text(csv_text([["2"] * 10], [*reversed(names), "Extra"]))
    (tmp_path / "c_data_points.csv").write_text(csv_text([["3"] * 9], names) + '"open\n')
    (tmp_path / "d_data_points.csv").write_text(csv_text([["4"]], ["Foo"]))
    (tmp_path / "e_data_points.csv").write_text('"a\nb",c\n1,2\n')
    (tmp_path / "f_data_points.csv").write_text("")
    scan = readers.scan_directory(spark, str(tmp_path))
    assert sorted((r["Entity"], r["Extra"]) for r in scan.points.collect()) == [("1", None), ("2", "2")]
    reasons = {r["source_file"][0]: r["reason"] for r in scan.rejected.collect()}
    assert reasons["c"] == "a quote is not closed" and reasons["e"] == "line break in the header"
    assert reasons["d"].startswith("missing columns: ['Cell', ") and set(reasons) == {"c", "d", "e"}
    with pytest.raises(ValueError, match="another header"):
        readers.read_points(spark, [str(tmp_path / "a_data_points.csv"), str(tmp_path / "d_data_points.csv")])


def test_plain_files_are_not_shuffled_beyond_the_split_table(spark, tmp_path):
    names = list(fixed.BRONZE_COLUMNS)
    for i in range(3):
        (tmp_path / f"{i}_data_points.csv").write_text(csv_text([[str(i)] * 9] * 50, names))
    points = readers.scan_directory(spark, str(tmp_path)).points
    assert points.count() == 150
    plan = points._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "BroadcastHashJoin" in plan and points.filter(F.col("Entity") == "1").count() == 50
