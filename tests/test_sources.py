"""Files in, files out."""

import json

import pytest
from pyspark.sql import functions as F

from regfacts import fixed
from regfacts.plans import enrich, normalize, silver, validate
from regfacts.sources import readers, writers
from regfacts.streaming import stream_ingest

HEAD9 = ",".join(fixed.BRONZE_COLUMNS)
HEAD13 = ",".join(fixed.BRONZE_WIDE_COLUMNS)
LEI1, LEI2 = "A" * 20, "B" * 20


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw" / "20251231"
    folder.mkdir(parents=True)

    def write(name, text):
        (folder / name).write_text("﻿" + text, encoding="utf-8")

    write(
        "K_01.00_data_points.csv",
        f'{HEAD9}\n{LEI1},Bank A,GR,Mod,10,"Line\nbreak",20,"Say ""x""","1,234"\n'
        f"{LEI1},Bank A2,GR,Mod,10,L,20,C,5\n{LEI1},Bank A2,GR,Mod,10,L,20,C,5\n"
        f"{LEI2},Bank B,ES,Mod,t = x | u = y,L,20,C,7\n{LEI2},,ES,Mod,99,L,20,C,NA\n",
    )
    write(
        "K_02.00_data_points.csv",
        f"{HEAD13}\n{LEI1},Other,GR,Mod,,K_02.00,0010,R,0020,C,,2025-12-31,1\n",
    )
    write("K_03.00_data_points.csv", f"{HEAD9}\n")
    write("K_04.00_data_points.csv", "Foo,Bar\n1,2\n")
    return tmp_path


def test_scan_directory(spark, raw):
    scan = readers.scan_directory(spark, str(raw / "raw"), "20251231")
    rows = scan.points.orderBy("source_file", "line").collect()
    assert [r["FactValue"] for r in rows] == ["1,234", "5", "5", "7", None, "1"]
    assert rows[0]["RowName"] == "Line\nbreak" and rows[0]["ColumnName"] == 'Say "x"'
    assert rows[5]["Template"] == "K_02.00" and rows[5]["Row"] == "0010"
    assert scan.files.count() == 4
    assert [r["source_file"] for r in scan.rejected.collect()] == ["K_04.00_data_points.csv"]
    with pytest.raises(ValueError):
        readers.scan_directory(spark, str(raw / "raw"), fail_fast=True)


def test_validate_counts_empty_and_incomplete_files(spark, raw):
    scan = readers.scan_directory(spark, str(raw / "raw"), required=())
    cells = [("K_01.00", "0010", "0020"), ("K_03.00", "10", "10"), ("K_04.00", "1", "1"),
             ("K_83.01", "1", "1"), ("K_09.00", "1", "1")]
    dictionary = spark.createDataFrame(cells, "template_code string, row_code string, col_code string")
    records, summary = validate.validation_report(scan.points, dictionary, scan.files, broken=["K_83.01"])
    by = {r["template_code"]: r for r in records.collect()}
    first = by["K_01.00"]
    assert (first["rows"], first["facts_mapped"], first["unmapped_facts"]) == (5, 3, 2)
    assert first["duplicate_fact_keys"] == 1 and first["severity"] == "error"
    assert first["notes"] == []
    assert by["K_03.00"]["rows"] == 0 and by["K_03.00"]["severity"] == "ok"
    assert by["K_04.00"]["notes"] == ["missing required columns: ['Column', 'Entity', 'Row']"]
    assert by["K_02.00"]["notes"] == ["template not in dictionary"]
    one = summary.first()
    assert one["missing_downloads"] == ["K_09.00"] and one["extra_downloads"] == ["K_02.00"]
    checked = first["facts_mapped"] + first["unmapped_facts"] + first["malformed_facts"]
    assert checked == first["facts_checked"]


def _dictionary(path):
    head = "template_code,template_name,module_name,section,row_code,row_name,col_code,col_name"
    path.write_text(
        f"{head},unit,dpm_point_id,main_property,dimensions\n"
        "K_01.00,T,M,S,10,R,20,C,EUR,1,p,\nK_01.00,T,M,S,0010,R2,20,C2,EUR,2,p,\n"
        "K_05.00,T5,M,S,OPEN_0007,R,20,C,EUR,3,p,\n",
        encoding="utf-8",
    )
    return str(path)


def _manifest(path):
    path.write_text(json.dumps({"templates": {
        "K_01.00": {"status": "complete", "rows": 4, "template_restart_token": False,
                    "failed_entities": [{"entity": "é"}]},
        "K_83.01": {"status": "skipped", "rows": 0, "reason": "known broken"}}}))
    return str(path)


def test_build_star_twice(spark, raw):
    out = str(raw / "star")
    args = dict(
        raw_root=str(raw / "raw"), out_root=out, folder="20251231",
        dictionary_path=_dictionary(raw / "dict.csv"), manifest_path=_manifest(raw / "m.json"),
    )
    first = silver.build_star(spark, **args).first().asDict()
    second = silver.build_star(spark, **args).first().asDict()
    assert first == second
    assert first["facts"] == 5 and first["distinct_facts"] == 4
    assert first["institutions"] == 2 and first["open_dimensions"] == 2
    assert first["completed_templates"] == 1 and first["skipped_templates"] == 1
    facts = writers.stored(spark, out, "fact")
    names = {r["lei"]: r["entity_name"] for r in writers.stored(spark, out, "dim_institution").collect()}
    assert names == {LEI1: "Bank A2", LEI2: "Bank B"}
    assert spark.table("v_p3dh_K_01_00").count() == 3
    assert spark.table("v_p3dh_K_05_00").count() == 0
    cell = writers.stored(spark, out, "dim_cell").filter("template_code = 'K_01.00'").collect()
    assert [c["row_name"] for c in cell] == ["R2"]
    assert facts.filter("open_key is not null").first()["row_code"] is None


def test_second_date_keeps_the_first(spark, raw):
    later = raw / "raw" / "20260331"
    later.mkdir()
    (later / "K_01.00_data_points.csv").write_text(f"{HEAD9}\n{LEI1},New,GR,M,10,L,20,C,8\n")
    out = str(raw / "star")
    args = dict(raw_root=str(raw / "raw"), out_root=out,
                dictionary_path=_dictionary(raw / "dict.csv"), manifest_path=str(raw / "none.json"))
    silver.build_star(spark, folder="20251231", **args)
    silver.build_star(spark, folder="20260331", **args)
    facts = writers.stored(spark, out, "fact")
    assert facts.count() == 5
    bank = writers.stored(spark, out, "dim_institution").filter(F.col("lei") == LEI1).first()
    assert bank["entity_name"] == "Bank A2"
    assert writers.stored(spark, out, "fact_dimension").count() == 2
    silver.build_star(spark, folder="20260331", replace=True, **args)
    assert writers.stored(spark, out, "fact").count() == 1


def test_normalize_all_and_stream_agree(spark, raw):
    rows = normalize.normalize_all(spark, str(raw / "raw"))
    got = {(r["entity_name"], r["template"], r["fact_value"]) for r in rows.collect()}
    assert got == {("Bank A2", "K_01.00", 5.0), ("Bank B", "K_01.00", 7.0),
                   ("Other", "K_02.00", 1.0)}
    nine = raw / "nine" / "20251231"
    nine.mkdir(parents=True)
    text = (raw / "raw" / "20251231" / "K_01.00_data_points.csv").read_text(encoding="utf-8")
    (nine / "K_01.00_data_points.csv").write_text(text, encoding="utf-8")
    out, state = str(raw / "facts"), str(raw / "state")
    for _ in range(2):
        stream_ingest(spark, str(raw / "nine"), out, state).awaitTermination()
    stored = spark.read.parquet(out).collect()
    assert {(r["entity_name"], r["fact_value"]) for r in stored} == {
        ("Bank A2", 5.0), ("Bank B", 7.0)}
    assert len(stored) == 2


def test_small_readers(spark, tmp_path):
    names = tmp_path / "names.json"
    names.write_text(json.dumps({"date": "31/12/2025", "kind": "templates", "count": 2,
                                 "values": ["b", "a", "b"]}))
    assert [r["name"] for r in readers.read_name_list(spark, str(names)).collect()] == ["a", "b"]
    names.write_text(json.dumps({"values": "x"}))
    assert readers.read_name_list(spark, str(names)).count() == 0
    assert readers.read_manifest(spark, str(tmp_path / "no.json")).count() == 0
    with pytest.raises(FileNotFoundError, match="tr_oth.csv.*tr_mrk.csv"):
        readers.read_named_csvs(spark, str(tmp_path))
    assert readers.expected_files(spark).count() == 12


def test_grid_exports(spark, tmp_path):
    cells = [("w", 0, "A b/c", 1, 0, "N"), ("w", 0, "A b/c", 1, 1, "M"), ("w", 0, "A b/c", 2, 0, "x"),
             ("w", 1, "List of Institutions", 1, 0, "LEI"), ("w", 1, "List of Institutions", 3, 0, "q")]
    grid = spark.createDataFrame(cells, "workbook string, sheet_no int, sheet string, r int, c int, value string")
    written = writers.export_sheets(grid, str(tmp_path))
    assert written["A b/c"].endswith("trex_metadata_A_b-c.csv")
    back = spark.read.option("header", True).csv(written["A b/c"]).collect()
    assert [(r["N"], r["M"]) for r in back] == [("x", None)]
    assert enrich.institution_list(grid).collect()[0]["LEI"] == "q"
