"""Files of one name in folders of several dates are files of their own; no part of a response is lost."""

import json

from regfacts.operators import responses
from regfacts.plans import normalize

HEAD = "Entity,Country,Module,Cell,Row,RowName,Column,ColumnName,FactValue\n"


def test_fills_do_not_cross_dates(spark, tmp_path):
    for date, bank in (("20250630", "A"), ("20251231", "B")):
        folder = tmp_path / date
        folder.mkdir()
        lei = f"LEI0{bank * 16}"
        lines = [f"{lei},,,mod,10,,10,,1", f"{lei},Bank {bank},Land {bank},mod,20,,10,,2", f"{lei},,,mod,30,,10,,3"]
        (folder / "K_101.00_data_points.csv").write_text(HEAD + "\n".join(lines) + "\n")
    rows = normalize.normalize_all(spark, str(tmp_path)).collect()
    assert len(rows) == 6
    assert {(str(r.reference_date), r.entity_name) for r in rows if r.entity_name} <= {
        ("2025-06-30", "Bank A"), ("2025-12-31", "Bank B")}
    assert {r.template for r in rows} == {"K_101.00"}


def response(parts, depth=1):
    def group(n):
        node = {"G1": f"g{n}", "X": [{"M0": n}]}
        return node if n >= depth else {**node, "M": [{"DM1": [group(n + 1)]}]}

    top = [{"G0": "bank", "M": [{"DM0": [group(1)]}]}]
    data = {"dsr": {"DS": [{"PH": [{"DM0": top} for _ in range(parts)]}]}}
    return json.dumps({"results": [{"result": {"data": data}}]})


def test_every_part_of_a_response_counts(spark):
    df = spark.createDataFrame([(1, response(1)), (2, response(2)), (3, response(1, 3))], "id int, body string")
    read = df.selectExpr("id", "parse_json(body) as response")
    got = responses.flatten_responses(read.withColumnRenamed("id", "response_id")).groupBy("response_id").count()
    assert {r["response_id"]: r["count"] for r in got.collect()} == {1: 1, 2: 2, 3: 3}


def test_groups_of_any_depth_count(spark):
    read = spark.createDataFrame([(1, response(1, 50))], "response_id int, body string").selectExpr(
        "response_id", "parse_json(body) as response")
    got = [r["FactValue"] for r in responses.flatten_responses(read).orderBy("pos").collect()]
    assert got == [f"{n}.0" for n in range(1, 51)]
