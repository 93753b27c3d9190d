"""Hand-written responses of all shapes."""

import json

import pytest
from pyspark.sql import functions as F

from regfacts.functions import has_restart_token, response_messages
from regfacts.operators import responses as R


def doc(dsr, descriptor=None):
    data = {"dsr": dsr, **({"descriptor": descriptor} if descriptor else {})}
    return json.dumps({"results": [{"result": {"data": data}}]})


def deep(levels):
    node = {"G5": "deep", "X": [{"M0": "1"}]}
    for _ in range(levels - 1):
        node = {"M": [{"DM2": [node]}]}
    return {"DS": [{"PH": [{"DM0": [{"G0": "E", "M": [{"DM1": [node]}]}]}]}]}


STANDARD = doc({"DS": [{
    "ValueDicts": {"D0": ["Greece", "Spain"], "D1": ["Rates"], "D7": ["0010", "0020"]},
    "PH": [{"DM0": [
        {"G0": "Bank A", "G1": 1, "X": [{"M0": "9"}], "M": [{"DM1": [
            {"G1": 0, "G2": 0, "M": [{"DM2": [
                {"G3": "{K}", "M": [{"DM3": [
                    {"G7": 0, "X": [{"M0": "12345678.9D"}, {"Q": 1}]},
                    {"G7": 9, "X": [{"M0": "abcD"}, {"M0": None}]},
                ]}]},
                {"X": [{"M0": 7}]},
            ]}]},
        ]}]},
        {"G0": "Bank B"},
    ]}],
}]})
RICHER = doc(
    {"DS": [{
        "RT": [["x"]], "Msg": [{"Message": "slow"}, {"Code": 1}],
        "ValueDicts": {"D0": ["L1"], "D1": ["T1", "T2"]},
        "SH": [{"DM0": [{"S": [{"N": "G4", "DN": "D1"}], "G4": 1}]}],
        "PH": [{"DM1": [{"S": [{"N": "G0", "DN": "D0"}], "G0": 0, "G9": 1767139200000, "M": [{"DM2": [
            {"G3": "{c1}", "X": [{"M0": "5D"}]}, {"G3": " ", "X": [{"M0": "6"}]},
            {"G3": "{c2}", "G4": 0, "X": [{"M0": "x"}]}]}]}]}],
    }]},
    {"Select": [{"Value": "G0", "Name": "d1.ENT_NAM"}, {"Value": "M0", "Name": "v"},
                {"Value": "G3", "NativeReferenceName": "CellCode", "Name": "z"},
                {"Value": "G4", "Name": "q.Template"}, {"Value": "G9", "Name": "ReferenceDate"}]},
)
TABLES = doc({"DataShapes": [{"Tables": [{
    "Columns": [{"DisplayName": "Entity"}, {"Name": "FactValue"}, {}],
    "Rows": [["a", 1, "z"], ["b"], "no row"]}]}]})


@pytest.fixture(scope="module")
def landed(spark):
    docs = [("1", STANDARD), ("2", RICHER), ("3", TABLES), ("4", "{bad"), ("5", doc(deep(15))),
            ("6", doc(deep(40))), ("7", doc({"DS": [{"RT": []}]}))]
    return spark.createDataFrame(docs, "response_id string, text string").select(
        "response_id", F.try_parse_json("text").alias("response"))


def test_standard_shape(landed):
    rows = R.flatten_responses(landed).orderBy("response_id", "pos").collect()
    got = [(r["Country"], r["Module"], r["Cell"], r["Column"], r["FactValue"])
           for r in rows if r["response_id"] == "1"]
    # the top level gives the entity only; an index beyond its dictionary stays
    assert got == [
        ("Greece", "Rates", "{K}", "0010", "12345678.9"), ("Greece", "Rates", "{K}", "9", "abc"),
        ("Greece", "Rates", "{K}", "9", None), ("Greece", "Rates", "", "", "7.0")]
    # facts on deep levels count as well
    assert [r["response_id"] for r in rows if r["Row"] == "deep"] == ["5", "6"]


def test_richer_shape(landed):
    rows = R.flatten_partitioned(landed.filter("response_id = '2'")).orderBy("pos").collect()
    assert [(r["Entity"], r["Cell"], r["Template"], r["FactValue"]) for r in rows] == [
        ("L1", "{c1}", "T2", "5.0"), ("L1", "{c2}", "T1", "x")]
    assert rows[0]["ReferenceDate"] == "2025-12-31"


def test_tables_shape(landed):
    rows = R.flatten_tables(landed).orderBy("pos").collect()
    assert [r["fields"] for r in rows] == [
        {"Entity": "a", "FactValue": "1", "col2": "z"}, {"Entity": "b"}]


def test_any_shape(landed):
    counts = {r["response_id"]: r["count"] for r in
              R.flatten_any(landed).groupBy("response_id").count().collect()}
    assert counts == {"1": 4, "2": 2, "3": 2, "5": 1, "6": 1}


def test_tokens_and_messages(landed):
    rows = {r[0]: r for r in landed.select(
        "response_id", has_restart_token("response"), response_messages("response")).collect()}
    assert [k for k, r in rows.items() if r[1]] == ["2"]
    assert rows["2"][2] == ["slow", '{"Code":1}']
