"""Scalar functions against hand-made tables of inputs and results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from regfacts import functions as fn


def apply(spark, f, values, type_="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_}")
    return [r[0] for r in rows.orderBy("i").select(f(F.col("v"))).collect()]


def table(cases):
    return [c[0] for c in cases], [c[1] for c in cases]


@pytest.mark.parametrize(
    "f, cases",
    [
        (fn.pystrip, [(" a\t\n", "a"), ("\xa0x\x85", "x"), ("", ""), (None, None), ("a b", "a b")]),
        (fn.clean_text, [("NaN", None), (" ", None), (" a ", "a"), ("nano", "nano"), (None, None)]),
        (
            fn.normalize_code,
            [("10", "0010"), ("10.00", "0010"), ("00010", "0010"), ("nan", None), ("", None),
             ("12345", "12345"), ("r1", "r1"), (" 7 ", "0007"), ("0", "0000"), (None, None)],
        ),
        (
            lambda c: fn.normalize_code(c, "norm"),
            [("10", "0010"), ("10.0", "0010"), ("10.00", "10.00"), ("00010", "00010"),
             ("nan", "nan"), (" ", None)],
        ),
        (
            lambda c: fn.normalize_code(c, "dictionary"),
            [("10.0", "0010"), ("1.5", "0001"), ("x", None), ("-5", "-005"), ("1e2", "0100"),
             (None, None)],
        ),
        (
            fn.numeric_value,
            [("1,234.5", 1234.5), ("1_0", 10.0), ("5D", None), ("abc", None), ("-3", -3.0),
             ("1e3", 1000.0), ("nan", None)],
        ),
        (
            fn.to_number_coerce,
            [("1,000", None), ("1_0", None), (" 12 ", 12.0), ("5D", None), (".5", 0.5)],
        ),
        (fn.safe_int, [("3.0", 0), ("12", 12), (None, 0), ("true", 1), ("x", 0), (" 5 ", 5)]),
        (fn.is_open_key, [("a = b", True), ("a=b", False), ("a | b", True), (None, False)]),
        (
            fn.cell_template,
            [("{K_68.00, r0010, c0020}", "K_68.00"), ("{ K_68.00.a , r1, c1}", "K_68.00.a"),
             ("{K_101.00, r0010, c0010}", "K_101.00"), (None, None)],
        ),
        (lambda c: fn.cell_template(c, wide_codes=False), [("{K_101.00, r0010}", None)]),
        (fn.cell_row, [("{K_68.00, r0010, c0020}", "0010"), ("x", None)]),
        (fn.cell_column, [("{K_68.00, r0010, c0020}", "0020"), ("x", None)]),
        (
            fn.template_from_name,
            [("K_68.00_data_points.csv", "K_68.00"), ("K_101.00_data_points.csv", "K_101.00")],
        ),
        (fn.template_from_file, [("K_101.00_data_points.csv", "K_101.00")]),
        (fn.template_code, [("K_68.00 - Rates - x", "K_68.00")]),
        (fn.code_from_parts, [("K_68.00_data_points.csv", "K_68.00")]),
        (fn.row_label_template, [(" K_30.04 - Pay", "K_30.04"), ("x", None)]),
        (fn.strip_sheet_variant, [("K_74.00.a(0010)", "K_74.00"), ("K_74.00", "K_74.00")]),
        (
            fn.module_from_file,
            [("a_CODISPILLAR3_1.xlsx", "Common disclosures"), ("mica.xlsx", None),
             ("MRELTLACDISPILLAR3", "MREL/TLAC disclosures")],
        ),
        (
            fn.infer_unit,
            [("1_x000D_\n€£$", "EUR"), ("1_x000D_\n%", "PCT"), ("1_x000D_\nx", "TEXT"),
             ("€", "TEXT"), (None, "TEXT")],
        ),
        (fn.dpm_id, [("33411_x000D_\n%", "33411"), ("x_x000D_", None), (None, None)]),
        (fn.clean_label, [("\xa0a\nb ", "a b")]),
        (fn.clean_section, [("0005 Own\nfunds", "Own funds")]),
        (fn.safe_name, [("List of/All", "List_of-All")]),
        (fn.ref_date_from_name, [("20250630_x.xlsx", "2025-06-30"), ("x", None)]),
        (
            fn.ref_date_from_path,
            [("/a/20240101/20251231/K.csv", "2025-12-31"), ("/20240101/20250630_x", "2025-06-30"),
             ("/a/b", None)],
        ),
        (
            fn.to_date_coerce,
            [("2025-12-31 00:00:00", dt.date(2025, 12, 31)), ("x", None),
             ("2025-99-99", None), ("20251231", dt.date(2025, 12, 31))],
        ),
        (fn.epoch_ms_to_date, [("1767139200000", dt.date(2025, 12, 31)), ("x", None)]),
        (fn.date_to_folder, [("31/12/2025", "20251231")]),
        (fn.decimal_suffix, [("5D", "5"), ("abc", "abc")]),
        (fn.canonical_field, [("ENT_NAM", "Entity"), ("Row Label", "RowName"), ("zz", None)]),
    ],
)
def test_text_functions(spark, f, cases):
    values, expected = table(cases)
    assert apply(spark, f, values) == expected


def test_float_text_matches_python(spark):
    values = [100.0, 12345678.9, 1e15, 1e16, 1.5e22, 0.001, 0.00012, 1e-5, -2.5e-7, -98765432.0, 0.0]
    assert apply(spark, fn.float_text, values, "double") == [repr(v) for v in values]


def test_parse_open_key(spark):
    got = apply(spark, fn.parse_open_key, ["a = p=q | b= |x| = y |c=d", None])
    assert [(r["name"], r["value"]) for r in got[0]] == [("a", "p=q"), ("c", "d")]
    assert got[1] is None


def test_fact_id_counts_nulls_as_empty(spark):
    import hashlib

    df = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    got = df.select(fn.fact_id(["x", "y", "z"])).first()[0]
    assert got == hashlib.sha256("a\x1f\x1fc".encode()).hexdigest()


def test_natural_key_names_missing_columns(spark):
    df = spark.createDataFrame([("a",)], "entity_name string")
    with pytest.raises(ValueError, match="template, row"):
        fn.natural_key(df)


def test_view_name():
    assert fn.view_name("K_68.00-a") == "v_p3dh_K_68_00_a"
