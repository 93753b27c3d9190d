"""A hand-made layout sheet, with sections, open rows and odd headers."""

from regfacts.operators.windows import locate_header
from regfacts.plans.dictionary import build_dictionary
from regfacts.schema import GRID

BOOK = "a_CODISPILLAR3.xlsx"


def grid(spark, cells, sheet="K_74.00.a", no=0, book=BOOK):
    return spark.createDataFrame([(book, no, sheet, r, c, v) for r, c, v in cells], GRID)


CELLS = [
    (1, 0, " Title "), (4, 3, "Amount"), (4, 4, "(x) p"), (5, 3, "0010"), (5, 4, " 0020 "),
    (6, 9, "(m) head"), (7, 1, "Rows"),
    (8, 1, "0005 Own\nfunds"),
    (9, 1, "Row\xa0one"), (9, 2, "10.0"), (9, 3, "11_x000D_\n€"), (9, 9, "(m) Main"),
    (9, 10, "d1"), (9, 12, "d2"),
    (10, 1, "skipped"), (10, 3, "data without a code"),
    (11, 1, "Open rows"), (11, 3, "12_x000D_\n%"), (11, 9, "(m) Own"),
    (12, 1, "Main Property"), (12, 3, " (m) Below "),
]


def test_locate_header(spark):
    row = locate_header(grid(spark, CELLS)).first()
    assert (row["codes_row"], row["data_start"], row["prop_col"]) == (5, 8, 9)
    assert row["template_name"] == "Title"
    assert locate_header(grid(spark, [(0, 0, "x"), (1, 3, "0010")])).count() == 0


def test_build_dictionary(spark):
    again = grid(spark, CELLS, "K_74.00.b(0010)", 1)
    other = grid(spark, CELLS, book="mica.xlsx")
    contents = grid(spark, CELLS, "TOC", 2)
    cells = grid(spark, CELLS).union(again).union(other).union(contents)
    rows = [r.asDict() for r in build_dictionary(cells).collect()]
    assert [(r["row_code"], r["col_code"]) for r in rows] == [
        ("0010", "0010"), ("0010", "0020"), ("OPEN_0011", "0010"), ("OPEN_0011", "0020")]
    first, second, opened, _ = rows
    assert first["template_code"] == "K_74.00" and first["module_name"] == "Common disclosures"
    assert first["section"] == "Own funds" and first["row_name"] == "Row one"
    assert (first["col_name"], first["unit"], first["dpm_point_id"]) == ("Amount", "EUR", "11")
    assert (first["main_property"], first["dimensions"]) == ("(m) Main", "d1 | d2")
    assert (second["col_name"], second["unit"], second["dpm_point_id"]) == ("0020", "TEXT", None)
    assert opened["main_property"] == "(m) Below" and opened["unit"] == "PCT"
    assert rows[3]["main_property"] == "(m) Own"
