"""Layout workbooks -> cell dictionary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regfacts import fixed
from regfacts.functions import (
    clean_label, clean_section, dpm_id, infer_unit, module_from_file, normalize_code, pystrip,
    strip_sheet_variant,
)
from regfacts.operators.aggregates import sort_dictionary
from regfacts.operators.joins import cells_from_grid
from regfacts.operators.project import row_cells
from regfacts.operators.windows import (
    carry_section, keep_first, locate_header, next_row_property,
)
from regfacts.schema import DICTIONARY_COLUMNS
from regfacts.session import broadcast_if_small, settle

SHEET = ["workbook", "sheet"]
OPEN_ROWS = "open rows"
MAIN_PROPERTY = "Main Property"


def coded_columns(grid: DataFrame, headers: DataFrame) -> DataFrame:
    """Columns with a four-digit code in the header row, named by the row above.

    A blank name, or one that looks like a property, gives way to the code.
    """
    text = pystrip("value")
    near = grid.join(headers, SHEET).filter(
        F.col("r").between(F.col("codes_row") - 1, F.col("codes_row"))
    )
    is_code = F.col("r") == F.col("codes_row")
    columns = near.groupBy(*SHEET, "c").agg(
        F.max(F.when(is_code, text)).alias("col_code"),
        F.max(F.when(~is_code, text)).alias("col_name"),
    )
    name = F.col("col_name")
    return columns.filter(F.col("col_code").rlike(r"^\d{4}$")).withColumn(
        "col_name",
        F.when(name.isNull() | (name == "") | name.startswith("("), F.col("col_code")).otherwise(
            name
        ),
    )


def labelled_rows(grid: DataFrame, headers: DataFrame, columns: DataFrame) -> DataFrame:
    """Data rows with their code, label, section and cells.

    A label without a code and without data in the coded columns opens a section;
    `Open rows` with data get a code made from their position.
    """
    codes = columns.groupBy(*SHEET).agg(F.collect_set("c").alias("coded_c"))
    rows = (
        row_cells(grid)
        .join(headers, SHEET)
        .join(broadcast_if_small(codes), SHEET)
        .filter(F.col("r") >= F.col("data_start"))
    )
    label = pystrip(F.col("cells")[1])
    has_data = F.exists("coded_c", lambda c: F.map_contains_key(F.col("cells"), c))
    rows = rows.select(
        *SHEET,
        "r",
        "cells",
        "template_name",
        "prop_col",
        label.alias("label"),
        normalize_code(F.col("cells")[2], "dictionary").alias("number_code"),
        has_data.alias("has_data"),
    ).filter((F.col("label") != "") & (F.col("label") != "nan"))
    is_open = F.col("has_data") & (F.lower("label") == OPEN_ROWS)
    rows = rows.withColumns(
        {
            "row_code": F.coalesce(
                "number_code",
                F.when(
                    is_open,
                    F.concat(
                        F.lit(fixed.OPEN_ROW_PREFIX),
                        F.lpad(
                            F.col("r").cast("string"),
                            F.greatest(F.lit(4), F.length(F.col("r").cast("string"))),
                            F.lit("0"),
                        ),
                    ),
                ),
            ),
            "section": F.when(
                F.col("number_code").isNull() & ~F.col("has_data"), clean_section("label")
            ),
        }
    )
    return carry_section(rows).filter(F.col("row_code").isNotNull())


def build_dictionary(grid: DataFrame) -> DataFrame:
    """The sorted 12-column dictionary of all layout workbooks.

    Of repeated cells (sub-sheets of one template) the first one stays, in order
    of workbook, sheet, row and column.
    """
    grid = grid.filter(F.col("value").isNotNull() & (F.col("sheet") != fixed.CONTENTS_SHEET))
    workbook = F.element_at(F.split("workbook", "/"), -1)
    grid = grid.withColumn("module_name", module_from_file(workbook)).filter(
        F.col("module_name").isNotNull()
    )
    # eight steps read the cells: written once, a sheet's rows side by side
    grid = settle(grid)
    # both are one small record per sheet or coded column; without a broadcast a
    # large sheet would meet its header in one task
    headers = broadcast_if_small(settle(locate_header(grid)))
    columns = settle(coded_columns(grid, headers))
    rows = labelled_rows(grid, headers, columns)
    sheets = broadcast_if_small(
        grid.groupBy(*SHEET).agg(
            F.min("module_name").alias("module_name"), F.min("sheet_no").alias("sheet_no")
        )
    )
    named = grid.filter((F.col("c") == 1) & (pystrip("value") == MAIN_PROPERTY)).select(*SHEET, "r")
    properties = grid.join(named, [*SHEET, "r"], "left_semi")
    cells = next_row_property(cells_from_grid(rows, columns), properties).join(sheets, SHEET)

    behind = F.filter(
        F.transform(
            F.array_sort(F.map_entries(F.col("cells"))),
            lambda e: F.struct(e["key"].alias("c"), pystrip(e["value"]).alias("text")),
        ),
        lambda e: (e["c"] > F.col("prop_col")) & (e["text"] != "") & (e["text"] != "nan"),
    )
    own = F.coalesce(pystrip(F.try_element_at("cells", F.col("prop_col"))), F.lit(""))
    found = cells.select(
        strip_sheet_variant("sheet").alias("template_code"),
        "template_name",
        "module_name",
        "section",
        "row_code",
        clean_label("label").alias("row_name"),
        "col_code",
        "col_name",
        infer_unit("cell").alias("unit"),
        dpm_id("cell").alias("dpm_point_id"),
        F.when(
            (F.lower("label") == OPEN_ROWS) & F.col("next_property").isNotNull(),
            pystrip("next_property"),
        )
        .otherwise(own)
        .alias("main_property"),
        F.array_join(behind["text"], " | ").alias("dimensions"),
        F.struct("workbook", "sheet_no", "sheet", "r", "c").alias("place"),
    )
    key = ["template_code", "row_code", "col_code", "module_name"]
    return sort_dictionary(keep_first(found, key, ["place"]).select(*DICTIONARY_COLUMNS))
