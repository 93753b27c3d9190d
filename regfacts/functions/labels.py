"""Labels and names of layouts, sheets and views."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regfacts import fixed
from regfacts.functions.text import ColumnOrName, as_col, pystrip


def infer_unit(c: ColumnOrName) -> Column:
    """EUR, PCT or TEXT from the mark behind the first line break of a cell."""
    c = as_col(c)
    at = F.locate(fixed.CELL_BREAK, c)
    mark = F.substr(c, at + len(fixed.CELL_BREAK))
    return (
        F.when(F.coalesce(at, F.lit(0)) == 0, F.lit("TEXT"))
        .when(mark.contains("€") | mark.contains("$"), F.lit("EUR"))
        .when(mark.contains("%"), F.lit("PCT"))
        .otherwise(F.lit("TEXT"))
    )


def dpm_id(c: ColumnOrName) -> Column:
    """Leading number of a layout cell, or null."""
    return F.nullif(F.regexp_extract(as_col(c), rf"^(\d+){fixed.CELL_BREAK}", 1), F.lit(""))


def clean_label(c: ColumnOrName) -> Column:
    """Hard spaces and line breaks become spaces; ends stripped."""
    return pystrip(F.translate(as_col(c), "\xa0\n", "  "))


def clean_section(c: ColumnOrName) -> Column:
    """Section title without its leading four-digit code."""
    return pystrip(F.translate(F.regexp_replace(as_col(c), r"^\d{4}\s+", ""), "\n", " "))


def safe_name(c: ColumnOrName) -> Column:
    """Sheet name as a file name."""
    return F.translate(as_col(c), " /", "_-")


def view_name(code: str, prefix: str = fixed.VIEW_PREFIX) -> str:
    """View name of a template code."""
    return prefix + code.replace(".", "_").replace("-", "_")
