"""Template, row and column codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regfacts import fixed
from regfacts.functions.numbers import FLOAT_PATTERN
from regfacts.functions.text import ColumnOrName, as_col, pystrip


def _extract(c: ColumnOrName, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(as_col(c), pattern, 1), F.lit(""))


def cell_template(c: ColumnOrName, wide_codes: bool = True) -> Column:
    """Template part of `{K_68.00, r0010, c0020}`.

    Two or three digits before the dot; without `wide_codes` three give null.
    """
    return _extract(
        c, fixed.CELL_TEMPLATE_PATTERN_WIDE if wide_codes else fixed.CELL_TEMPLATE_PATTERN
    )


def cell_row(c: ColumnOrName) -> Column:
    return _extract(c, fixed.CELL_ROW_PATTERN)


def cell_column(c: ColumnOrName) -> Column:
    return _extract(c, fixed.CELL_COLUMN_PATTERN)


def template_from_name(c: ColumnOrName, wide_codes: bool = True) -> Column:
    """Strict template code of a points file name; null if it does not fit."""
    return _extract(
        c, fixed.FILE_TEMPLATE_PATTERN_WIDE if wide_codes else fixed.FILE_TEMPLATE_PATTERN
    )


def template_from_file(c: ColumnOrName) -> Column:
    """Loose template code of a points file name: the name without its suffix."""
    return F.replace(as_col(c), F.lit(fixed.POINTS_SUFFIX), F.lit(""))


def template_code(c: ColumnOrName) -> Column:
    """Code of a full template name such as `K_68.00 - Interest rate risk`."""
    return pystrip(F.substring_index(as_col(c), " - ", 1))


def code_from_parts(c: ColumnOrName) -> Column:
    """First two `_` parts of a file name."""
    return F.substring_index(as_col(c), "_", 2)


def row_label_template(c: ColumnOrName) -> Column:
    """Template code at the start of a row label."""
    return _extract(pystrip(c), fixed.LABEL_TEMPLATE_PATTERN)


def strip_sheet_variant(c: ColumnOrName) -> Column:
    """`K_74.00.a(0010)` -> `K_74.00`."""
    return F.regexp_replace(as_col(c), r"\.[a-z](\(\d{4}\))?$", "")


def module_from_file(c: ColumnOrName) -> Column:
    """Module of a layout workbook, by the first fragment its name contains."""
    c = as_col(c)
    return F.coalesce(
        *[F.when(c.contains(key), F.lit(module)) for key, module in fixed.MODULES.items()]
    )


def _pad4(digits: Column) -> Column:
    # never shorter than the digits themselves: lpad would cut longer codes
    return F.lpad(digits, F.greatest(F.lit(4), F.length(digits)), F.lit("0"))


def normalize_code(c: ColumnOrName, variant: str = "silver", strip: bool = True) -> Column:
    """A code as four digits, in one of three variants; see `clean_text` for `strip`.

    - ``silver``: digits with an optional `.0…` are re-padded to four digits;
      `nan` and blank are null; other text stays.
    - ``norm``: digits with an optional `.0` are padded but not shortened;
      blank is null; other text, even `nan`, stays.
    - ``dictionary``: any number, cut to its whole part; other text is null.
    """
    text = pystrip(c) if strip else as_col(c)
    if variant == "silver":
        digits = F.ltrim(F.substring_index(text, ".", 1), F.lit("0"))
        return (
            F.when(text.rlike(r"^\d{4}$"), text)
            .when(text.rlike(r"^\d+(\.0+)?$"), _pad4(digits))
            .when(~F.lower(text).isin("", "nan"), text)
        )
    if variant == "norm":
        return F.when(text.rlike(r"^\d+(\.0)?$"), _pad4(F.substring_index(text, ".", 1))).when(
            text != "", text
        )
    if variant == "dictionary":
        number = F.when(
            text.rlike(FLOAT_PATTERN), F.replace(text, F.lit("_"), F.lit("")).try_cast("double")
        )
        whole = F.when(F.abs(number) < 1e15, number.cast("bigint"))
        size = F.abs(whole).cast("string")
        return F.when(whole >= 0, _pad4(size)).otherwise(
            F.concat(F.lit("-"), F.lpad(size, F.greatest(F.lit(3), F.length(size)), F.lit("0")))
        )
    raise ValueError(f"unknown code variant: {variant}")


def synthetic_cell(template: ColumnOrName, row: ColumnOrName, column: ColumnOrName) -> Column:
    """`{T, rR, cC}`; null unless all three parts are there."""
    return F.concat(
        F.lit("{"), as_col(template), F.lit(", r"), as_col(row), F.lit(", c"), as_col(column),
        F.lit("}"),
    )
