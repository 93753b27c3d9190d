"""Numbers in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regfacts.functions.text import ColumnOrName, as_col, clean_text, pystrip

# What counts as a number. Spark alone would also take `5D` or `1f`.
FLOAT_PATTERN = (
    r"(?i)^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?$"
    r"|^[+-]?(inf|infinity)$"
)
NUMBER_PATTERN = r"(?i)^[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?$|^[+-]?(inf|infinity)$"


def numeric_value(c: ColumnOrName, strip: bool = True) -> Column:
    """Silver number: thousands commas and digit underscores are dropped."""
    text = clean_text(c, strip)
    plain = F.when(text.contains(","), pystrip(F.replace(text, F.lit(","), F.lit("")))).otherwise(
        text
    )
    return F.when(plain.rlike(FLOAT_PATTERN), F.translate(plain, "_", "").try_cast("double"))


def to_number_coerce(c: ColumnOrName) -> Column:
    """Number or null, commas and underscores not allowed."""
    text = pystrip(c)
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def decimal_suffix(c: ColumnOrName) -> Column:
    """Response value as text with one trailing decimal mark `D` dropped."""
    return F.regexp_replace(as_col(c), "D$", "")


def safe_int(c: ColumnOrName) -> Column:
    """Whole number or 0; `3.0` is not a whole number here, booleans are 0/1."""
    text = pystrip(as_col(c).cast("string"))
    number = F.when(text.rlike(r"^[+-]?\d+(_\d+)*$"), F.replace(text, F.lit("_"), F.lit("")))
    return (
        F.when(F.lower(text) == "true", F.lit(1))
        .otherwise(F.coalesce(number.try_cast("bigint"), F.lit(0)))
        .cast("bigint")
    )


def float_text(c: ColumnOrName) -> Column:
    """A double written out as CSV files have it: `100.0`, `12345678.9`, `1e+16`.

    Spark writes an exponent from ten million on and below a thousandth; here
    plain digits are used from 0.0001 up to 1e16.
    """
    c = as_col(c)
    text = c.cast("string")
    sign = F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    mantissa = F.ltrim(F.substring_index(text, "E", 1), F.lit("-"))
    exponent = F.substring_index(text, "E", -1).try_cast("int")
    lead = F.substring_index(mantissa, ".", 1)
    rest = F.substring_index(mantissa, ".", -1)
    rest = F.when(rest == "0", F.lit("")).otherwise(rest)
    digits = F.concat(lead, rest)
    padded = F.rpad(digits, F.greatest(F.length(digits), exponent + 1), F.lit("0"))
    tail = padded.substr(exponent + 2, F.length(padded))
    large = F.concat(
        sign, padded.substr(F.lit(1), exponent + 1), F.lit("."),
        F.when(tail == "", F.lit("0")).otherwise(tail),
    )
    small = F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits)
    far = F.concat(
        sign, lead, F.when(rest == "", F.lit("")).otherwise(F.concat(F.lit("."), rest)),
        F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+")),
        F.lpad(F.abs(exponent).cast("string"), F.greatest(
            F.lit(2), F.length(F.abs(exponent).cast("string"))), F.lit("0")),
    )
    return (
        F.when(c.isNull() | F.isnan(c), F.lit(None).cast("string"))
        .when(text == "Infinity", F.lit("inf"))
        .when(text == "-Infinity", F.lit("-inf"))
        .when(~text.contains("E"), text)
        .when(exponent.between(0, 15), large)
        .when(exponent.between(-4, -1), small)
        .otherwise(far)
    )
