"""Scalar helpers on query responses (variant values)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regfacts import fixed
from regfacts.functions.text import ColumnOrName, as_col

DATA = "$.results[0].result.data"


def is_number(v: ColumnOrName) -> Column:
    """True where a variant holds a number."""
    return F.coalesce(
        F.schema_of_variant(as_col(v)).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), F.lit(False)
    )


def truthy(v: ColumnOrName) -> Column:
    """False for missing, null, false, zero and anything empty."""
    text = F.to_json(as_col(v))
    return F.coalesce(
        ~text.isin("null", "false", '""', "[]", "{}")
        & ~(text.rlike(r"^-?[0-9]") & (text.try_cast("double") == 0)),
        F.lit(False),
    )


def canonical_field(c: ColumnOrName) -> Column:
    """Bronze column for a response column name; null if unknown."""
    key = F.replace(F.lower(as_col(c)), F.lit("_"), F.lit(" "))
    pairs = [F.lit(x) for item in fixed.RESPONSE_FIELDS.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


def data_sets(v: ColumnOrName) -> Column:
    return F.try_variant_get(as_col(v), f"{DATA}.dsr.DS", "array<variant>")


def has_restart_token(v: ColumnOrName) -> Column:
    """True if any data set says that the answer was cut off."""
    return F.coalesce(
        F.exists(data_sets(v), lambda d: truthy(F.try_variant_get(d, "$.RT", "variant"))),
        F.lit(False),
    )


def response_messages(v: ColumnOrName) -> Column:
    """Messages of all data sets: their text, or the whole object."""
    messages = F.flatten(
        F.transform(
            data_sets(v),
            lambda d: F.coalesce(
                F.try_variant_get(d, "$.Msg", "array<variant>"), F.array().cast("array<variant>")
            ),
        )
    )
    return F.transform(
        messages, lambda m: F.coalesce(F.try_variant_get(m, "$.Message", "string"), F.to_json(m))
    )


def decode_index(dictionary: ColumnOrName, v: ColumnOrName) -> Column:
    """A number indexes the dictionary; text, or an index beyond it, stays.

    `dictionary` is an array<string> or null, `v` a variant; the result is text.
    """
    dictionary, v = as_col(dictionary), as_col(v)
    index = F.try_variant_get(v, "$", "double").try_cast("int")
    text = F.try_variant_get(v, "$", "string")
    inside = is_number(v) & (index >= 0) & (index < F.size(dictionary))
    return F.when(inside, F.get(dictionary, index)).otherwise(text)
