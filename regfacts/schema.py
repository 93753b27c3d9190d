"""Schemas of the three layers: bronze points, canonical rows, silver star."""

from pyspark.sql import types as T

from regfacts import fixed


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


BRONZE = strings(*fixed.BRONZE_COLUMNS)
BRONZE_WIDE = strings(*fixed.BRONZE_WIDE_COLUMNS)

CANONICAL_COLUMNS = (
    "entity_name", "country", "module_name", "cell", "open_key", "template", "row", "row_name",
    "column", "column_name", "sheet", "reference_date", "fact_value",
)
NATURAL_KEY = ("entity_name", "template", "row", "column", "cell", "reference_date")

SILVER_FACT_COLUMNS = (
    "fact_id", "reference_date", "template_code", "lei", "entity_name", "country", "module_name",
    "cell", "row_code", "row_label", "row_raw", "open_key", "column_code", "column_label",
    "fact_value_raw", "fact_value_num", "source_file", "run_id",
)
# parts of the fact id, in hashing order
FACT_ID_PARTS = (
    "reference_date", "template_code", "lei", "module_name", "cell", "row_code", "row_label",
    "row_raw", "open_key", "column_code", "column_label", "fact_value_raw",
)

# one row per non-blank worksheet cell; sheet_no is the position inside the workbook
GRID = T.StructType(
    [
        T.StructField("workbook", T.StringType()),
        T.StructField("sheet_no", T.IntegerType()),
        T.StructField("sheet", T.StringType()),
        T.StructField("r", T.IntegerType()),
        T.StructField("c", T.IntegerType()),
        T.StructField("value", T.StringType()),
    ]
)

DICTIONARY_COLUMNS = (
    "template_code", "template_name", "module_name", "section", "row_code", "row_name",
    "col_code", "col_name", "unit", "dpm_point_id", "main_property", "dimensions",
)
DICTIONARY = strings(*DICTIONARY_COLUMNS)
TEMPLATE_SUMMARY_COLUMNS = (
    "template_code", "template_name", "module_name", "cells", "rows", "columns", "dpm_points",
)
TEMPLATE_SUMMARY = strings(*TEMPLATE_SUMMARY_COLUMNS)

# numbers arrive as text or JSON numbers, so they are read as text and cast later
MANIFEST_RECORD = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("rows", T.StringType()),
        T.StructField("template_restart_token", T.StringType()),
        T.StructField("entity_restart_token_count", T.StringType()),
        T.StructField("row_partition_restart_token_count", T.StringType()),
        T.StructField("failed_entities", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("updated_at", T.StringType()),
    ]
)
MANIFEST = T.StructType(
    [T.StructField("templates", T.MapType(T.StringType(), MANIFEST_RECORD))]
)
NAME_LIST = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("count", T.LongType()),
        T.StructField("updated_at", T.StringType()),
        T.StructField("values", T.StringType()),
    ]
)
