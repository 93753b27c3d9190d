"""Validation against the cell dictionary, and completeness of a download."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regfacts import fixed
from regfacts.functions import normalize_code, template_from_file
from regfacts.operators.aggregates import (
    cell_match_counts, distinct_points, open_templates, severity, validation_summary,
)
from regfacts.operators.joins import compare_inventories, dictionary_cells, map_to_dictionary
from regfacts.session import broadcast_if_small, settle

REQUIRED = ("Entity", "Row", "Column")
RECORD = (
    "template_code", "rows", "template_in_dictionary", "facts_checked", "facts_mapped",
    "unmapped_facts", "malformed_facts", "duplicate_fact_keys", "is_open_template", "severity",
    "notes",
)


def validate(
    points: DataFrame,
    dictionary: DataFrame,
    files: DataFrame | None = None,
    required: Sequence[str] = REQUIRED,
) -> DataFrame:
    """One validation record per points file; a file is its path, where points and files have one.

    `files` (with `source_file` and `columns`) adds files without rows and tells
    which columns a file has; without it all files are taken as complete.

    The points are shuffled once, to their distinct keys. Everything after that
    works on those counts: codes as they are written per file, then cells, then the
    dictionary, then the file. Codes are normalized once per text and file, not once per point.
    """
    keys = ["source_file"]
    if "source_path" in points.columns and (files is None or "source_path" in files.columns):
        keys = ["source_path", "source_file"]
    copies = distinct_points(points, keys)
    cells = copies.groupBy(*keys, "Row", "Column").agg(
        F.sum("copies").alias("n"), F.sum(F.col("copies") - 1).alias("repeats")
    ).select(
        *keys,
        normalize_code("Row").alias("row_code"),
        normalize_code("Column").alias("column_code"),
        "n",
        "repeats",
        template_from_file("source_file").alias("template_code"),
    )
    matched = map_to_dictionary(cells, dictionary_cells(dictionary))
    counts = cell_match_counts(matched, keys)
    if files is None:
        records = counts.withColumn("missing_columns", F.array().cast("array<string>"))
    else:
        lacking = F.array_except(F.array(*[F.lit(c) for c in sorted(required)]), "columns")
        listed = files.select(*keys, lacking.alias("missing_columns"))
        records = listed.join(counts, keys, "left").fillna(
            0,
            subset=["facts_checked", "facts_mapped", "unmapped_facts", "malformed_facts",
                    "duplicate_fact_keys"],
        )
    records = records.withColumns(
        {"template_code": template_from_file("source_file"), "rows": F.col("facts_checked")}
    )
    # one row per template of the dictionary tells both: known, and open
    opened = open_templates(dictionary).withColumnRenamed("is_open_row", "is_open_template")
    records = records.join(broadcast_if_small(opened), "template_code", "left").withColumns(
        {
            "template_in_dictionary": F.col("is_open_template").isNotNull(),
            "is_open_template": F.coalesce("is_open_template", F.lit(False)),
        }
    )
    return severity(records).select(*RECORD)


def validation_report(
    points: DataFrame,
    dictionary: DataFrame,
    files: DataFrame | None = None,
    broken: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """(records, one-row summary). The records are written, so that the points are read once for both."""
    records = settle(validate(points, dictionary, files))
    return records, validation_summary(records, dictionary, broken)


def completeness(names: DataFrame, files: DataFrame) -> DataFrame:
    """One row: sorted codes that are there, missing and extra, with full names."""
    sides = compare_inventories(names, files)

    def codes(condition, value="code"):
        return F.sort_array(F.collect_set(F.when(condition, F.col(value))))

    side = F.col("side")
    return sides.agg(
        F.count_if(side != "extra").alias("listed"),
        F.count_if(side != "missing").alias("downloaded"),
        codes(side != "missing").alias("downloaded_codes"),
        codes(side == "missing").alias("missing_codes"),
        codes(side == "extra").alias("extra_codes"),
        codes(side == "missing", "full_name").alias("missing_names"),
    )
