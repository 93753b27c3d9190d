"""Exposure tables with metadata, and sheets of the metadata workbook."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regfacts import fixed
from regfacts.operators.aggregates import metadata_coverage
from regfacts.operators.joins import attach_metadata, union_all, unmatched_union
from regfacts.operators.project import promote_header
from regfacts.sources.writers import write_csv


def exposure_enrich(
    frames: Mapping[str, DataFrame],
    metadata: DataFrame,
    on: Sequence[str],
    files: Mapping[str, str] = fixed.EXPOSURE_FILES,
) -> dict[str, DataFrame]:
    """Each exposure table with its metadata columns."""
    return {
        key: attach_metadata(df, metadata, on, files.get(key, key)) for key, df in frames.items()
    }


def exposure_coverage(enriched: Mapping[str, DataFrame], col: str = "Category") -> DataFrame:
    """Match rate per exposure table."""
    return union_all(
        [
            metadata_coverage(df, col=col).select(F.lit(key).alias("name"), "*")
            for key, df in enriched.items()
        ]
    )


def exposure_unmatched(
    enriched: Mapping[str, DataFrame],
    files: Mapping[str, str] = fixed.EXPOSURE_FILES,
    col: str = "Category",
) -> DataFrame:
    """Rows without metadata of all exposure tables."""
    return unmatched_union({files.get(key, key): df for key, df in enriched.items()}, col)


def institution_list(
    grid: DataFrame, path: str | None = None, sheet: str = fixed.INSTITUTIONS_SHEET
) -> DataFrame:
    """The institutions sheet, its header in row 1; written as CSV if a path is given."""
    table = promote_header(grid.filter(F.col("sheet") == sheet), 1)
    table = table.orderBy("workbook", "r").drop("workbook", "sheet", "r")
    if path:
        write_csv(table, path)
    return table
