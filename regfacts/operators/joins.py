"""Joins and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regfacts import fixed
from regfacts.functions import code_from_parts, natural_key, normalize_code, template_code
from regfacts.session import broadcast_if_small

CELL = ("template_code", "row_code", "column_code")


def split_incremental(
    new: DataFrame, existing: DataFrame | None
) -> tuple[DataFrame, DataFrame]:
    """(rows to append, rows already there) by the natural key.

    Repeated keys inside `new` are all kept. Nothing stored: all rows are new.
    """
    if existing is None:
        return new, new.filter(F.lit(False))
    keyed = new.withColumn("_key", natural_key(new))
    known = existing.select(natural_key(existing).alias("_key")).distinct()
    return (
        keyed.join(known, "_key", "left_anti").drop("_key"),
        keyed.join(known, "_key", "left_semi").drop("_key"),
    )


def dictionary_cells(dictionary: DataFrame) -> DataFrame:
    """Distinct fixed cells of a dictionary: no open rows, no missing codes."""
    return (
        dictionary.filter(~F.coalesce(F.col("row_code").startswith(fixed.OPEN_ROW_PREFIX),
                                      F.lit(False)))
        .select(
            "template_code",
            normalize_code("row_code").alias("row_code"),
            normalize_code("col_code").alias("column_code"),
        )
        .dropna(subset=["row_code", "column_code"])
        .distinct()
    )


def map_to_dictionary(points: DataFrame, cells: DataFrame) -> DataFrame:
    """Add `mapped`: does the dictionary know this (template, row, column)?

    `cells` comes from `dictionary_cells`. It is broadcast if within the bound;
    else adaptive execution splits hot cells of the point side.
    """
    known = broadcast_if_small(cells).withColumn("mapped", F.lit(True))
    return points.join(known, list(CELL), "left").withColumn(
        "mapped", F.coalesce("mapped", F.lit(False))
    )


def attach_metadata(
    df: DataFrame, metadata: DataFrame, on: Sequence[str], csv_name: str | None = None
) -> DataFrame:
    """Left join of metadata columns; of one source file's items if it has any."""
    if csv_name is not None and "csv_name" in metadata.columns:
        metadata = metadata.filter(F.col("csv_name") == csv_name).drop("csv_name")
    return df.join(broadcast_if_small(metadata), list(on), "left")


def in_dictionary(files: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Add `template_in_dictionary` to rows with a `template_code`."""
    known = dictionary.select("template_code").distinct()
    return files.join(
        known.withColumn("template_in_dictionary", F.lit(True)), "template_code", "left"
    ).withColumn("template_in_dictionary", F.coalesce("template_in_dictionary", F.lit(False)))


def cells_from_grid(rows: DataFrame, columns: DataFrame) -> DataFrame:
    """Each data row with each coded column of its sheet, and the cell there.

    `rows` carries the row's cells as a map; `columns` has one row per coded
    column. The columns of a sheet are put into one bounded list per sheet and
    unnested on the row side.
    """
    lists = columns.groupBy("workbook", "sheet").agg(
        F.sort_array(F.collect_list(F.struct("c", "col_code", "col_name"))).alias("coded")
    )
    return (
        rows.join(broadcast_if_small(lists), ["workbook", "sheet"])
        .select("*", F.inline("coded"))
        .drop("coded")
        .withColumn("cell", F.col("cells")[F.col("c")])
    )


def coverage_gaps(
    entities: DataFrame,
    codes: DataFrame,
    actual: DataFrame,
    on: Sequence[str] = ("template_code",),
    entity: str = "entity",
    code_cols: Sequence[str] = ("row_code",),
) -> DataFrame:
    """Expected (entity, code) combinations that are not present.

    `entities` names who has to report what `on`, `codes` the codes expected
    there, `actual` what is there. The full grid is never built: each entity's
    present codes are taken out of the expected list, and only what is left is
    unnested. Present codes that nobody expects are left out first, so both
    lists are bounded by the number of codes of a template.
    """
    on, code = list(on), F.struct(*code_cols)
    expected = codes.groupBy(*on).agg(F.sort_array(F.collect_set(code)).alias("_expected"))
    # distinct combinations first, so that repeated facts do not pile up in one list
    wanted = codes.select(*on, *code_cols).distinct().alias("wanted")
    same = [F.col(f"there.{c}").eqNullSafe(F.col(f"wanted.{c}")) for c in (*on, *code_cols)]
    present = (
        actual.select(*on, entity, *code_cols)
        .distinct()
        .alias("there")
        .join(wanted, same, "left_semi")
        .groupBy(*on, entity)
        .agg(F.collect_set(code).alias("_present"))
    )
    return (
        entities.select(*on, entity)
        .distinct()
        .join(expected, on)
        .join(present, [*on, entity], "left")
        .select(
            *on,
            entity,
            F.inline(
                F.when(F.col("_present").isNull(), F.col("_expected")).otherwise(
                    F.array_except("_expected", "_present")
                )
            ),
        )
    )


def attach_entity(facts: DataFrame, institutions: DataFrame) -> DataFrame:
    """Facts with the columns of their institution, by LEI."""
    return facts.join(broadcast_if_small(institutions), "lei", "left")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames by column name; absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def missing(
    expected: DataFrame, actual: DataFrame, exclude: Sequence[str] = ()
) -> DataFrame:
    """expected − actual − exclude, on one column."""
    (col,) = expected.columns
    left = expected.subtract(actual)
    return left.filter(~F.col(col).isin(list(exclude))) if exclude else left


def extra(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """actual − expected."""
    return actual.subtract(expected)


def unmatched_union(
    frames: Mapping[str, DataFrame], col: str = "Category"
) -> DataFrame:
    """Rows without metadata of all sources, the source name as first column."""
    return union_all(
        [
            df.filter(F.col(col).isNull()).select(F.lit(name).alias("source_file"), *df.columns)
            for name, df in frames.items()
        ]
    )


def compare_inventories(names: DataFrame, files: DataFrame) -> DataFrame:
    """One row per template code with the side(s) it was found on.

    `names` has full template names in `template`, `files` file names in
    `source_file`.
    """
    listed = (
        names.groupBy(template_code("template").alias("code"))
        .agg(F.min("template").alias("full_name"))
        .withColumn("listed", F.lit(True))
    )
    there = (
        files.select(code_from_parts("source_file").alias("code"))
        .distinct()
        .withColumn("downloaded", F.lit(True))
    )
    return listed.join(there, "code", "full_outer").select(
        "code",
        F.coalesce("full_name", "code").alias("full_name"),
        F.when(F.col("downloaded").isNull(), F.lit("missing"))
        .when(F.col("listed").isNull(), F.lit("extra"))
        .otherwise(F.lit("both"))
        .alias("side"),
    )
