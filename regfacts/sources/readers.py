"""Readers of points, grids, dictionaries, manifests, responses and name lists."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regfacts import fixed, schema
from regfacts.functions import drop_na_tokens, normalize_code
from regfacts.session import settle
from regfacts.sources.records import columns_of, file_splits, read_lines, records

JSON_LIST = "array<string>"


@dataclass(frozen=True)
class Scan:
    """Points of a folder, the files they come from, and the files left out."""

    points: DataFrame
    files: DataFrame
    rejected: DataFrame


def _csv(spark: SparkSession, columns: T.StructType, multi_line: bool):
    return (
        spark.read.schema(columns)
        .option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("multiLine", multi_line)
    )


def bronze(df: DataFrame, columns: Iterable[str], tokens: Iterable[str] = fixed.NA_TOKENS):
    """Missing-value tokens become null, once, on entry."""
    tokens = list(tokens)
    return df.withColumns({c: drop_na_tokens(c, tokens) for c in columns})


def read_points(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] = fixed.BRONZE_COLUMNS,
    na_tokens: Iterable[str] = fixed.NA_TOKENS,
) -> DataFrame:
    """Bronze CSV files of one shape, all text, with file, path, line and chunk.

    Files are split whether or not line breaks are quoted, and `chunk` follows the
    splits. A file with another header, or one that cannot be read, is an error.
    """
    lines = read_lines(spark, path)
    splits = file_splits(lines)
    wrong = F.when(F.col("problem").isNotNull(), F.col("problem")).when(
        F.col("header") != F.lit(list(columns)), "another header")
    bad = splits.filter(wrong.isNotNull()).select("source_path", wrong.alias("reason")).first()
    if bad:
        raise ValueError(f"{bad['source_path']}: {bad['reason']}")
    return bronze(columns_of(records(lines, splits), columns), columns, na_tokens)


def scan_directory(
    spark: SparkSession,
    root: str,
    reference_date: str | None = None,
    required: Sequence[str] = fixed.BRONZE_COLUMNS,
    pattern: str = f"*{fixed.POINTS_SUFFIX}",
    recursive: bool = True,
    fail_fast: bool = False,
) -> Scan:
    """All points files of a folder, whatever their columns.

    One pass reads the headers and the quotes of all splits; every record is then
    parsed by the header of its own file. Files that lack a required column or
    cannot be read are set aside with a reason. `reference_date` (`yyyyMMdd`) keeps the
    files below the folder of that name. What reaches the driver is the distinct
    column names, neither paths nor headers. A file without a line is not listed.
    """
    lines = read_lines(spark, root, pattern, recursive)
    if reference_date:
        lines = lines.filter(F.array_contains(F.split("source_path", "/"), reference_date))
    splits = file_splits(lines)
    absent = F.array_sort(F.array_except(F.lit(list(required)).cast("array<string>"), "header"))
    named = F.concat(F.lit("missing columns: ['"), F.array_join(absent, "', '"), F.lit("']"))
    reason = F.coalesce("problem", F.when(F.size(absent) > 0, named))
    splits = splits.withColumn("problem", reason)
    files = splits.filter("block = 0")
    rejected = files.filter("problem is not null").select("source_file", "source_path", F.col("problem").alias("reason"))
    if fail_fast and (bad := rejected.first()):
        raise ValueError(f"{bad['source_file']}: {bad['reason']}")
    found = {r[0] for r in files.filter("problem is null").select(F.explode("header")).distinct().collect()}
    if not found:
        found = set(fixed.BRONZE_COLUMNS)
    names = [c for c in fixed.BRONZE_WIDE_COLUMNS if c in found]
    names += sorted(found - set(names))
    points = bronze(columns_of(records(lines, splits), names), names)
    return Scan(points, files.select("source_file", "source_path", F.col("header").alias("columns")), rejected)


def read_grid(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Worksheet cells as (workbook, sheet_no, sheet, r, c, value), blanks left out."""
    reader = spark.read.schema(schema.GRID).format(format)
    if format == "csv":
        reader = reader.option("header", True).option("escape", '"').option("multiLine", True)
    return reader.load(path).filter(F.col("value").isNotNull())


@dataclass(frozen=True)
class GridScan:
    """Cells of worksheets, and the cells that were set aside with a `reason`."""

    cells: DataFrame
    rejected: DataFrame


def scan_grid(spark: SparkSession, path: str, format: str = "parquet") -> GridScan:
    """`read_grid` with a side output: cells that have no place are rows of `rejected`.

    Files are read once; cells and rejects are folders of the copy written then.
    Reasons: `no workbook`, `no sheet`, `no place` (row or column lacking, negative
    or not a whole number). Rejected cells keep row and column as text and name
    their file. Blank cells are left out.
    """
    typed = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.GRID]) if format == "csv" else schema.GRID
    reader = spark.read.schema(typed).format(format)
    if format == "csv":
        reader = reader.option("header", True).option("escape", '"').option("multiLine", True)
    raw = reader.load(path).select("*", F.col("_metadata.file_path").alias("source_path"))

    def number(c: str) -> Column:
        return F.expr(f"try_cast({c} as int)")

    def lacks_place(c: str) -> Column:
        # a cast to int takes blanks around and digits behind a point; a place has neither
        return ~F.coalesce(F.col(c).cast("string").rlike("^[0-9]+$") & number(c).isNotNull(), F.lit(False))

    reason = (
        F.when(F.col("workbook").isNull(), "no workbook").when(F.col("sheet").isNull(), "no sheet")
        .when(lacks_place("r") | lacks_place("c"), "no place")
    )
    once = settle(
        raw.filter(F.col("value").isNotNull()).withColumns({"reason": reason, "aside": reason.isNotNull()})
        .withColumns({"r": F.col("r").cast("string"), "c": F.col("c").cast("string")}), "aside")
    cells = once.filter(~F.col("aside")).select(
        *[number(f.name).alias(f.name) if f.dataType.typeName() == "integer" else f.name for f in schema.GRID])
    return GridScan(cells, once.filter("aside").drop("aside"))


def read_named_csvs(
    spark: SparkSession, root: str, files: Mapping[str, str] = fixed.EXPOSURE_FILES
) -> dict[str, DataFrame]:
    """A fixed set of CSV files by key; one error names all that are missing."""
    frames, lacking = {}, []
    for key, name in files.items():
        path = f"{root.rstrip('/')}/{name}"
        try:
            frames[key] = spark.read.option("header", True).option("escape", '"').option(
                "multiLine", True).csv(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            lacking.append(path)
    if lacking:
        raise FileNotFoundError(f"Missing required files: {', '.join(lacking)}")
    return frames


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Cell dictionary, with codes also in normalized form and in file order."""
    raw = bronze(_csv(spark, schema.DICTIONARY, True).csv(path), schema.DICTIONARY_COLUMNS)
    return raw.select(
        "*",
        normalize_code("row_code").alias("row_code_norm"),
        normalize_code("col_code").alias("col_code_norm"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.monotonically_increasing_id().alias("pos"),
        ).alias("line"),
    )


def read_template_summary(spark: SparkSession, path: str) -> DataFrame:
    columns = schema.TEMPLATE_SUMMARY_COLUMNS
    return bronze(_csv(spark, schema.TEMPLATE_SUMMARY, True).csv(path), columns)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Run manifest: one row per template. An absent file has no rows."""
    record = schema.MANIFEST_RECORD
    if not _exists(spark, path):
        return spark.createDataFrame(
            [], T.StructType([T.StructField("template_code", T.StringType()), *record.fields])
        )
    loaded = spark.read.option("multiLine", True).schema(schema.MANIFEST).json(path)
    return loaded.select(F.explode("templates").alias("template_code", "record")).select(
        "template_code", "record.*"
    )


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Landed query responses, one document per file; bad documents have no value."""
    return (
        spark.read.text(path, wholetext=True, recursiveFileLookup=True)
        .select(
            F.col("_metadata.file_path").alias("response_id"),
            F.col("_metadata.file_name").alias("source_file"),
            F.try_parse_json("value").alias("response"),
        )
    )


def read_name_list(spark: SparkSession, path: str) -> DataFrame:
    """Discovery list: sorted distinct names. Anything but a list has no rows."""
    loaded = spark.read.option("multiLine", True).schema(schema.NAME_LIST).json(path)
    names = F.try_variant_get(F.try_parse_json("values"), "$", JSON_LIST)
    return (
        loaded.select("date", "kind", F.explode(names).alias("name")).distinct().orderBy("name")
    )


def expected_files(
    spark: SparkSession,
    periods: DataFrame | Sequence[str] = fixed.PERIODS,
    categories: Mapping[str, tuple[str, str, int]] = fixed.CATEGORIES,
) -> DataFrame:
    """File inventory: each period with each category, in order of priority."""
    if not isinstance(periods, DataFrame):
        periods = spark.createDataFrame([(p,) for p in periods], schema.strings("period"))
    listed = F.array(
        *[
            F.struct(
                F.lit(name).alias("category"),
                F.lit(prefix).alias("prefix"),
                F.lit(pattern).alias("pattern"),
                F.lit(priority).alias("priority"),
            )
            for name, (prefix, pattern, priority) in categories.items()
        ]
    )
    return (
        periods.select("period", F.inline(listed))
        .select(
            "period",
            "category",
            "prefix",
            F.replace(F.col("pattern"), F.lit("{period}"), F.col("period")).alias("file_name"),
            "priority",
        )
        .orderBy("period", "priority")
    )
