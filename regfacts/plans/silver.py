"""Points -> silver facts, and the star schema around them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regfacts import fixed
from regfacts.functions import (
    clean_text, fact_id, is_open_key, normalize_code, numeric_value, pystrip, safe_int,
    synthetic_cell, template_from_file,
)
from regfacts.operators.aggregates import (
    dim_cells, institutions, manifest_rows, open_templates, star_summary, template_summary,
)
from regfacts.operators.merge import explode_dimensions
from regfacts.operators.project import detect_layout
from regfacts.operators.windows import keep_last_of_few
from regfacts.schema import FACT_ID_PARTS, SILVER_FACT_COLUMNS
from regfacts.session import settle
from regfacts.sources.readers import (
    read_dictionary, read_manifest, read_template_summary, scan_directory,
)
from regfacts.sources.writers import Star, stored, template_views, write_star


def silver_facts(
    points: DataFrame, reference_date: str | Column, run_id: str | Column
) -> DataFrame:
    """Bronze points of the LEI layout -> silver facts, repeats included.

    One narrow pass: no shuffle. `line` stays, for the last-wins rules.
    """
    date = F.lit(reference_date) if isinstance(reference_date, str) else reference_date
    run = F.lit(run_id) if isinstance(run_id, str) else run_id
    texts = ["Entity", "Country", "Module", "Cell", "Row", "RowName", "Column", "ColumnName",
             "FactValue"]
    # each step uses the columns of the one before several times, so every text
    # is stripped and every code computed once
    stripped = points.select(
        template_from_file("source_file").alias("template_code"),
        *[(pystrip(c) if c in points.columns else F.lit(None).cast("string")).alias(c)
          for c in texts],
        "source_file",
        "line",
    )
    cleaned = stripped.select(
        date.alias("reference_date"),
        "template_code",
        clean_text("Entity", strip=False).alias("lei"),
        clean_text("Country", strip=False).alias("entity_name"),
        clean_text("Module", strip=False).alias("country"),
        clean_text("Cell", strip=False).alias("module_name"),
        clean_text("Row", strip=False).alias("row_raw"),
        clean_text("RowName", strip=False).alias("row_label"),
        normalize_code("Column", strip=False).alias("column_code"),
        clean_text("ColumnName", strip=False).alias("column_label"),
        clean_text("FactValue", strip=False).alias("fact_value_raw"),
        "source_file",
        run.alias("run_id"),
        "line",
    ).filter(F.col("fact_value_raw").isNotNull())
    is_open = is_open_key("row_raw")
    coded = cleaned.select(
        "*",
        F.when(is_open, F.col("row_raw")).alias("open_key"),
        F.when(~is_open, normalize_code("row_raw", strip=False)).alias("row_code"),
    )
    celled = coded.withColumn("cell", synthetic_cell("template_code", "row_code", "column_code"))
    return celled.select(
        fact_id(FACT_ID_PARTS).alias("fact_id"),
        *SILVER_FACT_COLUMNS[1:15],
        numeric_value("fact_value_raw", strip=False).alias("fact_value_num"),
        "source_file",
        "run_id",
        "line",
    )


def distinct_facts(facts: DataFrame) -> DataFrame:
    """One row per fact id; the last one in (file, line) order wins.

    Few ids repeat, so only these facts are shuffled. `facts` is read several times: a written
    copy, which may lack columns that the caller does not need.
    """
    last = keep_last_of_few(facts, ["fact_id"], ["source_file", "line"])
    return last.select(*[c for c in SILVER_FACT_COLUMNS if c in facts.columns])


def refuse_other_layouts(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(points of LEI files, files refused because their entities are no LEIs)."""
    laid_out = detect_layout(points)
    refused = laid_out.filter("layout <> 'lei'").select("source_file").distinct()
    return laid_out.filter("layout = 'lei'").drop("layout"), refused


def template_dimension(
    summary: DataFrame | None, dictionary: DataFrame
) -> DataFrame:
    """Templates of the summary with the open flag; open ones may come without one."""
    if summary is None:
        summary = template_summary(dictionary)
    counts = {c: safe_int(c) for c in ("cells", "rows", "columns", "dpm_points")}
    summary = summary.withColumns(counts).withColumn("has_summary", F.lit(True))
    flagged = open_templates(dictionary).filter("is_open_row")
    return summary.join(flagged, "template_code", "full_outer").fillna(
        False, subset=["has_summary", "is_open_row"]
    )


def make_star(
    points: DataFrame,
    dictionary: DataFrame,
    manifest: DataFrame,
    reference_date: str,
    run_id: str,
    summary: DataFrame | None = None,
    dictionary_order: str = "line",
    manifest_path: str | None = None,
) -> tuple[Star, DataFrame]:
    """(the seven tables of one load, all facts with repeats).

    The facts are written once: facts, institutions and counts read the copy, and
    a count of it comes from its footers. (Observed metrics would count a map
    stage twice that runs again after a lost executor.)
    """
    spark = points.sparkSession
    facts = settle(silver_facts(points, reference_date, run_id))
    unique = distinct_facts(facts)
    run = spark.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.lit(reference_date).alias("reference_date"),
        F.lit(reference_date.replace("-", "")).alias("folder"),
        F.lit(manifest_path).cast("string").alias("manifest_path"),
        F.current_timestamp().alias("loaded_at"),
    )
    star = Star(
        dim_run=run,
        extraction_manifest=manifest_rows(manifest, reference_date),
        dim_institution=institutions(facts),
        dim_template=template_dimension(summary, dictionary),
        dim_cell=dim_cells(dictionary, dictionary_order),
        fact=unique,
        fact_dimension=explode_dimensions(unique),
    )
    return star, facts


def build_star(
    spark: SparkSession,
    raw_root: str,
    out_root: str,
    folder: str,
    dictionary_path: str,
    manifest_path: str,
    summary_path: str | None = None,
    replace: bool = False,
    required: Sequence[str] = (),
) -> DataFrame:
    """Load the points of one folder (`yyyyMMdd`) into the star; returns the counts."""
    iso = f"{folder[:4]}-{folder[4:6]}-{folder[6:8]}"
    scan = scan_directory(spark, f"{raw_root}/{folder}", required=required, recursive=False)
    # parsed once: facts, institutions and counts all read the columnar copy
    lei_points, _ = refuse_other_layouts(settle(scan.points))
    star, facts = make_star(
        lei_points,
        read_dictionary(spark, dictionary_path),
        read_manifest(spark, manifest_path),
        iso,
        f"{fixed.RUN_PREFIX}{folder}",
        summary=read_template_summary(spark, summary_path) if summary_path else None,
        manifest_path=manifest_path,
    )
    write_star(star, out_root, replace)
    tables = {
        name: stored(spark, out_root, name)
        or spark.createDataFrame([], getattr(star, name).schema)
        for name in Star.__dataclass_fields__
    }
    template_views(tables["fact"], tables["dim_template"])
    return star_summary(
        facts,
        tables["fact"],
        tables["dim_institution"],
        tables["extraction_manifest"],
        tables["fact_dimension"],
    )
