"""Counts, summaries, severities and report rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regfacts import fixed
from regfacts.functions import (
    clean_text, has_restart_token, is_open_key, normalize_code, safe_int, template_code,
)
from regfacts.operators.windows import keep_last

DUPLICATE_KEYS = ("Entity", "Module", "Cell", "Row", "Column", "FactValue")


def _sorted_set(c: Column) -> Column:
    return F.sort_array(F.collect_set(c))


# --- A1 ----------------------------------------------------------------------
def summarize_sources(df: DataFrame, columns: Sequence[str], name: str = "csv") -> DataFrame:
    """Rows and columns per file; `columns` are the columns the files have."""
    return df.groupBy("source_file").agg(
        F.lit(name).alias("name"),
        F.count("*").alias("rows"),
        F.lit(len(columns)).cast("bigint").alias("columns"),
    )


def summarize_grids(grid: DataFrame) -> DataFrame:
    """Rows below the header and columns per sheet."""
    return grid.groupBy(F.col("workbook").alias("source_file"), F.col("sheet").alias("name")).agg(
        F.max("r").cast("bigint").alias("rows"),
        (F.max("c") + 1).cast("bigint").alias("columns"),
    )


# --- A2–A5: validation -------------------------------------------------------
def distinct_points(df: DataFrame, by: Sequence[str], keys: Sequence[str] = DUPLICATE_KEYS):
    """Distinct key rows per file with their number of `copies`, blank as blank."""
    keys = [k for k in keys if k in df.columns]
    return df.groupBy(*by, *[F.coalesce(F.col(k), F.lit("")).alias(k) for k in keys]).agg(
        F.count("*").alias("copies")
    )


def duplicate_count(
    df: DataFrame, by: Sequence[str] = ("source_file",), keys: Sequence[str] = DUPLICATE_KEYS
) -> DataFrame:
    """Rows beyond the first of each key, per file."""
    return (
        distinct_points(df, by, keys)
        .groupBy(*by)
        .agg(F.sum(F.col("copies") - 1).alias("duplicate_fact_keys"))
    )


def cell_match_counts(
    cells: DataFrame, by: Sequence[str] = ("template_code",), weight: str = "n"
) -> DataFrame:
    """Mapped, unmapped, malformed and checked facts.

    `cells` has one row per cell with `row_code`, `column_code`, `mapped` and the
    number of facts in `weight`; if it also has the number of `repeats`, those
    are summed up as duplicates.
    """
    n = F.col(weight)
    malformed = F.col("row_code").isNull() | F.col("column_code").isNull()

    def total(condition: Column) -> Column:
        return F.sum(F.when(condition, n).otherwise(0)).cast("bigint")

    return cells.groupBy(*by).agg(
        F.sum(n).cast("bigint").alias("facts_checked"),
        total(~malformed & F.col("mapped")).alias("facts_mapped"),
        total(~malformed & ~F.col("mapped")).alias("unmapped_facts"),
        total(malformed).alias("malformed_facts"),
        *(
            [F.sum("repeats").cast("bigint").alias("duplicate_fact_keys")]
            if "repeats" in cells.columns
            else []
        ),
    )


def severity(df: DataFrame) -> DataFrame:
    """Add severity and notes; facts of open templates all count as mapped.

    Needs the columns of a validation record and `missing_columns`, the sorted
    required columns that the file lacks.
    """
    known = F.col("template_in_dictionary")
    lacks = F.size("missing_columns") > 0
    # checks stop at the first failure, so later counts stay zero
    checked = known & ~lacks
    opened = checked & F.col("is_open_template")
    fixed_rows = checked & ~F.col("is_open_template")
    bad = fixed_rows & ((F.col("unmapped_facts") + F.col("malformed_facts")) > 0)
    repeats = checked & (F.col("duplicate_fact_keys") > 0)
    lacking = F.concat(
        F.lit("missing required columns: ['"), F.array_join("missing_columns", "', '"), F.lit("']")
    )
    zero = F.lit(0).cast("bigint")

    def only(condition: Column, value: Column) -> Column:
        return F.when(condition, value).otherwise(zero)

    return df.withColumns(
        {
            "severity": F.when(~checked | bad, F.lit("error"))
            .when(repeats, F.lit("warning"))
            .otherwise(F.lit("ok")),
            "notes": F.array_compact(
                F.array(
                    F.when(~known, F.lit("template not in dictionary")),
                    F.when(known & lacks, lacking),
                    F.when(repeats & ~bad, F.lit("duplicate fact rows")),
                    F.when(
                        opened, F.lit("open-row template: skipped fixed row/column cell match")
                    ),
                )
            ),
            "facts_checked": only(checked, F.when(opened, F.col("rows")).otherwise(
                F.col("facts_checked"))),
            "facts_mapped": only(checked, F.when(opened, F.col("rows")).otherwise(
                F.col("facts_mapped"))),
            "unmapped_facts": only(fixed_rows, F.col("unmapped_facts")),
            "malformed_facts": only(fixed_rows, F.col("malformed_facts")),
            "duplicate_fact_keys": only(checked, F.col("duplicate_fact_keys")),
        }
    )


def validation_summary(
    records: DataFrame, dictionary: DataFrame, broken: Sequence[str] = ()
) -> DataFrame:
    """One row: totals, error and warning counts, missing and extra templates."""
    known = dictionary.select("template_code").distinct().withColumn("known", F.lit(True))
    sides = records.withColumn("there", F.lit(True)).join(known, "template_code", "full_outer")
    there, listed = F.col("there").isNotNull(), F.col("known").isNotNull()
    code = F.col("template_code")

    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    return sides.agg(
        F.count_if(there).alias("files"),
        F.count_if(listed).alias("dictionary_templates"),
        F.count_distinct(F.when(there, code)).alias("downloaded_templates"),
        _sorted_set(F.when(~there & ~code.isin(list(broken)), code)).alias("missing_downloads"),
        _sorted_set(F.when(~listed, code)).alias("extra_downloads"),
        F.count_if(F.col("severity") == "error").alias("errors"),
        F.count_if(F.col("severity") == "warning").alias("warnings"),
        total("rows").alias("total_rows"),
        total("unmapped_facts").alias("total_unmapped_facts"),
        total("malformed_facts").alias("total_malformed_facts"),
        total("duplicate_fact_keys").alias("total_duplicate_fact_keys"),
    )


# --- A6, A10–A12: star -------------------------------------------------------
def star_summary(
    facts: DataFrame, stored: DataFrame, institutions: DataFrame, manifest: DataFrame,
    bridge: DataFrame,
) -> DataFrame:
    """One row of counts; `facts` before and after repeats of an id are removed."""
    parts = [
        facts.agg(F.count("*").alias("facts")),
        stored.agg(F.count("*").alias("distinct_facts")),
        institutions.agg(F.count("*").alias("institutions")),
        manifest.agg(
            F.count("*").alias("templates_in_manifest"),
            F.count_if(F.col("status") == "complete").alias("completed_templates"),
            F.count_if(F.col("status") == "skipped").alias("skipped_templates"),
        ),
        bridge.agg(F.count("*").alias("open_dimensions")),
    ]
    columns = [c for p in parts for c in p.columns]
    # one row each, put side by side by a sum over their union
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows.agg(*[F.sum(c).cast("bigint").alias(c) for c in columns])


def distinct_codes(df: DataFrame, kind: str) -> DataFrame:
    """Sorted distinct `open_key`, `column` or dictionary `row` codes, as rows."""
    if kind == "open_key":
        codes = df.filter(is_open_key("Row")).select(F.col("Row").alias("code"))
    elif kind == "column":
        code = F.col("Column")
        codes = df.filter((code != "") & (F.lower(code) != "nan")).select(code.alias("code"))
    elif kind == "row":
        code = F.col("row_code")
        codes = df.filter((code != "") & ~code.startswith(fixed.OPEN_ROW_PREFIX)).select(
            code.alias("code")
        )
    else:
        raise ValueError(f"unknown kind of code: {kind}")
    return codes.distinct().orderBy("code")


def template_summary(dictionary: DataFrame) -> DataFrame:
    """Per template: name, module and numbers of cells, rows, columns and points."""
    cells = dictionary.filter(F.col("template_code").isNotNull())
    return cells.groupBy("template_code").agg(
        F.min("template_name").alias("template_name"),
        F.min("module_name").alias("module_name"),
        F.count("*").alias("cells"),
        F.count_distinct("row_code").alias("rows"),
        F.count_distinct("col_code").alias("columns"),
        F.count_distinct("dpm_point_id").alias("dpm_points"),
    )


def open_templates(dictionary: DataFrame) -> DataFrame:
    """Per template, whether it has any open row."""
    return dictionary.groupBy("template_code").agg(
        F.coalesce(F.bool_or(F.col("row_code").startswith(fixed.OPEN_ROW_PREFIX)), F.lit(False))
        .alias("is_open_row")
    )


def institutions(facts: DataFrame, order: str = "line") -> DataFrame:
    """One row per LEI: the last row of a file, the first file by name and path."""
    file = F.struct("source_file", *[c for c in ("source_path",) if c in facts.columns])
    value = F.struct("entity_name", "country")
    per_file = (
        facts.filter(F.col("lei").isNotNull())
        .groupBy("lei", file.alias("file"))
        .agg(F.max_by(value, order).alias("value"))
    )
    return (
        per_file.groupBy("lei")
        .agg(F.min_by("value", "file").alias("value"))
        .select("lei", "value.entity_name", "value.country")
    )


# --- A7, A13–A15, A8: run bookkeeping ----------------------------------------
def latest_date(df: DataFrame, col: str = "date") -> DataFrame:
    """The latest of `dd/MM/yyyy` texts, compared as dates."""
    return df.agg(F.max_by(col, F.to_date(col, "dd/MM/yyyy")).alias("latest"))


def outcome_counts(results: DataFrame, col: str = "rows") -> DataFrame:
    """Success, empty, skipped, failed and total rows from result codes."""
    rows = F.col(col)
    return results.agg(
        F.count_if(rows > 0).alias("success"),
        F.count_if(rows == 0).alias("empty"),
        F.count_if(rows == -1).alias("skipped"),
        F.count_if(rows < -1).alias("failed"),
        F.coalesce(F.sum(F.when(rows > 0, rows)), F.lit(0)).cast("bigint").alias("total_rows"),
    )


def run_status(
    attempts: DataFrame,
    by: Sequence[str] = ("template_code",),
    broken: Sequence[str] = (),
) -> DataFrame:
    """Template status from a log of partition attempts.

    The log has per attempt an `error` text or null, `restart_token` and `rows`.
    `refresh_advised` marks templates with more than a quarter failed attempts.
    """
    failures, tokens, rows = F.col("failures"), F.col("restart_tokens"), F.col("rows")
    return (
        attempts.groupBy(*by)
        .agg(
            F.count("*").alias("attempts"),
            F.count_if(F.col("error").isNotNull()).alias("failures"),
            F.count_if(F.col("error").isNull() & F.col("restart_token")).alias("restart_tokens"),
            F.coalesce(F.sum(F.when(F.col("error").isNull(), F.col("rows"))), F.lit(0))
            .cast("bigint")
            .alias("rows"),
        )
        .withColumn(
            "status",
            F.when(F.col(by[0]).isin(list(broken)), F.lit("skipped"))
            .when(rows == 0, F.lit("failed"))
            .when((failures > 0) | (tokens > 0), F.lit("partial"))
            .otherwise(F.lit("complete")),
        )
        .withColumn("refresh_advised", failures / F.col("attempts") > 0.25)
    )


def restart_token_counts(
    responses: DataFrame, by: Sequence[str], rows: str | None = None
) -> DataFrame:
    """Cut-off responses per group, by token and, given a row count, by size."""
    marked = responses.withColumn("_rt", has_restart_token("response"))
    aggs = [F.count("*").alias("responses"), F.count_if("_rt").alias("restart_tokens")]
    if rows:
        aggs.append(
            F.count_if(F.col("_rt") | (F.col(rows) >= fixed.TRUNCATION_ROWS)).alias("truncated")
        )
    return marked.groupBy(*by).agg(*aggs)


def metadata_coverage(df: DataFrame, by: Sequence[str] = (), col: str = "Category") -> DataFrame:
    """Rows, rows with metadata and their share, per source file."""
    return df.groupBy(*by).agg(
        F.count("*").alias("rows"),
        F.count(col).alias("matched"),
        F.avg(F.col(col).isNotNull().cast("int")).alias("match_rate"),
    )


def manifest_rows(records: DataFrame, reference_date: str | Column) -> DataFrame:
    """Manifest table rows: counts as whole numbers, the token as a flag."""
    date = F.lit(reference_date) if isinstance(reference_date, str) else reference_date
    token = F.lower(F.col("template_restart_token"))
    return records.select(
        date.alias("reference_date"),
        "template_code",
        "status",
        safe_int("rows").alias("rows"),
        F.coalesce(~token.isin("false", "0", "", "null"), F.lit(False))
        .alias("template_restart_token"),
        safe_int("entity_restart_token_count").alias("entity_restart_token_count"),
        safe_int("row_partition_restart_token_count").alias("row_partition_restart_token_count"),
        F.coalesce("failed_entities", F.lit("[]")).alias("failed_entities_json"),
        "reason",
        "updated_at",
    )


def dim_cells(dictionary: DataFrame, order: str) -> DataFrame:
    """Dictionary cells, unique on (template, row, column), last one by `order` wins."""
    key = ["template_code", "row_code", "col_code"]
    texts = [
        "row_name", "col_name", "module_name", "unit", "dpm_point_id", "main_property",
        "dimensions",
    ]
    cells = dictionary.select(
        clean_text("template_code").alias("template_code"),
        normalize_code("row_code").alias("row_code"),
        normalize_code("col_code").alias("col_code"),
        *[clean_text(c).alias(c) for c in texts],
        F.col(order).alias("_order"),
    ).dropna(subset=key)
    return keep_last(cells, key, ["_order"]).select(*key, *texts)


# --- O1–O4 -------------------------------------------------------------------
def sort_dictionary(df: DataFrame) -> DataFrame:
    return df.orderBy("module_name", "template_code", "row_code", "col_code")


def sorted_names(df: DataFrame, col: str, by: Sequence[str] = ()) -> DataFrame:
    """Sorted distinct names as one list per group; for code-like columns only."""
    return df.groupBy(*by).agg(_sorted_set(F.col(col)).alias("names"))


def preview(df: DataFrame, order: Sequence[str], n: int = 20) -> tuple[DataFrame, DataFrame]:
    """(first n rows by order, one-row count of how many more there are)."""
    more = df.agg(F.greatest(F.count("*") - n, F.lit(0)).cast("bigint").alias("more"))
    return df.orderBy(*order).limit(n), more


def capped(df: DataFrame, by: Sequence[str], max_rows: int = fixed.ROW_CAP) -> DataFrame:
    """Rows per response and whether the row cap was reached; no row is dropped."""
    return df.groupBy(*by).agg(F.count("*").alias("rows")).withColumn(
        "capped", F.col("rows") >= max_rows
    )


def template_names(df: DataFrame, col: str = "template") -> DataFrame:
    """Distinct template codes of full names."""
    return df.select(template_code(col).alias("template_code")).distinct()
