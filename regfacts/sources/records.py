"""CSV files as records, split over tasks even where line breaks are quoted.

A file is read as lines by its splits. One pass counts the quotes of every split:
an odd number means that the next split starts inside quotes, so a prefix scan over
the splits of a file tells where its records start, without reading a file in one
task. Files without a quoted line break need no more than that pass; in the others
the lines are shuffled by split, and only the lines of broken records are grouped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regfacts.session import settle

SPLIT = ["source_path", "block"]
UNCLOSED = "a quote is not closed"
BROKEN_HEADER = "line break in the header"


def read_lines(spark: SparkSession, path: str | Sequence[str], pattern: str | None = None,
               recursive: bool = False) -> DataFrame:
    """Lines of text files: source_file, source_path, block (split offset), pos, value."""
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", recursive)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return numbered(reader.text(path).select("value", "_metadata"))


def numbered(lines: DataFrame) -> DataFrame:
    """Lines (value, _metadata) with their file, split and place; right at a scan."""
    # the running id also keeps filters above the scan, so that every pass has the same splits
    return lines.select(
        F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_path").alias("source_path"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"), "value")


def _quotes(value: Column) -> Column:
    return F.length(value) - F.length(F.replace(value, F.lit('"'), F.lit("")))


def _odd(value: Column) -> Column:
    return _quotes(value) % 2


def fields(record: Column, width: int) -> Column:
    """The first `width` values of a CSV record, as text."""
    columns = ", ".join(f"c{i} string" for i in range(width))
    parsed = F.from_csv(record, columns, {"escape": '"', "lineSep": "\n"})
    return F.array(*[parsed[f"c{i}"] for i in range(width)])


def file_splits(lines: DataFrame) -> DataFrame:
    """One written row for each split: source_file, source_path, block, where it starts, header, problem.

    `inside`: it starts inside quotes; `quoted`: some line break of the file is
    quoted; `first`: place of the header line; `header`: its columns; `problem`: why
    the file cannot be read, else null. A file without a line has no split.
    """
    counted = lines.groupBy("source_file", *SPLIT).agg(
        F.sum(_odd(F.col("value"))).alias("odd"), F.min("pos").alias("first"),
        F.min_by("value", "pos").alias("line"))
    file = Window.partitionBy("source_path")
    earlier = file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    start = F.when(F.col("block") == 0, F.regexp_replace("line", "^\ufeff|\r$", ""))
    splits = counted.select(
        "source_file", *SPLIT, F.when(F.col("block") == 0, F.col("first")).alias("first"),
        (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2 == 1).alias("inside"),
        (F.sum("odd").over(file) > 0).alias("quoted"),
        F.max(start).over(file).alias("line"),
        (F.sum("odd").over(file) % 2 == 1).alias("unclosed"))
    splits = settle(splits)
    # one number: the widest header
    width = splits.agg(F.max(_quotes(F.translate("line", ',"', '"')) + 1)).first()[0] or 1
    names = F.filter(fields(F.col("line"), width), lambda c: c.isNotNull())
    problem = F.when(F.col("unclosed"), UNCLOSED).when(_odd(F.col("line")) == 1, BROKEN_HEADER)
    return settle(splits.select(
        "source_file", *SPLIT, "first", "inside", "quoted", names.alias("header"), problem.alias("problem")))


def records(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """Records of the files without a problem: source_file, source_path, line, chunk, header, record.

    The header and blank lines are left out. `line` (split, place) rises in file order;
    `chunk` is the split a record starts in. An unclosed quote is a problem of
    its file, so no group of lines is longer than one record.
    """
    known = lines.join(splits.filter("problem is null").drop("source_file"), SPLIT)
    known = known.filter(F.col("first").isNull() | (F.col("pos") != F.col("first")))
    columns = ["source_file", "source_path", "block", "pos", "header", "value"]
    out = known.filter(~F.col("quoted")).select(*columns)
    if not splits.filter("quoted and problem is null").isEmpty():
        out = out.unionByName(_stitched(known.filter("quoted")).select(*columns))
    text = F.regexp_replace("value", "\r$", "")
    return out.filter(F.trim(text) != "").select(
        "source_file", "source_path", F.struct("block", "pos").alias("line"), F.col("block").alias("chunk"), "header",
        text.alias("record"))


def _stitched(lines: DataFrame) -> DataFrame:
    """Whole records from lines of files with quoted line breaks; the header line is gone already."""
    split = Window.partitionBy(*SPLIT).orderBy("pos")
    before = split.rowsBetween(Window.unboundedPreceding, -1)
    odd = _odd(F.col("value"))
    marked = lines.withColumn("odd", odd).withColumn(
        "within", (F.coalesce(F.sum("odd").over(before), F.lit(0)) + F.col("inside").cast("int")) % 2)
    whole = marked.filter("within = 0 and odd = 0").drop("odd", "within")
    # of broken records only: the number of starts so far in the split
    starts = F.sum(F.when(F.col("within") == 0, 1).otherwise(0)).over(split.rowsBetween(Window.unboundedPreceding, 0))
    broken = settle(marked.filter("within = 1 or odd = 1").withColumn("no", starts))
    counts = broken.groupBy(*SPLIT).agg(F.max("no").alias("starts"))
    earlier = Window.partitionBy("source_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(*SPLIT, F.coalesce(F.sum("starts").over(earlier), F.lit(0)).alias("base"))
    # lines before the first start of a split go on with the last record of the splits before
    grouped = broken.join(base, SPLIT).groupBy("source_file", "source_path", "header", F.col("base") + F.col("no")).agg(
        F.array_sort(F.collect_list(F.struct("block", "pos", "value"))).alias("parts"))
    joined = F.array_join(F.transform("parts", lambda p: p["value"]), "\n")
    return whole.unionByName(grouped.select(
        "source_file", "source_path", "header", F.get("parts", 0)["block"].alias("block"),
        F.get("parts", 0)["pos"].alias("pos"), joined.alias("value")), allowMissingColumns=True)


def columns_of(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """Records parsed by the header of their own file: one text column for each of `names`; absent ones are null.

    Of equal names in a header the first one counts.
    """
    width = rows.agg(F.max(F.size("header"))).first()[0] or 1
    parsed = rows.withColumn("_values", fields(F.col("record"), width))
    value = lambda c: F.get("_values", F.nullif(F.array_position("header", c), F.lit(0)).cast("int") - 1)
    return parsed.select(*[value(c).alias(c) for c in names], "source_file", "source_path", "line", "chunk")
