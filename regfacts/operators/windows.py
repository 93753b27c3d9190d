"""File order, order-dependent fills and first/last-wins.

A fill must see the rows of a file in order, yet one file may hold a large part
of all rows. So a fill never puts a whole file into one task. Rows carry a
`chunk`: any value that rises with the row order and cuts a file into pieces of
bounded size (a scan's split offset, or a line number divided by a constant).
Rows are shuffled by (file, chunk); what a chunk has to know from earlier or
later chunks reaches it as a few extra carry rows, computed from a small
aggregate with one row per (file, group, chunk).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from regfacts.functions import BITMAP_BITS, is_set, normalize_code, packed_id, plain_id, pystrip
from regfacts.session import broadcast_if_small, deal, settle

BEFORE = (Window.unboundedPreceding, Window.currentRow)


def with_line_no(df: DataFrame) -> DataFrame:
    """Add `line` (file order) and `chunk` (split offset) right at a file scan.

    The pair (split offset, running id) rises in file order. It must be added
    before any shuffle.
    """
    block = F.col("_metadata.file_block_start")
    return df.select(
        "*",
        F.struct(block.alias("block"), F.monotonically_increasing_id().alias("pos")).alias("line"),
        block.alias("chunk"),
    )


def chunk_by_range(
    df: DataFrame, part: Sequence[str], order: Sequence[str], chunks: int
) -> DataFrame:
    """Add a `chunk` to rows that have a total order but no line numbers.

    Rows are range-partitioned by (part, order), which also splits a hot part,
    and written once so that every later reader sees the same chunks.
    """
    ranged = df.repartitionByRange(chunks, *[F.col(c) for c in (*part, *order)])
    return settle(ranged.withColumn("chunk", F.spark_partition_id()))


@dataclass(frozen=True)
class Fill:
    """Columns to fill per group of `keys`, and how far a backward fill reaches.

    `back=None`: forward only. `back="part"`: then backward to the next filled
    value of the whole part, whatever its group. `back="group"`: to that of the
    own group. Null keys are a group.
    """

    cols: Sequence[str]
    keys: Sequence[str] = ()
    back: str | None = None


def fill(
    df: DataFrame,
    cols: Sequence[str],
    part: Sequence[str],
    keys: Sequence[str] = (),
    back: str | None = None,
    **order,
) -> DataFrame:
    """Fill `cols` per (part, keys) in file order."""
    return fill_all(df, [Fill(cols, keys, back)], part, **order)


def fill_all(
    df: DataFrame,
    fills: Sequence[Fill],
    part: Sequence[str],
    order: str = "line",
    chunk: str = "chunk",
) -> DataFrame:
    """Several fills that do not depend on each other, with one shuffle of the rows.

    `order` must be unique within a part. No column may be filled by one and a
    key of another.
    """
    part = list(part)
    for f in fills:
        if f.back not in (None, "part", "group"):
            raise ValueError(f"unknown backward scope: {f.back}")
    rows = df
    rank: list[Column] = []
    split = has_split_parts(df, part, chunk)
    if split:
        # rank 0: values from earlier chunks, 1: the rows, 2: values from later chunks
        rows = df.withColumn("_rank", F.lit(1))
        rank = [F.col("_rank")]
        for f in fills:
            rows = rows.unionByName(
                _carry_rows(df, list(f.cols), part, list(f.keys), f.back, order, chunk),
                allowMissingColumns=True,
            )
    # one shuffle; it also serves the per-group windows below
    rows = deal(rows, *part, chunk)
    for f in fills:
        down = (
            Window.partitionBy(*part, chunk, *f.keys).orderBy(*rank, order).rowsBetween(*BEFORE)
        )
        filled = {c: F.last(c, ignorenulls=True).over(down) for c in f.cols}
        if split:
            filled = {
                c: F.when(F.col("_rank") == 2, F.col(c)).otherwise(v) for c, v in filled.items()
            }
        rows = rows.withColumns(filled)
    for f in fills:
        if f.back:
            scope = f.keys if f.back == "group" else ()
            up = (
                Window.partitionBy(*part, chunk, *scope)
                .orderBy(*[r.desc() for r in rank], F.col(order).desc())
                .rowsBetween(*BEFORE)
            )
            rows = rows.withColumns(
                {
                    c: F.coalesce(F.col(c), F.last(c, ignorenulls=True).over(up))
                    for c in f.cols
                }
            )
    return (rows.filter(F.col("_rank") == 1) if split else rows).select(*df.columns)


def has_split_parts(df: DataFrame, part: Sequence[str], chunk: str = "chunk") -> bool:
    """Does any part have more than one chunk? If not, chunks need no carry rows.

    One narrow aggregate over two columns; only a flag reaches the driver.
    """
    spans = df.groupBy(*part).agg(F.min(chunk).alias("low"), F.max(chunk).alias("high"))
    return bool(spans.agg(F.bool_or(F.col("low") < F.col("high"))).first()[0])


def _carry_rows(
    df: DataFrame,
    cols: Sequence[str],
    part: list[str],
    keys: list[str],
    back: str | None,
    order: str,
    chunk: str,
) -> DataFrame:
    """What each chunk needs from the other chunks, as rows to be put into it."""
    group = part + keys
    here = F.col(order)

    def seen(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.struct(here.alias("at"), F.col(c).alias("value")))

    # partially aggregated before the shuffle
    pieces = df.groupBy(*group, chunk).agg(
        F.min(order).alias("_first"),
        *[F.max(seen(c)).alias(f"_last_{c}") for c in cols],
        *([F.min(seen(c)).alias(f"_lead_{c}") for c in cols] if back else []),
    )
    earlier = Window.partitionBy(*group).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(
        "*",
        *[
            F.last(F.col(f"_last_{c}.value"), ignorenulls=True).over(earlier).alias(f"_in_{c}")
            for c in cols
        ],
    )
    carried = pieces.select(
        *group, chunk, F.lit(0).alias("_rank"), *[F.col(f"_in_{c}").alias(c) for c in cols]
    ).filter(_any_set(cols))
    if not back:
        return carried

    # the first value of a chunk after the forward fill: a group that was seen
    # in an earlier chunk has one from its first row on, unless that row has its own
    scope = group if back == "group" else part
    heads = pieces.groupBy(*scope, chunk).agg(
        *[
            F.min(
                F.when(
                    F.col(f"_in_{c}").isNotNull()
                    & ~F.col(f"_lead_{c}.at").eqNullSafe(F.col("_first")),
                    F.struct(F.col("_first").alias("at"), F.col(f"_in_{c}").alias("value")),
                ).otherwise(F.col(f"_lead_{c}"))
            ).alias(f"_head_{c}")
            for c in cols
        ]
    )
    # descending, so that the frame only grows
    later = (
        Window.partitionBy(*scope)
        .orderBy(F.col(chunk).desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    following = heads.select(
        *scope,
        chunk,
        F.lit(2).alias("_rank"),
        *[
            F.last(F.col(f"_head_{c}.value"), ignorenulls=True).over(later).alias(c)
            for c in cols
        ],
    ).filter(_any_set(cols))
    return carried.unionByName(following, allowMissingColumns=True)


def _any_set(cols: Sequence[str]) -> Column:
    return reduce(or_, [F.col(c).isNotNull() for c in cols])


def ffill(df: DataFrame, col: str, part: Sequence[str], **kw) -> DataFrame:
    """Forward fill over a whole part, across group borders."""
    return fill(df, [col], part, **kw)


def ffill_group(
    df: DataFrame, cols: Sequence[str], part: Sequence[str], keys: Sequence[str], **kw
) -> DataFrame:
    """Forward fill per group of a part."""
    return fill(df, cols, part, keys, **kw)


def ffill_then_bfill(
    df: DataFrame,
    cols: Sequence[str],
    part: Sequence[str],
    keys: Sequence[str],
    bfill_scope: str = "part",
    **kw,
) -> DataFrame:
    """Forward fill per group, then backward fill.

    The backward fill runs over the whole part by default; `bfill_scope="group"`
    keeps it inside the group.
    """
    return fill(df, cols, part, keys, back=bfill_scope, **kw)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key by `order`.

    Ranked by row number, for which Spark keeps only the first row per key of
    each map task before the shuffle, so a hot key does not travel.
    """
    return first_n(df, 1, keys, [F.col(o) for o in order])


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key by `order`."""
    return first_n(df, 1, keys, [F.col(o).desc() for o in order])


#: Bitmaps of a filter of repeated keys, 4 kB each, and bits for each key at least.
FILTER_BITMAPS, FILTER_KEY_BITS = 8_192, 8


def keep_last_of_few(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """`keep_last` where most keys come once: only hashes of the keys and rows of repeated keys travel.

    `df` is read three times, so it is a written copy. The hashes that come more than
    once make a filter of 32 MB at most. Rows it lets through, repeated ones and a few others, are
    ranked; the rest stay where they are. Beyond what the filter holds all rows are ranked.
    """
    digest = F.xxhash64(*keys)
    counts = df.select(digest.alias("h")).groupBy("h").agg(F.count("*").alias("n"))
    twice = settle(counts.filter("n > 1").select("h"))
    hashes = twice.count()
    if not hashes:
        return df
    if hashes * FILTER_KEY_BITS > FILTER_BITMAPS * BITMAP_BITS:
        return _keep_last_packed(df, keys, order)
    maps = FILTER_BITMAPS
    # four times the bits that a key must have, where there is room
    while maps > 1 and maps * BITMAP_BITS >= 8 * FILTER_KEY_BITS * hashes:
        maps //= 2
    bitmap = F.pmod(F.shiftright("h", 16), F.lit(maps)).alias("bitmap")
    place = F.pmod(F.col("h"), F.lit(BITMAP_BITS))
    bits = twice.groupBy(bitmap).agg(F.bitmap_construct_agg(place).alias("bits"))
    marked = (
        df.withColumn("h", digest).withColumn("bitmap", bitmap)
        .join(F.broadcast(bits), "bitmap", "left")
        .withColumn("again", F.coalesce(is_set(F.col("bits"), place), F.lit(False)))
    )
    alone = marked.filter(~F.col("again")).select(*df.columns)
    return alone.unionByName(_keep_last_packed(marked.filter("again").select(*df.columns), keys, order))


def _keep_last_packed(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """`keep_last` with text keys as bytes in the shuffle."""
    texts = [k for k in keys if df.schema[k].dataType == StringType()]
    last = keep_last(df.withColumns({k: packed_id(k) for k in texts}), keys, order)
    return last.withColumns({k: plain_id(k) for k in texts})


def first_n(
    df: DataFrame, n: int, part: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """First n rows per part by `order`."""
    ranked = F.row_number().over(Window.partitionBy(*part).orderBy(*order))
    return df.withColumn("_rank", ranked).filter(F.col("_rank") <= n).drop("_rank")


def carry_section(rows: DataFrame, rows_per_chunk: int = 4096) -> DataFrame:
    """Carry the last `section` down a sheet, in row order `r`; "" before the first."""
    columns = rows.columns
    carried = fill(
        rows.withColumn("_chunk", F.floor(F.col("r") / rows_per_chunk)),
        ["section"],
        ["workbook", "sheet"],
        order="r",
        chunk="_chunk",
    )
    return carried.fillna("", subset=["section"]).select(*columns)


#: Sheet rows in which the header of a layout usually is.
HEADER_ROWS = (3, 10)


def next_row_property(rows: DataFrame, properties: DataFrame) -> DataFrame:
    """Per row and column, the property cell of the row below.

    `properties` are the cells of rows labelled as main property, with columns
    (workbook, sheet, r, c, value). Joined on the position, not by a window, so
    that a large sheet spreads over many tasks.
    """
    below = properties.select(
        "workbook", "sheet", (F.col("r") - 1).alias("r"), "c", F.col("value").alias("next_property")
    )
    return rows.join(below, ["workbook", "sheet", "r", "c"], "left")


def _sheets_with_header(grid: DataFrame) -> DataFrame:
    """Per sheet: size, title and header row; null where no row can be the header."""
    sheet = ["workbook", "sheet"]
    text = pystrip("value")
    title = F.when((F.col("c") == 0) & (F.col("r") < 3) & (text != ""), text)
    is_code = (F.col("c") >= 3) & (F.col("r") >= 3) & text.rlike(r"^\d{4}$")
    # one row per title and per sheet row with a code, and one for all other cells of a sheet: a large
    # sheet is combined in the tasks that read it. Titles are keys, as a text or struct that is
    # aggregated makes Spark sort all cells; codes are in other rows than titles
    place = F.when(F.coalesce(is_code, F.lit(False)) | title.isNotNull(), F.col("r"))
    rows = grid.groupBy(*sheet, place.alias("at"), title.alias("text")).agg(
        F.max("r").alias("r"), F.max("c").alias("c"), F.count_if(is_code).alias("codes"))
    r, codes = F.col("at"), F.col("codes")
    titled = F.when(F.col("text").isNotNull(), F.struct("at", "text")).alias("title")
    return rows.select("*", titled).groupBy(*sheet).agg(
        (F.max("r") + 1).alias("n_rows"),
        (F.max("c") + 1).alias("n_cols"),
        F.coalesce(F.min("title")["text"], F.first("sheet")).alias("template_name"),
        F.coalesce(
            F.min(F.when(r.between(*HEADER_ROWS) & (codes > 0), r)),
            # beyond the usual rows the one with the most codes, the first of equals
            F.max(F.when(codes > 0, F.struct("codes", (-r).alias("above"), r.alias("r"))))["r"],
        ).alias("codes_row"),
    )


def rejected_sheets(grid: DataFrame) -> DataFrame:
    """(workbook, sheet, n_rows, n_cols, reason) of the sheets that locate_header sets aside."""
    reason = (
        F.when(F.col("n_rows") < 6, "fewer than 6 rows")
        .when(F.col("n_cols") < 4, "fewer than 4 columns")
        .when(F.col("codes_row").isNull(), "no header row")
    )
    return _sheets_with_header(grid).withColumn("reason", reason).filter("reason is not null").select(
        "workbook", "sheet", "n_rows", "n_cols", "reason")


def locate_header(grid: DataFrame) -> DataFrame:
    """Per sheet: size, header row, first data row and property column.

    The header is the first of rows 3-10 with a four-digit code from column 3
    on; if none of them has one, the row further down with the most such codes.
    Data start behind a `Rows` label in column 1 or at the first number in
    column 2, whichever comes first, else right below the header. The property
    column is the first cell starting with `(` one row below the header, else 8.
    Sheets below six rows or four columns, and sheets without a header, give no
    row here: they are in rejected_sheets, with the reason.
    """
    sheet = ["workbook", "sheet"]
    text = pystrip("value")
    sheets = _sheets_with_header(grid).filter(
        (F.col("n_rows") >= 6) & (F.col("n_cols") >= 4) & F.col("codes_row").isNotNull())
    # one small record per sheet, read several times
    sheets = settle(sheets)
    r, c, top = F.col("r"), F.col("c"), F.col("codes_row")
    rows_label = (c == 1) & (text == "Rows")
    row_number = (c == 2) & normalize_code("value", "dictionary").isNotNull()
    # the row, then labels before numbers, as one number: it is aggregated without a sort
    number = r.cast("bigint") * 2
    start = F.when(rows_label, number).when(row_number, number + 1)
    first = F.col("_start")
    is_property = (r == top + 1) & (c >= 3) & F.col("value").startswith("(")
    found = (
        grid.join(broadcast_if_small(sheets.select(*sheet, "codes_row")), sheet)
        .filter(r > top)
        .filter(rows_label | row_number | is_property)
        .groupBy(*sheet)
        .agg(F.min(start).alias("_start"), F.min(F.when(is_property, c)).alias("prop_col"))
        .withColumn(
            "data_start", (F.floor(first / 2) + 1 - first % 2).cast(grid.schema["r"].dataType)
        )
        .drop("_start")
    )
    return sheets.join(found, sheet, "left").select(
        *sheet,
        "n_rows",
        "n_cols",
        "template_name",
        "codes_row",
        F.coalesce("data_start", top + 1).alias("data_start"),
        F.coalesce("prop_col", F.lit(8)).alias("prop_col"),
    )
