"""Merging new rows into stored ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regfacts.functions import natural_key, parse_open_key
from regfacts.operators.joins import split_incremental, union_all
from regfacts.operators.windows import keep_first, keep_last


def new_rows(
    new: DataFrame, existing: DataFrame | None, key: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """First row of each key that is not stored yet.

    Repeats inside `new` go first: a hot key is down to one row before the join.
    """
    first = keep_first(new, key, order)
    if existing is None:
        return first
    return first.join(existing.select(*key).distinct(), list(key), "left_anti")


def upsert_ignore(
    new: DataFrame, existing: DataFrame | None, key: Sequence[str], order: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Insert if absent, first wins: (table, one-row counts).

    `skipped` counts the repeats inside the batch too. Keys must not be null.
    """
    inserted = new_rows(new, existing, key, order)
    table = inserted if existing is None else union_all([existing, inserted])
    counts = union_all(
        [
            new.agg(F.count("*").alias("rows"), F.lit(0).alias("inserted")),
            inserted.agg(F.lit(0).alias("rows"), F.count("*").alias("inserted")),
        ]
    ).agg(
        F.sum("inserted").cast("bigint").alias("inserted"),
        (F.sum("rows") - F.sum("inserted")).cast("bigint").alias("skipped"),
    )
    return table, counts


def upsert_replace(
    new: DataFrame, existing: DataFrame | None, key: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Last row wins, over stored rows and inside the batch."""
    last = keep_last(new, key, order)
    if existing is None:
        return last
    kept = existing.join(last.select(*key), list(key), "left_anti")
    return kept.unionByName(last.select(*existing.columns))


def upsert_columns(
    new: DataFrame,
    existing: DataFrame | None,
    key: Sequence[str],
    cols: Sequence[str],
) -> DataFrame:
    """Insert, or on a known key set only `cols`; other columns stay.

    `new` has one row per key. A null in `new` is a value and is written.
    """
    if existing is None:
        return new
    old, fresh = existing.alias("old"), new.withColumn("_new", F.lit(True)).alias("fresh")
    updated = F.col("fresh._new").isNotNull()
    joined = old.withColumn("_old", F.lit(True)).alias("old").join(fresh, list(key), "full_outer")
    out = []
    for c in existing.columns:
        if c in key:
            out.append(F.col(c))
        elif c in cols:
            out.append(F.when(updated, F.col(f"fresh.{c}")).otherwise(F.col(f"old.{c}")).alias(c))
        elif c in new.columns:
            out.append(
                F.when(F.col("old._old").isNotNull(), F.col(f"old.{c}"))
                .otherwise(F.col(f"fresh.{c}"))
                .alias(c)
            )
        else:
            out.append(F.col(f"old.{c}").alias(c))
    return joined.select(*out)


def append_incremental(
    new: DataFrame, existing: DataFrame | None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(stored rows with the new ones appended, appended rows, skipped rows)."""
    appended, skipped = split_incremental(new, existing)
    combined = appended if existing is None else union_all([existing, appended])
    return combined, appended, skipped


def skipped_keys(new: DataFrame, existing: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(distinct keys already stored, one-row count of the skipped rows)."""
    _, skipped = split_incremental(new, existing)
    keys = skipped.select(natural_key(skipped).alias("fact_key")).distinct()
    return keys, skipped.agg(F.count("*").alias("skipped"))


def explode_dimensions(facts: DataFrame, *carry: str) -> DataFrame:
    """Bridge of open dimensions, unique on all three columns; `carry` are more columns of the facts.

    Facts are unique by id, so repeats can only come from one open key: they are
    removed inside the row, without a shuffle. Facts without their ids, as for counts, give rows without.
    """
    return facts.filter(F.col("open_key").isNotNull()).select(
        *[c for c in ("fact_id",) if c in facts.columns],
        F.inline(F.array_distinct(parse_open_key("open_key"))).alias(
            "dimension_name", "dimension_value"
        ),
        *carry,
    )
