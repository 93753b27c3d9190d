"""Open keys, fact ids and natural keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regfacts import fixed
from regfacts.functions.text import ColumnOrName, as_col, pystrip
from regfacts.schema import NATURAL_KEY


def is_open_key(c: ColumnOrName) -> Column:
    """True for text such as `name = value | name = value`; false for null."""
    c = as_col(c)
    return F.coalesce(c.contains(" = ") | c.contains(" | "), F.lit(False))


def parse_open_key(c: ColumnOrName) -> Column:
    """`name = value | …` as array<struct<name,value>>.

    Each part is cut at its first `=`; parts without one, and blank names or
    values, are left out.
    """
    pairs = F.transform(
        F.filter(F.split(as_col(c), "[|]"), lambda p: p.contains("=")),
        lambda p: F.struct(
            pystrip(F.substring_index(p, "=", 1)).alias("name"),
            pystrip(F.substr(p, F.locate("=", p) + 1)).alias("value"),
        ),
    )
    return F.filter(pairs, lambda x: (x["name"] != "") & (x["value"] != ""))


def fact_id(parts: Sequence[ColumnOrName]) -> Column:
    """SHA-256 hex of the parts joined by the unit separator, null as empty."""
    texts = [F.coalesce(as_col(p).cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws("\u001f", *texts), 256)


def packed_id(c: ColumnOrName) -> Column:
    """Any text as bytes that tell texts apart; a lowercase SHA-256 in hex takes half its length."""
    c = as_col(c)
    return F.when(c.rlike("^[0-9a-f]{64}$"), F.concat(F.lit(b"\x01"), F.unhex(c))).otherwise(
        F.concat(F.lit(b"\x00"), c.cast("binary")))


def plain_id(c: ColumnOrName) -> Column:
    """The text that `packed_id` made bytes of."""
    c = as_col(c)
    rest = F.substring(c, 2, 1 << 30)
    return F.when(F.substring(c, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


#: Bits of one bitmap, as `bitmap_construct_agg` makes it.
BITMAP_BITS = 32_768


def is_set(bits: Column, place: Column) -> Column:
    """Whether a bit of a bitmap is set; bit 0 is the lowest of the first byte."""
    byte = F.substring(bits, (place / 8).cast("int") + 1, F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(place, F.lit(8)).cast("int")) == 1


def natural_key(df: DataFrame, columns: Sequence[str] = NATURAL_KEY) -> Column:
    """`entity|template|row|column|cell|date` as one text, null as one token."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing key columns: {', '.join(missing)}")
    return F.concat_ws(
        "|", *[F.coalesce(F.col(c).cast("string"), F.lit(fixed.KEY_NULL_TOKEN)) for c in columns]
    )
