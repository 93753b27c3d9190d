"""Blank, missing and trimmed text."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from regfacts import fixed

ColumnOrName = Column | str


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pystrip(c: ColumnOrName) -> Column:
    """Strip every kind of whitespace; plain `trim` strips spaces only."""
    return F.btrim(as_col(c), F.lit(fixed.PY_WHITESPACE))


def is_missing(c: ColumnOrName) -> Column:
    return as_col(c).isNull()


def nonblank(c: ColumnOrName) -> Column:
    """True where the stripped text is not empty; false for null."""
    return F.coalesce(F.length(pystrip(c)) > 0, F.lit(False))


def clean_text(c: ColumnOrName, strip: bool = True) -> Column:
    """Stripped text; empty or `nan` in any case becomes null.

    `strip=False` for text that is stripped already: a caller that needs the
    stripped text several times should strip it once, in a projection below.
    """
    text = pystrip(c) if strip else as_col(c)
    return F.when(~F.lower(text).isin("", "nan"), text)


def drop_na_tokens(c: ColumnOrName, tokens: Iterable[str] = fixed.NA_TOKENS) -> Column:
    """Null where the whole text is one of the missing-value tokens."""
    c = as_col(c)
    tokens = list(tokens)
    return F.when(~c.isin(tokens), c) if tokens else c


#: Between packed texts, before escaped characters, and a null text.
_UNIT, _ESCAPE, _NULL = "\u001f", "\u001b", "\u001bN"
_PACKED = "_texts"


def _packable(df: DataFrame, keep: Sequence[str]) -> list[str]:
    return [f.name for f in df.schema if f.dataType == StringType() and f.name not in keep]


def pack_texts(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """`df` with its text columns other than `keep` as one text, for a shuffle of wide rows.

    A row in a shuffle has eight bytes and a padded value for every column, most of which
    differ from row to row. Any text, and null, comes back by `unpack_texts`.
    """
    texts = _packable(df, keep)
    if len(texts) < 2:
        return df

    def escaped(c: str) -> Column:
        plain = F.replace(F.col(f"`{c}`"), F.lit(_ESCAPE), F.lit(_ESCAPE + "0"))
        return F.coalesce(F.replace(plain, F.lit(_UNIT), F.lit(_ESCAPE + "1")), F.lit(_NULL))

    rest = [F.col(f"`{c}`") for c in df.columns if c not in texts]
    return df.select(*rest, F.concat_ws(_UNIT, *[escaped(c) for c in texts]).alias(_PACKED))


def unpack_texts(packed: DataFrame, like: DataFrame) -> DataFrame:
    """The rows that `pack_texts` packed, with the columns of `like`, which was packed (or its ids before)."""
    if _PACKED not in packed.columns:
        return packed
    texts = [c for c in like.columns if c not in packed.columns]

    def plain(i: int) -> Column:
        # works on bytes, where a split decodes
        part = F.substring_index(F.substring_index(F.col(_PACKED), _UNIT, i + 1), _UNIT, -1)
        text = F.replace(part, F.lit(_ESCAPE + "1"), F.lit(_UNIT))
        return F.when(part != _NULL, F.replace(text, F.lit(_ESCAPE + "0"), F.lit(_ESCAPE)))

    return packed.select(*[
        plain(texts.index(c)).alias(c) if c in texts else F.col(f"`{c}`") for c in like.columns])


def to_json_list(c: ColumnOrName) -> Column:
    """A list as JSON text; a missing list is an empty one."""
    return F.coalesce(F.to_json(as_col(c)), F.lit("[]"))
