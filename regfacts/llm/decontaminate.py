"""Benchmark decontamination by pigeonhole edit matching.

A test item is cut into one piece more than the edits allowed. If a text holds
the item within that budget, at least one piece is untouched. Pieces are
sought by exact matching, and each hit is verified with Myers' bit-parallel
edit distance over the stretch of text that the hit allows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regfacts.llm.common import record_batch, slices, table_rows
from regfacts.llm.registry import query

#: Edits allowed, as a share of an item's characters.
ERROR_SHARE = 0.06
#: Characters of items that one matcher holds; more items go in further passes over the texts.
BLOCK_CHARS = 4_000_000

HITS = "item_id long, item_start long, item_end long, distance int"
_SPACE = re.compile(r"\s+")


def normalized(text: str | None) -> str:
    """Lower case, one space for white space, none at the ends."""
    return _SPACE.sub(" ", (text or "").lower()).strip()


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """budget + 1 consecutive pieces of about equal length, with their places."""
    n = budget + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def best_match(item: str, text: str) -> tuple[int, int]:
    """(distance, end) of the substring of text nearest to item; the first end of several.

    Myers' bit-parallel columns; a Python integer holds one column.
    """
    m = len(item)
    eq: dict[str, int] = {}
    for i, c in enumerate(item):
        eq[c] = eq.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text):
        x = eq.get(c, 0)
        d0 = ((((x & pv) + pv) ^ pv) | x | mv) & full
        hp, hn = mv | ~(d0 | pv) & full, pv & d0
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp = hp << 1 & full
        pv, mv = (hn << 1 | ~(d0 | hp)) & full, hp & d0
        if score < best:
            best, end = score, j + 1
    return best, end


class Matcher:
    """Finds items of a block in texts."""

    def __init__(self, items: list[tuple[int, str]], error_share: float):
        self.items = [(i, s, int(len(s) * error_share)) for i, s in items if s]
        places: dict[str, list[tuple[int, int]]] = {}
        for n, (_, item, budget) in enumerate(self.items):
            for at, piece in pieces(item, budget):
                places.setdefault(piece, []).append((n, at))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item_id, start, end, distance) of the best place of every item within its budget.

        Places are characters of the normalised text.
        """
        if not self.items or not text:
            return []
        # hits of one item whose diagonals lie within its budget are one stretch to verify
        starts: dict[int, set[int]] = {}
        for end, (size, where) in self.automaton.iter(text):
            for n, at in where:
                starts.setdefault(n, set()).add(end + 1 - size - at)
        out = []
        for n, found in starts.items():
            item_id, item, budget = self.items[n]
            best = None
            reach = -1
            for lo in sorted(found):
                if lo <= reach:
                    continue
                reach = lo + budget  # this stretch covers the starts up to here
                a, b = max(0, lo - budget), lo + len(item) + 2 * budget
                if text.startswith(item, max(0, lo)) and lo >= 0:
                    d, e = 0, lo + len(item)
                else:
                    d, e = best_match(item, text[a:b])
                    e += a
                if d <= budget and (best is None or d < best[0]):
                    best = (d, e)
                    if not d:
                        break
            if best:
                d, e = best
                # the start: the nearest prefix seen from the end
                back = text[max(0, e - len(item) - d):e][::-1]
                out.append((item_id, e - best_match(item[::-1], back)[1], e, d))
        return out


def _blocks(items: DataFrame, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """Items with an id and a text, in blocks of bounded size, read one partition at a time."""
    block, size = [], 0
    for row in items.where("item_id is not null and text is not null").select("item_id", "text").toLocalIterator():
        text = normalized(row.text)
        block.append((row.item_id, text))
        size += len(text)
        if size >= block_chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_items(docs: DataFrame, items: DataFrame, *, error_share: float = ERROR_SHARE,
               block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id and HITS for every item that a text holds within its edit budget, best place first found.

    Whole texts, whole items. Items are matched block by block, so what is
    sent to the tasks is bounded whatever the number of items; each block is
    one pass over the texts without a shuffle. Null or blank texts and items
    match nothing; rows of null id keep a null id.
    """
    schema = "doc_id long, " + HITS
    out = None
    for block in _blocks(items, block_chars):
        def search(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(block, error_share)
            for batch in slices(batches):
                rows = [(d, *hit) for d, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(),
                                                  strict=True) for hit in matcher.find(normalized(t))]
                yield record_batch(schema, list(zip(*rows, strict=True)) or [[]] * 5)

        hits = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(search, schema)
        out = hits if out is None else out.union(hits)
    return docs.sparkSession.createDataFrame([], T._parse_datatype_string(schema)) if out is None else out


def clean_documents(docs: DataFrame, items: DataFrame, *, error_share: float = ERROR_SHARE,
                    block_chars: int = BLOCK_CHARS) -> DataFrame:
    """docs without those that hold an item; a narrow pass for every block of items."""
    for block in _blocks(items, block_chars):
        docs = docs.where(~F.arrow_udf(_leaks(block, error_share), "boolean").asNondeterministic()(F.col("text")))
    return docs


def _leaks(block: list[tuple[int, str]], error_share: float) -> Callable[[pa.Array], pa.Array]:
    def leaks(text: pa.Array) -> pa.Array:
        matcher = _cached(block, error_share)
        return pa.array([bool(matcher.find(normalized(t))) for t in text.to_pylist()], pa.bool_())

    return leaks


_MATCHERS: dict[int, tuple[list, Matcher]] = {}


def _cached(block: list[tuple[int, str]], error_share: float) -> Matcher:
    """One matcher for all batches of a task."""
    held = _MATCHERS.get(0)
    if held is None or held[0] is not block:
        _MATCHERS[0] = (block, Matcher(block, error_share))
    return _MATCHERS[0][1]


@query()
def op5_benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item within its edit budget, one row for each item held."""
    return find_items(table_rows(spark, sf_dir, "documents"), table_rows(spark, sf_dir, "benchmark"))
