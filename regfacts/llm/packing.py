"""Best-fit packing by large-item matching over a histogram of lengths.

How sequences are filled depends only on how many pieces there are of each
length, a table of at most `capacity` rows. Pieces above a third of the
capacity fit at most twice into a sequence: the longest are matched greedily
with the longest that still fit. Shorter pieces go, longest first, to the
smallest gap that holds them. The plan is made for whole classes of equal
sequences at once; pieces then take their places by their rank among those of
the same length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regfacts.llm.common import Workspace, record_batch, slices, table_rows
from regfacts.llm.registry import query
from regfacts.llm.tokens import encoder, vocabulary

CAPACITY, END = 2048, 0
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _encode(batches: Iterator[pa.RecordBatch], path: str, end: int, capacity: int,
            keep_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        ids = encoder(path).encode([t or "" for t in batch.column("text").to_pylist()])
        rows = []
        for doc, own in zip(batch.column("doc_id").to_pylist(), ids, strict=True):
            own = np.append(own, np.uint32(end)).astype("<u4")
            for n, at in enumerate(range(0, len(own), capacity)):
                part = own[at:at + capacity]
                rows.append((doc, n, at, len(part), zlib.crc32(part.tobytes()), part))
        columns = list(zip(*rows, strict=True)) or [[]] * 6
        out = record_batch(PIECES, columns[:5])
        if keep_ids:
            out = out.append_column("ids", pa.array([x.astype(np.int32) for x in columns[5]], pa.list_(pa.int32())))
        yield out


def token_pieces(docs: DataFrame, tokenizer_path: str, *, end: int = END, capacity: int = CAPACITY,
                 keep_ids: bool = False) -> DataFrame:
    """PIECES of every document, and with keep_ids the array `ids`.

    A null text is empty: its only token is the end. Only documents longer
    than the capacity are cut.
    """
    schema = PIECES + (", ids array<int>" if keep_ids else "")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        partial(_encode, path=tokenizer_path, end=end, capacity=capacity, keep_ids=keep_ids), schema)


def plan_sequences(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Slots (length, first rank, number, first sequence, offset) for all pieces.

    counts: pieces of each length, 1 to capacity. Ranks of a length start at 0;
    the pieces of a slot go to consecutive sequences at the same offset.
    """
    left = {n: c for n, c in counts.items() if c}
    used = dict.fromkeys(left, 0)
    slots: list[tuple[int, int, int, int, int]] = []
    by_gap: dict[int, list[tuple[int, int]]] = {}
    sequences = 0

    def take(length: int, number: int, sequence: int, offset: int) -> None:
        slots.append((length, used[length], number, sequence, offset))
        used[length] += number
        left[length] -= number

    def fits(gap: int, floor: int) -> int:
        return max((n for n, c in left.items() if c and floor < n <= gap), default=0)

    third = capacity // 3
    for a in sorted((n for n in left if n > third), reverse=True):
        while left[a]:
            b = fits(capacity - a, third)
            number = left[a] if not b else min(left[a], left[b]) if a != b else left[a] // 2
            if not number:  # the last one of a length that could only pair with itself
                b = fits(min(capacity - a, a - 1), third)
                number = 1
            take(a, number, sequences, 0)
            if b:
                take(b, number, sequences, a)
            by_gap.setdefault(capacity - a - b, []).append((sequences, number))
            sequences += number
    for a in sorted((n for n in left if n <= third), reverse=True):
        while left[a]:
            gap = min((g for g, v in by_gap.items() if g >= a and v), default=0)
            if gap:
                first, number = by_gap[gap].pop()
            else:
                gap, first = capacity, sequences
                number = -(-left[a] // (capacity // a))
                sequences += number
            each = min(gap // a, left[a])
            full = min(number, left[a] // each)
            for k in range(each):
                take(a, full, first, capacity - gap + k * a)
            by_gap.setdefault(gap - each * a, []).append((first, full))
            rest = 0
            if full < number:
                rest = left[a] if left[a] < gap // a else 0
                for k in range(rest):
                    take(a, 1, first + full, capacity - gap + k * a)
                if rest:
                    by_gap.setdefault(gap - rest * a, []).append((first + full, 1))
            if (open_ := number - full - bool(rest)) > 0:
                by_gap.setdefault(gap, []).append((first + full + bool(rest), open_))
    return slots


def _place(batches: Iterator[pa.RecordBatch], slots: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sequence and offset of every piece by its length and rank."""
    key = slots[:, 0] << 48 | slots[:, 1]
    for batch in batches:
        length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
        at = np.searchsorted(key, length << 48 | rank, "right") - 1
        s = slots[at]
        table = {"sequence_id": s[:, 3] + rank - s[:, 1], "offset": s[:, 4]}
        yield pa.RecordBatch.from_arrays(
            [*[c for c, n in zip(batch.columns, batch.schema.names, strict=True) if n != "rank"],
             *[pa.array(v) for v in table.values()]],
            names=[*[n for n in batch.schema.names if n != "rank"], *table])


def pack(pieces: DataFrame, *, capacity: int = CAPACITY, group_rows: int = 50_000) -> DataFrame:
    """pieces (doc_id, piece, length and more) with sequence_id and offset.

    `pieces` is read several times and must not change between: write it
    first. Ranks are taken inside hashed groups of bounded size and shifted by
    the counts of the groups before, so no length is one task.
    """
    total = pieces.count()
    groups = max(1, -(-total // group_rows))
    group = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(groups)).cast("int")
    counted = pieces.groupBy("length", group.alias("group")).agg(F.count(F.lit(1)).alias("n"))
    before = counted.withColumn("shift", F.sum("n").over(
        Window.partitionBy("length").orderBy("group").rowsBetween(Window.unboundedPreceding, -1))).select(
        "length", "group", F.coalesce("shift", F.lit(0)).alias("shift"))
    order = Window.partitionBy("length", "group").orderBy("doc_id", "piece", "start")
    ranked = pieces.withColumn("group", group).withColumn("own", F.row_number().over(order) - 1) \
        .join(before, ["length", "group"]) \
        .select(*pieces.columns, (F.col("own") + F.col("shift")).alias("rank"))
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = np.array(plan_sequences(histogram, capacity), np.int64).reshape(-1, 5)
    slots = slots[np.lexsort((slots[:, 1], slots[:, 0]))]
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(partial(_place, slots=slots), kind + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, work: Workspace, tokenizer_path: str, *, end: int = END,
                   capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most `capacity` tokens."""
    pieces = token_pieces(docs, tokenizer_path, end=end, capacity=capacity, keep_ids=keep_ids)
    return pack(work.write(pieces, "pieces"), capacity=capacity)


@query()
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and offset."""
    docs = table_rows(spark, sf_dir, "documents")
    return pack_documents(docs, Workspace(spark, "op8"), vocabulary("word_bpe_49k.json"))
