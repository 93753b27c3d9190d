"""Substring deduplication by relative Lempel-Ziv parsing.

A word goes if it lies in a window of `length` words whose sequence also starts
in a document of smaller id. Anchors bring together the frames (stretches of
windows) that can be equal. Frames of one anchor with a single content are
covered by their first document. For anchors with several contents, the frames
of documents in ascending order are factored greedily against the reference
block of all smaller documents' frames; factors of at least `length` words are
duplicate spans, and the windows across a factor's end are looked up one by
one. An anchor with very many contents is compared by hashes of single windows
instead, so that no task holds an unbounded group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regfacts.llm import anchors
from regfacts.llm.common import Workspace, batches_of, record_batch, runs, slices, table_rows, utf8, whole_groups
from regfacts.llm.registry import query
from regfacts.llm.spans import Finish, finish_spans
from regfacts.llm.suffix_dedup import spans_of

LENGTH, KGRAM = 13, 4
#: Contents of one anchor that are parsed in one block.
GROUP = 512
#: Bits of the filter of shared anchors; it only saves shuffled rows, so its size is fixed.
FILTER_BITS = 26

_FRAME = "row1 long, row2 int, anchor long, f long, lo int, more int"
_MARK = "row1 long, row2 int, lo int, hi int"
_NUMBERS: dict[bytes, int] = {}
CACHE = 300_000


def symbols(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words."""
    known = _NUMBERS
    if len(known) > CACHE:
        known.clear()
    h = xxhash.xxh3_64_intdigest
    return np.fromiter((known[w] if w in known else known.setdefault(w, h(w)) for w in words), np.uint64, len(words))


def _penalty(words: list[bytes], k: int) -> np.ndarray:
    """Short words in every k-gram, 3 at most: stretches of short words are common and make poor anchors."""
    short = np.append(0, np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) <= 3))
    return np.minimum(short[k:] - short[:-k], 3)


def _frames(batches: Iterator[pa.RecordBatch], length: int, k: int, shared) -> Iterator[pa.RecordBatch]:
    bits = None if shared is None else shared.value
    step = anchors.CHUNK // 4
    for batch in slices(batches):
        row1, row2 = batch.column("row1").to_numpy(), batch.column("row2").to_numpy()
        parts = []
        for i, text in enumerate(utf8(batch.column("text"))):
            words = text.split()
            if len(words) >= length:
                parts += [(i, at, words[at:at + step + length - 1]) for at in range(0, len(words) - length + 1, step)]
        for a, b in batches_of([len(p[2]) for p in parts], step):
            words = [w for p in parts[a:b] for w in p[2]]
            starts = np.cumsum([0] + [len(p[2]) for p in parts[a:b]])
            own = symbols(words)
            h, _, lo, hi = anchors.frames(own, starts, length, k, _penalty(words, k))
            if bits is not None:
                at = h >> np.uint64(64 - FILTER_BITS)
                use = (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
                h, lo, hi = h[use], lo[use], hi[use]
            data, digest = memoryview(own.tobytes()), xxhash.xxh3_64_intdigest
            f = np.fromiter((digest(data[8 * x:8 * (y + length)]) for x, y in zip(lo.tolist(), hi.tolist(), strict=True)),
                            np.uint64, len(lo))
            part = np.searchsorted(starts, lo, "right") - 1
            of = np.fromiter((p[0] for p in parts[a:b]), np.int64, b - a)[part]
            base = np.fromiter((p[1] for p in parts[a:b]), np.int64, b - a)[part] - starts[part]
            yield record_batch(_FRAME, [row1[of], row2[of], h.view(np.int64), f.view(np.int64),
                                        (lo + base).astype(np.int32), (hi - lo).astype(np.int32)])


class ReferenceBlock:
    """Word sequences of smaller documents, indexed by their windows."""

    def __init__(self, length: int):
        self.size = 8 * length
        self.data = bytearray()
        self.windows: dict[bytes, int] = {}

    def add(self, body: bytes) -> None:
        at = len(self.data)
        self.data += body
        for i in range(0, len(body) - self.size + 1, 8):
            self.windows.setdefault(body[i:i + self.size], at + i)

    def parse(self, body: bytes) -> list[tuple[int, int]]:
        """Factors (first word, end) of at least `length` words, which together hold every window found.

        A factor goes on as long as its windows are in the block; the windows
        across its end are looked up in turn.
        """
        out: list[tuple[int, int]] = []
        i, last = 0, len(body) - self.size
        while i <= last:
            at = self.windows.get(body[i:i + self.size])
            if at is None:
                i += 8
                continue
            stop = i + self.size
            at += self.size
            while stop < len(body) and body[stop:stop + 8] == self.data[at:at + 8] \
                    and self.windows.get(body[stop + 8 - self.size:stop + 8]) is not None:
                stop, at = stop + 8, at + 8
            out.append((i // 8, stop // 8))
            i = stop - self.size + 8
        return out


def _parse(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for table in whole_groups(batches, ["anchor"], 4000):
        row1, row2, lo = (table.column(c).to_pylist() for c in ("row1", "row2", "lo"))
        body = table.column("body").to_pylist()
        out = []
        at = runs(table.column("anchor").to_numpy())
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            block, waiting, doc = ReferenceBlock(length), [], row1[a]
            for i in range(a, b):
                if row1[i] != doc:
                    for x in waiting:
                        block.add(x)
                    waiting, doc = [], row1[i]
                out += [(row1[i], row2[i], lo[i] + x, lo[i] + y) for x, y in block.parse(body[i])]
                waiting.append(body[i])
        yield record_batch(_MARK, list(zip(*out, strict=True)) or [[]] * 4)


_WINDOW = "row1 long, row2 int, lo int, w1 long, w2 long"


def _windows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        out = []
        for r1, r2, lo, body in zip(*(batch.column(c).to_pylist() for c in ("row1", "row2", "lo", "body")), strict=True):
            for i in range(len(body) // 8 - length + 1):
                d = xxhash.xxh3_128_digest(body[8 * i:8 * (i + length)])
                out.append((r1, r2, lo + i, int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)))
        yield record_batch(_WINDOW, list(zip(*out, strict=True)) or [[]] * 5)


def _of_hot(bodies: DataFrame, work: Workspace, length: int) -> DataFrame:
    """Marks of frames whose anchor has very many contents: windows that a smaller document has too."""
    each = work.write(bodies.mapInArrow(partial(_windows, length=length), _WINDOW), "windows")
    first = work.write(each.groupBy("w1", "w2").agg(F.min("row1").alias("first"), F.max("row1").alias("last"))
                       .where("first < last").drop("last"), "first-windows")
    return each.join(first, ["w1", "w2"]).where("row1 > first").select(
        "row1", "row2", "lo", (F.col("lo") + F.lit(length)).alias("hi"))


def _filter(shared: DataFrame) -> np.ndarray:
    """A bit for every value of the leading FILTER_BITS bits that a shared anchor has; 2^(FILTER_BITS - 6) rows at most."""
    at = F.shiftrightunsigned("anchor", 64 - FILTER_BITS)
    words = shared.groupBy(F.shiftright(at, 6).cast("int").alias("n")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(shiftrightunsigned(anchor, %d) & 63 as int))" % (64 - FILTER_BITS))).alias("w"))
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    table = words.toArrow()
    out[table.column("n").to_numpy()] = table.column("w").to_numpy()
    return out.view(np.uint8)


def repeated_words(docs: DataFrame, work: Workspace, fields: str, finish: Finish, *, length: int = LENGTH,
                   kgram: int = KGRAM, group: int = GROUP) -> DataFrame:
    """doc_id with `fields` of what `finish` makes of a text and its word ranges that smaller ids have too.

    Rows of one id do not remove each other. Rows of null id remove nothing
    and lose nothing. Null and short texts have no marks.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text", F.col("doc_id").cast("long").alias("row1"),
                       F.pmod(F.xxhash64("text"), F.lit(0x7FFFFFFF)).cast("int").alias("row2"))
    source = docs.where(F.col("row1").isNotNull() & F.col("text").isNotNull()).select("row1", "row2", "text")

    def frames(sent) -> DataFrame:
        return source.mapInArrow(partial(_frames, length=length, k=kgram, shared=sent), _FRAME)

    shared = work.write(frames(None).groupBy("anchor").agg(
        F.min("row1").alias("first"), F.max("row1").alias("last"), F.min("f").alias("a"), F.max("f").alias("b"))
        .where("first < last").select("anchor", "first", F.expr("a = b").alias("same")), "shared")
    sent = spark.sparkContext.broadcast(_filter(shared))  # 2^FILTER_BITS bits, whatever the data
    live = work.write(frames(sent).join(shared, "anchor").where("not same or row1 > first")
                      .select("row1", "row2", "anchor", "f", "lo", "more", "same"), "live")
    mixed = live.where(~F.col("same"))
    contents = work.write(mixed.groupBy("anchor", "f").agg(F.min("row1").alias("first")), "contents")
    number = work.write(contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("contents")), "number")
    of_content = mixed.join(contents, ["anchor", "f"])
    zero = F.lit(0).cast("long")
    whole = live.where("same").select("row1", "row2", zero.alias("anchor"), "lo", "more", zero.alias("contents")).union(
        of_content.where("row1 > first").select("row1", "row2", zero, "lo", "more", zero))
    to_parse = of_content.where("row1 = first").join(number, "anchor").select(
        "row1", "row2", "anchor", "lo", "more", "contents")
    per_row = whole.union(to_parse).groupBy("row1", "row2").agg(
        F.collect_list(F.struct("anchor", "lo", "more", "contents")).alias("marks"))

    def search(bodies: DataFrame) -> DataFrame:
        found = bodies.where(F.col("contents") <= group).repartition("anchor").sortWithinPartitions("anchor", "row1") \
            .select("row1", "row2", "anchor", "lo", "body").mapInArrow(partial(_parse, length=length), _MARK)
        hot = bodies.where(F.col("contents") > group)
        return found if hot.isEmpty() else found.union(_of_hot(work.write(hot, "hot"), work, length))

    return finish_spans(docs, per_row, work, length=length, fields=fields, finish=finish, body=_stretch, search=search)


def _stretch(text: bytes, lo: np.ndarray, hi: np.ndarray) -> list[bytes]:
    data = symbols(text.split()).tobytes()
    return [data[8 * a:8 * b] for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]


def kept_words(text: bytes, lo: np.ndarray, hi: np.ndarray) -> tuple[int, list[bytes]]:
    """(words, words outside the ranges)."""
    words = text.split()
    a, b = spans_of(lo, hi)
    at = [0, *b.tolist()]
    return len(words), [w for x, y in zip(at, [*a.tolist(), len(words)], strict=True) for w in words[x:y]]


DIGEST = "n_words long, n_removed long, kept_sha256 string"


def digest(text: bytes | None, lo: np.ndarray, hi: np.ndarray) -> tuple:
    """The fields of DIGEST; a null text has no words."""
    n, kept = kept_words(text or b"", lo, hi)
    return n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def clean(text: bytes | None, lo: np.ndarray, hi: np.ndarray) -> tuple[str | None]:
    """The words outside the ranges, joined by one space; texts without ranges stay as they are."""
    if text is None or not len(lo):
        return (None if text is None else text.decode("utf-8", "replace"),)
    return (b" ".join(kept_words(text, lo, hi)[1]).decode("utf-8", "replace"),)


@query()
def op4_relative_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, removed words and hash of what is left, of every document; null texts have no words."""
    docs = table_rows(spark, sf_dir, "documents").select("doc_id", "text")
    return repeated_words(docs, Workspace(spark, "op4"), DIGEST, digest)
