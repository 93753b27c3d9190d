"""Suffix-array deduplication with a run-length index.

A byte is removed if it lies in a string of `length` bytes that starts at
another place too. Anchors bring together the frames (stretches of windows)
that can be equal. Frames whose anchor has one content only are equal as they
stand. Frames of an anchor with several contents are indexed together, block
by block, in a run-compressed Burrows-Wheeler transform, and its matching
statistics mark the windows that occur elsewhere. An anchor with very many
contents is cut finer by hashes, down to single windows, so that no task holds
an unbounded group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regfacts.llm import anchors
from regfacts.llm.common import Workspace, batches_of, record_batch, runs, slices, table_rows, utf8, whole_groups
from regfacts.llm.registry import query
from regfacts.llm.run_index import RunLengthIndex
from regfacts.llm.spans import Finish, finish_spans

LENGTH, KGRAM = 400, 64
#: Contents of one anchor that are indexed in one block; more are cut finer.
GROUP = 512
#: Frames of one index.
INDEX_ROWS = 900
#: Bytes handled at once: about a hundred bytes of arrays for each in a worker.
CHUNK = 1 << 19
STEP = 16

#: From a text to the bytes that are compared.
Code = Callable[[bytes], bytes]

_FRAME = "row1 long, row2 long, anchor long, f1 long, f2 long, lo long, more int, ahead int"
_MARK = "row1 long, row2 long, lo long, hi long"


def _two(digest: bytes) -> tuple[int, int]:
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


def _halves(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)


def _pieces(text: bytes, length: int) -> Iterator[tuple[int, bytes]]:
    """A text in stretches that share length-1 bytes, so that every window lies in one."""
    step = CHUNK - length
    for at in range(0, max(1, len(text) - length + 1), step):
        yield at, text[at:at + step + length - 1]


def _frames(batches: Iterator[pa.RecordBatch], length: int, k: int, code: Code) -> Iterator[pa.RecordBatch]:
    table = anchors.byte_symbols()
    for batch in slices(batches):
        row1, row2 = batch.column("row1").to_numpy(), batch.column("row2").to_numpy()
        parts = [(i, at, piece) for i, text in enumerate(map(code, utf8(batch.column("text")))) if len(text) >= length
                 for at, piece in _pieces(text, length)]
        for a, b in batches_of([len(p[2]) for p in parts], CHUNK // 2):
            body = b"".join(p[2] for p in parts[a:b])
            starts = np.cumsum([0] + [len(p[2]) for p in parts[a:b]])
            h, at, lo, hi = anchors.frames(table[np.frombuffer(body, np.uint8)], starts, length, k)
            view, digest = memoryview(body), xxhash.xxh3_128_digest
            f = _halves([digest(view[x:y + length]) for x, y in zip(lo.tolist(), hi.tolist(), strict=True)])
            part = np.searchsorted(starts, lo, "right") - 1
            of = np.fromiter((p[0] for p in parts[a:b]), np.int64, b - a)[part]
            base = np.fromiter((p[1] for p in parts[a:b]), np.int64, b - a)[part] - starts[part]
            yield record_batch(_FRAME, [row1[of], row2[of], h.view(np.int64), f[:, 0], f[:, 1], lo + base,
                                        (hi - lo).astype(np.int32), (at - lo).astype(np.int32)])


def spans_of(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals [lo, hi) as maximal runs."""
    if not len(lo):
        return lo, hi
    order = np.argsort(lo, kind="stable")
    lo, reach = lo[order], np.maximum.accumulate(hi[order])
    new = np.append(True, lo[1:] > reach[:-1])
    first = np.flatnonzero(new)
    return lo[first], reach[np.append(first[1:], len(lo)) - 1]


def cut(text: bytes, lo: np.ndarray, hi: np.ndarray) -> tuple[int, int, bytes]:
    """(removed bytes, removed runs, what is left) of a text without the intervals."""
    a, b = spans_of(lo, hi)
    at = [0, *b.tolist()]
    kept = b"".join(text[x:y] for x, y in zip(at, [*a.tolist(), len(text)], strict=True))
    return len(text) - len(kept), len(a), kept


def _index(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Marks of the windows that the index finds at another place too."""
    for table in whole_groups(batches, ["anchor"], INDEX_ROWS):
        bodies = table.column("body").to_pylist()
        index = RunLengthIndex(bodies)
        hit = index.matching_statistics() >= length
        row1, row2, lo = (table.column(c).to_numpy() for c in ("row1", "row2", "lo"))
        # windows of one body are its places but for the last length - 1, which cannot match so far
        string = np.repeat(np.arange(len(bodies)), np.diff(np.append(index.starts, index.n)))
        at = np.flatnonzero(hit)
        first = runs(at - np.arange(len(at)), string[at])
        a, b = at[first[:-1]], at[first[1:] - 1]
        s = string[a]
        yield record_batch(_MARK, [row1[s], row2[s], lo[s] + a - index.starts[s], lo[s] + b - index.starts[s] + length])


def _finer(batches: Iterator[pa.RecordBatch], length: int, step: int) -> Iterator[pa.RecordBatch]:
    """Frames cut by the distance of a window to the anchor, in blocks of `step` distances.

    All windows of a block share the core between them; it is the new anchor.
    """
    digest = xxhash.xxh3_128_digest
    for batch in slices(batches):
        out = []
        for r in batch.to_pylist():
            body, ahead, more = r["body"], r["ahead"], r["more"]
            for q in range((ahead - more) // step, ahead // step + 1):
                a, b = max(0, ahead - (q * step + step - 1)), min(more, ahead - q * step)
                core = body[max(0, ahead - q * step):max(0, ahead - q * step - step + 1 + length)]
                key, _ = _two(digest(core + q.to_bytes(4, "big") + r["anchor"].to_bytes(8, "big", signed=True)))
                f1, f2 = _two(digest(body[a:b + length] + (b - a).to_bytes(4, "big")))
                out.append((r["row1"], r["row2"], r["anchor"], r["lo"], key, f1, f2, r["lo"] + a, r["lo"] + b + length,
                            q, r["weight"]))
        yield record_batch(_FINER, list(zip(*out, strict=True)) or [[]] * 11)


_FINER = ("row1 long, row2 long, anchor long, from_lo long, key long, f1 long, f2 long, lo long, hi long, q int, "
          "weight long")


def _marks_of_hot(bodies: DataFrame, work: Workspace, length: int) -> DataFrame:
    """Marks of frames whose anchor has very many contents, by hashes of ever finer cuts."""
    coarse = work.write(bodies.mapInArrow(partial(_finer, length=length, step=STEP), _FINER), "cuts")
    by_content = coarse.groupBy("key", "f1", "f2").agg(F.sum("weight").alias("n"))
    twice = by_content.where("n > 1").select("key", "f1", "f2")
    marks = coarse.join(twice, ["key", "f1", "f2"]).select("row1", "row2", "lo", "hi")
    # cuts of one content whose core occurs with another one
    several = by_content.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("least")).where(
        "m > 1 and least = 1").select("key")
    open_cuts = coarse.join(several, "key").select("row1", "row2", "anchor", F.col("from_lo").alias("lo"), "q").distinct()
    again = bodies.join(open_cuts, ["row1", "row2", "anchor", "lo"]).select(*bodies.columns, "q")
    single = work.write(again.mapInArrow(partial(_single, length=length, step=STEP), _SINGLE), "windows")
    same = single.groupBy("f1", "f2").agg(F.sum("weight").alias("n")).where("n > 1").select("f1", "f2")
    return marks.union(single.join(same, ["f1", "f2"]).select("row1", "row2", "lo", F.col("lo") + F.lit(length)))


_SINGLE = "row1 long, row2 long, f1 long, f2 long, lo long, weight long"


def _single(batches: Iterator[pa.RecordBatch], length: int, step: int) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_128_digest
    for batch in slices(batches):
        out = []
        for r in batch.to_pylist():
            q, ahead = r["q"], r["ahead"]
            for s in range(max(0, ahead - (q * step + step - 1)), min(r["more"], ahead - q * step) + 1):
                out.append((r["row1"], r["row2"], *_two(digest(r["body"][s:s + length])), r["lo"] + s, r["weight"]))
        yield record_batch(_SINGLE, list(zip(*out, strict=True)) or [[]] * 6)


def repeated_bytes(docs: DataFrame, work: Workspace, fields: str, finish: Finish, *, length: int = LENGTH,
                   kgram: int = KGRAM, group: int = GROUP, code: Code = bytes, least: int | None = None) -> DataFrame:
    """docs without text, with `fields` of what `finish` makes of a text and its repeated ranges.

    What is compared is the `code` of a text; texts of fewer than `least` bytes (by default
    `length`) have no window. The ranges cover the bytes in strings of `length` bytes that start
    elsewhere too, in any row. Equal rows are two places. Null and short texts
    have none.
    """
    docs = docs.select(*docs.columns, F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("row1"),
                       F.xxhash64("doc_id", "text").alias("row2"))
    frames = work.write(docs.where(F.octet_length("text") >= (least or length)).select("row1", "row2", "text").mapInArrow(
        partial(_frames, length=length, k=kgram, code=code), _FRAME), "frames")
    # written, so that the join below meets plain shuffles, whose hot keys Spark splits
    shared = work.write(frames.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("c"), F.min("f1").alias("a1"), F.max("f1").alias("b1"), F.min("f2").alias("a2"),
        F.max("f2").alias("b2")).where("c > 1").select("anchor", F.expr("a1 = b1 and a2 = b2").alias("same")), "shared")
    live = work.write(frames.join(shared, "anchor"), "live")
    work.drop("frames")
    mixed = live.where(~F.col("same"))
    contents = work.write(mixed.groupBy("anchor", "f1", "f2").agg(
        F.count(F.lit(1)).alias("weight"), F.min(F.struct("row1", "row2", "lo", "more", "ahead")).alias("at")), "contents")
    copies = mixed.join(contents.where("weight > 1").select("anchor", "f1", "f2"), ["anchor", "f1", "f2"])
    number = work.write(contents.groupBy("anchor").agg(F.count(F.lit(1)).alias("contents"), F.min("weight").alias("least")) \
        .where("least = 1").select("anchor", "contents"), "number")
    to_index = contents.join(number, "anchor").select("at.row1", "at.row2", "anchor", "at.lo", "at.more", "at.ahead",
                                                      "weight", "contents")
    whole = live.where("same").unionByName(copies.select(live.columns)).select(
        "row1", "row2", F.lit(0).cast("long").alias("anchor"), "lo", "more", "ahead", F.lit(0).cast("long").alias("weight"),
        F.lit(0).cast("long").alias("contents"))
    # a set: equal rows share row1 and row2 and have the same marks
    per_row = whole.unionByName(to_index).groupBy("row1", "row2").agg(
        F.collect_set(F.struct("anchor", "lo", "more", "ahead", "weight", "contents")).alias("marks"))

    def search(bodies: DataFrame) -> DataFrame:
        found = bodies.where(F.col("contents") <= group).repartition("anchor").sortWithinPartitions("anchor") \
            .select("row1", "row2", "anchor", "lo", "body").mapInArrow(partial(_index, length=length), _MARK)
        hot = bodies.where(F.col("contents") > group)
        return found if hot.isEmpty() else found.union(_marks_of_hot(work.write(hot, "hot"), work, length))

    return finish_spans(docs, per_row, work, length=length, fields=fields, finish=finish,
                        body=partial(_stretch, code=code), search=search, spent=("shared", "live", "contents", "number"))


def _stretch(text: bytes, lo: np.ndarray, hi: np.ndarray, code: Code) -> list[bytes]:
    text = code(text)
    return [text[a:b] for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]


DIGEST = "n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def digest(text: bytes | None, lo: np.ndarray, hi: np.ndarray) -> tuple:
    """The fields of DIGEST; a null text is empty."""
    removed, n, kept = cut(text or b"", lo, hi)
    return len(text or b""), removed, n, hashlib.sha256(kept).hexdigest()


def clean(text: bytes | None, lo: np.ndarray, hi: np.ndarray) -> tuple[str | None]:
    """The text without the ranges; a character of which a byte stays, stays whole."""
    if text is None:
        return (None,)
    if not len(lo):
        return (text.decode("utf-8", "replace"),)
    edge = np.append(np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80), len(text))
    a, b = spans_of(lo, hi)
    a, b = edge[np.searchsorted(edge, a)], edge[np.searchsorted(edge, b, "right") - 1]
    return (cut(text, a[a < b], b[a < b])[2].decode("utf-8", "replace"),)


def without_repeats(docs: DataFrame, work: Workspace, **options) -> DataFrame:
    """Documents with their own columns and their text without repeated stretches.

    A column n_chars, where there is one, counts the new text.
    """
    return _with_new_text(docs, work, clean, **options)


#: Words of the stretches that without_repeated_words removes, and bytes that stand for a word.
WORDS, WORD_BYTES = 50, 6


def word_places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of bytes.split(), in 16 bytes a word, however long the text."""
    byte = np.frombuffer(text, np.uint8)
    inside = np.zeros(len(byte) + 2, np.int8)
    inside[1:-1] = (byte != 32) & ((byte < 9) | (byte > 13))
    edges = np.flatnonzero(np.diff(inside))
    return edges[::2], edges[1::2]


def coded(text: bytes) -> bytes:
    """WORD_BYTES of hash for every word."""
    return b"".join([xxhash.xxh3_64_digest(w)[:WORD_BYTES] for w in text.split()])


def clean_words(text: bytes | None, lo: np.ndarray, hi: np.ndarray) -> tuple[str | None]:
    """The text without the words in ranges of its code."""
    if text is None:
        return (None,)
    if len(lo):
        a, b = spans_of(lo, hi)
        a, b = -(-a // WORD_BYTES), b // WORD_BYTES
        start, end = word_places(text)
        text = cut(text, start[a[a < b]], end[b[a < b] - 1])[2]
    return (text.decode("utf-8", "replace"),)


def _with_new_text(docs: DataFrame, work: Workspace, finish: Finish, **options) -> DataFrame:
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    out = repeated_bytes(docs.select("doc_id", "text", rest.alias("rest")), work, "clean string", finish, **options)
    new = {"text": F.col("clean"), "n_chars": F.length(F.coalesce("clean", F.lit(""))).cast("long")}
    return out.select(*[new.get(c, F.col("rest")[c]).alias(c) for c in docs.columns])


def without_repeated_words(docs: DataFrame, work: Workspace, *, words: int = WORDS, kgram: int = 8) -> DataFrame:
    """Documents with their own columns and their text without stretches of `words` words that occur elsewhere too.

    A word counts as WORD_BYTES of its hash, so a stretch of short words is as
    long as one of long words, and white space between words does not matter. Texts
    travel as they are; a worker codes them where it needs them.
    """
    return _with_new_text(docs, work, clean_words, length=words * WORD_BYTES, kgram=kgram * WORD_BYTES, code=coded,
                          least=2 * words - 1)


@query()
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes, removed bytes and runs, and hash of what is left, of every document.

    Null texts are empty: zero bytes and the hash of nothing. Equal rows
    remove each other.
    """
    docs = table_rows(spark, sf_dir, "documents").select("doc_id", "text")
    return repeated_bytes(docs, Workspace(spark, "op10", batch_rows=1000), DIGEST, digest)
