"""Token files of fixed-width packed ids, with block offsets for random access.

An id takes as many bits as the largest id of the vocabulary needs. A file is

    magic 'PKID' | version u16 | bits u16 | block ids u32 | ids u64 | documents u64
    block offsets, (blocks + 1) x u64, from the start of the packed blocks
    document starts, (documents + 1) x u64, in ids
    document ids, documents x i64, and a byte for each that tells whether it is null
    packed blocks

with numbers in little-endian order and bits in big-endian order inside a
block; every block starts at a byte.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regfacts.llm.common import Workspace, dealt_files, file_system, record_batch, slices, table_rows
from regfacts.llm.registry import query
from regfacts.llm.tokens import encoder, vocabulary

END, BLOCK_IDS = 2, 8192
HEAD = struct.Struct("<4sHHIQQ")
#: Text of one file; an executor holds one file's ids at a time.
FILE_BYTES = 16 << 20
FILES = "path string, first long, n_docs long, n_ids long"
TOKENS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def width(vocabulary_size: int) -> int:
    """The least bits that hold every id below the size."""
    return max(1, (vocabulary_size - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    if bits in (8, 16, 32):
        return ids.astype(f">u{bits // 8}").tobytes()
    shifts = np.arange(bits - 1, -1, -1, dtype=np.uint32)
    return np.packbits((ids.astype(np.uint32)[:, None] >> shifts & 1).astype(np.uint8).ravel()).tobytes()


def unpack_bits(data: bytes, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f">u{bits // 8}", n).astype(np.uint32)
    raw = np.unpackbits(np.frombuffer(data, np.uint8), count=n * bits).reshape(n, bits)
    weights = np.left_shift(1, np.arange(bits - 1, -1, -1, dtype=np.uint64), dtype=np.uint64)
    return (raw @ weights).astype(np.uint32)


def write_file(sink, docs: list[int | None], ids: list[np.ndarray], bits: int, block_ids: int = BLOCK_IDS) -> int:
    """Write documents to a binary sink; the number of ids."""
    flat = np.concatenate([np.zeros(0, np.uint32), *ids])
    if len(flat) and int(flat.max()) >> bits:
        raise ValueError(f"an id does not fit {bits} bits")
    blocks = [pack_bits(flat[at:at + block_ids], bits) for at in range(0, len(flat), block_ids)]
    sink.write(HEAD.pack(b"PKID", 1, bits, block_ids, len(flat), len(docs)))
    sink.write(np.cumsum([0, *map(len, blocks)]).astype("<u8").tobytes())
    sink.write(np.cumsum([0, *map(len, ids)]).astype("<u8").tobytes())
    sink.write(np.array([d or 0 for d in docs], "<i8").tobytes())
    sink.write(np.array([d is None for d in docs], np.uint8).tobytes())
    for b in blocks:
        sink.write(b)
    return len(flat)


class TokenFile:
    """Random access to a file through a seekable source."""

    def __init__(self, source):
        self.source = source
        magic, version, self.bits, self.block_ids, self.n_ids, n_docs = HEAD.unpack(source.read(HEAD.size))
        if (magic, version) != (b"PKID", 1):
            raise ValueError("not a packed token file of version 1")
        blocks = -(-self.n_ids // self.block_ids)
        self.offsets = np.frombuffer(source.read(8 * (blocks + 1)), "<u8").astype(np.int64)
        self.starts = np.frombuffer(source.read(8 * (n_docs + 1)), "<u8").astype(np.int64)
        docs = np.frombuffer(source.read(8 * n_docs), "<i8")
        null = np.frombuffer(source.read(n_docs), np.uint8)
        self.docs = [None if x else int(d) for d, x in zip(docs, null, strict=True)]
        self.base = HEAD.size + 8 * (blocks + 1) + 8 * (n_docs + 1) + 9 * n_docs

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start to stop, of which only the blocks they lie in are read."""
        if start >= stop:
            return np.zeros(0, np.uint32)
        a, b = start // self.block_ids, (stop - 1) // self.block_ids + 1
        self.source.seek(self.base + int(self.offsets[a]))
        data = self.source.read(int(self.offsets[b] - self.offsets[a]))
        parts = []
        for k in range(a, b):
            at = int(self.offsets[k] - self.offsets[a])
            n = min(self.block_ids, self.n_ids - k * self.block_ids)
            parts.append(unpack_bits(data[at:at + int(self.offsets[k + 1] - self.offsets[k])], self.bits, n))
        return np.concatenate(parts)[start - a * self.block_ids:stop - a * self.block_ids]

    def document(self, n: int) -> np.ndarray:
        return self.ids(int(self.starts[n]), int(self.starts[n + 1]))


def _write(batches: Iterator[pa.RecordBatch], folder: str, path: str, end: int) -> Iterator[pa.RecordBatch]:
    """Files of about FILE_BYTES of text each, in the order of the rows.

    A name is used once, so that a repeated task never touches the files of
    another attempt; only names that a finished task returns are read.
    """
    fs, where = file_system(folder)
    fs.create_dir(where, recursive=True)
    held_docs, held_ids, size = [], [], 0

    def flush() -> pa.RecordBatch:
        name = f"{where}/{uuid.uuid4().hex}.pkid"
        with fs.open_output_stream(name, compression=None) as sink:
            n = write_file(sink, held_docs, held_ids, width(max(encoder(path).size, end + 1)))
        return record_batch("name string, row long, n_docs long, n_ids long",
                            [[name], [row - len(held_docs)], [len(held_docs)], [n]])

    row = 0
    # a batch's distinct stretches are looked up once: fewer of them in larger batches
    for batch in slices(batches, 1000):
        texts = [t or "" for t in batch.column("text").to_pylist()]
        ids = encoder(path).encode(texts)
        for doc, own, text in zip(batch.column("doc_id").to_pylist(), ids, texts, strict=True):
            held_docs.append(doc)
            held_ids.append(np.append(own, np.uint32(end)))
            size += len(text)
            row += 1
            if size >= FILE_BYTES:
                yield flush()
                held_docs, held_ids, size = [], [], 0
    if held_docs:
        yield flush()


def write_tokens(docs: DataFrame, work: Workspace, tokenizer_path: str, *, end: int = END) -> DataFrame:
    """Token files in ascending doc_id order: (name, part, row, n_docs, n_ids, base).

    `base` is the number of ids in all files before. Rows of null id come
    first; rows of one id lie next to each other. Each row ends with the id
    `end`; a null text is empty.
    """
    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    files = ordered.mapInArrow(
        partial(_write, folder=work.path("tokens"), path=tokenizer_path, end=end),
        "name string, row long, n_docs long, n_ids long").select("*", F.spark_partition_id().alias("part"))
    files = work.write(files, "files")
    # one row for each file of about FILE_BYTES
    order = Window.orderBy("part", "row").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("base", F.coalesce(F.sum("n_ids").over(order), F.lit(0)))


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    fs, _ = file_system(folder)
    for batch in batches:
        for name, base in zip(batch.column("name").to_pylist(), batch.column("base").to_pylist(), strict=True):
            with fs.open_input_file(name) as source:
                file = TokenFile(source)
                n = len(file.docs)
                for at in range(0, n, 2000):
                    stop = min(n, at + 2000)
                    first = int(file.starts[at])
                    ids = file.ids(first, int(file.starts[stop])).astype("<u4")
                    starts = file.starts[at:stop + 1] - first
                    crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts[:-1], starts[1:], strict=True)]
                    yield record_batch(TOKENS, [file.docs[at:stop], base + file.starts[at:stop],
                                                np.diff(starts), crc])


def read_tokens(files: DataFrame, work: Workspace) -> DataFrame:
    """TOKENS of every document in the files, a task for each few files."""
    return dealt_files(files, "name").mapInArrow(partial(_read, folder=work.path("tokens")), TOKENS)


@query()
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, read back from the files."""
    work = Workspace(spark, "op9")
    return read_tokens(write_tokens(table_rows(spark, sf_dir, "documents"), work, vocabulary("byte_bpe_50k.json")), work)
