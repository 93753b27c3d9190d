"""SimHash near-duplicates with covering locality-sensitive hashing.

A fingerprint bit is the majority of that bit over the hashes of a document's
word shingles. Candidate pairs come from 2^(r+1) - 1 structured bit masks: bit
i carries a vector m(i) of r+1 bits, and mask v keeps the bits whose vector has
an odd product with v. The vectors of at most r differing bits span at most r
dimensions, so some v is orthogonal to all of them and that mask keeps none of
the differing bits: every pair within the radius meets in some table.

Documents of a given shingle similarity are further apart than a radius can
cover, so `one_per_group` takes its candidates from several minima of the
shingle hashes (MinHash) and confirms them by the shingle sets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regfacts.llm.common import Workspace, record_batch, runs, slices, table_rows, utf8, whole_groups
from regfacts.llm.components import components
from regfacts.llm.registry import query

#: Fingerprints compared in one task; larger buckets are compared block by block.
BLOCK = 8192


def shingle_hashes(text: bytes, shingle_words: int) -> np.ndarray:
    """Hash of every word shingle; a shorter text is one shingle, a text without words has none."""
    words = text.lower().split()  # lower() of bytes changes A-Z only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    stop = np.cumsum(size) - 1
    start = stop - size + 1
    n = max(1, len(words) - shingle_words + 1)
    stops = stop[-n:]
    view, h = memoryview(joined), xxhash.xxh64_intdigest
    return np.fromiter((h(view[a:b], 42) for a, b in zip(start[:n].tolist(), stops.tolist(), strict=True)),
                       np.uint64, n)


def fingerprint(text: bytes, shingle_words: int) -> int:
    hashes = shingle_hashes(text, shingle_words)
    n = len(hashes)
    if not n:
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[at:at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def _fingerprints(text: pa.Array, shingle_words: int) -> pa.Array:
    values = np.array([fingerprint(x, shingle_words) for x in utf8(text)], np.uint64)
    return pa.array(values.view(np.int64))


def fingerprints(text: Column, shingle_words: int) -> Column:
    """64-bit fingerprint as a long; texts without words have 0."""
    def one(column: pa.Array) -> pa.Array:
        return _fingerprints(column, shingle_words)

    return F.arrow_udf(one, "bigint").asNondeterministic()(text)


def covering_masks(radius: int) -> list[int]:
    """The bit masks of all tables, as signed 64-bit numbers.

    The vectors go round the nonzero values in a fixed order, so that every
    mask keeps about half of the bits.
    """
    vectors = [1 + (i * 11) % ((1 << (radius + 1)) - 1) for i in range(64)]
    masks = []
    for v in range(1, 1 << (radius + 1)):
        mask = sum(1 << i for i in range(64) if (vectors[i] & v).bit_count() % 2)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def linked(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (other, smallest) that give the components of one bucket block.

    A breadth-first walk that compares only with what is not reached yet.
    """
    prints = np.unique(prints)
    order = np.arange(len(prints))
    left, a, b = order[1:], [], []
    frontier, root = [0], 0
    while True:
        while frontier and len(left):
            x = frontier.pop()
            near = np.bitwise_count(prints[left] ^ prints[x]) <= radius
            if near.any():
                hit = left[near]
                a.append(hit)
                b.append(np.full(len(hit), root))
                frontier.extend(hit.tolist())
                left = left[~near]
        if not len(left):
            break
        root, left, frontier = int(left[0]), left[1:], [int(left[0])]
    if not a:
        return prints[:0], prints[:0]
    return prints[np.concatenate(a)], prints[np.concatenate(b)]


def _link_buckets(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    keys = ["part", "mask", "kept"]
    for table in whole_groups(batches, keys, 200_000):
        cols = [table.column(k).to_numpy() for k in keys]
        prints = table.column("print").to_numpy().view(np.uint64)
        at = runs(*cols)
        size = np.diff(at)
        two = at[:-1][size == 2]
        near = np.bitwise_count(prints[two] ^ prints[two + 1]) <= radius
        a, b = [prints[two[near]]], [prints[two[near] + 1]]
        for i in np.flatnonzero(size > 2):
            x, y = linked(prints[at[i]:at[i + 1]], radius)
            a.append(x)
            b.append(y)
        pair = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], axis=1), axis=0).view(np.int64)
        yield record_batch("x long, y long", [pair[:, 0], pair[:, 1]])


def _parts(blocks: Column) -> Column:
    """The pairs of blocks that hold the block of `print`; a single block meets itself."""
    own = F.pmod(F.xxhash64("print"), blocks).cast("int")
    return F.when(blocks == 1, F.array(F.lit(0))).otherwise(F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda j: F.least(j, own) * blocks + F.greatest(j, own)))


def print_links(prints: DataFrame, radius: int, work: Workspace, block: int = BLOCK) -> DataFrame:
    """Links (x, y) between distinct fingerprints `print`, enough for the components at `radius`.

    A bucket of more than `block` fingerprints is cut into blocks and every two
    blocks meet in a task of their own, so no task holds an unbounded bucket.
    """
    masks = F.array(*[F.struct(F.lit(i).alias("mask"), F.lit(m).alias("bits"))
                      for i, m in enumerate(covering_masks(radius))])
    keyed = prints.select("print", F.explode(masks).alias("t")).select(
        "print", F.col("t.mask").alias("mask"), F.col("print").bitwiseAND(F.col("t.bits")).alias("kept"))
    # written, so that the join meets plain shuffles, whose hot keys Spark splits
    sizes = work.write(keyed.groupBy("mask", "kept").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    dealt = (keyed.join(sizes, ["mask", "kept"])
             .select("mask", "kept", "print", F.explode(_parts(F.ceil(F.col("n") / F.lit(block)).cast("int"))).alias("part"))
             .repartition("mask", "kept", "part").sortWithinPartitions("part", "mask", "kept"))
    return dealt.mapInArrow(partial(_link_buckets, radius=radius), "x long, y long").distinct()


def near_components(docs: DataFrame, work: Workspace, *, shingle_words: int, radius: int) -> DataFrame:
    """(doc_id, print, component_id) of every row of docs.

    Links are sought between distinct fingerprints only, so copies cost one.
    component_id is the smallest id reachable, over rows of equal or linked
    fingerprints. Rows of null id take part in no group: their component_id is
    null.
    """
    rows = work.write(docs.select("doc_id", fingerprints(F.col("text"), shingle_words).alias("print")), "prints")
    firsts = work.write(rows.where(F.col("doc_id").isNotNull())
                        .groupBy("print").agg(F.min("doc_id").alias("first")), "firsts")
    return _grouped(rows, firsts, work.write(print_links(firsts.select("print"), radius, work), "links"), work)


def _grouped(rows: DataFrame, firsts: DataFrame, links: DataFrame, work: Workspace) -> DataFrame:
    """(doc_id, print, component_id) of rows (doc_id, print), by links (x, y) of prints and their `first` ids."""
    x = firsts.select(F.col("print").alias("x"), F.col("first").alias("a"))
    y = firsts.select(F.col("print").alias("y"), F.col("first").alias("b"))
    roots = components(links.join(x, "x").join(y, "y").select("a", "b"), work)
    of_print = firsts.join(roots, firsts["first"] == roots["node"], "left").select(
        "print", F.coalesce("root", "first").alias("component_id"))
    return rows.join(of_print, "print", "left").select(
        "doc_id", "print", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


#: Near duplicates: five-word shingles, of which two texts share this part of those that either has.
SHINGLE_WORDS, SIMILARITY = 5, 0.8
#: Minima of a text, in bands. Texts of similarity 0.8 agree in no whole band once in 13,000 pairs.
BANDS, BAND_ROWS = 24, 5
MINIMA = BANDS * BAND_ROWS
#: Candidates may agree in so much less of the minima than their similarity, four standard deviations.
SLACK = 0.15
#: Bytes of text compared in one block of a group of candidates.
TEXT_BLOCK = 8 << 20

_MIX = np.random.default_rng(5).integers(0, 1 << 64, (2, MINIMA, 1), np.uint64, endpoint=False)
_SKETCH = "doc_id long, text_hash long, print long, minima binary"


def sketch(text: bytes, shingle_words: int) -> tuple[int, bytes]:
    """Hash of the set of shingles, and its minima under MINIMA orders; a text without words is the empty set."""
    hashes = np.unique(shingle_hashes(text, shingle_words))
    least = np.full(MINIMA, (1 << 64) - 1, np.uint64)
    for at in range(0, len(hashes), 2048):
        x = (hashes[None, at:at + 2048] ^ _MIX[0]) * (_MIX[1] | np.uint64(1))
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x9E3779B97F4A7C15)
        least = np.minimum(least, x.min(axis=1))
    key = xxhash.xxh3_64_intdigest(hashes.tobytes())
    return key - (1 << 64) if key >> 63 else key, (least >> np.uint64(32)).astype("<u4").tobytes()


def _sketches(batches: Iterator[pa.RecordBatch], shingle_words: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        keys, minima = zip(*(sketch(x, shingle_words) for x in utf8(batch.column("text"))), strict=True)
        yield record_batch(_SKETCH, [batch.column("doc_id"), batch.column("text_hash"), list(keys), list(minima)])


def _walk(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> tuple[list[int], list[int]]:
    """Links (other, root) that give the components of n items; near(x, left) tells which of `left` are near x."""
    a, b, left = [], [], np.arange(n)
    while len(left) > 1:
        root, left = int(left[0]), left[1:]
        frontier = [root]
        while frontier and len(left):
            hit = near(frontier.pop(), left)
            a += left[hit].tolist()
            b += [root] * int(hit.sum())
            frontier += left[hit].tolist()
            left = left[~hit]
    return a, b


def _near_minima(minima: np.ndarray, least: float) -> Callable[[int, np.ndarray], np.ndarray]:
    return lambda x, left: (minima[left] == minima[x]).sum(axis=1) >= least * MINIMA


def near_sets(sets: list[np.ndarray], similarity: float) -> Callable[[int, np.ndarray], np.ndarray]:
    """Which of some sets share at least `similarity` of their union with one set; two empty sets do."""
    _, code = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_inverse=True)
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    edge = np.append(0, np.cumsum(size))
    held = np.zeros(len(code) + 1, bool)
    least = similarity - 1e-12  # 0.8 of a union may be a whole number

    def near(x: int, left: np.ndarray) -> np.ndarray:
        own = code[edge[x]:edge[x + 1]]
        held[own] = True
        out = np.zeros(len(left), bool)
        fit = np.minimum(size[left], size[x]) >= least * np.maximum(size[left], size[x])
        for i in np.flatnonzero(fit).tolist():
            y = int(left[i])
            both = int(np.count_nonzero(held[code[edge[y]:edge[y + 1]]]))
            out[i] = both >= least * (size[x] + size[y] - both)
        held[own] = False
        return out

    return near


_LINK = "x long, y long"


def _link_minima(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    keys = ["part", "band", "kept"]
    for table in whole_groups(batches, keys, 10_000):
        prints = table.column("print").to_numpy()
        minima = np.frombuffer(b"".join(table.column("minima").to_pylist()), "<u4").reshape(-1, MINIMA)
        at = runs(*(table.column(k).to_numpy() for k in keys))
        pairs = {(prints[p + i], prints[p + j]) for p, q in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)
                 for i, j in zip(*_walk(q - p, _near_minima(minima[p:q], least)), strict=True)}
        yield record_batch(_LINK, list(zip(*pairs, strict=True)) or [[], []])


def _confirm(batches: Iterator[pa.RecordBatch], shingle_words: int, similarity: float) -> Iterator[pa.RecordBatch]:
    keys = ["part", "root"]
    for table in whole_groups((s for s in slices(batches, 50)), keys, 200):
        prints, texts = table.column("print").to_numpy(), table.column("text")
        at = runs(*(table.column(k).to_numpy() for k in keys))
        pairs = []
        for p, q in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            own, first = np.unique(prints[p:q], return_index=True)  # equal rows are one
            sets = [np.unique(shingle_hashes((texts[p + i].as_py() or "").encode(), shingle_words)) for i in first.tolist()]
            pairs += [(own[i], own[j]) for i, j in zip(*_walk(len(own), near_sets(sets, similarity)), strict=True)]
        yield record_batch(_LINK, list(zip(*pairs, strict=True)) or [[], []])


def similar_links(docs: DataFrame, work: Workspace, *, shingle_words: int, similarity: float,
                  text_block: int = TEXT_BLOCK, among: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (doc_id, text_hash, print), the first id of each print, and links (x, y) of similar prints.

    A print is a hash of the set of shingles. Linked are sets that share `similarity` of
    their union. Sets that meet in a band and agree in enough minima are candidates,
    and all sets of a group of candidates are compared with one another as they are.
    Rows of null id are not linked. With `among` (id, hash) only rows of these ids and text
    hashes count; texts are not shuffled to find them, and a copy of them is not needed.
    """
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    sketches = work.write(texts.mapInArrow(partial(_sketches, shingle_words=shingle_words), _SKETCH), "prints")
    # without the minima, which are most of the sketches
    rows = sketches.drop("minima")
    if among is not None:
        rows = rows.join(among.select(F.col("id").alias("doc_id"), F.col("hash").alias("text_hash")),
                         ["doc_id", "text_hash"], "left_semi")
    rows = work.write(rows, "rows")
    of_print = rows.where(F.col("doc_id").isNotNull()).groupBy("print").agg(F.min(F.struct("doc_id", "text_hash")).alias("m")).select(
        "print", "m.doc_id", "m.text_hash")
    # equal rows have equal minima, and meet on the keys of the join
    firsts = work.write(sketches.join(of_print, ["print", "doc_id", "text_hash"]).groupBy(
        "print", "doc_id", "text_hash").agg(F.min("minima").alias("minima")).withColumnRenamed("doc_id", "first"), "firsts")
    work.drop("prints")
    bands = F.array(*[F.struct(F.lit(i).alias("band"), F.xxhash64(
        F.substring("minima", 1 + 4 * BAND_ROWS * i, 4 * BAND_ROWS)).alias("kept")) for i in range(BANDS)])
    keyed = firsts.select("print", F.explode(bands).alias("t")).select("print", "t.band", "t.kept")
    sizes = work.write(keyed.groupBy("band", "kept").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    dealt = (keyed.join(sizes, ["band", "kept"])
             .select("band", "kept", "print", F.explode(_parts(F.ceil(F.col("n") / F.lit(BLOCK)).cast("int"))).alias("part"))
             .join(firsts.select("print", "minima"), "print")
             .repartition("band", "kept", "part").sortWithinPartitions("part", "band", "kept"))
    met = work.write(dealt.mapInArrow(partial(_link_minima, least=similarity - SLACK), _LINK).distinct(), "candidates")
    roots = components(met.select(F.col("x").alias("a"), F.col("y").alias("b")), Workspace(work.spark, "candidates"))
    members = work.write(roots.withColumnRenamed("node", "print").join(firsts.drop("minima"), "print").select(
        "print", "root", F.col("first").alias("doc_id"), "text_hash"), "members")
    held = work.write(texts.join(members, ["doc_id", "text_hash"]).select("print", "root", "text"), "member-texts")
    bytes_ = work.write(held.groupBy("root").agg(F.sum(F.octet_length("text")).alias("n")), "group-bytes")
    of_text = F.greatest(F.lit(1), F.ceil(F.col("n") / F.lit(text_block))).cast("int")
    compared = (held.join(bytes_, "root").select("root", "print", "text", F.explode(_parts(of_text)).alias("part"))
                .repartition("root", "part").sortWithinPartitions("part", "root"))
    links = work.write(compared.mapInArrow(
        partial(_confirm, shingle_words=shingle_words, similarity=similarity), _LINK).distinct(), "links")
    work.drop("buckets", "candidates", "members", "member-texts", "group-bytes")
    return rows, firsts.select("print", "first"), links


def similar_components(docs: DataFrame, work: Workspace, **options) -> DataFrame:
    """(doc_id, print, component_id) of every row of docs, by similar_links. Ids as in near_components."""
    rows, firsts, links = similar_links(docs, work, **options)
    return _grouped(rows.select("doc_id", "print"), firsts, links, work)


def one_per_group(docs: DataFrame, work: Workspace, *, shingle_words: int = SHINGLE_WORDS,
                  similarity: float = SIMILARITY, among: DataFrame | None = None) -> DataFrame:
    """docs with one row of each group of near duplicates: that of the smallest id, then of the smallest text hash.

    Groups are of texts, not of ids: unlike texts that share an id are groups of their
    own and all stay. Equal rows (id and text) are one. Rows of null id stay. All
    texts without words are one group. The input's columns may have any name. With `among`
    (id, hash) the groups are of these rows only, and the others are left out but for rows of null id.
    """
    rows, _, links = similar_links(docs.select("doc_id", "text"), work, shingle_words=shingle_words, similarity=similarity,
                                   among=among)
    work.drop("firsts")
    roots = components(links.select(F.col("x").alias("a"), F.col("y").alias("b")), Workspace(work.spark, "similar"))
    return _kept(docs, _firsts_of_groups(rows, roots))


def one_per_fingerprint(docs: DataFrame, work: Workspace, **options) -> DataFrame:
    """docs with one row of each component of SimHash fingerprints at most `radius` bits apart; rows as in one_per_group."""
    return _kept(docs, first_of_fingerprints(docs, work, **options))


def first_of_fingerprints(docs: DataFrame, work: Workspace, *, shingle_words: int = 4, radius: int = 4) -> DataFrame:
    """(id, hash) of the rows that one_per_fingerprint keeps but for those of null id: ids and text hashes, written."""
    rows = work.write(docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                                  fingerprints(F.col("text"), shingle_words).alias("print")), "simhash-prints")
    prints = work.write(rows.where(F.col("doc_id").isNotNull()).select("print").distinct(), "simhash-distinct")
    links = work.write(print_links(prints, radius, work), "simhash-links")
    roots = components(links.select(F.col("x").alias("a"), F.col("y").alias("b")), Workspace(work.spark, "simhash"))
    firsts = work.write(_firsts_of_groups(rows, roots), "simhash-firsts")
    work.drop("buckets", "simhash-prints", "simhash-distinct", "simhash-links")
    return firsts


def _firsts_of_groups(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """(id, hash) of one row of each group, by rows (doc_id, text_hash, print) and the roots of linked prints."""
    return (
        rows.where(F.col("doc_id").isNotNull()).join(roots, F.col("print") == F.col("node"), "left")
        .groupBy(F.coalesce("root", "print").alias("group")).agg(F.min(F.struct("doc_id", "text_hash")).alias("one"))
        .select(F.col("one.doc_id").alias("id"), F.col("one.text_hash").alias("hash")))


def _kept(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of docs of the chosen (id, hash), of equal ones one, and those of null id."""
    held = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("hash"), F.struct("*").alias("row"))
    # dropDuplicates combines equal rows before the shuffle
    kept = held.where(F.col("id").isNotNull()).join(chosen, ["id", "hash"], "left_semi").dropDuplicates(["id", "hash"])
    return kept.select("row.*").unionByName(docs.where(F.col("doc_id").isNull()))


def hexadecimal(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


@query()
def op6_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document; null, empty and blank texts have fingerprint zero."""
    docs = table_rows(spark, sf_dir, "documents").select("doc_id", "text")
    out = near_components(docs, Workspace(spark, "op6"), shingle_words=4, radius=4)
    return out.select("doc_id", hexadecimal(F.col("print")).alias("fingerprint"), "component_id")
