"""Hierarchical Pitman-Yor language model, seated by Gibbs sampling.

Restaurants are contexts: the whole word before, and the start of a text. They
share one parent restaurant without context, whose own base is uniform over the
vocabulary and one unknown token. Customers are the training tokens; every
table of a context restaurant is a customer of the parent. A sweep seats all
customers anew, in Chinese-restaurant order, given the tables of the sweep
before. The predictive probabilities of the kept sweeps are averaged. Every
draw is a hash of its pair (or word), sweep and step, so the model depends on
the texts alone, not on partitions, order or a task that ran twice.

The seating is a table of (context, word) pairs, dealt by hash and written
after every sweep. A pair seen once has one table whatever is drawn, so only
pairs seen more often are kept in it. Totals of contexts and words are
aggregated map-side and meet the pairs in joins whose hot keys Spark splits.

Texts are dealt into blocks by hash. A block's distinct pairs travel packed, to
be counted by shards of pairs; what comes back are pairs seen more than once,
and those seen once that a held-out text asks for. A training text's pair
without an answer was seen once, a held-out text's never. All other pairs are
scored from their context and word alone. Words and contexts are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regfacts.llm.common import Workspace, record_batch, runs, slices, table_rows, utf8
from regfacts.llm.registry import query

#: The end token; no word has white space.
END = b"\n"
#: The context of the first token; no word is empty.
START = b""
START_HASH, END_HASH = (int(np.uint64(xxhash.xxh3_64_intdigest(x)).view(np.int64)) for x in (START, END))
#: Bytes of text of one block.
BLOCK_BYTES = 32 << 20
#: Sweeps in all, and those at their beginning that are not averaged.
SWEEPS, BURN_IN = 3, 1
STRENGTH = 1.0
#: Pairs or words seated together.
GROUP_ROWS = 20_000
#: Pairs or words of one packed row, and rows that a worker gets at once where rows are packed.
CELL, CELL_ROWS = 1_000, 500
#: Answers that a task packs together.
ANSWERS = 1_000_000

#: Packed pairs of a block; without contexts, its words. Codes: see `_wants`.
WANTS = "shard int, block int, context binary, word binary, code binary"
COUNTED = "is_pair boolean, context long, word long, n long, blocks array<int>"
#: Packed answers for a block; the kind tells which values they have.
PACKED = "block int, kind int, key binary, counts binary"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def tokens(text: bytes) -> list[bytes]:
    return [*text.lower().split(), END]  # lower() of bytes changes A-Z only


def pairs_of(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Context and word of every token, as hashes."""
    own = [START, *tokens(text)]
    ids = np.fromiter(map(xxhash.xxh3_64_intdigest, own), np.uint64, len(own)).view(np.int64)
    return ids[:-1], ids[1:]


def pair_key(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    c = context.view(np.uint64)
    return (((c << np.uint64(21)) | (c >> np.uint64(43))) ^ word.view(np.uint64)).view(np.int64)


def key_column() -> Column:
    """`pair_key` of the columns context and word."""
    c = F.col("context")
    return F.shiftleft(c, 21).bitwiseOR(F.shiftrightunsigned(c, 43)).bitwiseXOR(F.col("word"))


def planes(counts: np.ndarray) -> bytes:
    """Whole numbers by byte planes: most are small, and planes of zeros compress."""
    return np.ascontiguousarray(counts, np.int64).view(np.uint8).reshape(-1, 8).T.tobytes()


def of_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.int64).reshape(-1)


class Ids(dict):
    """Numbers of the words of a block in the order they come."""

    def __init__(self):
        super().__init__()
        self.words: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.words)
        self.words.append(word)
        return number

    def of(self, text: bytes) -> np.ndarray:
        """The start and all tokens of a text."""
        own = [START, *tokens(text)]
        return np.fromiter(map(self.__getitem__, own), np.int64, len(own))

    def hashes(self, since: int = 0) -> np.ndarray:
        some = self.words[since:]
        return np.fromiter(map(xxhash.xxh3_64_intdigest, some), np.uint64, len(some)).view(np.int64)


def _grouped(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal keys together, and the starts of their runs in it."""
    order = np.argsort(key, kind="stable")
    return order, runs(key[order])[:-1]


def _packed(shards: int, block: int, key: np.ndarray, context: np.ndarray | None, word: np.ndarray,
            code: np.ndarray) -> Iterator[pa.RecordBatch]:
    """WANTS rows of at most CELL entries, in the given order within a shard: equal contexts side by side compress."""
    shard = ((key.view(np.uint64) >> np.uint64(32)) % np.uint64(shards)).astype(np.uint16 if shards <= 1 << 16 else np.int32)
    order = np.argsort(shard, kind="stable")
    at = runs(shard[order])
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        cells = [order[i:min(b, i + CELL)] for i in range(a, b, CELL)]
        yield record_batch(WANTS, [
            [int(shard[order[a]])] * len(cells), [block] * len(cells),
            [None if context is None else context[c].tobytes() for c in cells],
            [word[c].tobytes() for c in cells], [planes(code[c]) for c in cells]])


def _wants(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """WANTS of every block: its distinct pairs and words with their codes.

    A pair's code is twice its training count, plus one if a held-out text has
    it; a word's is its training count. The start of a text counts as a word.
    """
    none = np.zeros(0, np.int64)
    block, ids, counted, fresh, size = None, Ids(), (none, none), [], 0

    def count() -> tuple[np.ndarray, np.ndarray]:
        """Pairs of numbers in order with their codes, so far and since."""
        pair = np.sort(np.concatenate([none, *fresh]))  # the last bit: of a held-out text
        fresh.clear()
        at = runs(pair >> 1)
        if not len(pair):
            return counted
        held = np.add.reduceat(pair & 1, at[:-1])
        new = pair[at[:-1]] >> 1, 2 * (np.diff(at) - held) + (held > 0)
        if not len(counted[0]):
            return new
        pair, code = (np.concatenate(x) for x in zip(counted, new, strict=True))
        order, at = _grouped(pair)
        code = code[order]
        return pair[order[at]], np.add.reduceat(code & -2, at) | np.bitwise_or.reduceat(code & 1, at)

    def flush() -> Iterator[pa.RecordBatch]:
        pair, code = count()
        hashes, first, last = ids.hashes(), pair >> 31, pair & (1 << 31) - 1
        # every token has one context: starts are counted there, all else as words
        seen = np.bincount(last, code >> 1, len(hashes)).astype(np.int64)
        seen[ids[START]] = (code[first == ids[START]] >> 1).sum()
        context, word = hashes[first], hashes[last]
        del pair, first, last
        yield from _packed(shards, block, pair_key(context, word), context, word, code)
        yield from _packed(shards, block, hashes, None, hashes, seen)

    for batch in slices(batches):
        for b, held, text in zip(batch.column("block").to_pylist(), batch.column("held_out").to_pylist(),
                                 utf8(batch.column("text")), strict=True):
            if b != block:
                if block is not None:
                    yield from flush()
                block, ids, counted, size = b, Ids(), (none, none), 0  # frees those of the block before
            own = ids.of(text)
            fresh.append((own[:-1] << 31 | own[1:]) << 1 | int(held))
            size += len(own)
            if size > 4_000_000:
                counted, size = count(), 0
    if block is not None:
        yield from flush()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """COUNTED of every shard: pairs that some block needs an answer for, and all training words."""
    shard, pairs, words = None, [], []

    def answers(cells: list[tuple], is_pair: bool) -> Iterator[pa.RecordBatch]:
        if not cells:
            return
        context, word, code = (np.concatenate([get(c[i]) for c in cells]) for i, get in (
            (1, partial(np.frombuffer, dtype=np.int64)), (2, partial(np.frombuffer, dtype=np.int64)), (3, of_planes)))
        block = np.repeat(np.array([c[0] for c in cells], np.int32), [len(c[3]) // 8 for c in cells])
        cells.clear()
        order, at = _grouped(pair_key(context, word) if is_pair else word)
        code, block = code[order], block[order]
        if is_pair:
            n = np.add.reduceat(code >> 1, at)
            total = np.repeat(n, np.diff(np.append(at, len(code))))
            wanted = (total > 1) | ((total == 1) & (code & 1 == 1))
        else:
            n = np.add.reduceat(code, at)
            wanted = np.repeat(n > 0, np.diff(np.append(at, len(code))))
        held = np.add.reduceat(wanted.astype(np.int64), at)
        block = block[wanted]
        kept = held > 0
        first, n, ends = order[at[kept]], n[kept], np.cumsum(held[kept])
        for i in range(0, len(n), GROUP_ROWS):
            some = slice(i, i + GROUP_ROWS)
            start = ends[i - 1] if i else 0
            offsets = np.append(0, ends[some] - start).astype(np.int32)
            lists = pa.ListArray.from_arrays(offsets, block[start:ends[some][-1]])
            w = word[first[some]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(w), is_pair)), pa.array(context[first[some]] if is_pair else w), pa.array(w),
                 pa.array(n[some]), lists], names=["is_pair", "context", "word", "n", "blocks"])

    for batch in batches:
        for s, block, context, word, code in zip(*(batch.column(c).to_pylist() for c in (
                "shard", "block", "context", "word", "code")), strict=True):
            if s != shard:
                yield from answers(pairs, True)
                yield from answers(words, False)
                shard = s
            (words if context is None else pairs).append((block, context or word, word, code))
    yield from answers(pairs, True)
    yield from answers(words, False)


def mixed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit numbers with all bits mixed (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds_of(sweep: int, *keys: np.ndarray) -> np.ndarray:
    """A seed for each row from its own keys."""
    seed = np.full(len(keys[0]), sweep, np.uint64)
    for key in keys:
        seed = mixed((seed + np.uint64(0x9E3779B97F4A7C15)) ^ key.view(np.uint64))
    return seed


def seat(seeds: np.ndarray, customers: np.ndarray, new: np.ndarray, discount: float) -> np.ndarray:
    """Tables after seating customers one by one; new: weight of a new table for each dish.

    The first 64 are seated one at a time, then steps of an eighth of those
    seated, with the number of new tables of a step drawn at its beginning. A
    dish draws from its own seed only.
    """
    tables = np.minimum(customers, 1).astype(np.float64)
    open_ = np.flatnonzero(customers > 1)
    for seated in range(1, 64):
        if not len(open_):
            return tables
        t, w = tables[open_], new[open_]
        chance = w / (w + np.maximum(seated - discount * t, 1e-9))
        draw = mixed(seeds[open_] + np.uint64(seated)) >> np.uint64(11)
        tables[open_] = t + (draw * 2.0 ** -53 < chance)
        open_ = open_[customers[open_] > seated + 1]
    for i in open_.tolist():
        rng, n, t, w, seated = np.random.default_rng(int(seeds[i])), int(customers[i]), tables[i], new[i], 64
        while seated < n:
            step = min(n - seated, seated // 8)
            t += rng.binomial(step, w / (w + max(seated - discount * t, 1e-9)))
            seated += step
        tables[i] = t
    return tables


_SEATED = "context long, word long, n long, tables double, kept double"
_PARENT = "word long, seen long, ones long, customers double, tables double"


def _seat_pairs(batches: Iterator[pa.RecordBatch], sweep: int, discount: float) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, GROUP_ROWS):
        context, word, n, kept, new = (batch.column(c).to_numpy() for c in ("context", "word", "n", "kept", "new"))
        tables = seat(seeds_of(sweep, context, word), n, new, discount)
        yield record_batch(_SEATED, [context, word, n, tables, kept + tables if sweep > BURN_IN else kept])


def _seat_parent(batches: Iterator[pa.RecordBatch], sweep: int, discount: float, new: float) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, GROUP_ROWS):
        word, seen, ones, customers = (batch.column(c).to_numpy() for c in ("word", "seen", "ones", "customers"))
        tables = seat(seeds_of(sweep, word), customers.astype(np.int64), np.full(len(word), new), discount)
        yield record_batch(_PARENT, [word, seen, ones, customers, tables])


def _discount(once: int, twice: int) -> float:
    """The usual estimate from dishes seen once and twice, inside (0, 1)."""
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once + twice else 0.5


@dataclass(frozen=True)
class Model:
    """What a probability is made of.

    `seats`: (context, word, kept) of pairs seen more than once, their tables
    summed over the kept sweeps. `contexts`: (context, seen, guests by sweep),
    `words`: (word, seen, customers and tables by sweep). The scalars are those of `probability`.
    """

    seats: DataFrame
    contexts: DataFrame
    words: DataFrame
    discount: float
    parent_discount: float
    #: Of every kept sweep: the weight of the uniform base, and all customers of the parent.
    sweeps: tuple[tuple[float, float], ...]
    n_train: int
    vocabulary: int


#: Per kept sweep: the tables of a context, the customers and tables of a word.
KEPT = range(BURN_IN + 1, SWEEPS + 1)
OF_CONTEXT = [f"more{k}" for k in KEPT]
OF_WORD = [f"{c}{k}" for k in KEPT for c in ("customers", "tables")]


def backed_off(model: Model, seen, more):
    """What a context of `seen` tokens and `more` tables leaves to its parent (seen 0: all)."""
    return (STRENGTH + model.discount * more) / (STRENGTH + seen)


def of_parent(model: Model, sweep: tuple[float, float], customers, tables):
    """A word's probability in the parent after a kept sweep."""
    base, everyone = sweep
    return (customers - model.parent_discount * tables + base) / (STRENGTH + everyone)


def probability(model: Model, n, kept, seen, left: list, parents: list):
    """The average over kept sweeps of a pair's probability, for columns as for arrays.

    n: the pair's count; kept: its tables over the kept sweeps; seen: the count of its
    context; left and parents: `backed_off` and `of_parent` of each kept sweep.
    """
    share = 0.0
    for back, parent in zip(left, parents, strict=True):
        share = share + back * parent
    # without a count there are no tables, and the pair's own share is zero
    return (n - model.discount * (kept / float(len(KEPT)))) / (STRENGTH + seen) + share / float(len(KEPT))


def _seat(often: DataFrame, contexts: DataFrame, words: DataFrame, work: Workspace) -> Model:
    """The model of pairs seen more than once (context, word, n), all contexts (context, seen) and all words (word, seen)."""
    # what is not in `often` is seen once: `ones` of a context or word, and of its pairs (`dishes`)
    def totals(of: DataFrame, key: str) -> DataFrame:
        more = often.groupBy(key).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("often"))
        ones = F.col("seen") - F.coalesce("n", F.lit(0))
        often_ = F.coalesce("often", F.lit(0))
        return work.write(of.join(more, key, "left").select(
            key, "seen", ones.alias("ones"), (ones + often_).alias("dishes"), often_.alias("often")), f"{key}s")

    contexts, words = totals(contexts, "context"), totals(words, "word")
    vocabulary, n_train, once, all_pairs, one, two = words.agg(
        F.count(F.lit(1)), F.coalesce(F.sum("seen"), F.lit(0)), F.coalesce(F.sum("ones"), F.lit(0)),
        F.coalesce(F.sum("dishes"), F.lit(0)), F.count_if(F.col("dishes") == 1), F.count_if(F.col("dishes") == 2)).first()
    discount, parent_discount = _discount(once, often.where("n = 2").count()), _discount(one, two)
    base = 1.0 / (vocabulary + 1)
    customers, tables = float(all_pairs), float(vocabulary)

    def back() -> float:
        return STRENGTH + parent_discount * tables

    # before the first sweep every dish of a restaurant has one table
    state = often.select("context", "word", "n", F.lit(1.0).alias("tables"), F.lit(0.0).alias("kept"))
    parent = words.select("word", "seen", "ones", F.col("dishes").cast("double").alias("customers"),
                          F.lit(1.0).alias("tables"))
    drawn = contexts.where("often > 0").select("context", "ones")
    # the kept sweeps' scalars, the contexts' further tables, the words' customers and tables
    sweeps, more, by_word = [], [], words.select("word", "seen")
    for sweep in range(1, SWEEPS + 1):
        of_context = drawn.join(state.groupBy("context").agg(F.sum("tables").alias("more")), "context").select(
            "context", (F.lit(STRENGTH) + F.lit(discount) * (F.col("ones") + F.col("more"))).alias("weight"))
        p = (F.col("customers") - F.lit(parent_discount) * F.col("tables") + F.lit(back() * base)) / F.lit(STRENGTH + customers)
        seats = state.drop("tables").join(of_context.hint("shuffle_hash"), "context").join(
            parent.select("word", p.alias("p")).hint("shuffle_hash"), "word").withColumn("new", F.col("weight") * F.col("p")).drop("weight", "p")
        state = work.write(seats.mapInArrow(partial(_seat_pairs, sweep=sweep, discount=discount), _SEATED), f"seats-{sweep}")
        guests = state.groupBy("word").agg(F.sum("tables").alias("more"))
        parent = work.write(parent.join(guests, "word", "left").withColumn(
            "customers", F.col("ones") + F.coalesce("more", F.lit(0.0))).drop("tables", "more").mapInArrow(partial(
                _seat_parent, sweep=sweep, discount=parent_discount, new=back() * base), _PARENT), f"parent-{sweep}")
        customers, tables = (float(x or 0) for x in parent.agg(F.sum("customers"), F.sum("tables")).first())
        if sweep > BURN_IN:
            sweeps.append((back() * base, customers))
            more.append(state.groupBy("context").agg(F.sum("tables").alias(f"more{sweep}")))
            by_word = by_word.join(parent.select("word", F.col("customers").alias(f"customers{sweep}"),
                                                 F.col("tables").alias(f"tables{sweep}")), "word")
        if sweep - 1 <= BURN_IN:
            work.drop(f"seats-{sweep - 1}", f"parent-{sweep - 1}")
    for further in more:
        contexts = contexts.join(further, "context", "left")
    contexts = contexts.select("context", "seen", *[
        (F.col("ones") + F.coalesce(c, F.lit(0.0))).alias(c) for c in OF_CONTEXT])
    return Model(state.select("context", "word", "kept"), contexts, by_word, discount, parent_discount, tuple(sweeps),
                 n_train, vocabulary)


def _tables(pairs: DataFrame, model: Model) -> DataFrame:
    """The pairs with `kept`; a pair seen once has one table in each sweep."""
    once = (F.col("n") * len(KEPT)).cast("double")
    return pairs.where("n < 2").withColumn("kept", once).unionByName(
        pairs.where("n > 1").join(model.seats, ["context", "word"]))


def fit(pairs: DataFrame, work: Workspace) -> tuple[DataFrame, int, int]:
    """(context, word, blocks, seen, probability) of all pairs (context, word, n, blocks), training tokens, vocabulary."""
    trained = pairs.where("n > 0")
    model = _seat(trained.where("n > 1").select("context", "word", "n"),
                  *(trained.groupBy(key).agg(F.sum("n").alias("seen")) for key in ("context", "word")), work)
    met = _tables(pairs, model).join(model.contexts.withColumnRenamed("seen", "guests"), "context", "left").join(
        model.words, "word", "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in (*OF_CONTEXT, *OF_WORD, "guests")}
    return met.select("context", "word", "blocks", F.coalesce("seen", F.lit(0)).cast("long").alias("seen"), probability(
        model, F.col("n"), F.col("kept"), zero["guests"],
        [backed_off(model, zero["guests"], zero[c]) for c in OF_CONTEXT],
        [of_parent(model, x, zero[f"customers{k}"], zero[f"tables{k}"]) for k, x in zip(KEPT, model.sweeps, strict=True)],
    ).alias("probability")), model.n_train, model.vocabulary


#: Kinds of the rows that meet in a block, in order, and the values of the first two.
PAIRS, WORDS, TEXTS = 0, 1, 2
VALUES = (["n", "kept"], ["n", *OF_CONTEXT, *OF_WORD])


def many_rows(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The same rows in tables of at least `rows`, but for the last."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _pack_answers(batches: Iterator[pa.RecordBatch], kind: int) -> Iterator[pa.RecordBatch]:
    """PACKED rows of (key, values of the kind, blocks): each answer goes to all its blocks."""
    held, size = [], 0

    def flush() -> Iterator[pa.RecordBatch]:
        block, key, counts = (np.concatenate(x, axis=-1) for x in zip(*held, strict=True))
        held.clear()
        order = np.argsort(block, kind="stable")
        at = runs(block[order])
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            cells = [order[i:min(b, i + CELL)] for i in range(a, b, CELL)]
            yield record_batch(PACKED, [[int(block[order[a]])] * len(cells), [kind] * len(cells), [
                key[c].tobytes() for c in cells], [planes(counts[:, c]) for c in cells]])

    for table in many_rows(batches, GROUP_ROWS):
        lists = table.column("blocks").combine_chunks()
        row = np.repeat(np.arange(table.num_rows), lists.value_lengths().to_numpy())
        held.append((lists.flatten().to_numpy(), table.column("key").to_numpy()[row], np.stack(
            [table.column(c).to_numpy() for c in VALUES[kind]]).astype(np.int64)[:, row]))
        size += len(row)
        if size > ANSWERS:
            yield from flush()
            size = 0
    if held:
        yield from flush()


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """SCORES of the texts of a block, which come after its pairs and its words."""
    base_total = np.log10(model.n_train + 0.1 * (model.vocabulary + 1))
    none = np.zeros(0, np.int64)
    block, answers, tables, ids, hashes, places = None, {}, None, Ids(), none, none

    def sorted_table(kind: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys in order and their values; the last row stands for what has none."""
        parts, columns = answers.pop(kind, []), len(VALUES[kind])
        key = np.concatenate([none, *(k for k, _ in parts)])
        values = np.concatenate([np.zeros((columns, 0)), *(v for _, v in parts)], axis=1)
        order = np.argsort(key)
        return key[order], np.append(values[:, order], np.zeros((columns, 1)), axis=1)

    def place(key: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Places of the wanted keys; absent ones are at the end."""
        if not len(key):
            return np.zeros(len(wanted), np.int64)
        i = np.searchsorted(key, wanted)
        return np.where(key[np.minimum(i, len(key) - 1)] == wanted, i, len(key))

    for batch in slices(batches, GROUP_ROWS):
        kinds, blocks, rows = batch.column("kind").to_numpy(), batch.column("block").to_numpy(), []
        at = runs(blocks, kinds)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if blocks[a] != block:
                block, answers, tables, ids, hashes, places = blocks[a], {}, None, Ids(), none, none
            some, kind = batch.slice(a, b - a), int(kinds[a])
            if kind < TEXTS:
                for key, counts in zip(some.column("key").to_pylist(), some.column("counts").to_pylist(), strict=True):
                    answers.setdefault(kind, []).append((np.frombuffer(key, np.int64), of_planes(counts).reshape(
                        len(VALUES[kind]), -1).astype(np.float64)))
                continue
            if tables is None:
                word_keys, (seen, *counts) = sorted_table(WORDS)
                more, by_word = counts[:len(OF_CONTEXT)], counts[len(OF_CONTEXT):]
                # once a word, not once a token
                left = [backed_off(model, seen, m) for m in more]
                parents = [of_parent(model, x, *by_word[2 * i:2 * i + 2]) for i, x in enumerate(model.sweeps)]
                tables = *sorted_table(PAIRS), word_keys, seen, np.log10(seen + 0.1) - base_total, left, parents
                del counts, more, by_word
            pair_keys, by_pair, word_keys, seen, base_of, left, parents = tables
            own = [ids.of(text) for text in utf8(some.column("text"))]
            new = ids.hashes(len(hashes))
            hashes, places = np.append(hashes, new), np.append(places, place(word_keys, new))
            held = some.column("held_out").to_numpy(zero_copy_only=False)
            ends = np.cumsum([0, *(len(x) - 1 for x in own)])
            before, word = (np.concatenate(x) for x in ([x[:-1] for x in own], [x[1:] for x in own]))
            j = place(pair_keys, pair_key(hashes[before], hashes[word]))
            before, word = places[before], places[word]
            n, kept = by_pair[:, j]
            # a training text's pair without an answer was seen once
            single = (j == len(pair_keys)) & np.repeat(~held, np.diff(ends))
            n, kept = np.where(single, 1.0, n), np.where(single, float(len(KEPT)), kept)
            score = np.log10(probability(model, n, kept, seen[before], [x[before] for x in left], [x[word] for x in parents]))
            known, base = seen[word] > 0, base_of[word]
            for r, (doc, x, y) in enumerate(zip(some.column("doc_id").to_pylist(), ends[:-1].tolist(),
                                                ends[1:].tolist(), strict=True)):
                rows.append((doc, bool(held[r]), y - x, int(known[x:y].sum()), float(base[x:y].sum()),
                             float(score[x:y].sum())))
        if rows:
            yield record_batch(SCORES, list(zip(*rows, strict=True)))


def is_held_out(doc_id: Column) -> Column:
    """A tenth of the ids, by checksum; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(10)) == 0, F.lit(False))


def score_documents(docs: DataFrame, work: Workspace, *, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """SCORES and train_tokens of every document, by a model of the documents not held out.

    Null and empty texts are one end token. With no training document every
    token has the probability of an unknown one. Repeated rows each count and
    each have a score; other columns are not read. A very long text is in one
    block, whose pairs are counted as they are read.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    dealt = docs.select(F.col("doc_id").cast("long"), "text", is_held_out(F.col("doc_id")).alias("held_out"),
                        F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block"))
    # numbers, or adaptive execution would put all blocks, or all shards, into a few tasks
    cores = docs.sparkSession.sparkContext.defaultParallelism
    tasks, shards = max(blocks, cores), 2 * blocks
    texts = work.write(dealt.select("held_out", "text", "block").repartition(tasks, "block").sortWithinPartitions("block"),
                       "texts")
    wants = texts.mapInArrow(partial(_wants, shards=shards), WANTS)
    counted = work.write(wants.repartition(max(shards, cores), "shard").sortWithinPartitions("shard").mapInArrow(
        _count, COUNTED), "counted", batch_rows=CELL_ROWS)
    work.drop("texts")
    pairs, words = counted.where("is_pair").drop("is_pair"), counted.where("not is_pair").drop("is_pair")
    # each training token but an end is the context of the next one
    model = _seat(pairs.where("n > 1").select("context", "word", "n"),
                  words.where(F.col("word") != END_HASH).select(F.col("word").alias("context"), F.col("n").alias("seen")),
                  words.where(F.col("word") != START_HASH).select("word", F.col("n").alias("seen")), work)
    zero = [F.coalesce(c, F.lit(0.0)).alias(c) for c in (*OF_CONTEXT, *OF_WORD)]
    by_pair = work.write(_tables(pairs, model).select(
        key_column().alias("key"), F.col("n").cast("double").alias("n"), "kept", "blocks"), "by-pair")
    by_word = work.write(words.join(model.contexts.drop("seen").withColumnRenamed("context", "word"), "word", "left").join(
        model.words.drop("seen"), "word", "left").select(
            F.col("word").alias("key"), F.col("n").cast("double").alias("n"), *zero, "blocks"), "by-word")
    work.drop("counted", "contexts", "words", *(f"{name}-{k}" for name in ("seats", "parent") for k in KEPT))
    each = [df.mapInArrow(partial(_pack_answers, kind=kind), PACKED) for df, kind in ((by_pair, PAIRS), (by_word, WORDS))]
    text = dealt.select("block", F.lit(TEXTS).alias("kind"), "doc_id", "held_out", "text")
    met = each[0].union(each[1]).unionByName(text, allowMissingColumns=True)
    plain = replace(model, seats=None, contexts=None, words=None)  # tasks get the numbers only
    scored = work.write(met.repartition(tasks, "block").sortWithinPartitions("block", "kind").mapInArrow(
        partial(_score, model=plain), SCORES), "scores", batch_rows=CELL_ROWS)
    work.drop("by-pair", "by-word")
    return scored.withColumn("train_tokens", F.lit(model.n_train).cast("long"))


@query()
def op7_pitman_yor_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model log10 probability of every document."""
    return score_documents(table_rows(spark, sf_dir, "documents").select("doc_id", "text"), Workspace(spark, "op7", drop_shuffles=True)).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
