"""Repair of the role structure of conversations by rank-convergence parallel Viterbi.

A conversation should read `(s?(ua)+)?` by the initials of its roles. Edits cost:
Keep 0, Rerole 2, Delete 3, Insert 2, and 1 for a truncated row that stays; blank
and repeated rows must go. The least cost from a row to the end is a vector over
four states of the pattern, and a row turns the vector behind it into the one
before it. Kept relative to their least entry these vectors are few, so a step is
a look-up.

Rows are sorted once by range, and each task solves its stretch of a conversation
from behind. A stretch that does not hold the end starts from a speculative
vector. When the stretch behind it arrives at another vector, the stretch is run
again from that one, and only until both runs differ by a constant: from there on
every choice is the same. With the vectors stitched, each stretch names the state
it leaves for each state it is entered in, the states are chained, and a last pass
traces the least audit. What reaches the driver is one short row for each stretch
at the edge of a partition, two a partition.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from regfacts.llm.common import Workspace, table_rows
from regfacts.llm.registry import query

BLANKS = " \t\n\x0b\x0c\r"
#: Rows of a task, about; sets the number of range partitions from a count.
ROWS_A_TASK = 500_000

# States: nothing yet, after a system row, after a user row, after an assistant row.
NEXT = (2, 2, 3, 2)  # where an inserted or reroled row leads: the only user or assistant that fits
ROLE_OF = {2: "user", 3: "assistant"}
SYSTEM, USER, ASSISTANT, OTHER = range(4)
KEEP = {(0, SYSTEM): 1, (0, USER): 2, (1, USER): 2, (2, ASSISTANT): 3, (3, USER): 2}
# A row's kind is 8 * fault + initial; the first fault counts.
SOUND, TRUNCATED, BLANK, DUPLICATE = range(4)
INSERT_COST, REROLE_COST, DELETE_COST, TRUNCATED_COST = 2, 2, 3, 1
LEGAL_PAIRS = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
#: Cost to the end behind the last row: nothing, or the missing rows inserted.
END = (0, 4, 2, 0)

Vector = tuple[int, int, int, int]


def edits(state: int, kind: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits of a row, in ASCII order."""
    fault, initial = divmod(kind, 8)
    out = [("D", DELETE_COST, state)]
    if fault < BLANK:
        more = TRUNCATED_COST if fault == TRUNCATED else 0
        if (state, initial) in KEEP:
            out.append(("K", more, KEEP[state, initial]))
        out.append(("R", REROLE_COST + more, NEXT[state]))
    return out


@lru_cache(maxsize=1 << 16)
def step(behind: Vector, kind: int) -> tuple[Vector, int, tuple[tuple[str, int], ...]]:
    """The vector before a row from the one behind it, its constant, and each state's choice.

    A choice is the least string of inserts and one edit, and the state it leads to.
    """
    cost = [min(c + behind[t] for _, c, t in edits(s, kind)) for s in range(4)]
    for _ in range(2):  # up to two inserts can pay off before one row
        cost = [min(cost[s], INSERT_COST + cost[NEXT[s]]) for s in range(4)]
    choices = []
    for s in range(4):
        text, at = "", s
        while True:
            options = [(letter, t) for letter, c, t in edits(at, kind) if c + behind[t] == cost[at]]
            if INSERT_COST + cost[NEXT[at]] == cost[at]:
                options.append(("I", NEXT[at]))
            letter, to = min(options)
            text, at = text + letter, to
            if letter != "I":
                break
        choices.append((text, at))
    least = min(cost)
    return tuple(c - least for c in cost), least, tuple(choices)


def backward(kinds: np.ndarray, behind: Vector) -> tuple[Vector, int]:
    """The vector before a stretch from the one behind it, and the constant between them."""
    total = 0
    for kind in kinds[::-1].tolist():
        behind, least, _ = step(behind, kind)
        total += least
    return behind, total


def rerun(kinds: np.ndarray, old: Vector, new: Vector) -> Vector | None:
    """A fix-up pass: both vectors go back until they differ by a constant only.

    None if they met; what is before the stretch stays then. Otherwise the new
    vector before the stretch.
    """
    for kind in kinds[::-1].tolist():
        old, new = step(old, kind)[0], step(new, kind)[0]
        if old == new:
            return None
    return new


def exits(kinds: np.ndarray, behind: Vector) -> list[int]:
    """The state a stretch leaves, for each state it is entered in."""
    out = list(range(4))
    for kind in kinds[::-1].tolist():
        behind, _, choices = step(behind, kind)
        out = [out[to] for _, to in choices]
    return out


def trace(kinds: np.ndarray, behind: Vector, state: int) -> tuple[str, int, int]:
    """The least audit of a stretch entered in a state, its cost, and the state it leaves."""
    choices = []
    for kind in kinds[::-1].tolist():
        behind, _, choice = step(behind, kind)
        choices.append(choice)
    out, cost = [], 0
    for choice, kind in zip(reversed(choices), kinds.tolist(), strict=True):
        text, state = choice[state]
        out.append(text)
        cost += INSERT_COST * (len(text) - 1) + (0 if text[-1] == "K" else REROLE_COST if text[-1] == "R" else DELETE_COST)
        cost += TRUNCATED_COST if kind // 8 == TRUNCATED and text[-1] != "D" else 0
    return "".join(out), cost, state


# --- rows --------------------------------------------------------------------
def with_faults(rows: DataFrame) -> DataFrame:
    """`rows` (conv, turn, role, text) with `digest` of role and text, and `kind` without duplicates.

    A duplicate needs the rows before it; see `ordered_kinds`.
    """
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.left("role", F.lit(1))
    kind = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    fault = F.when(bare == "", BLANK).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), SOUND).otherwise(TRUNCATED)
    return rows.withColumns({
        # the length keeps role and text apart
        "digest": F.unhex(F.substring(F.sha2(F.concat_ws(":", F.length("role"), "role", "text"), 256), 1, 32)),
        "kind": (fault * 8 + kind).cast("int")})


ORDER = ["turn", "digest"]  # nulls first; equal turns go by the digest


def ordered_kinds(rows: DataFrame, work: Workspace) -> DataFrame:
    """`part`, `pos`, `conv`, `kind` of all rows in order of conversation, turn and digest.

    `rows` holds conv, turn, digest and kind. A part is a range of the order, so a
    conversation of any length is cut into many; equal rows are dealt by a salt.
    """
    count = rows.count()
    parts = max(count // ROWS_A_TASK + 1, rows.sparkSession.sparkContext.defaultParallelism)
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20))
    ranged = rows.select("conv", *ORDER, "kind", salt.alias("salt")).repartitionByRange(parts, "conv", *ORDER, "salt")
    ranged = ranged.sortWithinPartitions("conv", *ORDER, "salt").select(
        F.spark_partition_id().alias("part"), "conv", "digest", "kind")

    def number(batches):
        at = 0
        for b in batches:
            pos = pa.array(np.arange(at, at + b.num_rows), pa.int64())
            at += b.num_rows
            yield pa.RecordBatch.from_arrays([b.column("part"), pos, *(b.column(c) for c in ("conv", "digest", "kind"))],
                                             names=["part", "pos", "conv", "digest", "kind"])

    kind_of = rows.schema["conv"].dataType.simpleString()
    numbered = work.write(ranged.mapInArrow(_number, f"part int, pos long, conv {kind_of}, digest binary, kind int"), "numbered")
    place = F.shiftleft(F.col("part").cast("long"), 40) + F.col("pos")
    first = (numbered.filter(F.col("kind") < BLANK * 8).groupBy("conv", "digest").agg(F.min(place).alias("place"))
             .select("place", F.lit(True).alias("first")))
    # a place is one row: the join has no frequent key
    marked = numbered.select(place.alias("place"), "part", "pos", "conv", "kind").join(first, "place", "left")
    again = (F.col("kind") < BLANK * 8) & F.col("first").isNull()
    marked = marked.select("part", "pos", "conv", F.when(again, DUPLICATE * 8 + F.col("kind") % 8).otherwise(
        F.col("kind")).cast("int").alias("kind"))
    parted = marked.repartition(parts, "part").sortWithinPartitions("part", "pos")
    return work.write(parted.mapInArrow(
        _stretches, f"part int, no long, conv {kind_of}, kinds binary, edge boolean"), "stretches")


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at = 0
    for b in batches:
        pos = pa.array(np.arange(at, at + b.num_rows), pa.int64())
        at += b.num_rows
        yield pa.RecordBatch.from_arrays([b.column("part"), pos, *(b.column(c) for c in ("conv", "digest", "kind"))],
                                         names=["part", "pos", "conv", "digest", "kind"])


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each stretch of a conversation in a part; the first and last of a part are edges."""
    held: list[bytes] = []
    key = None
    no = 0

    def row(part, conv, first, last):
        return part, no, conv, b"".join(held), first or last

    def batch_of(rows, kind):
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], kind),
             pa.array(columns[3], pa.binary()), pa.array(columns[4], pa.bool_())],
            names=["part", "no", "conv", "kinds", "edge"])

    kind = None
    for b in batches:
        if not b.num_rows:
            continue
        kind = b.column("conv").type
        part, conv = b.column("part").to_pylist(), b.column("conv").to_pylist()
        kinds = b.column("kind").to_numpy().astype(np.uint8)
        cuts = [0] + [i for i in range(1, len(conv)) if conv[i] != conv[i - 1] or part[i] != part[i - 1]] + [len(conv)]
        rows = []
        for lo, hi in zip(cuts, cuts[1:]):
            new = (part[lo], conv[lo])
            if key is not None and new != key:
                rows.append(row(*key, no == 0, new[0] != key[0]))
                held = []
                no = 0 if new[0] != key[0] else no + 1
            key = new
            held.append(kinds[lo:hi].tobytes())
        if rows:
            yield batch_of(rows, kind)
    if key is not None:
        yield batch_of([row(*key, no == 0, True)], kind)


# --- stitching ---------------------------------------------------------------
def _over_edges(stretches: DataFrame, wanted: dict, work_on, columns: str) -> list:
    """Run `work_on(kinds, wanted value)` on the named edge stretches; one short row each comes back."""

    def apply(batches):
        for b in batches:
            for part, no, kinds in zip(*(b.column(c).to_pylist() for c in ("part", "no", "kinds")), strict=True):
                if (part, no) in wanted:
                    found = work_on(np.frombuffer(kinds, np.uint8), wanted[part, no])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part], pa.int32()), pa.array([no], pa.int64()), pa.array([found], pa.list_(pa.int32()))],
                        names=["part", "no", "found"])

    rows = stretches.filter("edge").select("part", "no", "kinds").mapInArrow(apply, columns)
    return [((r["part"], r["no"]), r["found"]) for r in rows.collect()]


@dataclass(frozen=True)
class Link:
    """What a stretch at the edge of a part needs to know of its conversation."""

    behind: Vector  # the vector behind its last row
    state: int  # the state it is entered in
    last: bool  # the conversation ends with it
    clash: bool  # its first row may not follow the last one of the part before


def stitch(stretches: DataFrame) -> tuple[dict[tuple[int, int], Link], int]:
    """Links of the stretches whose conversation lies in several parts, and the fix-up passes taken."""
    found = "part int, no long, found array<int>"
    ends = stretches.filter("edge").select(
        "part", "no", "conv", F.conv(F.hex(F.substring("kinds", 1, 1)), 16, 10).cast("int").alias("head"),
        F.conv(F.hex(F.substring("kinds", -1, 1)), 16, 10).cast("int").alias("foot"))
    rows = sorted(ends.collect(), key=lambda r: (r["part"], r["no"]))
    chains: list[list] = []
    for before, r in zip([None, *rows], rows):
        if before is not None and before["part"] != r["part"] and before["conv"] == r["conv"]:
            chains[-1].append(r)
        else:
            chains.append([r])
    chains = [[((r["part"], r["no"]), r) for r in chain] for chain in chains if len(chain) > 1]
    if not chains:
        return {}, 0
    # speculation: every stretch but the last starts as if its conversation ended there
    behind = {key: END for chain in chains for key, _ in chain}
    ahead = {k: tuple(v) for k, v in _over_edges(stretches, behind, lambda x, v: list(backward(x, v)[0]), found)}
    passes = 0
    while True:
        again = {a: (behind[a], ahead[b]) for chain in chains for (a, _), (b, _) in zip(chain, chain[1:])
                 if behind[a] != ahead[b]}
        if not again:
            break
        passes += 1
        behind.update({k: new for k, (_, new) in again.items()})
        for k, v in _over_edges(stretches, again, lambda x, v: rerun(x, *v), found):
            if v is not None:
                ahead[k] = tuple(v)
    leaves = dict(_over_edges(stretches, behind, exits, found))
    links = {}
    for chain in chains:
        state = 0
        for n, (key, r) in enumerate(chain):
            pair = n and (chain[n - 1][1]["foot"] % 8, r["head"] % 8)
            links[key] = Link(behind[key], state, n == len(chain) - 1, bool(n) and pair not in LEGAL_PAIRS)
            state = leaves[key][state]
    return links, passes


def audits(stretches: DataFrame, links: dict[tuple[int, int], Link]) -> DataFrame:
    """`conv`, `part`, `audit`, `cost` and the counts of faults and illegal neighbours, of every stretch."""
    whole = Link(END, 0, True, False)
    legal = np.zeros((8, 8), bool)
    for a, b in LEGAL_PAIRS:
        legal[a, b] = True
    counts = ["cost", "blank", "duplicate", "truncated", "illegal"]

    def apply(batches):
        for b in batches:
            texts, numbers = [], []
            for part, no, kinds in zip(*(b.column(c).to_pylist() for c in ("part", "no", "kinds")), strict=True):
                link = links.get((part, no), whole)
                x = np.frombuffer(kinds, np.uint8)
                audit, cost, state = trace(x, link.behind, link.state)
                if link.last:
                    audit, cost = audit + "I" * (END[state] // INSERT_COST), cost + END[state]
                fault, initial = x // 8, x % 8
                bad = int((~legal[initial[:-1], initial[1:]]).sum()) + link.clash
                texts.append(audit)
                numbers.append((cost, *(int((fault == f).sum()) for f in (BLANK, DUPLICATE, TRUNCATED)), bad))
            yield pa.RecordBatch.from_arrays(
                [b.column("conv"), b.column("part"), pa.array(texts, pa.string()),
                 *(pa.array(c, pa.int64()) for c in (zip(*numbers, strict=True) if numbers else [[]] * 5))],
                names=["conv", "part", "audit", *counts])

    kind_of = stretches.schema["conv"].dataType.simpleString()
    return stretches.mapInArrow(apply, f"conv {kind_of}, part int, audit string, " + ", ".join(f"{c} long" for c in counts))


# --- the operator ------------------------------------------------------------
class _Conversation:
    """One conversation while its rows pass in order; holds its audit, not its texts."""

    def __init__(self, conv):
        self.conv = conv
        self.audit: list[str] = []
        self.counts = [0] * 5
        self.at = self.state = self.turns = 0
        self.low = self.high = None
        self.text = ""

    def piece(self, audit: str, counts: list[int]) -> None:
        self.audit.append(audit)
        self.counts = [a + b for a, b in zip(self.counts, counts, strict=True)]

    def rows(self, role: str | None, text: str | None) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of what stays up to and with the next row; of the end if there is none."""
        if self.audit:
            self.text, self.audit = "".join(self.audit), []
        while self.at < len(self.text):
            letter = self.text[self.at]
            if letter != "I" and role is None:
                return
            self.at += 1
            if letter == "D":
                return
            if letter == "K":
                initial = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[:1]]
                self.state = KEEP[self.state, initial]
                yield "K", role, text
                return
            self.state = NEXT[self.state]
            yield letter, ROLE_OF[self.state], "" if letter == "I" else text
            if letter == "R":
                return

    def turn(self, turn: int | None) -> None:
        """Turns come in rising order, nulls first."""
        if turn is not None:
            self.turns += self.high != turn
            self.low = turn if self.low is None else self.low
            self.high = turn

    @property
    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Conversation, str, str, str]]:
    """(conversation, edit, role, text) in order; an edit of "" ends a conversation."""
    now = None
    for b in batches:
        columns = [b.column(c).to_pylist() for c in ("conv", "audit", "counts", "present", "turn", "role", "text")]
        for conv, audit, counts, present, turn, role, text in zip(*columns, strict=True):
            if now is None or conv != now.conv:
                if now is not None:
                    yield from ((now, *r) for r in now.rows(None, None))
                    yield now, "", "", ""
                now = _Conversation(conv)
            if audit is not None:
                now.piece(audit, counts)
            elif present:
                now.turn(turn)
                yield from ((now, *r) for r in now.rows(role, text))
    if now is not None:
        yield from ((now, *r) for r in now.rows(None, None))
        yield now, "", "", ""


def in_order(rows: DataFrame, work: Workspace) -> DataFrame:
    """Audit pieces and rows of each conversation in one sorted run, pieces first.

    `rows` holds conv, turn, role, text and present (false: the row is gone, its
    conversation stays). Texts are shuffled here only, once. A conversation ends in one
    task, through which its sorted rows stream: its digest is one chain by definition.
    """
    rows = rows.select("conv", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                       F.coalesce("text", F.lit(" ")).alias("text"), "present")
    marked = with_faults(rows)
    stretches = ordered_kinds(marked.filter("present"), work)
    links, _ = stitch(stretches)
    pieces = audits(stretches, links)
    pieces = pieces.select("conv", "part", "audit", F.array("cost", "blank", "duplicate", "truncated", "illegal").alias("counts"))
    texts = marked.select("conv", *ORDER, "role", "text", "present")
    run = pieces.unionByName(texts, allowMissingColumns=True)
    # pieces have a part, rows none; nulls go last here
    return run.repartition("conv").sortWithinPartitions("conv", F.asc_nulls_last("part"), *ORDER)


def _source(df: DataFrame, conv: str, turn: str, role: str, text: str, present: str | None) -> DataFrame:
    column = lambda c, name: F.col(f"`{c}`").alias(name)
    return df.select(column(conv, "conv"), column(turn, "turn").cast("long").alias("turn"), column(role, "role"),
                     column(text, "text"), (F.lit(True) if present is None else F.col(f"`{present}`")).alias("present"))


def repair(df: DataFrame, work: Workspace, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text", present: str | None = None) -> DataFrame:
    """The repaired rows: `conv`, `place` (from 0), `edit` (K, R or I), `role` and `text`.

    Rows go by turn, nulls first; equal turns by a digest of role and text. A null role
    or text is one space, so such a row is blank or of no known role. A null
    conversation is a conversation. Repeated rows are duplicates. Texts of any length
    and conversations of any number of rows; columns of other names are not read.
    A conversation of which no row is present, and an empty table, give no rows.
    """
    run = in_order(_source(df, conv, turn, role, text, present), work)

    def apply(batches):
        rows: list[tuple] = []
        place = 0
        for now, edit, r, t in _conversations(batches):
            if edit:
                rows.append((now.conv, place, edit, r, t))
            place = place + 1 if edit else 0
            if len(rows) >= 2000:
                yield batch(rows)
                rows = []
        if rows:
            yield batch(rows)

    def batch(rows):
        c = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(c[0]).cast(arrow), pa.array(c[1], pa.int64()), *(pa.array(x, pa.string()) for x in c[2:])],
            names=["conv", "place", "edit", "role", "text"])

    kind, arrow = _kinds_of(run)
    return run.mapInArrow(apply, f"conv {kind}, place long, edit string, role string, text string")


def summaries(df: DataFrame, work: Workspace, conv: str = "conv_id", turn: str = "turn", role: str = "role",
              text: str = "text", present: str | None = None) -> DataFrame:
    """Faults, cost, audit and a digest of the repaired rows of every conversation; odd rows as in `repair`.

    A conversation of which no row is present has zeros, an empty audit and the digest
    of an empty string.
    """
    run = in_order(_source(df, conv, turn, role, text, present), work)

    def apply(batches):
        out: list[tuple] = []
        digest, empty = hashlib.sha256(), True
        for now, edit, r, t in _conversations(batches):
            if edit:
                digest.update(f"{'' if empty else chr(10)}{r}:{t}".encode())
                empty = False
                continue
            cost, blank, duplicate, truncated, illegal = now.counts
            out.append((now.conv, now.gaps, blank, duplicate, truncated, illegal, cost, now.text, digest.hexdigest()))
            digest, empty = hashlib.sha256(), True
            if len(out) >= 2000:
                yield batch(out)
                out = []
        if out:
            yield batch(out)

    def batch(out):
        c = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(c[0]).cast(arrow), *(pa.array(x, pa.int64()) for x in c[1:7]),
             *(pa.array(x, pa.string()) for x in c[7:])], names=names)

    names = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    kind, arrow = _kinds_of(run)
    return run.mapInArrow(apply, f"conv {kind}, " + ", ".join(f"{c} long" for c in names[1:7])
                          + ", audit string, repaired_sha256 string")


def _kinds_of(run: DataFrame) -> tuple[str, pa.DataType]:
    kind = run.schema["conv"].dataType
    return kind.simpleString(), to_arrow_type(kind)


def damaged(conversations: DataFrame) -> DataFrame:
    """`conversations` with planted faults by the checksum of conversation and turn; a dropped row is not present."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    text = F.coalesce("text", F.lit(" "))
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("damage"))
    damage = F.col("damage")
    return rows.select(
        "conv_id", "turn", F.when(damage == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(damage == 1, "").when(damage == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        (damage != 0).alias("present"),
        F.explode(F.when(damage == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))


@query()
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, least edits and repaired digest of every conversation; odd rows as in `repair`."""
    rows = damaged(table_rows(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return summaries(rows, Workspace(spark, "op13"), present="present").withColumnRenamed("conv", "conv_id")
