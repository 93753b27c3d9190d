"""Whitening, licence scan and conversation repair against brute force, through operator and query."""

import collections
import hashlib
import heapq
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from regfacts.llm import conversation_repair as repair
from regfacts.llm import license_scan, whitening
from regfacts.llm.common import Workspace


# --- whitening ---------------------------------------------------------------
def write(spark, tmp_path, name, rows, ddl):
    spark.createDataFrame(rows, ddl).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def vectors(rng, n):
    base = [[rng.gauss(0, 0.2) for _ in range(5)] for _ in range(n)]
    rows = [(i, v, "c") for i, v in enumerate(base)]
    rows += [(n + i, base[0], "c") for i in range(2 * n)]  # a hot vector
    return rows + [(None, base[1], None), (3, base[3], "c"), (3, base[3], "c"), (901, None, "c"),
                   (902, [0.1, None, 0.2, 0.3, 0.4], "c"), (903, [0.1, math.nan, 0.2, 0.3, 0.4], "c"),
                   (904, [0.1, math.inf, 0.2, 0.3, 0.4], "c"), (905, [0.1, 3e38, 0.2, 0.3, 0.4], "c")]


VECTORS = "vec_id long, embedding array<float>, component string"


def test_whitening_query_equals_numpy(spark, tmp_path):
    rows = vectors(random.Random(1), 40)
    sf = write(spark, tmp_path, "embeddings", rows, VECTORS)
    got = whitening.op11_whitened_embeddings(spark, sf).toPandas()
    kept = [(i, v) for i, v, _ in rows if i not in (901, 902, 903, 904, 905)]
    x = np.floor(64 * np.array([v for _, v in kept], np.float32).astype(np.float64)).astype(np.int64) + 1_000_000
    distinct = np.unique(x, axis=0)
    n, sums = len(distinct), distinct.sum(axis=0)
    v = np.cov(distinct.T, bias=True)
    assert len(got) == 5 * len(kept) and (got["n"] == n).all() and got["identity_error"].max() < 1e-9
    deviations = ((n * x - sums) ** 2).sum(axis=1)
    assert sorted(got[got.component == 1]["deviation"]) == sorted(deviations)
    e, u = np.linalg.eigh(v)
    for k in range(5):
        mine = np.sort(got[got.component == k + 1]["whitened"].to_numpy())
        theirs = (x - sums / n) @ u[:, 4 - k] / math.sqrt(e[4 - k])
        assert min(np.abs(mine - np.sort(t)).max() for t in (theirs, -theirs)) < 1e-8
        assert np.allclose(got[got.component == k + 1]["explained"], e[4 - k] / e.sum(), rtol=1e-9)


def test_whitening_by_count_and_odd_rows(spark):
    rows = vectors(random.Random(2), 30)
    df = spark.createDataFrame(rows, VECTORS)
    out, error = whitening.whiten(df, Workspace(spark, "t"), "embedding", by_count=True)
    assert error < 1e-9 and {r.n for r in out.collect()} == {len(rows) - 5}
    assert out.columns == ["row", "n", "deviation", "whitened", "explained"]  # names cannot clash
    empty, error = whitening.whiten(df.limit(0), Workspace(spark, "t"), "embedding")
    assert empty.count() == 0 and error == 0.0
    # one distinct vector has no variance; lengths are fits of their own; an empty vector has no components
    few = spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, []), (4, [0.1]), (5, [0.2])], "vec_id long, embedding array<float>")
    out, _ = whitening.whiten(few, Workspace(spark, "t"), "embedding")
    assert {r.row.vec_id: (r.n, len(r.whitened)) for r in out.collect()} == {1: (1, 0), 2: (1, 0), 3: (1, 0), 4: (2, 1), 5: (2, 1)}


def test_deviation_is_exact_beyond_64_bits(spark):
    big = spark.createDataFrame([(1, [4e13, 0.0]), (2, [-4e13, 1.0]), (3, [1e13, 2.0])], "vec_id long, embedding array<double>")
    out, _ = whitening.whiten(big, Workspace(spark, "t"), "embedding")
    x = [[math.floor(64 * a) + 1_000_000 for a in v] for v in ([4e13, 0.0], [-4e13, 1.0], [1e13, 2.0])]
    sums = [sum(c) for c in zip(*x)]
    want = [sum((3 * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    assert [int(r.deviation) for r in out.orderBy("row.vec_id").collect()] == want


# --- licence scan ------------------------------------------------------------
DOCS = "doc_id long, text string, licences string, doc string"


def licence_docs():
    rng = random.Random(3)
    noise = lambda n: " ".join(rng.choice("the of mit license cc by general all rights free software zeta".split()) for _ in range(n))
    rows = [(2000 + i, noise(rng.randrange(80)), "x", "y") for i in range(120)]
    for i, (_, wording, _) in enumerate(license_scan.TEMPLATES):
        rows.append((500 + i, f"{noise(9)}\n{wording.title()}. {noise(5)}", None, "y"))
        cut = wording.split()
        rows.append((600 + i, " ".join(cut[:len(cut) // 2]), None, "y"))
    rows += [(None, None, None, None), (7, "", None, None), (8, " \n", None, None), (8, " \n", None, None),
             (9, "CC BY cc by ALL RIGHTS RESERVED", "x", "y"), (10, "Released under the KMIT LICENSE İ", "x", "y"),
             (11, "all rights reserved " * 20_000, "x", "y"), (12, "é-cc by\x00cc-by ß", "x", "y")]
    return rows


def test_licence_query_equals_sql_on_odd_rows(spark, tmp_path):
    sf = write(spark, tmp_path, "documents", licence_docs(), DOCS)
    got = license_scan.op12_license_scan(spark, sf)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet/*.parquet'")
    result = con.execute(license_scan.SQL)
    columns = [d[0] for d in result.description]
    assert columns == got.columns
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, result.fetchall()))


def test_every_template_is_found_at_its_place(spark):
    docs = spark.createDataFrame(licence_docs(), DOCS)
    got = {r.doc.doc_id: r for r in license_scan.scan(docs, Workspace(spark, "t")).collect()}
    for i, (label, _, _) in enumerate(license_scan.TEMPLATES):
        hit = [f for f in got[500 + i].licences.found if f.template == i]
        assert hit and hit[0].label == label and hit[0].word == 9 and hit[0].share == 1.0, (i, label)
    assert got[11].licences.n_base == 20_000 and got[11].licences.last_word == 59_997
    assert license_scan.scan(docs.limit(0), Workspace(spark, "t")).count() == 0
    plan = license_scan.scan(docs, Workspace(spark, "t"))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# --- conversation repair -----------------------------------------------------
FITS = {"": "su", "s": "u", "u": "a", "a": "u"}


def cheapest(rows):
    """Dijkstra over (cost, audit) of rows (role, text): the summary without gaps."""
    seen, faults = set(), []
    for role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    queue, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, state, out = heapq.heappop(queue)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            bad = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
            text = "\n".join(f"{r}:{t}" for r, t in out)
            return (*(faults.count(f) for f in "bdt"), bad, cost, audit, hashlib.sha256(text.encode()).hexdigest())
        steps = [(2, "I", 0, role, (role, "")) for role in ("user", "assistant")]
        if i < len(rows):
            role, text = rows[i]
            heapq.heappush(queue, (cost + 3, audit + "D", i + 1, state, out))
            if faults[i] not in ("b", "d"):
                more = faults[i] == "t"
                steps += [(more, "K", 1, role, (role, text))]
                steps += [(2 + more, "R", 1, r, (r, text)) for r in ("user", "assistant")]
        for c, letter, n, role, row in steps:
            if role[:1] and role[:1] in FITS[state]:
                heapq.heappush(queue, (cost + c, audit + letter, i + n, role[:1], (*out, row)))


def expected(rows):
    held = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        damage = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if damage == 1 else re.sub("[.!?]", "", text) if damage == 2 else text
        held[conv] += [(turn, "user" if damage == 4 else role, text)] * (damage and 1 + (damage == 3))
    out = {}
    for conv, kept in held.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0,
                                 hashlib.sha256(f"{len(r[1])}:{r[1]}:{r[2]}".encode()).digest()[:16]))
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *cheapest([(r, t) for _, r, t in kept]))
    return out


COLUMNS = "conv_id long, turn long, role string, text string, conv string, part int"
NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def odd_conversations():
    rng = random.Random(4)
    roles, texts = ["user", "assistant", "system", "tool", "u", None], ["a.", "b", "c!", "", " \n", "d?\x0b", None, "e" * 90_000]
    rows = [(c, t if rng.random() < 0.9 else None, rng.choice(roles), rng.choice(texts) if rng.random() < 0.4 else f"x{t}.")
            for c in range(60) for t in range(rng.randrange(1, 9))]
    rows += [(7000, t, rng.choice(roles), rng.choice(texts[:5]) if rng.random() < 0.5 else f"y {t}?") for t in range(1500)]
    return rows + [(None, 1, "user", "hi."), (None, None, None, None), (5, 2, "user", "same."), (5, 2, "user", "same.")]


def test_repair_query_equals_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(repair, "ROWS_A_TASK", 100)  # the long conversation lies in many parts
    rows = odd_conversations()
    sf = write(spark, tmp_path, "conversations", [(*r, "z", 1) for r in rows], COLUMNS)
    got = {r.conv_id: tuple(r[c] for c in NAMES) for r in repair.op13_conversation_repair(spark, sf).collect()}
    want = expected(rows)
    assert got.keys() == want.keys()
    assert {k: v for k, v in got.items() if v != want[k]} == {}


def test_repaired_rows_are_legal_and_empty_tables_give_none(spark):
    df = spark.createDataFrame([(*r, "z", 1) for r in odd_conversations()], COLUMNS)
    rows = collections.defaultdict(list)
    for r in repair.repair(df, Workspace(spark, "t")).orderBy("conv", "place").collect():
        rows[r.conv].append(r)
    for found in rows.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in found))
        assert [r.place for r in found] == list(range(len(found)))
    assert repair.repair(df.limit(0), Workspace(spark, "t")).count() == 0
    assert repair.summaries(df.limit(0), Workspace(spark, "t")).count() == 0
    gone = repair.summaries(df.withColumn("no", F.lit(False)), Workspace(spark, "t"), present="no")
    assert {(r.cost, r.audit, r.repaired_sha256) for r in gone.collect()} == {(0, "", hashlib.sha256(b"").hexdigest())}


def test_vectors_meet_and_constants_add_up():
    rng = random.Random(5)
    for _ in range(200):
        kinds = np.array([8 * rng.randrange(4) + rng.randrange(4) for _ in range(rng.randrange(1, 40))], np.uint8)
        other = (rng.randrange(4), rng.randrange(4), 0, rng.randrange(4))
        old, total = repair.backward(kinds, repair.END)
        met = repair.rerun(kinds, repair.END, other)
        assert repair.backward(kinds, other)[0] == (old if met is None else met)
        leaves = repair.exits(kinds, repair.END)
        for state in range(4):
            audit, cost, left = repair.trace(kinds, repair.END, state)
            assert left == leaves[state] and cost + repair.END[left] == total + old[state]
            assert len(audit.replace("I", "")) == len(kinds)


@pytest.mark.parametrize("kind", range(4))
def test_forced_rows_can_only_go(kind):
    for fault in (repair.BLANK, repair.DUPLICATE):
        assert [e for e, _, _ in repair.edits(0, 8 * fault + kind)] == ["D"]
