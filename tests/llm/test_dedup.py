"""Suffix and SimHash deduplication against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyarrow.fs import FileSelector

from regfacts.llm import relative_parse, simhash, suffix_dedup
from regfacts.llm.common import Workspace, file_system, whole_groups
from regfacts.llm.components import components
from regfacts.llm.run_index import RunLengthIndex

DOCS = "doc_id long, text string"


def made_texts(seed: int, n: int = 60) -> list[str | None]:
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abé") for _ in range(rng.randint(1, 4)))
    passage = " ".join(word() for _ in range(20))
    out: list[str | None] = [None, "", " ", "x"]
    for _ in range(n):
        kind = rng.random()
        if kind < 0.3 and len(out) > 8:
            t = list(rng.choice([x for x in out if x]))
            for _ in range(rng.randint(0, 2)):
                t[rng.randrange(len(t))] = rng.choice("abé ")
            out.append("".join(t))
        elif kind < 0.7:
            out.append(f"{' '.join(word() for _ in range(rng.randint(0, 9)))} {passage} {word()}")
        elif kind < 0.8:
            out.append("ab" * rng.randint(5, 60))
        else:
            out.append(" ".join(word() for _ in range(rng.randint(1, 60))))
    return out


def cut_by_hand(rows, length):
    seen = Counter()
    data = [(d, (t or "").encode()) for d, t in rows]
    for _, t in data:
        seen.update(t[i:i + length] for i in range(len(t) - length + 1))
    out = []
    for d, t in data:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("group", [512, 1])
def test_suffix_dedup_equals_brute_force(spark, group):
    texts = made_texts(group)
    rows = [*enumerate(texts), (None, texts[10]), (7, texts[7]), (8, "q")]
    docs = spark.createDataFrame(rows, DOCS)
    got = suffix_dedup.repeated_bytes(docs, Workspace(spark, "t"), suffix_dedup.DIGEST, suffix_dedup.digest, length=24,
                                      kgram=5, group=group).collect()
    assert sorted(map(tuple, got), key=repr) == cut_by_hand(rows, 24)


def test_suffix_dedup_keeps_columns_and_characters(spark):
    text = "é" * 40
    docs = spark.createDataFrame([(1, "x" + text, "a", 5), (2, text + "y", "b", 6), (3, None, None, None)],
                                 "doc_id long, text string, row1 string, n_chars long")
    got = {r.doc_id: r for r in suffix_dedup.without_repeats(docs, Workspace(spark, "t"), length=30, kgram=8).collect()}
    assert (got[1].text, got[2].text, got[3].text) == ("x", "y", None)
    assert (got[1].row1, got[2].n_chars) == ("a", 1)
    empty = suffix_dedup.without_repeats(docs.limit(0), Workspace(spark, "t"))
    assert empty.columns == docs.columns and empty.count() == 0


def test_marks_of_equal_rows_are_collected_once(spark, monkeypatch):
    most = []
    finish = suffix_dedup.finish_spans

    def watched(docs, per_row, work, **options):
        most.append(max(len(r.marks) for r in per_row.collect()))
        return finish(docs, per_row, work, **options)

    monkeypatch.setattr(suffix_dedup, "finish_spans", watched)
    text = "".join(random.Random(3).choices("abcdefgh", k=300))
    for n in (2, 40):
        rows = [(None, text)] * n
        got = suffix_dedup.repeated_bytes(spark.createDataFrame(rows, DOCS), Workspace(spark, "t"), suffix_dedup.DIGEST,
                                          suffix_dedup.digest, length=24, kgram=5).collect()
        assert sorted(map(tuple, got), key=repr) == cut_by_hand(rows, 24)
    assert most[0] == most[1]


def test_suffix_stage_removes_passages_of_51_words(spark):
    import corpus_pipeline

    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdefgé") for _ in range(n))
    long, short, less = ([word(n) for _ in range(k)] for n, k in ((5, 51), (2, 51), (12, 49)))
    ends = [[word(6) for _ in range(30)] for _ in range(7)]
    text = lambda a, body, b, gap=" ": " ".join(a) + " " + gap.join(body) + " " + " ".join(b)
    rows = [(1, text(ends[0], long, ends[1])), (2, text(ends[2], long, ends[3], "\n")), (3, text([], short, ends[4])),
            (4, text(ends[5], short, [])), (5, text(ends[6], less, [])), (6, text(ends[0][:9], less, ends[1][:9])), (7, None)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_chars long")
    got = {r.doc_id: r for r in corpus_pipeline.suffix_stage(spark, docs, "").collect()}
    want = {1: ends[0] + ends[1], 2: ends[2] + ends[3], 3: ends[4], 4: ends[5]}
    assert {d: got[d].text.split() for d in want} == want
    assert (got[5].text, got[6].text, got[7].text) == (rows[4][1], rows[5][1], None)
    assert got[4].n_chars == len(got[4].text)


def test_run_index_compresses_copies():
    body = bytes(random.Random(1).choices(b"abcdefgh", k=500))
    index = RunLengthIndex([body] * 8)
    assert len(index.heads) < index.n / 6
    assert index.matching_statistics()[0] == 500


def components_by_hand(prints, ids, radius):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in ids:
        for j in ids:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def print_by_hand(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_components_equal_brute_force(spark):
    texts = made_texts(5)
    docs = spark.createDataFrame([*enumerate(texts), (None, "a b"), (9, texts[9])], DOCS)
    got = simhash.near_components(docs, Workspace(spark, "t"), shingle_words=4, radius=4).collect()
    prints = {i: print_by_hand(t) for i, t in enumerate(texts)}
    want = components_by_hand(prints, list(prints), 4)
    assert len(got) == len(texts) + 2
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.print % (1 << 64), r.component_id) == (prints[r.doc_id], want[r.doc_id])


def test_masks_cover_every_pair_within_the_radius():
    masks = simhash.covering_masks(4)
    assert len(masks) == 31
    rng = random.Random(2)
    for _ in range(3000):
        x = sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
        assert any(m & x == 0 for m in masks)


@pytest.mark.parametrize("block", [8192, 4])
def test_links_of_large_buckets_keep_components(spark, block):
    rng = random.Random(block)
    base = [rng.getrandbits(63) for _ in range(3)]
    prints = sorted({b ^ (1 << rng.randrange(62)) ^ (1 << rng.randrange(62)) for b in base for _ in range(40)})
    frame = spark.createDataFrame([(p,) for p in prints], "print long")
    links = simhash.print_links(frame, 4, Workspace(spark, "t"), block=block).toDF("a", "b")
    roots = {r.node: r.root for r in components(links, Workspace(spark, "t")).collect()}
    want = components_by_hand({p: p for p in prints}, prints, 4)
    assert {p: roots.get(p, p) for p in prints} == want


def test_no_links_no_components(spark):
    assert components(spark.createDataFrame([], "a long, b long"), Workspace(spark, "t")).count() == 0


def shingles_by_hand(text):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.mark.parametrize("text_block", [8 << 20, 2000])
def test_near_dedup_finds_all_texts_of_similarity_0_8(spark, text_block):
    rng = random.Random(6)
    texts = [None, " ", "a b", "A  b"]
    for _ in range(60):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([12, 80, 300]))]
        texts.append(" ".join(words))
        for _ in range(3):
            near = list(words)
            for _ in range(rng.randint(1, max(1, len(words) // 30))):
                near[rng.randrange(len(near))] = f"x{rng.randrange(3000)}"
            texts.append(" ".join(near))
    rows = [*enumerate(texts), (None, texts[5]), (9, "another text of this id")]
    sets = [(d, shingles_by_hand(t)) for d, t in rows if d is not None]
    root = {d: d for d, _ in sets}

    def find(x):
        return x if root[x] == x else find(root[x])

    pairs = 0
    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s == t or len(s & t) >= 0.8 * len(s | t):
                pairs += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert pairs > 100
    docs = spark.createDataFrame(rows, DOCS)
    got = simhash.similar_components(docs, Workspace(spark, "t"), shingle_words=5, similarity=0.8, text_block=text_block)
    found = {r.doc_id: r.component_id for r in got.collect() if r.doc_id not in (None, 9)}
    assert found == {d: find(d) for d in root if d != 9}
    kept = sorted(r.doc_id for r in simhash.one_per_group(docs, Workspace(spark, "t")).collect() if r.doc_id is not None)
    # the other text of id 9 is like no other: it stays beside the groups of the texts above
    assert kept == sorted([*{find(d) for d in root}, 9])


def parsed_by_hand(rows, length):
    seen, out = {}, []
    for d, t in rows:
        w = (t or "").encode().split()
        for i in range(len(w) - length + 1):
            key = tuple(w[i:i + length])
            if d is not None:
                seen[key] = min(d, seen.get(key, d))
    for d, t in rows:
        w = (t or "").encode().split()
        gone = set()
        for i in range(len(w) - length + 1):
            if d is not None and seen[tuple(w[i:i + length])] < d:
                gone.update(range(i, i + length))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("group", [512, 1])
def test_relative_parse_equals_brute_force(spark, group):
    texts = made_texts(group + 1)
    rows = [*enumerate(texts), (None, texts[10]), (7, texts[7]), (8, texts[9])]
    got = relative_parse.repeated_words(
        spark.createDataFrame(rows, DOCS), Workspace(spark, "t"), relative_parse.DIGEST, relative_parse.digest, length=5,
        kgram=2, group=group).collect()
    assert sorted(map(tuple, got), key=repr) == parsed_by_hand(rows, 5)


def test_parse_joins_factors_and_looks_up_windows_across_ends():
    word = {c: xxhash.xxh3_64_digest(c) for c in "abcdefghij"}
    body = lambda x: b"".join(word[c] for c in x)
    block = relative_parse.ReferenceBlock(3)
    block.add(body("abcd"))
    block.add(body("cde"))
    assert block.parse(body("xabcdefa".replace("x", "j"))) == [(1, 5), (3, 6)]
    assert block.parse(body("ab")) == []


def test_the_pipeline_groups_by_fingerprints(spark):
    import corpus_pipeline

    cycle = "alpha beta gamma delta epsilon " * 200
    more = " ".join(f"w{i}" for i in range(30))
    rows = [(7, cycle + more), (3, cycle), (5, "one two three four five six seven"), (None, cycle), (8, None), (9, " ")]
    docs = spark.createDataFrame(rows, DOCS)
    # few shingles in common, but a fingerprint counts repeats
    assert (simhash.fingerprint(rows[0][1].encode(), 4) ^ simhash.fingerprint(cycle.encode(), 4)).bit_count() <= 4
    assert sorted(r.doc_id or 0 for r in simhash.one_per_group(docs, Workspace(spark, "t")).collect()) == [0, 3, 5, 7, 8]
    out = corpus_pipeline.simhash_stage(spark, docs, "")
    assert out.columns == docs.columns and sorted(r.doc_id or 0 for r in out.collect()) == [0, 3, 5, 8]


def test_near_dedup_of_the_pipeline_neither_copies_texts_nor_keeps_its_tables(spark, monkeypatch):
    import corpus_pipeline

    words = [f"w{i}" for i in range(60)]
    rows = [(4, " ".join(words)), (2, " ".join([*words[:59], "x"])), (2, " ".join(words)), (2, " ".join(words)), (None, "a"),
            (None, "a"), (6, None), (5, " "), (7, "b c d e f g h"), (8, "b c d e f g h"), (8, "other words of one id too"),
            (9, " ".join(words[::-1])), (10, " ".join([*words[:0:-1], "y"]))]
    docs = spark.createDataFrame(rows, DOCS)
    two = simhash.one_per_group(simhash.one_per_fingerprint(docs, Workspace(spark, "t")), Workspace(spark, "t"))
    written, write = [], Workspace.write
    monkeypatch.setattr(Workspace, "write", lambda self, df, name: written.append((self, name, df.columns)) or write(self, df, name))
    got = corpus_pipeline.simhash_stage(spark, docs, "")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, two.collect()), key=repr)
    # texts are written for groups of candidates only
    assert {name for _, name, columns in written if "text" in columns} == {"member-texts"}
    left = {name for work, name, _ in written if file_system(work.path(name))[0].get_file_info(
        file_system(work.path(name))[1]).type.name == "Directory"}
    assert not left & {"prints", "firsts", "member-texts", "members", "buckets", "simhash-prints", "simhash-links"}


def test_suffix_dedup_drops_the_tables_of_its_first_pass(spark):
    work = Workspace(spark, "t")
    docs = spark.createDataFrame([(1, "abcdefgh" * 9), (2, "xabcdefgh" * 9), (3, None)], DOCS)
    got = suffix_dedup.repeated_bytes(docs, work, suffix_dedup.DIGEST, suffix_dedup.digest, length=24, kgram=5)
    fs, root = file_system(work.root)
    names = {x.base_name for x in fs.get_file_info(FileSelector(root))}
    assert "first" in names and not names & {"frames", "shared", "live", "contents", "number"}
    assert got.count() == 3


def test_unlike_texts_of_one_id_stay(spark):
    rng = random.Random(11)
    text = lambda: " ".join("".join(rng.choice("abcdef") for _ in range(6)) for _ in range(40))
    a, b, c = text(), text(), text()
    many = [(9, text()) for _ in range(6)]
    rows = [(1, a), (9, b), (9, a), (9, b), *many, (20, b + " x"), (None, a), (None, a), (30, c), (30, c), (40, None), (41, "")]
    docs = spark.createDataFrame([(d, t, 1, 2, "q", "w") for d, t in rows],
                                 "doc_id long, text string, __id int, __rank int, id string, hash string")
    out = simhash.one_per_group(docs, Workspace(spark, "t"))
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    assert got == sorted([(1, a), (9, b), *many, (None, a), (None, a), (30, c), (40, None)], key=repr)


def test_suffix_dedup_of_a_text_of_several_pieces(spark):
    rng = random.Random(12)
    body = "".join(rng.choice("abcdefghijklmnop") for _ in range(suffix_dedup.CHUNK + 90_000))
    edge = suffix_dedup.CHUNK
    rows = [(1, body), (2, "0" + body[edge - 300:edge + 300] + "1"), (3, body[:50] + "2"), (4, body[-60:]), (5, "zz")]
    got = suffix_dedup.repeated_bytes(spark.createDataFrame(rows, DOCS), Workspace(spark, "t"), suffix_dedup.DIGEST,
                                      suffix_dedup.digest, length=24, kgram=5).collect()
    assert sorted(map(tuple, got), key=repr) == cut_by_hand(rows, 24)


@pytest.mark.parametrize("text", [b"", b" \t\n", b"a", " é\x0bb\x1cc\u00a0d \r\n".encode(), b"x  y\x0c z"])
def test_places_are_those_of_split(text):
    starts, ends = suffix_dedup.word_places(text)
    assert [text[a:b] for a, b in zip(starts, ends, strict=True)] == text.split()


def test_whole_groups_are_bounded_by_the_limit_not_by_the_batch():
    keys = np.repeat(np.arange(4000), 5)
    batches = pa.table({"k": keys, "n": np.arange(20000)}).to_batches(max_chunksize=10000)
    tables = list(whole_groups(iter(batches), ["k"], 900))
    assert max(t.num_rows for t in tables) <= 2 * 900
    assert np.concatenate([t.column("n").to_numpy() for t in tables]).tolist() == list(range(20000))
    assert all(a.column("k")[-1] != b.column("k")[0] for a, b in zip(tables, tables[1:], strict=False))
