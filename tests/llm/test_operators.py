"""Rules, archives, classifier, matching, model, packing and token files on small inputs."""

import gzip
import io
import math
import random
import zlib
from collections import Counter, defaultdict
from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F

from regfacts.llm import decontaminate, ordinal, packing, pitman_yor, quality_rules, token_files, tokens, warc
from regfacts.llm.common import Workspace, dealt_files

DOCS = "doc_id long, text string"
ODD = [(None, "a b"), (1, None), (2, ""), (3, " \n "), (4, "x " * 3000), (4, "x " * 3000), (5, "é" * 70_000)]


def odd_docs(spark, rows=ODD):
    return spark.createDataFrame([(d, t, "s") for d, t in rows], DOCS + ", s string")


def test_counts_of_a_text():
    text = "a b c a b c\n\n# x\n# x\né".encode()
    n_words, chars, symbols, dup, repeat = quality_rules.count_text(text)[:5]
    assert (n_words, chars, symbols, dup, repeat) == (11, 11, 2, 1, 6)
    assert quality_rules.count_text(b"") == (0,) * 8


def test_rules_reject_what_the_labels_reject(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(("w%d#" if i % 3 == 0 else "w%d") % rng.randrange(9999) for _ in range(60))) for i in range(120)]
    docs = odd_docs(spark, rows + [(900, None)])
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(90)] + [(91, None), (None, 1)], "doc_id long, quality int")
    rules = quality_rules.fit(docs, labels)
    kept = {r.doc_id for r in quality_rules.keep(docs, rules).collect()}
    assert kept == {i for i in range(120) if i % 3}
    assert quality_rules.fit(docs, labels.limit(0)) == []
    assert quality_rules.keep(odd_docs(spark), []).columns == ["doc_id", "text", "s"]


def test_archives_round_trip_and_are_members(spark, tmp_path):
    rows = [(5, "u", "<a>"), (3, "u\nx", "<a>"), (7, None, None), (2, "u", ""), (9, "u", "é"), (None, "u", "<a>"), (3, "u", "<a>")]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, offset int")
    work = Workspace(spark, "t")
    files = warc.normalise_archives(warc.write_archives(pages, work), work)
    got = sorted([(r.page_id, r.record_type, r.payload_bytes, r.refers_to) for r in warc.read_archives(files, work).collect()], key=repr)
    want = [(2, "response", 0, None), (3, "response", 3, None), (3, "response", 3, None), (5, "revisit", 3, 3),
            (7, "revisit", 0, 2), (9, "response", 2, None), (None, "response", 3, None)]
    assert got == sorted(want, key=repr)
    assert warc.read_archives(warc.normalise_archives(warc.write_archives(pages.limit(0), work2 := Workspace(spark, "t")), work2),
                              work2).count() == 0


def test_normaliser_reads_one_stream_and_indexes_every_record():
    records = [warc.record(i, "u", b"x" * i, None) for i in range(50)]
    sink, index = io.BytesIO(), io.BytesIO()
    assert warc.normalise(io.BytesIO(gzip.compress(b"".join(records))), sink, index) == 50
    places = list(warc.INDEX.iter_unpack(index.getvalue()))
    assert [zlib.decompress(sink.getvalue()[a:a + n], 31) for a, n in places] == records
    with pytest.raises((ValueError, EOFError)):
        warc.normalise(io.BytesIO(gzip.compress(b"".join(records)[:-9])), io.BytesIO(), io.BytesIO())


def test_classifier_orders_grades(spark):
    rng = random.Random(2)
    tell = ["awful", "plain", "lovely"]
    rows = [(i, " ".join([tell[i % 3]] + ["w%d" % rng.randrange(50) for _ in range(20)])) for i in range(600)]
    docs = odd_docs(spark, rows)
    ratings = spark.createDataFrame([(i, i % 3) for i in range(450)] + [(None, 1), (7, None)], "doc_id long, grade int")
    model = ordinal.fit(docs, ratings)
    assert model.thresholds[0] < model.thresholds[1]
    got = {r.doc_id: r for r in ordinal.select(docs, model).collect()}
    assert np.mean([got[i].kept == (i % 3 == 2) for i in range(450, 600)]) > 0.9
    assert ordinal.select(odd_docs(spark), model).count() == len(ODD)


def edit_distance_to_substring(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_edit_matching_equals_brute_force(spark):
    rng = random.Random(3)
    items = [(i, "".join(rng.choice("abcd ") for _ in range(rng.randint(20, 50)))) for i in range(12)]
    rows = []
    for d in range(60):
        t = list(rng.choice(items)[1])
        for _ in range(rng.randint(0, 9)):
            k = rng.randrange(len(t))
            t[k:k + 1] = rng.choice([[], ["a"], ["b", "c"]])
        rows.append((d, "".join(rng.choice("abcd") for _ in range(30)) + "".join(t) + "dd"))
    found = decontaminate.find_items(odd_docs(spark, rows + ODD), spark.createDataFrame(
        items + [(99, None), (None, "a")], "item_id long, text string"), error_share=0.1, block_chars=100)
    got = {(r.doc_id, r.item_id): r.distance for r in found.collect()}
    want = {}
    for d, t in rows + ODD[:1]:
        for i, s in items:
            s = decontaminate.normalized(s)
            e = edit_distance_to_substring(s, decontaminate.normalized(t))
            if e <= int(len(s) * 0.1):
                want[(d, i)] = e
    assert set(got) == set(want) and all(got[k] >= want[k] for k in want)
    clean = decontaminate.clean_documents(odd_docs(spark, rows), spark.createDataFrame(items, "item_id long, text string"),
                                          error_share=0.1)
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in rows} - {d for d, _ in want}


def test_model_probabilities_sum_to_one_and_beat_the_base(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice([["the", "cat"], ["a", "dog"], ["no", "END"]])[k % 2] for k in range(30))) for i in range(100, 180)]
    scored = pitman_yor.score_documents(odd_docs(spark, rows + ODD), Workspace(spark, "t"), block_bytes=500).collect()
    assert len(scored) == 80 + len(ODD)
    held = [r for r in scored if r.held_out and (r.doc_id or 0) > 5]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)
    assert {r.n_tokens for r in scored if r.doc_id in (2, 3)} == {1}
    assert all(r.train_tokens == scored[0].train_tokens for r in scored)


def test_model_tells_whole_context_words_apart(spark):
    # both contexts end in the same byte; only the whole word tells what follows
    rng = random.Random(9)
    follows = {"xa": "one", "ya": "two"}
    text = lambda k: " ".join(f"{c} {follows[c]}" for c in rng.choices(list(follows), k=k))
    docs = odd_docs(spark, [(i, text(30)) for i in range(100, 200)])
    scored = pitman_yor.score_documents(docs, Workspace(spark, "t"), block_bytes=5000).collect()
    held = [r for r in scored if r.held_out]
    # xa or ya is one choice of two, its follower is certain: about log10(2) / 2 a token
    assert held and -sum(r.score for r in held) / sum(r.n_tokens for r in held) < 0.2


def test_scores_depend_on_the_texts_alone(spark):
    rng = random.Random(11)
    rows = [(i, " ".join(rng.choice(["the", "a", "cat", "dog", "ran"]) for _ in range(40))) for i in range(60)]
    docs = odd_docs(spark, rows + ODD)
    runs = []
    for parts, block_bytes in ((2, 1 << 20), (7, 700)):
        scored = pitman_yor.score_documents(docs.repartition(parts), Workspace(spark, "t"), block_bytes=block_bytes)
        runs.append(sorted((r.doc_id or -1, r.n_tokens, r.score, r.base_score) for r in scored.collect()))
    assert runs[0] == runs[1]


def counted_pairs(spark, texts):
    """Counts of (context, word) of the texts, and every pair of a context with any word or an unknown one."""
    counts = {}
    for text in texts:
        for c, w in zip(*(x.tolist() for x in pitman_yor.pairs_of(text.encode())), strict=True):
            counts[c, w] = counts.get((c, w), 0) + 1
    words = {w for _, w in counts} | {12345}
    pairs = {(c, w): counts.get((c, w), 0) for c in {c for c, _ in counts} | {777} for w in words}
    frame = spark.createDataFrame([(c, w, n, [0]) for (c, w), n in pairs.items()],
                                  "context long, word long, n long, blocks array<int>")
    return pairs, frame


TOY = ["the cat ran", "the dog ran", "a cat a dog"] + ["the end"] * 90


def test_probabilities_of_a_context_sum_to_one(spark):
    _, frame = counted_pairs(spark, TOY)
    answers, n_train, _ = pitman_yor.fit(frame, Workspace(spark, "t"))
    totals = answers.groupBy("context").agg(F.sum("probability").alias("p"), F.min("probability").alias("least")).collect()
    assert len(totals) > 5 and all(abs(r.p - 1) < 1e-12 and r.least > 0 for r in totals)
    assert n_train == sum(len(t.split()) + 1 for t in TOY)


def seated_by_hand(sweep, keys, n, new, discount):
    """Tables of one dish, customer by customer, with the operator's draws."""
    seed = int(pitman_yor.seeds_of(sweep, *(np.array([k], np.int64) for k in keys))[0])
    tables, seated, rng = min(n, 1), 1, np.random.default_rng(seed)
    while seated < n:
        chance = new / (new + max(seated - discount * tables, 1e-9))
        if seated < 64:
            draw = int(pitman_yor.mixed(np.array([(seed + seated) % 2**64], np.uint64))[0]) >> 11
            tables, seated = tables + (draw / 2**53 < chance), seated + 1
        else:
            step = min(n - seated, seated // 8)
            tables, seated = tables + rng.binomial(step, chance), seated + step
    return tables


def test_model_equals_a_sampler_by_hand(spark):
    pairs, frame = counted_pairs(spark, TOY)
    seen = {k: n for k, n in pairs.items() if n}
    contexts, words = {c for c, _ in seen}, {w for _, w in seen}
    d = pitman_yor._discount(*(sum(n == k for n in seen.values()) for k in (1, 2)))
    dishes = {w: sum(x == w for _, x in seen) for w in words}
    pd = pitman_yor._discount(*(sum(n == k for n in dishes.values()) for k in (1, 2)))
    guests, base = {c: sum(n for (x, _), n in seen.items() if x == c) for c in contexts}, 1 / (len(words) + 1)
    tables, parent = dict.fromkeys(seen, 1), dict.fromkeys(words, 1)
    want = dict.fromkeys(pairs, 0.0)

    def p(w):
        customers = sum(tables.values())
        back = 1 + pd * sum(parent.values())
        own = sum(t for (_, x), t in tables.items() if x == w) - pd * parent[w] if w in parent else 0
        return (own + back * base) / (1 + customers)

    for sweep in (1, 2, 3):
        total = {c: sum(t for (x, _), t in tables.items() if x == c) for c in contexts}
        chances = {w: p(w) for w in words}
        back = 1 + pd * sum(parent.values())
        tables = {(c, w): seated_by_hand(sweep, (c, w), n, (1 + d * total[c]) * chances[w], d) for (c, w), n in seen.items()}
        parent = {w: seated_by_hand(sweep, (w,), sum(t for (_, x), t in tables.items() if x == w), back * base, pd) for w in words}
        if sweep > 1:
            for c, w in pairs:
                if c not in contexts:
                    want[c, w] += p(w) / 2
                    continue
                total = sum(t for (x, _), t in tables.items() if x == c)
                own = pairs[c, w] - d * tables.get((c, w), 0)
                want[c, w] += (own + (1 + d * total) * p(w)) / (1 + guests[c]) / 2
    answers, _, _ = pitman_yor.fit(frame, Workspace(spark, "t"))
    got = {(r.context, r.word): r.probability for r in answers.collect()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    assert max(tables.values()) > 1  # some dish has a second table


def test_files_are_dealt_to_many_tasks(spark):
    files = spark.createDataFrame([(f"file-{i}",) for i in range(40)], "name string")
    tasks = dealt_files(files, "name").select(F.spark_partition_id().alias("task")).distinct().count()
    assert tasks >= 4


def test_repeated_ids_are_one_training_row(spark):
    rows = [(1, f"x{i} " * 60) for i in range(300)] + [(2, "y " * 60), (3, None)]
    docs, labels = odd_docs(spark, rows), spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "doc_id long, quality int")
    chosen = quality_rules.one_row_an_id(docs.select("doc_id", "text"))
    assert sorted(r.doc_id for r in chosen.collect()) == [1, 2, 3]
    assert quality_rules.fit(docs, labels) == quality_rules.fit(docs.repartition(5), labels)
    named = docs.withColumn("__quality_counts", F.lit(7))
    assert quality_rules.keep(named, []).columns == named.columns


@pytest.mark.parametrize("capacity", [1, 7, 100])
def test_plans_place_every_piece_once(capacity):
    rng = random.Random(capacity)
    for _ in range(60):
        counts = {rng.randint(1, capacity): rng.randint(1, 9) for _ in range(8)}
        held: dict[int, list] = {}
        placed = set()
        for length, rank, number, sequence, offset in packing.plan_sequences(dict(counts), capacity):
            for i in range(number):
                placed.add((length, rank + i))
                held.setdefault(sequence + i, []).append((offset, length))
        assert placed == {(n, i) for n, c in counts.items() for i in range(c)}
        for parts in held.values():
            ends = 0
            for offset, length in sorted(parts):
                assert offset == ends
                ends += length
            assert ends <= capacity


def test_packed_pieces_hold_all_tokens(spark):
    path = tokens.vocabulary("word_bpe_49k.json")
    got = packing.pack_documents(odd_docs(spark), Workspace(spark, "t"), path, capacity=64, keep_ids=True).collect()
    assert sum(r.length for r in got if r.doc_id == 4) == 2 * 3001
    assert {(r.length, tuple(r.ids)) for r in got if r.doc_id in (1, 2, 3)} == {(1, (0,))}
    assert packing.pack_documents(odd_docs(spark).limit(0), Workspace(spark, "t"), path).count() == 0


@pytest.mark.parametrize("bits", [1, 5, 8, 16, 17, 32])
def test_token_file_round_trip(bits):
    rng = np.random.default_rng(bits)
    ids = [rng.integers(0, 1 << bits, n, np.uint64).astype(np.uint32) for n in (0, 1, 999, 3, 2500)]
    data = io.BytesIO()
    token_files.write_file(data, [None, 1, 2, 2, 3], ids, bits, block_ids=100)
    data.seek(0)
    file = token_files.TokenFile(data)
    assert file.docs == [None, 1, 2, 2, 3]
    assert all(np.array_equal(file.document(i), x) for i, x in enumerate(ids))


def test_token_files_in_id_order(spark):
    work = Workspace(spark, "t")
    path = tokens.vocabulary("byte_bpe_50k.json")
    got = sorted(token_files.read_tokens(token_files.write_tokens(odd_docs(spark), work, path), work).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((d for d, _ in ODD), key=lambda d: -1 if d is None else d)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()


def test_encoder_equals_the_library():
    rng = random.Random(5)
    odd = ["", " ", "  a  b ", "\n\n a\n", "a<|endoftext|>b c  <|startoftext|> ", "a\x1cb \x1dc", "é  x　y\x85z", "don't I'll"]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        e = tokens.Encoder(tokens.vocabulary(name))
        texts = odd + ["".join(rng.choice("ab'é1 \n\t.<|") for _ in range(25)) for _ in range(300)]
        assert [x.tolist() for x in e.encode(texts)] == [e.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_remembers_up_to_its_bound(name, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE", 40)
    e = tokens.Encoder(tokens.vocabulary(name))
    texts = [f"w{i} one two\nw{i + 1} (w{i})\n\n w{i}" + " " * (i % 3) for i in range(60)]
    for at in (0, 7, 20, 0):
        some = texts[at:at + 15] + ["", "x"]
        assert [x.tolist() for x in e.encode(some)] == [e.tokenizer.encode(t, add_special_tokens=False).ids for t in some]
    assert len(e.known) == 40


def test_encoder_needs_no_pattern_for_single_white_space(monkeypatch):
    e = tokens.Encoder(tokens.vocabulary("byte_bpe_50k.json"))
    monkeypatch.setattr(tokens, "_STRETCH", None)  # a text of single white space needs no pattern
    texts = ["one two\nthree two", "two\tone\nthree two ", " two"]
    assert [x.tolist() for x in e.encode(texts)] == [e.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_pipeline_keeps_columns_until_packing(spark, tmp_path):
    import corpus_pipeline

    rows = [(i, " ".join(f"w{(i * 7919 + k * 104729) % 5003}" for k in range(80)), "en", "s", 5) for i in range(20)]
    rows += [(50, rows[3][1], "en", "s", 5), (51, None, None, None, None), (None, rows[2][1], "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, rows[5][1][40:200])], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path)).cache()
        assert now.columns == docs.columns, name
    assert {r.doc_id for r in now.collect()} - {None} == set(range(20)) - {5}
    assert corpus_pipeline.run(spark, str(tmp_path)).where(F.col("length") > 0).count() >= 19


def test_only_answers_that_a_block_lacks_are_kept(spark):
    # a pair seen once goes back only to held-out texts that have it
    rng = random.Random(5)
    texts = {i: " ".join(f"w{rng.randrange(40)}" for _ in range(30)) for i in range(100, 160)}
    batch = odd_docs(spark, list(texts.items())).where("doc_id >= 100").select(
        pitman_yor.is_held_out(F.col("doc_id")).alias("held_out"), "text", (F.col("doc_id") % 3).cast("int").alias("block"))
    wants = batch.repartition(2, "block").sortWithinPartitions("block").mapInArrow(
        partial(pitman_yor._wants, shards=4), pitman_yor.WANTS)
    counted = wants.repartition(3, "shard").sortWithinPartitions("shard").mapInArrow(pitman_yor._count, pitman_yor.COUNTED)
    got = {(r.context, r.word): (r.n, sorted(r.blocks)) for r in counted.collect() if r.is_pair}
    held = {i for i in texts if zlib.crc32(str(i).encode()) % 10 == 0}
    n, blocks, asked = Counter(), defaultdict(set), defaultdict(set)
    for i, text in texts.items():
        for pair in zip(*(x.tolist() for x in pitman_yor.pairs_of(text.encode())), strict=True):
            n[pair] += i not in held
            blocks[pair].add(i % 3)
            if i in held:
                asked[pair].add(i % 3)
    want = {p: (k, sorted(blocks[p] if k > 1 else asked[p])) for p, k in n.items() if k > 1 or k and asked[p]}
    assert held and got == want and len(want) < len(n)


@pytest.mark.parametrize("block_bytes", [1 << 20, 900])
def test_scores_are_the_sums_of_fitted_probabilities(spark, block_bytes):
    rng = random.Random(8)
    texts = {i: " ".join(f"w{int(rng.expovariate(0.1))}" for _ in range(30)) for i in range(100, 160)}
    held = {i for i in texts if zlib.crc32(str(i).encode()) % 10 == 0}
    n = Counter()
    for i, text in texts.items():
        for pair in zip(*(x.tolist() for x in pitman_yor.pairs_of(text.encode())), strict=True):
            n[pair] += i not in held
    frame = spark.createDataFrame([(*p, k, [0]) for p, k in n.items()], "context long, word long, n long, blocks array<int>")
    answers, n_train, _ = pitman_yor.fit(frame, Workspace(spark, "t"))
    chance = {(r.context, r.word): r.probability for r in answers.collect()}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    scored = pitman_yor.score_documents(docs, Workspace(spark, "t", drop_shuffles=True), block_bytes=block_bytes).collect()
    assert len(scored) == len(texts) and {r.train_tokens for r in scored} == {n_train}
    for r in scored:
        pairs = zip(*(x.tolist() for x in pitman_yor.pairs_of(texts[r.doc_id].encode())), strict=True)
        assert abs(r.score - sum(math.log10(chance[p]) for p in pairs)) < 1e-9
