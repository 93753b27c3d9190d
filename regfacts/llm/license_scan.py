"""Licence scans with a positional index of rare words, in DataFrame functions only.

Every licence template is short public wording with mandatory key phrases. The
words of all templates are counted over all documents; the rarest half of a
template's words (at most INDEX_WORDS) form its postings (word, position). A
document looks up those of its words that are in the index, i.e. its licence
words of highest inverse document frequency; postings that meet at one relative
position (place in the document minus place in the template) vote together, and
a template counts where its postings at one such place carry at least MIN_SHARE
of their weight and the document holds every mandatory phrase.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regfacts.llm.common import Workspace, table_rows
from regfacts.llm.registry import query

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases of the base scan and their labels.
BASE = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Public licence wording as (label, wording, mandatory phrases).
TEMPLATES = (
    ("agpl", "published by the free software foundation under the terms of the gnu affero general public license",
     ("gnu affero general public license",)),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license "
     "is distributed on an as is basis without warranties or conditions of any kind",
     ("required by applicable law or agreed to in writing", "on an as is basis")),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided "
     "that the following conditions are met", ("redistribution and use in source and binary forms",)),
    ("bsl-1.0", "distributed under the boost software license version 1 0", ("boost software license",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license",
     ("creative commons attribution noncommercial",)),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license",
     ("creative commons attribution sharealike",)),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights "
     "to this work", ("waived all copyright and related or neighboring rights",)),
    ("epl", "made available under the terms of the eclipse public license", ("eclipse public license",)),
    ("gpl-notice", "this work is licensed under the gnu general public license version 3",
     ("licensed under the gnu general public license",)),
    ("gpl-notice", "this program is free software you can redistribute it and or modify it under the terms of the gnu "
     "general public license as published by the free software foundation",
     ("redistribute it and or modify it under the terms of the gnu general public license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
     "hereby granted", ("for any purpose with or without fee is hereby granted",)),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation",
     ("gnu lesser general public license",)),
    ("mit", "released under the mit license", ("mit license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and "
     "associated documentation files to deal in the software without restriction",
     ("permission is hereby granted free of charge", "to deal in the software without restriction")),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ("mozilla public license",)),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ("free and unencumbered software",)),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors "
     "be held liable for any damages arising from the use of this software",
     ("without any express or implied warranty", "be held liable for any damages")),
)

INDEX_WORDS = 8
MIN_SHARE = 0.6
#: Score of a document with base phrases only; templates add up to as much again.
BASE_SCORE = 0.5

POSTINGS = "map<string,array<struct<t:int,at:int,weight:double>>>"


def normal_text(text: Column) -> Column:
    """The words of a text in lower case between single spaces; one space without words.

    Only A-Z may fall. `lower` also lowers letters beyond ASCII, which stay beyond
    ASCII and in their word; the one that would become a plain letter, the Kelvin
    sign, sends its text through the slower `translate`.
    """
    text = F.coalesce(text, F.lit(""))
    plain = F.when(F.contains(text, F.lit("\u212a")), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))
    return F.regexp_replace(F.concat(F.lit(" "), plain, F.lit(" ")), NO_WORD, " ")


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _words(normal: Column) -> Column:
    return F.split(F.btrim(normal), " ")


def _strings(values: list[str]) -> Column:
    return F.from_json(F.lit(json.dumps(values)), "array<string>")


def _base(normal: Column, pieces: Column) -> list[Column]:
    """Counts of the words and of the places of base phrases.

    `pieces` is the text split before each place, so that every piece but the
    first begins with a phrase. No phrase starts inside another or itself: no
    place is hidden.
    """
    label = lambda p: F.coalesce(*[
        F.when(F.startswith(p, F.lit(b)), F.lit(name)) for b, name in BASE.items()])
    n_words = (_spaces(normal) - 1).cast("long")
    n_base = (F.size(pieces) - 1).cast("long")
    last = n_words - _spaces(F.element_at(pieces, -1))
    return [
        n_words.alias("n_words"), n_base.alias("n_base"),
        F.when(n_base > 0, _spaces(F.get(pieces, 0)).cast("long")).alias("first_word"),
        F.when(n_base > 0, last).alias("last_word"),
        F.array_distinct(F.transform(F.slice(pieces, 2, F.size(pieces)), label)).alias("base_labels"),
    ]


def rare_words(docs: DataFrame, text: str = "text", templates=TEMPLATES) -> dict[str, list[dict]]:
    """Postings of the templates' rarest words: word -> [{t, at, weight}].

    Document frequencies are counted over all documents; what reaches the driver
    is one count for each word of the templates. `weight` is the word's share of
    its template's inverse document frequency, so a template's weights sum to one.
    """
    vocabulary = sorted({w for _, wording, _ in templates for w in wording.split()})
    seen = docs.select(F.explode(F.array_intersect(_words(normal_text(F.col(text))), _strings(vocabulary))).alias("word"))
    df = {r["word"]: r["n"] for r in seen.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = docs.count()
    index: dict[str, list[dict]] = {}
    for t, (_, wording, _) in enumerate(templates):
        words = wording.split()
        rarest = sorted(set(words), key=lambda w: (df.get(w, 0), w))
        rarest = set(rarest[:min(INDEX_WORDS, (len(rarest) + 1) // 2)])
        places = [(at, w) for at, w in enumerate(words) if w in rarest]
        # one is added, so that a word of every document still weighs something
        idf = [math.log((total + 1) / (df.get(w, 0) + 1)) + 1 for _, w in places]
        for (at, w), x in zip(places, idf, strict=True):
            index.setdefault(w, []).append({"t": t, "at": at, "weight": x / sum(idf)})
    return index


def scan(docs: DataFrame, work: Workspace, text: str = "text", templates=TEMPLATES) -> DataFrame:
    """Licences of every document: `doc` (the other columns) and `licences`.

    `licences` holds n_words, the base phrases (n_base, first_word, last_word,
    base_labels) and `found`: an array of (template, label, share, word) with the
    best share of the template's index weight at one relative position and the
    word where the wording would start.

    A null or empty text has no words and no licences. Rows are told apart by a
    number of their own, so null, repeated and tied ids are separate rows, and
    input columns lie in a struct, so no name can clash. A text of any length is
    one row; its postings are counted in a shuffle, and an empty table gives no
    rows. The texts are read twice (words, then places) and are not shuffled.
    """
    index = rare_words(docs, text, templates)
    phrases = [(t, p) for t, (_, _, needed) in enumerate(templates) for p in needed]
    others = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(None).cast("int").alias("none")]
    rows = docs.select(F.struct(*others).alias("doc"), normal_text(F.col(text)).alias("normal"))
    rows = rows.select(
        "doc", "normal",
        F.split("normal", f" (?=(?:{'|'.join(BASE)}) )").alias("pieces"),
        F.array_intersect(_words(F.col("normal")), _strings(sorted(index))).alias("rare"))
    some = F.size("rare") > 0
    hits = F.filter(
        F.transform(_words(F.col("normal")), lambda w, i: F.struct(w.alias("word"), i.alias("at"))),
        lambda h: F.array_contains("rare", h["word"]))
    # the templates of which a mandatory phrase is missing
    absent = F.array_distinct(F.filter(F.array(*[
        F.when(~F.contains("normal", F.lit(f" {p} ")), t) for t, p in phrases]), lambda t: t.isNotNull()))
    rows = work.write(rows.select(
        F.monotonically_increasing_id().alias("row"), "doc", *_base(F.col("normal"), F.col("pieces")),
        F.when(some, hits).alias("hits"), F.when(some, absent).alias("absent")), "licence-words")

    postings = F.from_json(F.lit(json.dumps(index)), POSTINGS)
    votes = (
        rows.filter("hits is not null")
        .select("row", "absent", F.explode("hits").alias("hit"))
        .select("row", "absent", "hit.at", F.explode(F.try_element_at(postings, F.col("hit.word"))).alias("p"))
        .filter(~F.array_contains("absent", F.col("p.t")))
        .groupBy("row", F.col("p.t").alias("t"), (F.col("at") - F.col("p.at")).alias("word"))
        .agg(F.sum("p.weight").alias("share"))
        # of equal sums whatever the order of adding
        .select("row", "t", "word", F.least(F.round("share", 6), F.lit(1.0)).alias("share"))
        .filter(F.col("share") >= MIN_SHARE))
    best = votes.groupBy("row", "t").agg(F.max(F.struct("share", (-F.col("word")).alias("before"))).alias("best"))
    labels = _strings([label for label, _, _ in templates])
    # at most one entry for each template
    found = best.groupBy("row").agg(F.array_sort(F.collect_list(F.struct(
        F.col("t").alias("template"), F.get(labels, F.col("t")).alias("label"),
        F.col("best.share").alias("share"), (-F.col("best.before")).alias("word")))).alias("found"))
    base = ["doc", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    none = F.array().cast(found.schema["found"].dataType)
    looked_up = rows.filter("hits is not null").select("row", *base).join(found, "row", "left").select(
        *base, F.coalesce("found", none).alias("found"))
    plain = rows.filter("hits is null").select(*base, none.alias("found"))
    return plain.unionByName(looked_up).select("doc", F.struct(*base[1:], "found").alias("licences"))


def _template_sql() -> str:
    return ", ".join(
        f"({t}, '{label}', '{wording}', [{', '.join(repr(p) for p in needed)}])"
        for t, (label, wording, needed) in enumerate(TEMPLATES))


SQL = f"""
with docs as (
  select row_number() over () as r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
words as (select r, unnest(w) as word, generate_subscripts(w, 1) - 1 as pos from docs),
phrases as (select * from (values ('cc by', 'cc-by'), ('general public license', 'gpl'),
  ('all rights reserved', 'reserved')) as p(phrase, label)),
three as (select r, pos, word, lead(word) over o as w2, lead(word, 2) over o as w3 from words
  window o as (partition by r order by pos)),
places as (select r, pos, label from three, phrases
  where phrase = concat(word, ' ', w2) or phrase = concat(word, ' ', w2, ' ', w3)),
base as (select r, count(*) as n_base, min(pos) as first_word, max(pos) as last_word,
  list_distinct(list(label)) as labels from places group by r),
templates as (select * from (values {_template_sql()}) as t(t, label, wording, needed)),
tw as (select t, unnest(string_split(wording, ' ')) as word,
  generate_subscripts(string_split(wording, ' '), 1) - 1 as pos from templates),
df as (select word, count(distinct r) as n from words where word in (select word from tw) group by word),
distinct_words as (select t, word, coalesce(n, 0) as n from (select distinct t, word from tw) left join df using (word)),
ranked as (select *, row_number() over (partition by t order by n, word) as k, count(*) over (partition by t) as m
  from distinct_words),
idf as (select tw.t, tw.word, tw.pos, ln(((select count(*) from docs) + 1) / (n + 1)) + 1 as x
  from tw join ranked using (t, word) where k <= least({INDEX_WORDS}, (m + 1) // 2)),
postings as (select t, word, pos, x / sum(x) over (partition by t) as weight from idf),
votes as (select r, t, words.pos - postings.pos as word_at, round(sum(weight), 6) as share
  from words join postings using (word) group by all having round(sum(weight), 6) >= {MIN_SHARE}),
checked as (select r, label, least(max(share), 1.0) as share from votes join templates using (t) join docs using (r)
  where list_bool_and(list_transform(needed,
    lambda p: contains(concat(' ', array_to_string(w, ' '), ' '), concat(' ', p, ' ')))) group by r, t, label),
found as (select r, list(label) as labels, max(share) as share from checked group by r)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_base, 0) as n_base, cast(first_word as bigint) as first_word,
  cast(last_word as bigint) as last_word,
  coalesce(array_to_string(list_sort(base.labels), ','), '') as base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ','),
    '') as labels,
  cast(round(case when share is not null then {BASE_SCORE} + share * (1 - {BASE_SCORE})
       when n_base > 0 then {BASE_SCORE} else 0 end, 6) as double) as score
from docs left join base using (r) left join found using (r)
"""


@query(SQL)
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base phrases and licences of all documents; see `scan` for nulls, empty and repeated rows."""
    docs = table_rows(spark, sf_dir, "documents").select("doc_id", "text")
    got = F.col("licences")
    share = F.array_max(F.transform(got["found"], lambda f: f["share"]))
    names = F.array_union(got["base_labels"], F.transform(got["found"], lambda f: f["label"]))
    return scan(docs, Workspace(spark, "op12")).select(
        "doc.doc_id", *[got[c].alias(c) for c in ("n_words", "n_base", "first_word", "last_word")],
        F.array_join(F.array_sort(got["base_labels"]), ",").alias("base_labels"),
        F.array_join(F.array_sort(names), ",").alias("labels"),
        F.round(F.when(share.isNotNull(), BASE_SCORE + share * (1 - BASE_SCORE))
                .when(got["n_base"] > 0, BASE_SCORE).otherwise(0.0), 6).alias("score"))
