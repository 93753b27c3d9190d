"""Two passes that turn marked stretches of texts into results.

Texts whose stretches are all settled get their result in the first pass and
are not carried on. Texts with stretches that are still open go on with the
contents of these, and get their result in the last pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regfacts.llm.common import Workspace, arrow_schema, slices

#: From a text (None where null) and its ranges to the values of the result's fields.
Finish = Callable[[bytes | None, np.ndarray, np.ndarray], tuple]

#: From a text and ranges to what is sought for each of them.
Body = Callable[[bytes, np.ndarray, np.ndarray], list[bytes]]


def _ranges(marks: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    table = np.array(marks, np.int64).reshape(-1, 2)
    return table[:, 0], table[:, 1]


def _columns(rows: list[tuple | None], fields: str) -> tuple[list[pa.Array], list[str]]:
    names, kinds = zip(*(f.split() for f in fields.split(", ")), strict=True)
    return [pa.array([None if r is None else r[i] for r in rows], arrow_schema(k)) for i, k in enumerate(kinds)], list(names)


def _first(batches: Iterator[pa.RecordBatch], length: int, fields: str, finish: Finish,
           body: Body, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        marks = batch.column("marks")
        flat = marks.flatten()
        lo, more, contents = (flat.field(n).to_numpy().astype(np.int64) for n in ("lo", "more", "contents"))
        hi = lo + more + length
        is_open = contents > 0
        edge = np.append(0, np.cumsum(pc.fill_null(pc.list_value_length(marks), 0).to_numpy(zero_copy_only=False)))
        # open stretches before each mark, to cut the flat bodies into rows
        before = np.append(0, np.cumsum(is_open))[edge]
        texts, bodies, results = [], [], []
        for i, text in enumerate(batch.column("text").cast(pa.binary()).to_pylist()):
            a, b = edge[i], edge[i + 1]
            if before[i + 1] > before[i]:
                own = a + np.flatnonzero(is_open[a:b])
                bodies += body(text, lo[own], hi[own])
                results.append(None)
                texts.append(text)
            else:
                results.append(finish(text, lo[a:b], hi[a:b]))
                texts.append(None)
        new, names = _columns(results, fields)
        open_marks = flat.filter(pa.array(is_open))
        struct = kind.value_type
        body_rows = pa.StructArray.from_arrays(
            [pa.array(bodies, pa.binary()) if f.name == "body" else open_marks.field(f.name).cast(f.type) for f in struct],
            fields=list(struct))
        held = {"text": pa.array(texts, pa.binary())}
        yield pa.RecordBatch.from_arrays(
            [*[held.get(n, c) for n, c in zip(batch.schema.names, batch.columns, strict=True)],
             pa.ListArray.from_arrays(pa.array(before, pa.int32()), body_rows), *new],
            names=[*batch.schema.names, "bodies", *names])


def _last(batches: Iterator[pa.RecordBatch], fields: str, finish: Finish) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        results = [finish(text, *_ranges([(m["lo"], m["hi"]) for m in marks])) for text, marks in zip(
            batch.column("text").to_pylist(), batch.column("marks").to_pylist(), strict=True)]
        new, names = _columns(results, fields)
        keep = [n for n in batch.schema.names if n not in ("text", "marks")]
        yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in keep], *new], names=[*keep, *names])


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def finish_spans(docs: DataFrame, per_row: DataFrame, work: Workspace, *, length: int, fields: str, finish: Finish,
                 body: Body, search: Callable[[DataFrame], DataFrame], spent: Sequence[str] = ()) -> DataFrame:
    """docs without text, row1 and row2, with `fields`.

    docs: text, row1, row2 and what is to be kept
    per_row: row1, row2, marks (lo, more, contents and more); contents is 0 for a settled stretch
    body: what is sought in the open stretches of a text
    search: from the open stretches (row1, row2, marks' fields, body) to ranges found (row1, row2, lo, hi)
    spent: tables of `work` that only per_row reads; they are dropped after the first pass
    """
    met = docs.join(per_row, ["row1", "row2"], "left").withColumn("text", F.col("text").cast("binary"))
    mark = met.schema["marks"].dataType.elementType
    struct = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in mark)
    kind = pa.list_(pa.struct([*[(f.name, arrow_schema({"bigint": "long"}.get(f.dataType.simpleString(),
                                                                              f.dataType.simpleString()))) for f in mark],
                               ("body", pa.binary())]))
    first = work.write(met.mapInArrow(
        partial(_first, length=length, fields=fields, finish=finish, body=body, kind=kind),
        f"{_ddl(met)}, bodies array<struct<{struct}, body: binary>>, {fields}"), "first")
    work.drop(*spent)
    open_ = first.where(F.size("bodies") > 0)
    # equal rows have the same stretches; each is sought once
    found = work.write(search(open_.select("row1", "row2", F.explode("bodies").alias("b")).select(
        "row1", "row2", "b.*").distinct()).groupBy("row1", "row2").agg(
        F.collect_list(F.struct("lo", "hi")).alias("found")), "found")
    number = mark["lo"].dataType.simpleString()
    settled = F.transform(F.filter("marks", lambda m: m["contents"] == 0), lambda m: F.struct(
        m["lo"].alias("lo"), (m["lo"] + m["more"] + F.lit(length)).cast(number).alias("hi")))
    own = [c for c in docs.columns if c not in ("text", "row1", "row2")]
    names = [f.split()[0] for f in fields.split(", ")]
    waiting = open_.select(*own, "text", "row1", "row2", settled.alias("settled")).join(
        found, ["row1", "row2"], "left").select(*own, "text", F.concat("settled", F.coalesce(
            "found", F.array().cast(f"array<struct<lo:{number},hi:{number}>>"))).alias("marks"))
    return first.where(F.size("bodies") == 0).select(*own, *names).union(waiting.mapInArrow(
        partial(_last, fields=fields, finish=finish), f"{_ddl(waiting.select(*own))}, {fields}").select(*own, *names))
