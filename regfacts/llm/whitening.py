"""Whitening of embeddings on the distinct vectors of an integer grid.

Vectors are put on a grid (x = floor(scale * entry) + shift, whole numbers) and
equal ones are grouped, so that a vector that a third of all rows repeat is
fitted and whitened once. A distinct vector weighs one or, if asked, its count.
Sums are exact whole numbers; the covariance is a weighted product of centred
blocks, one partial matrix a task, added up in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regfacts.llm.common import Workspace, table_rows
from regfacts.llm.registry import query

#: Rows of a block that is centred and multiplied at once: bounds a task's memory.
BLOCK = 4096
#: Tasks a core in the passes that leave a matrix each: bounds what is added up.
TASKS_A_CORE = 4
#: Components of a share of variance below this are rounding, not directions.
RANK = 1e-12
#: Vectors with this share of all rows or more are joined apart: HOT_VECTORS at most.
HOT_VECTORS = 256
LARGEST = float(1 << 52)


@dataclass(frozen=True)
class Whitener:
    """Fit of the vectors of one length: x -> ((n x - sums) / n) @ vectors / sqrt(values)."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float]:
        return (self.values / self.trace).tolist() if len(self.values) else []


def grid(df: DataFrame, vector: str, scale: float, shift: int) -> DataFrame:
    """`row` (the other columns), `x` and its `key`, of rows whose entries are all finite."""
    v = F.col(f"`{vector}`")
    fits = lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double") * scale) < LARGEST), F.lit(False))
    others = [F.col(f"`{c}`") for c in df.columns if c != vector] or [F.lit(None).cast("int").alias("none")]
    kept = df.filter(v.isNotNull() & F.forall(v, fits))
    x = F.transform(v, lambda c: F.floor(c.cast("double") * scale).cast("long") + F.lit(shift).cast("long"))
    return kept.select(F.struct(*others).alias("row"), x.alias("x")).withColumn(
        "key", F.unhex(F.substring(F.sha2(F.array_join(F.col("x").cast("array<string>"), ","), 256), 1, 32)))


def _blocks(batches: Iterator[pa.RecordBatch], vector: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches whose vectors have one length, with their vectors as a matrix."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            lengths = part.column(vector).value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(lengths):
                some = part if len(np.unique(lengths)) == 1 else part.filter(pa.array(lengths == d))
                yield some, some.column(vector).flatten().to_numpy(zero_copy_only=False).reshape(some.num_rows, d)


def _few_tasks(rows: DataFrame) -> DataFrame:
    return rows.coalesce(TASKS_A_CORE * rows.sparkSession.sparkContext.defaultParallelism)


def _exact(n: int, x: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """n x - sums in whole numbers, in Python's own where 64 bits could overflow."""
    largest = max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
    if n * largest < 1 << 62 and all(abs(int(s)) < 1 << 62 for s in sums):
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def sums_of(rows: DataFrame, vector: str, number: str) -> dict[int, tuple[int, list]]:
    """Weight and weighted sums of the vectors of each length; whole numbers stay exact."""
    kind = {"long": pa.int64(), "double": pa.float64()}[number]

    def partial(batches):
        held: dict[int, list] = {}
        for batch, x in _blocks(batches, vector):
            w = batch.column("weight").to_numpy()
            total = held.setdefault(x.shape[1], [0, np.zeros(x.shape[1], x.dtype)])
            total[0] += int(w.sum())
            total[1] = total[1] + (x * w[:, None]).sum(axis=0)
        for d, (n, sums) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * (d + 1), pa.int32()), pa.array(range(-1, d), pa.int32()),
                 pa.array([n, *[0] * d], pa.int64()), pa.array(np.append(np.zeros(1, x.dtype), sums), kind)],
                names=["d", "i", "n", "s"])

    found = _few_tasks(rows.select(vector, "weight")).mapInArrow(partial, f"d int, i int, n long, s {number}")
    exact = F.sum(F.col("s").cast("decimal(20,0)")) if number == "long" else F.sum("s")
    out: dict[int, tuple[int, list]] = {}
    # one row for each dimension
    for r in found.groupBy("d", "i").agg(F.sum("n").alias("n"), exact.alias("s")).orderBy("d", "i").collect():
        if r["i"] < 0:
            out[r["d"]] = (r["n"], [])
        else:
            out[r["d"]][1].append(int(r["s"]) if number == "long" else r["s"])
    return out


def covariance(rows: DataFrame, vector: str, totals: dict[int, tuple[int, list]]) -> dict[int, np.ndarray]:
    """Weighted covariance of the vectors of each length, centred before multiplying; divisor is the weight."""

    def partial(batches):
        held: dict[int, np.ndarray] = {}
        for batch, x in _blocks(batches, vector):
            d = x.shape[1]
            n, sums = totals[d]
            if x.dtype == np.int64:
                centred = _exact(n, x, np.array(sums, object)).astype(np.float64) / n
            else:
                centred = x - np.array(sums) / n
            w = batch.column("weight").to_numpy().astype(np.float64)
            held[d] = held.get(d, 0) + centred.T @ (centred * w[:, None])
        for d, m in held.items():
            if d:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(d, d), pa.int32()), pa.array(np.arange(d), pa.int32()),
                     pa.array(list(m), pa.list_(pa.float64()))], names=["d", "i", "m"])

    found = _few_tasks(rows.select(vector, "weight")).mapInArrow(partial, "d int, i int, m array<double>")
    entries = found.select("d", "i", F.posexplode("m").alias("j", "m")).groupBy("d", "i", "j").agg(F.sum("m").alias("m"))
    out = {d: np.zeros((d, d)) for d in totals}
    # dimension x dimension numbers, whatever the number of rows
    for r in entries.collect():
        out[r["d"]][r["i"], r["j"]] = r["m"] / totals[r["d"]][0]
    return out


def fit(distinct: DataFrame, components: int) -> dict[int, Whitener]:
    """A whitener for each length of the vectors in `x`, each counted `weight` times."""
    totals = sums_of(distinct, "x", "long")
    out = {}
    for d, v in covariance(distinct, "x", totals).items():
        n, sums = totals[d]
        values, vectors = np.linalg.eigh((v + v.T) / 2) if d else (np.zeros(0), np.zeros((0, 0)))
        trace = float(np.trace(v)) if d else 0.0
        order = [i for i in np.argsort(-values, kind="stable")[:components] if values[i] > RANK * max(trace, 0.0)]
        vectors = vectors[:, order]
        if order:  # the largest entry of a component is positive
            vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
        out[d] = Whitener(n, tuple(sums), values[order], vectors, trace)
    return out


def transform(distinct: DataFrame, model: dict[int, Whitener]) -> DataFrame:
    """`key`, `weight`, `n`, `deviation`, `whitened` and `explained` of every distinct vector."""
    names = ["key", "weight", "n", "deviation", "whitened", "explained"]

    def apply(batches):
        for batch, x in _blocks(batches, "x"):
            fitted = model[x.shape[1]]
            apart = _exact(fitted.n, x, np.array(fitted.sums, object))
            if apart.dtype == object or np.square(np.abs(apart).max(initial=0).astype(float)) * x.shape[1] > 9e18:
                apart = apart.astype(object)
            squares = (apart * apart).sum(axis=1)
            whitened = apart.astype(np.float64) / fitted.n @ fitted.vectors / np.sqrt(fitted.values)
            deviation = pa.array([format(s, "d") for s in squares]) if squares.dtype == object else (
                pa.array(squares).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("weight"), pa.array(np.full(len(x), fitted.n), pa.int64()), deviation,
                 pa.array(list(whitened), pa.list_(pa.float64())),
                 pa.array([fitted.explained] * len(x), pa.list_(pa.float64()))], names=names)

    return distinct.mapInArrow(
        apply, "key binary, weight long, n long, deviation string, whitened array<double>, explained array<double>")


def identity_error(whitened: DataFrame) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity, over all lengths."""
    rows = whitened.select("whitened", "weight")
    matrices = covariance(rows, "whitened", sums_of(rows, "whitened", "double"))
    return max((float(np.abs(m - np.eye(d)).max()) for d, m in matrices.items() if d), default=0.0)


def whiten(df: DataFrame, work: Workspace, vector: str, components: int = 16, scale: float = 64.0,
           shift: int = 1_000_000, by_count: bool = False) -> tuple[DataFrame, float]:
    """Whitened vectors of all rows, and how far their covariance is from the identity.

    Returns `row` (a struct of the other input columns, so no name can clash), `n`,
    `deviation` (a whole number as text, exact at any size), `whitened` and
    `explained` (by component). Rows whose vector is null, or has an entry that is
    null, not finite or beyond 2^52 on the grid, are left out. Every length of
    vectors is a fit of its own. Components without variance are left out, so a
    single distinct vector has none; an empty vector has none; an empty table gives no
    rows. Repeated rows stay repeated; components of equal variance are any basis
    of their space, the same for all rows.

    Shuffles: distinct vectors once (hash aggregate with partial counts), then
    (row, key) against the whitened vectors. At most HOT_VECTORS vectors hold so
    large a share of the rows that their rows are joined by broadcast instead.
    """
    rows = work.write(grid(df, vector, scale, shift), "rows")
    # a key is 128 bits of SHA-256 of the whole vector
    counted = rows.groupBy("key", "x").agg(F.count(F.lit(1)).alias("copies"))
    distinct = work.write(counted.select(
        "key", "x", "copies", (F.col("copies") if by_count else F.lit(1).cast("long")).alias("weight")), "distinct")
    model = fit(distinct, components)
    whitened = work.write(transform(distinct, model), "whitened")
    error = identity_error(whitened)

    total = distinct.agg(F.sum("copies")).first()[0] or 0
    hot = distinct.filter(F.col("copies") * HOT_VECTORS > total).select("key")
    results = whitened.drop("weight")
    wanted = rows.select("row", "key").join(F.broadcast(hot.withColumn("hot", F.lit(True))), "key", "left")
    few = results.join(F.broadcast(hot), "key", "left_semi")
    out = (
        wanted.filter("hot is null").join(results, "key")
        .unionByName(wanted.filter("hot").join(F.broadcast(few), "key")))
    return out.select("row", "n", "deviation", "whitened", "explained"), error


@query()
def op11_whitened_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each row and component of `embeddings`; see `whiten` for odd rows.

    A deviation beyond 64 bits is null.
    """
    rows = table_rows(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    out, error = whiten(rows, Workspace(spark, "op11"), "embedding")
    pairs = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "pair")
    return out.select("row.vec_id", "n", F.expr("try_cast(deviation as bigint)").alias("deviation"), pairs).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation",
        F.col("pair.whitened").alias("whitened"), F.col("pair.explained").alias("explained"),
        F.lit(error).alias("identity_error"))
