"""Ordinal cumulative-link regression on graded ratings of hashed texts.

A text's grade is at least g with probability sigmoid(score - threshold g),
with one score from hashed-word weights for all grades and thresholds in
ascending order. Expected grade and tail probability come from the same score.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regfacts.llm.common import one_row_an_id, record_batch, slices, table_rows, utf8
from regfacts.llm.registry import query

#: Labelled rows used to fit; a bounded sample chosen by a hash of the id.
TRAIN_ROWS = 20_000
#: Weights; the model sent to the tasks has a fixed size.
BUCKETS = 1 << 18
GRADES = 3
#: Word numbers remembered by one worker.
CACHE = 300_000
SCORES = "doc_id long, expected_grade double, tail_probability double, kept boolean"

_NUMBERS: dict[bytes, list[int]] = {}
_SIGNS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's distinct words and their values, log(1 + occurrences).

    A word counts without the punctuation around it; each different sign at a
    word's end counts as a word of its own, and so do the text's length, in
    powers of two, and the tenths that its most frequent word takes.
    """
    known = _NUMBERS
    if len(known) > CACHE:
        known.clear()
    ids: list[int] = []
    for w in text.lower().split():
        if w not in known:
            core = w.strip(_SIGNS)
            parts = ([core] if core else []) + [b"\0" + bytes([c]) for c in sorted(set(w[len(w.rstrip(_SIGNS)):]))]
            known[w] = [xxhash.xxh3_64_intdigest(x) % BUCKETS for x in parts]
        ids += known[w]
    most = int(np.bincount(np.unique(np.array(ids, np.int64), return_inverse=True)[1]).max(initial=0))
    shape = [b"\0words %d" % len(ids).bit_length(), b"\0most %d" % (10 * most // max(1, len(ids)))]
    ids += [xxhash.xxh3_64_intdigest(x) % BUCKETS for x in shape]
    bucket, times = np.unique(np.array(ids, np.int64), return_counts=True)
    return bucket, np.log1p(times)


class Ordinal:
    """Shared weights and ascending thresholds of GRADES grades, 0 to GRADES - 1."""

    def __init__(self, grades: int = GRADES, buckets: int = BUCKETS):
        self.weights = np.zeros(buckets)
        self.thresholds = np.linspace(-1.0, 1.0, grades - 1)

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ... of each score."""
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds, -40, 40)))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], grade: np.ndarray, *, epochs: int = 25,
            rate: float = 0.15, penalty: float = 2e-4, batch: int = 256, least_rows: int = 10,
            least_z: float = 5.0) -> Ordinal:
        """AdaGrad on the negative log likelihood; rare grades weigh more, by the root of their rarity.

        Buckets of fewer than `least_rows` rows, or whose mean grade is within
        `least_z` standard errors of that of all rows, keep no weight: they
        would learn single texts by heart. Thresholds are kept in order by their gaps, which stay positive. No
        rows leave the model as it is.
        """
        if not rows:
            return self
        counts = np.bincount(grade, minlength=len(self.thresholds) + 1)
        share = len(rows) / np.maximum(counts, 1) / max(1, np.count_nonzero(counts))
        weight = np.sqrt(share)[grade]
        size = np.array([len(b) for b, _ in rows])
        at = np.append(0, np.cumsum(size))
        bucket = np.concatenate([b for b, _ in rows])
        value = np.concatenate([v for _, v in rows])
        value = np.where(self._telling(bucket, np.repeat(grade, size), grade, least_rows, least_z)[bucket], value, 0.0)
        rng = np.random.default_rng(1)
        squares, t_squares = np.full(len(self.weights), 1e-8), np.full(len(self.thresholds), 1e-8)
        free = np.append(self.thresholds[0], np.log(np.diff(self.thresholds)))
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for k in range(0, len(order), batch):
                some = order[k:k + batch]
                pick = np.concatenate([np.arange(at[i], at[i + 1]) for i in some])
                of = np.repeat(np.arange(len(some)), size[some])
                b, v = bucket[pick], value[pick]
                score = np.bincount(of, self.weights[b] * v, len(some))
                s = np.pad(self.tails(score), ((0, 0), (1, 1)), constant_values=((0, 0), (1, 0)))
                g = grade[some]
                i = np.arange(len(some))
                high, low = s[i, g], s[i, g + 1]  # P(>= g), P(>= g + 1)
                p = np.maximum(high - low, 1e-12)
                up, down = high * (1 - high), low * (1 - low)
                scale = weight[some] / len(some)
                d_score = -(up - down) / p * scale
                d_threshold = np.zeros(len(self.thresholds) + 2)
                np.add.at(d_threshold, g, up / p * scale)
                np.add.at(d_threshold, g + 1, -down / p * scale)
                gradient = np.bincount(b, d_score[of] * v, len(self.weights))
                seen = np.unique(b)
                step = gradient[seen] + penalty * self.weights[seen]
                squares[seen] += step ** 2
                self.weights[seen] -= rate * step / np.sqrt(squares[seen])
                d = d_threshold[1:-1]
                d_free = np.append(d.sum(), np.cumsum(d[::-1])[::-1][1:] * np.exp(free[1:]))
                t_squares += d_free ** 2
                free -= 0.1 * d_free / np.sqrt(t_squares)
                self.thresholds = free[0] + np.append(0, np.cumsum(np.exp(free[1:])))
        return self

    def _telling(self, bucket: np.ndarray, of_row: np.ndarray, grade: np.ndarray, least_rows: int,
                 least_z: float) -> np.ndarray:
        n = len(self.weights)
        rows, total = np.bincount(bucket, minlength=n), np.bincount(bucket, of_row, n)
        error = grade.std() / np.sqrt(np.maximum(rows, 1)) + 1e-12
        return (rows >= least_rows) & (np.abs(total / np.maximum(rows, 1) - grade.mean()) >= least_z * error)

    def score(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        return np.array([float(self.weights[b] @ v) for b, v in rows])


def graded(quality: Column, toxic: Column) -> Column:
    """Grade of a rating: 0 toxic, 1 not toxic but of low quality, 2 good; null if either is missing."""
    return F.when(quality.isNull() | toxic.isNull(), None).when(toxic >= 1, 0).when(quality < 1, 1).otherwise(2)


def fit(docs: DataFrame, ratings: DataFrame, *, train_rows: int = TRAIN_ROWS, **options) -> Ordinal:
    """Fit on at most `train_rows` rated documents (doc_id, grade).

    The sample is the ratings of smallest hashed id; of the rows of one id that
    with the text of smallest hash counts. Of several ratings of one
    id the lowest counts; ratings without id or grade are left out.
    """
    chosen = (ratings.where(F.col("doc_id").isNotNull() & F.col("grade").isNotNull())
              .groupBy("doc_id").agg(F.min("grade").alias("grade"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows))
    # both sides are bounded by train_rows: a repeated id gives one row
    rows = one_row_an_id(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            f = [features(t) for t in utf8(batch.column("text"))]
            yield record_batch("doc_id long, grade int, bucket binary, value binary", [
                batch.column("doc_id"), batch.column("grade").cast(pa.int32()), [b.astype("<i4").tobytes() for b, _ in f],
                [v.astype("<f4").tobytes() for _, v in f]])

    data = sorted(rows.mapInArrow(hashed, "doc_id long, grade int, bucket binary, value binary").collect(),
                  key=lambda r: (r.doc_id, bytes(r.bucket)))
    return Ordinal().fit([(np.frombuffer(r.bucket, "<i4"), np.frombuffer(r.value, "<f4").astype(float)) for r in data],
                         np.array([r.grade for r in data], np.int64), **options)


def _score(batches: Iterator[pa.RecordBatch], model, least_grade: int, least_tail: float) -> Iterator[pa.RecordBatch]:
    fitted = model.value
    for batch in slices(batches):
        tails = fitted.tails(fitted.score([features(t) for t in utf8(batch.column("text"))]))
        tail = tails[:, least_grade - 1]
        yield record_batch(SCORES, [batch.column("doc_id"), tails.sum(axis=1), tail, tail >= least_tail])


def select(docs: DataFrame, model: Ordinal, *, least_grade: int = GRADES - 1, least_tail: float = 0.5) -> DataFrame:
    """SCORES of every document; kept where P(grade >= least_grade) is at least least_tail.

    One narrow pass. Null and empty texts have score 0.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights, whatever the data
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        partial(_score, model=sent, least_grade=least_grade, least_tail=least_tail), SCORES)


@query()
def op3_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade, probability of the best grade and selection of every document."""
    docs = table_rows(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table_rows(spark, sf_dir, "labels")
    return select(docs, fit(docs, labels.select("doc_id", graded(F.col("quality"), F.col("toxic")).alias("grade"))))
