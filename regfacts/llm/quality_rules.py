"""Quality rules: a decision list learned by sequential covering over text statistics.

Statistics are counted over whole texts. Rules are conjunctions of thresholds
that reject a document; they are grown on one part of the labelled rows and
pruned on the other, and come out as one ordered Spark conditional expression.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regfacts.llm.common import one_row_an_id, table_rows, utf8
from regfacts.llm.registry import query

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper",
          "n_distinct_words")
#: Labelled rows used to learn; a bounded sample chosen by a hash of the id.
TRAIN_ROWS = 20_000
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def repeated_words(ids: np.ndarray) -> int:
    """Words covered by windows of three words that occur twice or more."""
    n = len(ids)
    if n < 4:
        return 0
    _, pairs = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)
    _, windows, times = np.unique(pairs[:-1] * n + ids[2:], return_inverse=True, return_counts=True)
    hit = times[windows] > 1
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= hit
    return int(covered.sum())


def count_text(text: bytes) -> tuple[int, ...]:
    """The counts of one text, in the order of COUNTS."""
    words = text.split()
    raw = np.frombuffer(text, np.uint8)
    # a code point is a byte that does not continue another one
    chars = int(np.count_nonzero(~_SPACE[raw] & ((raw & 0xC0) != 0x80)))
    lines = [x for x in text.split(b"\n") if x.strip()]
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    return (len(words), chars, int(np.count_nonzero(_SYMBOL[raw])), len(lines) - len(set(lines)),
            repeated_words(ids), len(lines), int(np.count_nonzero((raw >= 65) & (raw <= 90))), len(known))


def _counts(text: pa.Array) -> pa.Array:
    table = np.array([count_text(x) for x in utf8(text)], np.int64).reshape(-1, len(COUNTS))
    return pa.StructArray.from_arrays([pa.array(table[:, i]) for i in range(len(COUNTS))], names=list(COUNTS))


def text_counts(text: Column) -> Column:
    """Struct of whole-text counts; a null text has zeros."""
    kind = ", ".join(f"{c}: bigint" for c in COUNTS)
    # once per row, also where a filter reads it
    return F.arrow_udf(_counts, f"struct<{kind}>").asNondeterministic()(text)


def features(stats: Column) -> dict[str, Column]:
    """The statistics that rules may test, by name."""
    c = {n: stats[n].cast("double") for n in COUNTS}
    words, lines = F.greatest(c["n_words"], F.lit(1.0)), F.greatest(c["n_lines"], F.lit(1.0))
    chars = F.greatest(c["word_chars"], F.lit(1.0))
    return {
        "mean_word_chars": c["word_chars"] / words,
        "symbol_share": c["n_symbols"] / chars,
        "symbols_per_word": c["n_symbols"] / words,
        "dup_line_share": c["n_dup_lines"] / lines,
        "repeat_share": c["n_repeat_words"] / words,
        "upper_share": c["n_upper"] / chars,
        "words_per_line": c["n_words"] / lines,
        "distinct_share": c["n_distinct_words"] / words,
    }


def base_failed(stats: Column) -> Column:
    return (stats["n_words"] < MIN_WORDS) | (
        F.lit(100) * stats["n_repeat_words"] > F.lit(MAX_REPEAT_PERCENT) * stats["n_words"])


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        v = table[self.feature]
        return v > self.threshold if self.above else v <= self.threshold

    def column(self, columns: dict[str, Column]) -> Column:
        v = columns[self.feature]
        return v > F.lit(self.threshold) if self.above else v <= F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, table: dict[str, np.ndarray], n: int) -> np.ndarray:
    hit = np.ones(n, bool)
    for c in rule:
        hit &= c.holds(table)
    return hit


def _thresholds(x: np.ndarray, cuts: int) -> np.ndarray:
    """Midpoints above quantiles, so that a cut lies between observed values."""
    seen = np.unique(x)
    if len(seen) < 2:
        return seen[:0]
    at = np.unique(np.searchsorted(seen, np.quantile(x, np.linspace(0, 1, cuts + 2)[1:-1], method="lower")))
    at = at[at < len(seen) - 1]
    return (seen[at] + seen[at + 1]) / 2


def _grow(table: dict[str, np.ndarray], bad: np.ndarray, cuts: int, max_conditions: int) -> Rule:
    """Add the condition of highest information gain until no good row is covered."""
    rule: list[Condition] = []
    left = np.ones(len(bad), bool)
    while len(rule) < max_conditions:
        p0, n0 = int((left & bad).sum()), int((left & ~bad).sum())
        if not n0 or not p0:
            break
        best, gain = None, 1e-9
        before = np.log2(p0 / (p0 + n0))
        for name, v in table.items():
            x, y = v[left], bad[left]
            for t in _thresholds(x, cuts):
                over = x > t
                for above in (True, False):
                    hit = over if above else ~over
                    p, n = int((hit & y).sum()), int((hit & ~y).sum())
                    if p and (g := p * (np.log2(p / (p + n)) - before)) > gain:
                        best, gain = Condition(name, above, float(t)), g
        if best is None:
            break
        rule.append(best)
        left &= best.holds(table)
    return tuple(rule)


def _prune(rule: Rule, table: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    """The leading part of the rule that does best on rows it was not grown on."""
    def worth(r: Rule) -> float:
        hit = _covers(r, table, len(bad))
        p, n = int((hit & bad).sum()), int((hit & ~bad).sum())
        return (p - n) / (p + n) if p + n else -1.0

    return max((rule[:k] for k in range(len(rule), 0, -1)), key=worth, default=())


def learn_rules(table: dict[str, np.ndarray], bad: np.ndarray, fold: np.ndarray, *, cuts: int = 48,
                max_conditions: int = 4, max_rules: int = 16, min_precision: float = 0.9) -> list[Rule]:
    """An ordered list of rejecting rules.

    Grown where fold > 0, pruned where fold = 0. Covering stops when a pruned
    rule no longer rejects `min_precision` bad rows among those it covers in
    both parts, so that good documents are kept. No labels, or none of one
    kind, gives no rules.
    """
    rules: list[Rule] = []
    open_rows = np.ones(len(bad), bool)
    while len(rules) < max_rules:
        g, p = open_rows & (fold > 0), open_rows & (fold == 0)
        if not (g & bad).any() or not (p & bad).any():
            break
        rule = _grow({k: v[g] for k, v in table.items()}, bad[g], cuts, max_conditions)
        rule = _prune(rule, {k: v[p] for k, v in table.items()}, bad[p])
        if not rule:
            break
        hit = _covers(rule, table, len(bad))
        precise = [bad[hit & part].mean() if (hit & part).any() else 0.0 for part in (g, p)]
        if min(precise) < min_precision:
            break
        rules.append(rule)
        open_rows &= ~hit
    return rules


def accepts(rules: list[Rule], stats: Column) -> Column:
    """The rules as one ordered conditional: the first rule that holds rejects."""
    columns = features(stats)
    out = None
    for rule in rules:
        test = rule[0].column(columns)
        for c in rule[1:]:
            test = test & c.column(columns)
        out = F.when(test, F.lit(False)) if out is None else out.when(test, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, *, train_rows: int = TRAIN_ROWS, **options) -> list[Rule]:
    """Learn from at most `train_rows` labelled documents.

    The sample is the labels of smallest hashed id, so it does not depend on
    order or partitioning; of the rows of one id that with the text of smallest
    hash counts. Labels without an id or a quality are left out; of
    several labels of one id the lowest quality counts.
    """
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
              .groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows))
    # both sides are bounded by train_rows: a repeated id gives one row
    rows = one_row_an_id(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))
    stats = rows.select("doc_id", "quality", text_counts(F.col("text")).alias("s"))
    named = features(F.col("s"))
    data = (stats.where(~base_failed(F.col("s")))
            .select("doc_id", (F.col("quality") < 1).alias("bad"),
                    F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)).alias("fold"),
                    *[v.alias(k) for k, v in named.items()])
            .toPandas().sort_values("doc_id", kind="stable"))
    return learn_rules({k: data[k].to_numpy(float) for k in named}, data["bad"].to_numpy(bool),
                       data["fold"].to_numpy(int), **options)


def keep(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """The documents that pass the base limits and all rules, with their own columns."""
    s = "__quality_counts"
    while s in map(str.lower, docs.columns):  # the documents may have a column of any name
        s += "_"
    return (docs.withColumn(s, text_counts(F.col("text")))
            .where(~base_failed(F.col(s)) & accepts(rules, F.col(s))).drop(s))


@query()
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base verdict and learned verdict of every document.

    Null and empty texts have zero words and fail the base limits. Repeated
    rows each give a row. Columns of `documents` other than id and text are
    not read.
    """
    docs = table_rows(spark, sf_dir, "documents").select("doc_id", "text")
    rules = fit(docs, table_rows(spark, sf_dir, "labels").select("doc_id", "quality"))
    s = F.col("s")
    failed = base_failed(s)
    return docs.select("doc_id", text_counts(F.col("text")).alias("s")).select(
        "doc_id", *[s[c].alias(c) for c in COUNTS[:5]], failed.alias("base_failed"),
        (~failed & accepts(rules, s)).alias("kept"))
