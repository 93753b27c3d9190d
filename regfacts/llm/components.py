"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regfacts.llm.common import Workspace


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """One star step on links (a, b).

    The smallest neighbour is a map-side aggregate and the links meet it in a
    join that Spark can split, so a node with very many links is no hot task.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large \
        else links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    met = both.join(least, "a")
    if large:
        return met.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
        least.select("a", F.col("m").alias("b"))).where(F.col("a") != F.col("b"))


def components(links: DataFrame, work: Workspace) -> DataFrame:
    """(node, root): the smallest node reachable over links (a, b); nodes without links are absent.

    Self links and repeated links change nothing. Every round is written to the
    shared folder. It ends when a round leaves the links as they were, seen
    from a count and a sum of hashes.
    """
    def settled(df: DataFrame, name: str) -> tuple[DataFrame, tuple]:
        out = work.write(df.distinct(), name)
        mark = out.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return out, tuple(mark)

    now, mark = settled(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .where(F.col("a") != F.col("b")), "links-0")
    n = 0
    while True:
        n += 1
        new, after = settled(_stars(_stars(now, True), False), f"links-{n}")
        work.drop(f"links-{n - 1}")
        if after == mark:
            break
        now, mark = new, after
    return new.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        new.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
