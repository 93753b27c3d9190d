"""A corpus pipeline of the training-data operators; every stage is written as Parquet and reread."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from regfacts.llm import decontaminate, packing, quality_rules, simhash, suffix_dedup
from regfacts.llm.common import Workspace, table_rows
from regfacts.llm.tokens import vocabulary

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base limits and the learned rules accept."""
    return quality_rules.keep(docs, quality_rules.fit(docs, table_rows(spark, sf_dir, "labels")))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of smallest id.

    Groups are components of SimHash fingerprints. Of texts whose shingle sets share 0.8 a
    few bits miss most, so what is left is grouped once more by the sets themselves. Ids
    and hashes tell what is left; texts are neither shuffled nor copied between the two.
    """
    unlike = simhash.first_of_fingerprints(docs, Workspace(spark, "pipeline-simhash"))
    return simhash.one_per_group(docs, Workspace(spark, "pipeline-similar"), among=unlike)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the stretches of 50 or more words that occur elsewhere too."""
    return suffix_dedup.without_repeated_words(docs, Workspace(spark, "pipeline-suffix", batch_rows=1000))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within its edit budget."""
    return decontaminate.clean_documents(docs, table_rows(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in packed sequences."""
    return packing.pack_documents(docs, Workspace(spark, "pipeline-packing"), vocabulary("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules_stage),
    ("simhash near-dedup", simhash_stage),
    ("suffix-array dedup", suffix_stage),
    ("benchmark decontamination", decontamination_stage),
    ("best-fit packing", packing_stage),
]

#: Learned rules, fingerprints and byte strings are beyond SQL: tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to `documents`."""
    work = Workspace(spark, "pipeline")
    docs = table_rows(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = work.write(stage(spark, docs, sf_dir), f"stage-{i}")
    return docs
