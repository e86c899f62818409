"""The corpus pipeline: quality rules, near-duplicates, decontamination, mixing, sharding.

Nulls: a null text has no words and fails the quality rules, so it goes with the
first stage; null ids, sources and other columns pass through, a null source is
a source of its own. Of near-duplicates the least id stays (a null id is greater
than others; then the least text by MD5, then the least row by hash). Rows alike
in all columns are copies of one text: one stays. A row that the mix takes twice
is two rows. Empty and very long texts are read whole. An empty table, or one of
which a stage keeps nothing, gives empty tables with the same columns, and an
empty benchmark rejects nothing. Columns beyond those of ``documents`` are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from growthloom.llm.common import read_table, scratch_table
from growthloom.llm.host_rules import kept_documents
from growthloom.llm.latent_search import clean_documents
from growthloom.llm.mixing import mixed_documents
from growthloom.llm.prob_minhash import one_of_each
from growthloom.llm.sharding import shards


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or their host's verdict reject go."""
    return kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return clean_documents(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard (and the shard's depth, bytes and rows)."""
    return shards(docs, keep=tuple(c for c in docs.columns if c != "doc_id"))


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: SQL can't express the sketches and the latent search; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and reread as the next one's docs."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch_table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
