"""The registered queries of this subpackage: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growthloom.llm.boosted_toxicity import toxicity_scores
from growthloom.llm.common import read_table
from growthloom.llm.factor_quality import quality_scores
from growthloom.llm.host_rules import host_rules
from growthloom.llm.latent_search import contaminated
from growthloom.llm.merkle import manifest
from growthloom.llm.mixing import source_mix
from growthloom.llm.piece_table import round_trip as piece_round_trip
from growthloom.llm.prob_minhash import near_duplicates
from growthloom.llm.secret_ledger import secrets
from growthloom.llm.sharding import shards
from growthloom.llm.token_file import round_trip
from growthloom.llm.url_filter import url_verdicts
from growthloom.llm.whitening import whitened


def op1_subset_sum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix(read_table(spark, sf_dir, "documents"))


def op2_latent_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op3_url_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(read_table(spark, sf_dir, "pages")).drop("score")


def op4_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets(read_table(spark, sf_dir, "documents"))


def op5_factor_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(read_table(spark, sf_dir, "documents"))


def op7_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op8_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return host_rules(read_table(spark, sf_dir, "documents")).select(*columns)


def op9_directly_addressable(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    import public_tokenizers

    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    return round_trip(read_table(spark, sf_dir, "documents"), path, end_id=2)


def op10_boosted_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op11_bit_sliced_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(read_table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_merkle_witnesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(read_table(spark, sf_dir, "documents"))


def op13_piece_table(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    import public_tokenizers

    return piece_round_trip(read_table(spark, sf_dir, "documents"), model or public_tokenizers.path("piece_bpe_32k.model"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_subset_sum_mix, op2_latent_search, op3_url_markov, op4_secret_ledger, op5_factor_quality,
            op6_extendible_shards, op7_prob_minhash, op8_host_rules, op9_directly_addressable, op10_boosted_toxicity,
            op11_bit_sliced_whitening, op12_merkle_witnesses, op13_piece_table,
        )
    }
