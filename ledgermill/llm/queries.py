"""The registered queries of this folder: each applies one operator to the whole of its table."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermill.llm import divergence, manifest, mixing
from ledgermill.llm.additive import additive_scores
from ledgermill.llm.lattice import held_out_by_id, lattice_scores
from ledgermill.llm.line_rules import line_quality
from ledgermill.llm.near_copies import near_copies
from ledgermill.llm.neighbours import neighbour_scores
from ledgermill.llm.packing import pack
from ledgermill.llm.pivots import near_vectors
from ledgermill.llm.shards import shard_documents
from ledgermill.llm.substrings import cut_repeats
from ledgermill.llm.url_rules import SPAM_PATTERNS, judge_urls, prefix_rule
from ledgermill.llm.url_rules import oracle as url_oracle


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"))


def labels_to_learn(spark: SparkSession, folder: str, label: str, parts: int, part: int) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(~held_out_by_id("doc_id", parts, part))
    return labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("label"))


def classified(scored: DataFrame, parts: int, part: int) -> DataFrame:
    others = [c for c in scored.columns if c not in ("doc_id", "score")]
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", held_out_by_id("doc_id", parts, part).alias("held_out"), "score", predicted, *others)


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    labels = labels_to_learn(spark, folder, "toxic", 5, 0)
    return classified(neighbour_scores(documents(spark, folder), labels), 5, 0)


#: Rules of the query over pages.
URL_RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]


def op3_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rules = [prefix_rule(*rule) for rule in URL_RULES]
    return judge_urls(spark.read.parquet(f"{folder}/pages.parquet"), [*rules, *SPAM_PATTERNS])


def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    labels = labels_to_learn(spark, folder, "quality", 3, 1)
    return classified(additive_scores(documents(spark, folder), labels), 3, 1)


def op5_mixing_to_targets(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_documents(documents(spark, folder))
    return mixed.select("doc_id", *mixing.DIMENSIONS, "n_tokens", F.round("mix_rate", 6).alias("mix_rate"), "sampled")


def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return cut_repeats(documents(spark, folder))


def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return line_quality(documents(spark, folder))


def op8_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_copies(documents(spark, folder), percent=85)


def op9_lattice_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs, vocabulary = documents(spark, folder), public_tokenizers.path("piece_bpe_32k.model")
    return lattice_scores(docs, held_out_by_id("doc_id", 7, 2), vocabulary)


def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"))


def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.tamper_check(documents(spark, folder))


def op12_group_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = shard_documents(documents(spark, folder), shards=8)
    law, grown = F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard")
    return placed.select("doc_id", "size", "text_crc32", law, "shard", "slot", grown)


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(documents(spark, folder))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_url_filters": op3_url_filters,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_mixing_to_targets": op5_mixing_to_targets,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_lattice_scores": op9_lattice_scores,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_group_shards": op12_group_shards,
    "op13_source_divergence": op13_source_divergence,
}
ORACLE: dict[str, str] = {
    "op3_url_filters": url_oracle(URL_RULES),
    "op5_mixing_to_targets": mixing.oracle(),
    "op11_merkle_manifest": manifest.oracle(),
    "op13_source_divergence": divergence.oracle(),
}
