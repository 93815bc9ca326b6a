"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.llm import bpe, chat_pairs, decontaminate, exact_dedup, jaccard_join, language_id, license_scan, line_dedup, multi_index, prefix_trie, structure_repair, substring_dedup, surrogates
from strataflow.llm.graph import read


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against its copy with another last answer; loss spans as text."""
    pairs = chat_pairs.preference_pairs(chat_pairs.rejections(read(spark, sf_dir, "conversations")))
    return pairs.withColumns({c: F.expr(chat_pairs.span_text(c)) for c in ("chosen_loss", "rejected_loss")})


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(read(spark, sf_dir, "documents"))


def op3_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(read(spark, sf_dir, "embeddings"))


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the key that the session's setting strataflow.surrogates.key names, or one drawn for this run."""
    return surrogates.replace_entities(read(spark, sf_dir, "documents"), spark.conf.get("strataflow.surrogates.key", None))


def op5_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(read(spark, sf_dir, "documents"), tokenizer_path())


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(read(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.licenses(read(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(read(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(spark, exact_dedup.arrivals(read(spark, sf_dir, "documents")))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of conversations that were rebuilt with shared heads."""
    return prefix_trie.trie_nodes(prefix_trie.rebuilt(prefix_trie.sequences(read(spark, sf_dir, "conversations"))))


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repairs of the conversations with planted damage."""
    return structure_repair.repair(structure_repair.damaged(read(spark, sf_dir, "conversations")), "present")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_preference_pairs, op2_substring_dedup, op3_multi_index, op4_surrogates, op5_bpe_encode_decode, op6_language_id, op7_line_dedup, op8_license_scan, op9_jaccard_join, op10_decontamination, op11_exact_dedup, op12_prefix_trie, op13_structure_repair)
}
ORACLES: dict[str, str] = {"op1_preference_pairs": chat_pairs.ORACLE, "op2_substring_dedup": substring_dedup.ORACLE, "op7_line_dedup": line_dedup.ORACLE, "op9_jaccard_join": jaccard_join.ORACLE, "op11_exact_dedup": exact_dedup.ORACLE, "op12_prefix_trie": prefix_trie.ORACLE, "op13_structure_repair": structure_repair.ORACLE}
