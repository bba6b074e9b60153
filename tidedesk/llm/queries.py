"""The query of each operator, as a function of the session and the folder with the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidedesk.llm.common import table
from tidedesk.llm.decontaminate import overlaps
from tidedesk.llm.html import main_texts
from tidedesk.llm.merkle import merkle_manifest
from tidedesk.llm.minmax import near_copies
from tidedesk.llm.mixing import mix_sources
from tidedesk.llm.oracle import MERKLE, NEAR_COPIES, TRIE
from tidedesk.llm.perplexity import perplexities
from tidedesk.llm.prefix_trie import prefix_trie
from tidedesk.llm.quality import quality_rules
from tidedesk.llm.sharding import even_tree, shard_documents
from tidedesk.llm.simhash import near_duplicates
from tidedesk.llm.substrings import remove_repeats
from tidedesk.llm.toxicity import toxicity
from tidedesk.llm.warc import archive_pages

SHARDS = 8
#: Passes over any source in the mixture.
MAX_REPETITION = 1.5


def op6_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexities(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_boosted_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))


def op8_linear_grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), with_bytes=False).drop("kept")


def op9_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    items, keys = table(spark, sf_dir, "benchmark"), {"doc_id": F.col("doc_id")}
    return overlaps(table(spark, sf_dir, "documents"), items, keys, short_items=True)


def op10_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), even_tree(SHARDS), even_tree(SHARDS, grown=1))


def op1_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages"))


def op2_factorization_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"), ["doc_id", "source"], max_repetition=MAX_REPETITION)


def op4_vantage_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), ["doc_id"])


def op11_min_max_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies(table(spark, sf_dir, "documents"), ["doc_id"])


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_manifest(table(spark, sf_dir, "documents"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc_segments": op1_warc_segments,
    "op2_factorization_machine": op2_factorization_machine,
    "op3_temperature_mix": op3_temperature_mix,
    "op4_vantage_points": op4_vantage_points,
    "op5_robust_outliers": op5_robust_outliers,
    "op6_kneser_ney": op6_kneser_ney,
    "op7_boosted_nodes": op7_boosted_nodes,
    "op8_linear_grouping": op8_linear_grouping,
    "op9_spaced_seeds": op9_spaced_seeds,
    "op10_hash_tree": op10_hash_tree,
    "op11_min_max_copies": op11_min_max_copies,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_merkle_manifest": op13_merkle_manifest,
}
LLM_ORACLE: dict[str, str] = {
    "op11_min_max_copies": NEAR_COPIES,
    "op12_prefix_trie": TRIE,
    "op13_merkle_manifest": MERKLE,
}
