"""A training corpus from ``documents``: quality rules, SimHash near duplicates, benchmark leaks, mixture, shards.

Each stage is a function of (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidedesk.llm.common import DOCUMENT_COLUMNS, stored, table
from tidedesk.llm.decontaminate import equals_short_item, overlaps
from tidedesk.llm.mixing import mix_sources
from tidedesk.llm.quality import quality_rules
from tidedesk.llm.queries import MAX_REPETITION, SHARDS
from tidedesk.llm.sharding import even_tree, shard_documents
from tidedesk.llm.simhash import representatives

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither fail the fixed rules nor are outliers of their language and source."""
    return quality_rules(docs, DOCUMENT_COLUMNS).where("kept").select(DOCUMENT_COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (fingerprints of three-word shingles within 3 bits) the document with the least id."""
    # Two independent hashes name a row, so that texts move once: to be joined and, in the same place, made distinct.
    named = docs.select(
        *DOCUMENT_COLUMNS, F.xxhash64("doc_id", "text").alias("k"), F.xxhash64("text", F.lit("row"), "doc_id").alias("j")
    )
    chosen = representatives(named)
    return named.join(chosen, ["k", "j"], "left_semi").dropDuplicates(["k", "j"]).select(DOCUMENT_COLUMNS)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item of nine words or more, and are none of a shorter one."""
    keys = {"doc_id": F.col("doc_id"), "text_hash": F.xxhash64("text")}
    benchmark = table(spark, sf_dir, "benchmark")
    found = overlaps(docs, benchmark, keys).select(*keys).union(equals_short_item(docs, benchmark, keys))
    leaks = stored(found.distinct(), "leaks")
    leaks = leaks.select(F.col("doc_id").alias("leak_id"), F.col("text_hash").alias("leak_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("leak_id")) & (F.xxhash64("text") == F.col("leak_hash"))
    return docs.join(leaks, same, "left_anti").select(DOCUMENT_COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document once for every pass over its source that draws it."""
    return mix_sources(docs, DOCUMENT_COLUMNS, max_repetition=MAX_REPETITION).select(DOCUMENT_COLUMNS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every drawn document with its shard and its place there."""
    return shard_documents(docs, even_tree(SHARDS), even_tree(SHARDS, grown=1))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", keep_quality),
    ("SimHash near-dedup", keep_one_of_each_group),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("mixing", mix),
    ("sharding", shard),
]

#: No SQL states the pipeline: it hashes with XXH64 and CRC-32, which DuckDB lacks. Brute-force tests stand in.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each result written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
