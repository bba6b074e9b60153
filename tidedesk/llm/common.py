"""Helpers the operators share: the driver's tables, written intermediate tables, joined-in columns."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: White space that separates words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which driver and executors share.

    Only a local master, whose executors see the driver's disk, may do without that setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tidedesk-llm-")
    return f"{base.rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there, and lost executors cost
    nothing that is already written."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
