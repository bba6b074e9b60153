"""Session settings the jobs rely on, and the shared work folder."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_TASK_BYTES = 256 * 1024 * 1024


def build_session(app_name: str = "tidedesk", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` overrides any setting."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.files.maxPartitionBytes": "256m",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Event time is UTC throughout, whatever zone the session was started in."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"session time zone is {zone!r}; call pin_utc(spark) first")


def work_dir(spark: SparkSession, label: str, base: str | None = None) -> str:
    """A fresh folder for intermediate tables and stream checkpoints.

    It lies in ``base``, or in the folder that ``spark.checkpoint.dir`` names, which every executor must
    reach. All of a session's folders share one that bears the day and the application's id, so that
    they can be expired together.
    """
    context = spark.sparkContext
    base = base or spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    run = f"{date.today():%Y%m%d}-{context.applicationId}"
    return f"{base.rstrip('/')}/tidedesk/{run}/{label}-{uuid.uuid4().hex}"


def scan_bytes(table: DataFrame) -> int:
    """The optimizer's size of a plain scan: its files, as far as its columns need them."""
    return table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()


def fits_broadcast(table: DataFrame) -> bool:
    """Whether a plain scan is within the session's broadcast threshold."""
    limit = table.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return 0 < scan_bytes(table) <= limit


def shuffle_tasks(shuffled_bytes: int) -> int:
    """How many tasks a shuffle of ``shuffled_bytes`` should start with.

    A job's session gets it as ``spark.sql.adaptive.coalescePartitions.initialPartitionNum``: adaptive
    execution merges tasks that turn out small but cannot split evenly oversized ones. Nothing here
    changes a session's settings.
    """
    return max(1, -(-shuffled_bytes // SHUFFLE_TASK_BYTES))
