"""Work folders of the checks, which the driver also runs in local sessions without a shared folder."""

from __future__ import annotations

import tempfile
from functools import cache

from pyspark.sql import SparkSession

from tidedesk import session


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tidedesk-")


def work_dir(spark: SparkSession, label: str) -> str:
    """As the library's; a local master, whose executors see the driver's disk, may use a temporary folder."""
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    local = context.master == "local" or context.master.startswith("local[")
    return session.work_dir(spark, label, None if shared or not local else _local_folder())
