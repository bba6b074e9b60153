"""Reprocessing of the dead-letter table."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidedesk.functions.contact import event_date
from tidedesk.operators.validate import replay_dlq, valid_rows
from tidedesk.schema import CONTACT_SCHEMA, REQUIRED_FIELDS
from tidedesk.sources.commits import Change, Part, State
from tidedesk.sources.messages import spread
from tidedesk.sources.tables import (
    CLUSTER_BY,
    DAY,
    DLQ_DAY,
    LOAD,
    REPAIRED,
    ContactStore,
    drop_parts,
    read_dlq,
    stage_load,
)

REPLAY_LOAD = "reproceso"
#: How often a replay starts again when another one has marked letters of its days meanwhile.
MOST_TRIES = 10
#: Marks from before they were kept by day, one folder a replay.
UNDATED = "repaso="


def _marks(spark: SparkSession, store: ContactStore, parts: Sequence[Part]) -> DataFrame | None:
    """Fingerprints and days of the dead letters that replays have repaired."""
    schema = f"huella string, {DLQ_DAY} date"
    paths = [f"{store.repaired}/{p.day}/{p.name}" for p in parts if not p.day.startswith(UNDATED)]
    undated = [f"{store.repaired}/{p.day}/{p.name}" for p in parts if p.day.startswith(UNDATED)]
    found = [spark.read.schema(schema).parquet(*undated)] if undated else []
    if paths:
        dated = spark.read.schema(f"{schema}, {LOAD} string").option("basePath", store.repaired).parquet(*paths)
        found.append(dated.select("huella", DLQ_DAY))
    return found[0].union(found[-1]) if len(found) > 1 else next(iter(found), None)


def _marked(state: State, start: date | None, end: date | None) -> list[Part]:
    dated = state.parts(REPAIRED, start, end)
    return sorted({*dated, *(p for p in state.parts(REPAIRED) if p.day.startswith(UNDATED) and p.name.endswith(".parquet"))})


def replay_store(
    spark: SparkSession,
    store: ContactStore,
    required: Sequence[str] = REQUIRED_FIELDS,
    start: date | None = None,
    end: date | None = None,
) -> None:
    """Adds the stored rejects that are valid by now to the contacts table, as one more load.

    The dead letters stay, and so does what earlier replays repaired: only dead letters without a mark
    of repair, of the days of capture from ``start`` to ``end``, are parsed. Marks are kept by day of capture, so the
    replay of a day reads that day's marks. Equal payloads of a day are repaired together. Contacts and marks become
    live in one commit: a replay that died has done nothing. One that finds another's marks on its days
    when it is about to commit starts again. A text field that is no longer required is stored as empty
    text, as the table takes no NULL there.
    """
    log = store.log(spark)
    for _ in range(MOST_TRIES):
        state = log.open()
        marked = _marked(state, start, end)
        letters = read_dlq(spark, store.dlq, start, end).withColumn("huella", F.sha2("raw_payload", 256))
        repaired = _marks(spark, store, marked)
        if repaired is not None:
            letters = letters.join(repaired, ["huella", DLQ_DAY], "left_anti")
        load = f"{REPLAY_LOAD}-{uuid.uuid4().hex}"
        # The letters of a day may lie in one file.
        outcome = replay_dlq(spread(letters), required, keep=["huella", DLQ_DAY]).where(F.col("error").isNull()).persist()
        try:
            texts = [f.name for f in CONTACT_SCHEMA if f.name in REQUIRED_FIELDS and isinstance(f.dataType, T.StringType)]
            rows = valid_rows(outcome).withColumns({name: F.coalesce(name, F.lit("")) for name in texts})
            parts = stage_load(rows.withColumn(DAY, event_date()), store.contacts, load, DAY, *CLUSTER_BY)
            parts += stage_load(outcome.select("huella", DLQ_DAY).distinct(), store.repaired, load, DLQ_DAY)
        finally:
            outcome.unpersist()
        after = log.commit(lambda now: Change(parts) if _marked(now, start, end) == marked else Change(), state)
        if all(p in after for p in parts):
            return
        drop_parts(spark, store.root, parts)
    raise RuntimeError(f"other replays came first {MOST_TRIES} times")
