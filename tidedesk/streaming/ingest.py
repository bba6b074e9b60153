"""Streaming ingestion: messages to the contacts and dead-letter tables, one load per micro-batch."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidedesk.functions.contact import event_date
from tidedesk.operators.validate import validate
from tidedesk.schema import DLQ_SCHEMA, REQUIRED_FIELDS, WINDOW_SECONDS
from tidedesk.session import require_utc
from tidedesk.sources.tables import CLUSTER_BY, DAY, DLQ_DAY, ContactStore, Sink, commit_load

log = logging.getLogger(__name__)


#: How many equal messages a row stands for.
COPIES = "_copias"

ADAPTIVE = "spark.sql.adaptive.enabled"

#: Ids that came are kept on the executors' disks: on their heaps they grow with what a batch brings.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


def ingest_rows(
    messages: DataFrame, required: Sequence[str] = REQUIRED_FIELDS, keep: Sequence[str] = ()
) -> DataFrame:
    """Validated messages ready for both sinks, and ``keep`` columns; a valid one does not carry its text along.

    On a stream ``ingested_at`` is the micro-batch's logged time, the same on every retry.
    """
    return validate(messages, required=required, keep=keep).select(
        "evento",
        F.when(F.col("error").isNotNull(), F.col("raw_payload")).alias("raw_payload"),
        "error",
        F.current_timestamp().alias("ingested_at"),
        *keep,
    )


def counted(messages: DataFrame) -> DataFrame:
    """``value`` and ``COPIES``: equal messages in one batch of rows of a task as one row, so that they are parsed once."""
    values = messages.select("value", F.lit(1).cast("long").alias(COPIES))

    # A closure is sent to workers by value, so they need no copy of this package.
    def once_each(batches):
        import pyarrow
        import pyarrow.compute

        for batch in batches:
            found = pyarrow.compute.value_counts(batch.column(0))
            yield pyarrow.RecordBatch.from_arrays([found.field(0), found.field(1)], names=batch.schema.names)

    return values.mapInArrow(once_each, values.schema)


def unique_rows(rows: DataFrame, within: str) -> DataFrame:
    """The rows of a stream without contacts that came before, by their id, in the last ``within`` (such as "1 hour").

    The instant of capture is the watermark's, so nothing is late for it, and the state holds the ids of that long.
    Rejected messages have no id and all stay, each as often as its ``COPIES`` say. Copies in one batch of rows of a
    task are reduced to one before the ids are dealt to their state, so that a message sent very often reaches one task
    a few times only.
    """
    key = "_clave"
    keyed = rows.withColumn(key, F.when(F.col("error").isNull(), F.col("evento.contact_id")).otherwise(F.uuid()))

    # A closure is sent to workers by value, so they need no copy of this package.
    def first_of_each(batches):
        import pyarrow

        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(key)).to_pylist()
            places = {k: n for n, k in reversed(list(enumerate(keys)))}
            yield batch.take(pyarrow.array(sorted(places.values()), pyarrow.int64()))

    few = keyed.mapInArrow(first_of_each, keyed.schema)
    unique = few.withWatermark("ingested_at", within).dropDuplicatesWithinWatermark([key])
    times = F.when(F.col("error").isNull(), 1).otherwise(F.col(COPIES).cast("int"))
    return unique.withColumn(key, F.explode(F.array_repeat(F.lit(1), times))).drop(key, COPIES)


def write_batch(rows: DataFrame, store: ContactStore, load: str) -> dict[str, int]:
    """Writes one micro-batch of ``ingest_rows`` to both tables in one commit; returns the rows per table.

    The batch is kept while both sinks read it, so each message is parsed once. A reader sees the whole batch, in both
    tables and the load log, or nothing of it; a retry replaces what an earlier attempt has committed. Rows
    are counted as they are written: a batch costs the two writes and no further job. An empty batch leaves no rows
    and no log entry.
    """
    rows = rows.persist()
    try:
        valid = rows.where(F.col("error").isNull()).select("evento.*").withColumn(DAY, event_date())
        rejected = rows.where(F.col("error").isNotNull()).select(
            *DLQ_SCHEMA.names, F.to_date("ingested_at").alias(DLQ_DAY)
        )
        sinks = [Sink(valid, store.contacts, DAY, CLUSTER_BY), Sink(rejected, store.dlq, DLQ_DAY)]
        spark = rows.sparkSession
        written = commit_load(spark, store.log(spark), load, sinks, logged=store.load_log)
    finally:
        rows.unpersist()
    if not any(written.values()):
        return {}
    for table, n in written.items():
        log.info("load %s: %d rows to %s", load, n, table)
    return written


@contextmanager
def _with_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def batch_writer(store: ContactStore, adaptive: bool = False) -> Callable[[DataFrame, int], None]:
    """Writes the micro-batches of a query. ``adaptive`` says that the session which started it is so.

    A query with state turns that off for its own plans and so, in its copy of the session, for the writes: every
    task of the state would then leave a file for every day. The batch is planned by then, and the next one is
    planned with the query's setting again.
    """
    conf = {ADAPTIVE: "true"} if adaptive else {}

    def write(rows: DataFrame, batch_id: int) -> None:
        # The query id comes from the checkpoint: a new checkpoint starts again at batch 0 and must
        # not replace the loads of an earlier one.
        query_id = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        with _with_conf(rows.sparkSession, conf):
            write_batch(rows, store, f"{query_id}-{batch_id:010d}")

    return write


def start_ingest(
    messages: DataFrame,
    store: ContactStore,
    checkpoint: str,
    window_seconds: int = WINDOW_SECONDS,
    drain: bool = False,
    required: Sequence[str] = REQUIRED_FIELDS,
    name: str | None = None,
    unique_within: str | None = None,
) -> StreamingQuery:
    """Starts ingestion with one load per ``window_seconds``, until stopped.

    ``drain`` takes what is there now and ends. Nothing is late for ingestion. With ``unique_within`` a contact that
    comes again in that time is left out, as ``unique_rows`` says.
    """
    require_utc(messages.sparkSession)
    if unique_within:
        rows = unique_rows(ingest_rows(counted(messages), required, keep=[COPIES]), unique_within)
    else:
        rows = ingest_rows(messages, required)
    trigger = {"availableNow": True} if drain else {"processingTime": f"{window_seconds} seconds"}
    spark = messages.sparkSession
    write = batch_writer(store, spark.conf.get(ADAPTIVE) == "true")
    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger)
    # A query takes the session's settings over when it starts. What the session sets itself holds, and a checkpoint
    # keeps the state store that it began with.
    own = {key: value for key, value in STATE_CONF.items() if unique_within and spark.conf.get(key, None) is None}
    with _with_conf(spark, own):
        return writer.start(queryName=name)

