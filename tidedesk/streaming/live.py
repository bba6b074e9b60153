"""Tumbling event-time windows over contacts, for batch and streaming input alike."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidedesk.functions.contact import contact_line
from tidedesk.functions.measures import rounded
from tidedesk.operators.kpis import KPIS
from tidedesk.operators.validate import valid_rows, validate
from tidedesk.schema import WINDOW_SECONDS
from tidedesk.sources.commits import Change, Part
from tidedesk.sources.tables import DAY, LOAD, Sink, commit_load, drop_parts, log_of, stage_load

LATENESS = "2 minutes"


def _windowed(rows: DataFrame, instant: str, seconds: int, lateness: str, *dimensions: str) -> GroupedData:
    if rows.isStreaming:
        rows = rows.withColumn(instant, F.col(instant).cast("timestamp")).withWatermark(instant, lateness)
    return rows.groupBy(F.window(instant, f"{seconds} seconds").alias("ventana"), *dimensions)


def window_batches(
    rows: DataFrame, seconds: int = WINDOW_SECONDS, lateness: str = LATENESS, instant: str = "timestamp_evento"
) -> DataFrame:
    """Rows per window; empty windows have no row.

    Contacts are placed by event time. Messages can be placed by broker time, their ``timestamp``.
    """
    counted = _windowed(rows, instant, seconds, lateness).agg(F.count("*").alias("contactos"))
    return counted.select(
        F.col("ventana.start").alias("inicio"), F.col("ventana.end").alias("fin"), "contactos"
    )


def live_kpis(contacts: DataFrame, seconds: int = WINDOW_SECONDS, lateness: str = LATENESS) -> DataFrame:
    """KPIs per window and channel, for batch and streaming input alike."""
    totals = _windowed(contacts, "timestamp_evento", seconds, lateness, "canal").agg(
        F.count("*").alias("total_contactos"), *rounded(*KPIS)
    )
    return totals.select(
        F.col("ventana.start").alias("inicio"),
        F.col("ventana.end").alias("fin"),
        "canal",
        "total_contactos",
        *KPIS,
    )


def start_live(
    windows: DataFrame, path: str, checkpoint: str, drain: bool = False, seconds: int = WINDOW_SECONDS
) -> StreamingQuery:
    """Writes the windows that each micro-batch has changed, as one load of the table in ``path``.

    A window is written again while contacts for it arrive, so none waits for the watermark and a
    bounded run leaves none out; ``read_live`` takes the latest. Once the watermark has passed its
    end, it is final and leaves the state. A retried micro-batch replaces its own load. Loads bear the number of the
    commit they follow, which grows whatever query writes them: a query with a new checkpoint, whose batches count from
    0 again, writes later states than the query before it.
    """

    def write(rows: DataFrame, batch_id: int) -> None:
        query_id = rows.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        log, _ = log_of(rows.sparkSession, path)
        # A row for each changed window and channel; stateful batches have no adaptive plan to merge tasks.
        dated = rows.withColumn(DAY, F.to_date("inicio")).repartition(DAY)
        follows = _version(log.open().number)
        commit_load(rows.sparkSession, log, f"{query_id}-{batch_id:010d}", [Sink(dated, path, DAY, ("inicio",))], f"{follows}-")

    trigger = {"availableNow": True} if drain else {"processingTime": f"{seconds} seconds"}
    return (
        windows.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def _version(number: int) -> str:
    """The beginning of the name of a load that follows commit ``number``; names are in the order of time."""
    return f"v{number:012d}"


def read_live(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The latest state of every window in ``path``; ``schema`` is that of the streamed windows.

    The latest is that of the load that follows the highest commit. Aggregated with partial maxima, so that a window
    written very often is small before it moves.
    """
    log, table = log_of(spark, path)
    state = log.state()
    return _latest(spark, path, schema, state.parts(table) if state.number else None).drop(DAY)


def _latest(spark: SparkSession, path: str, schema: T.StructType, parts: list[Part] | None) -> DataFrame:
    declared = T.StructType([*schema, T.StructField(DAY, T.DateType()), T.StructField(LOAD, T.StringType())])
    reader = spark.read.schema(declared).option("basePath", path)
    if parts is None:
        rows = reader.parquet(path)
    elif parts:
        rows = reader.parquet(*[f"{path}/{p.day}/{p.name}" for p in parts])
    else:
        rows = spark.createDataFrame([], declared)
    keys = [name for name in ("inicio", "fin", "canal") if name in schema.names]
    values = [name for name in schema.names if name not in keys]
    latest = rows.groupBy(*keys, DAY).agg(F.max_by(F.struct(*values), LOAD).alias("v"))
    return latest.select(*keys, "v.*", DAY).select(*schema.names, DAY)


def merge_live(spark: SparkSession, path: str, schema: T.StructType, before: date) -> None:
    """Puts one load with the latest states in place of the loads of each day before ``before``, in one commit.

    What a query writes to such a day meanwhile stays, and comes later than the merged states. If another job has
    taken a merged load out meanwhile, nothing is swapped.
    """
    log, table = log_of(spark, path)
    state = log.open()
    days: dict[str, list[Part]] = {}
    for part in state.parts(table):
        if part.value < str(before):
            days.setdefault(part.day, []).append(part)
    merged = [p for parts in days.values() if len(parts) > 1 for p in parts]
    if not merged:
        return
    load = f"dia-{uuid.uuid4().hex}"
    # "+" sorts before "-": a load that follows the same commit is later than the merged ones.
    name = f"{_version(state.number)}+{load}"
    parts = stage_load(_latest(spark, path, schema, merged), path, load, DAY, "inicio", folders=name)
    swapped = log.commit(lambda now: Change(parts, merged) if all(p in now for p in merged) else Change(), state)
    drop_parts(spark, path.rpartition("/")[0], merged if all(p in swapped for p in parts) else parts)


def message_lines(messages: DataFrame) -> DataFrame:
    """One readable line per valid message."""
    return valid_rows(validate(messages)).select(contact_line().alias("linea"))


def start_tail(messages: DataFrame, path: str, checkpoint: str, drain: bool = False) -> StreamingQuery:
    """Appends the line of every arriving contact to text files in ``path``, for a shell's ``tail`` to follow.

    Executors write the files; no line passes through the driver and none is left out.
    """
    trigger = {"availableNow": True} if drain else {"processingTime": "1 second"}
    return (
        message_lines(messages)
        .writeStream.format("text")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
