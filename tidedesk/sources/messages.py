"""Message streams: Kafka in production, files of the same shape elsewhere."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidedesk.schema import CONTACT_COLUMNS, MESSAGE_SCHEMA
from tidedesk.session import require_utc

CHANNEL_ATTRIBUTE = "canal"


def _event_json() -> Column:
    stamp = F.date_format("timestamp_evento", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("timestamp_evento")
    fields = [stamp if name == "timestamp_evento" else F.col(name) for name in CONTACT_COLUMNS]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def publish_messages(contacts: DataFrame, *keep: str | Column) -> DataFrame:
    """``value``: the row as UTF-8 JSON with explicit nulls; ``headers``: its channel; then ``keep``."""
    require_utc(contacts.sparkSession)
    channel = F.struct(F.lit(CHANNEL_ATTRIBUTE).alias("key"), F.col("canal").cast("binary").alias("value"))
    return contacts.select(_event_json().cast("binary").alias("value"), F.array(channel).alias("headers"), *keep)


def write_kafka(messages: DataFrame, servers: str, topic: str) -> None:
    messages.write.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "topic": topic, "includeHeaders": "true"}
    ).save()


def read_kafka(
    spark: SparkSession, servers: str, topic: str, max_offsets: int = 50_000_000, **options: str
) -> DataFrame:
    """Needs the Kafka connector on the classpath. ``max_offsets`` bounds one micro-batch.

    A topic partition that holds far more than the others is read by several tasks.
    """
    source = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "includeHeaders": "true",
        "maxOffsetsPerTrigger": str(max_offsets),
        "maxRecordsPerPartition": "500000",
        **options,
    }
    return spark.readStream.format("kafka").options(**source).load().select("value", "headers", "timestamp")


def read_message_files(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """Parquet files of messages as a stream. ``max_files`` bounds one micro-batch."""
    return spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(path)


def spread(rows: DataFrame, tasks: int | None = None) -> DataFrame:
    """Rows dealt out evenly to ``tasks``, or as many as the session runs at a time, before they are parsed.

    For a source with fewer partitions than there are cores, such as one large file: to parse a message costs far more
    than to move it. A topic with enough partitions is better left as it is.
    """
    return rows.repartition(tasks or rows.sparkSession.sparkContext.defaultParallelism)


def attribute(key: str) -> Column:
    """A message attribute as text, NULL when absent; the payload is not opened."""
    return F.get(F.filter("headers", lambda h: h["key"] == key), F.lit(0))["value"].cast("string")


def with_channel(messages: DataFrame, *channels: str) -> DataFrame:
    return messages.where(attribute(CHANNEL_ATTRIBUTE).isin(*channels))
