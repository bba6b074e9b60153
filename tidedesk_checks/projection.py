"""Projections of the driver's tables onto contacts and messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidedesk.schema import CONTACT_COLUMNS
from tidedesk.session import fits_broadcast
from tidedesk.sources.messages import publish_messages

# --- Fixed values: the domain of the driver's tables --------------------------------------------------
CHANNELS = ["click", "error", "purchase", "signup", "view"]
SALTS = 16
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "nation": "n_nationkey int, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}
# --- End of fixed values ------------------------------------------------------------------------------
#: A customer with a larger part of the events than one in so many is hot.
HOT_SHARE = 1000


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def project_events(events: DataFrame, customers: DataFrame, hot: Sequence[int] = ()) -> DataFrame:
    """Contacts from ``events`` rows and the segment and region of each customer.

    Beyond the broadcast limit this is a sort-merge join on the customer, in which adaptive execution
    splits a customer with very many events over several tasks once its partition exceeds the
    session's skew threshold. Customers that are ``salted`` are those in ``hot``.
    """
    e, uid = F.col("event_id"), F.col("user_id")
    k = F.get_json_object("props", "$.k").cast("int")
    order_id = (e - e % 3).cast("string")
    abandoned = k % 5 == 0

    def served(column, condition=None):
        return F.when(~F.col("abandonado") if condition is None else ~F.col("abandonado") & condition, column)

    same = uid == F.col("c_custkey")
    if "c_salt" in customers.columns:
        same = same & (_salt(uid, hot, F.pmod(e, F.lit(SALTS)), F.lit(0)) == F.col("c_salt"))
    return (
        events.join(customers, same)
        .withColumn("abandonado", abandoned)
        .select(
            e.cast("string").alias("contact_id"),
            F.col("ts").alias("timestamp_evento"),
            F.col("event_type").alias("canal"),
            F.col("c_mktsegment").alias("cola"),
            F.col("r_name").alias("region"),
            F.col("value").alias("tiempo_espera_seg"),
            "abandonado",
            (~F.col("abandonado") & (F.col("value") <= 20)).alias("dentro_sla"),
            served(F.concat(F.lit("AG-"), F.lpad((uid % 40 + 1).cast("string"), 3, "0"))).alias("agente_id"),
            served(45 + (e * 37) % 500).alias("tiempo_atencion_seg"),
            served((e * 7) % 4 < 3).alias("resuelto_primer_contacto"),
            served(1 + (e * 3) % 5, e % 2 == 0).alias("csat"),
            served(
                # Padding cuts what is longer than its length, so the length is the id's own beyond six digits.
                F.concat(F.lit("ORD-"), F.lpad(order_id, F.greatest(F.lit(6), F.length(order_id)), F.lit("0"))),
                (e * 11) % 5 < 3,
            ).alias("orden_asociada"),
        )
    )


def customer_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment and region name per customer, one row each."""
    places = _table(spark, sf_dir, "nation").join(
        _table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = _table(spark, sf_dir, "customer")
    joined = customers.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_mktsegment", "r_name"
    )
    # Size estimates multiply along joins, so the optimizer would never broadcast this result. It
    # has at most one row per customer; the size of the customer scan decides.
    if fits_broadcast(customers):
        return F.broadcast(joined)
    return joined


def contacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return project_events(_table(spark, sf_dir, "events"), customer_places(spark, sf_dir))


def contact_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """The same contacts, with ``events`` read as a file stream of ``max_files`` per micro-batch.

    Without a limit one micro-batch takes all files, so that no row is late whatever their order.
    """
    reader = spark.readStream.schema(SCHEMAS["events"])
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # The file source takes a folder or a pattern but no single file; this pattern fits either.
    events = reader.parquet(f"{sf_dir}/events.parque[t]")
    places = customer_places(spark, sf_dir)
    if fits_broadcast(_table(spark, sf_dir, "customer")):
        return project_events(events, places)
    hot = hot_customers(_table(spark, sf_dir, "events"))
    return project_events(events, salted(places, hot) if hot else places, hot)


def hot_customers(events: DataFrame) -> list[int]:
    """Customers with more than one in ``HOT_SHARE`` of the events that are there, so fewer than that."""
    counted = events.where("user_id IS NOT NULL").groupBy("user_id").agg(F.count("*").alias("n"))
    return [row[0] for row in counted.where(F.col("n") * HOT_SHARE > events.count()).select("user_id").collect()]


def _salt(customer: Column, hot: Sequence[int], value: Column, other: Column) -> Column:
    return F.when(customer.isin(*hot), value).otherwise(other)


def salted(places: DataFrame, hot: Sequence[int]) -> DataFrame:
    """Places of ``hot`` customers dealt out over ``SALTS`` tasks each, for joins that cannot be split as they run.

    A plan in a stream is not adaptive: without a salt all events of a hot customer meet in one task. With one for
    every customer, there would be more places to shuffle and sort than events. A customer who becomes hot after
    the stream began is joined unsalted.
    """
    every = F.sequence(F.lit(0), F.lit(SALTS - 1))
    return places.select("*", F.explode(_salt(F.col("c_custkey"), hot, every, F.array(F.lit(0)))).alias("c_salt"))


def payloads(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The contacts as messages, some of them damaged by the fixture's rules, and the ``keep`` columns."""
    m = F.col("contact_id").cast("bigint") % 50
    altered = rows.select(
        *[
            {
                "canal": F.when(m == 6, F.lit("")).otherwise(F.col("canal")),
                "cola": F.when(m != 1, F.col("cola")),
                "region": F.when(m != 1, F.col("region")),
                "abandonado": F.when(m != 8, F.col("abandonado")),
            }
            .get(name, F.col(name))
            .alias(name)
            for name in CONTACT_COLUMNS
        ]
    )
    sent = publish_messages(altered, m.alias("m"), *keep)
    text, m = F.col("value").cast("string"), F.col("m")
    damaged = (
        F.when(m == 0, F.substr(text, F.lit(1), F.length(text) - 5).cast("binary"))
        .when(m == 2, F.concat(F.lit("["), text, F.lit("]")).cast("binary"))
        .when(m == 3, F.regexp_replace(text, '"tiempo_espera_seg":[^,]+', '"tiempo_espera_seg":"abc"').cast("binary"))
        .when(m == 4, F.concat("value", F.lit(b"\xff")))
        .when(m == 5, F.concat(text, F.lit(" trailing")).cast("binary"))
        .when(m == 9, F.regexp_replace(text, '"canal":"[^"]*"', '"canal":{"a":1}').cast("binary"))
        .when(m == 10, F.regexp_replace(text, '"timestamp_evento":"[^"]*"', '"timestamp_evento":"2026"').cast("binary"))
        .when(m == 11, F.lit(None).cast("binary"))
        .when(m == 7, F.regexp_replace(text, "[}]$", ',"extra":1}').cast("binary"))
        .otherwise(F.col("value"))
    )
    return sent.select(damaged.alias("value"), "headers", *keep)
