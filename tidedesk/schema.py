"""Declared schemas and business catalogues. Nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- Fixed values: column names, types, order and meaning are part of the data contract ----------
CONTACT_SCHEMA = T.StructType(
    [
        T.StructField("contact_id", T.StringType(), False, {"comment": "Identifies one contact"}),
        T.StructField("timestamp_evento", T.TimestampType(), False, {"comment": "When it happened (UTC)"}),
        T.StructField("canal", T.StringType(), False, {"comment": "Channel it came through"}),
        T.StructField("cola", T.StringType(), False, {"comment": "Queue that took it"}),
        T.StructField("region", T.StringType(), False, {"comment": "Where the customer is"}),
        T.StructField("tiempo_espera_seg", T.DoubleType(), False, {"comment": "Wait until service or hang-up (s)"}),
        T.StructField("abandonado", T.BooleanType(), False, {"comment": "True if nobody served it"}),
        T.StructField("dentro_sla", T.BooleanType(), False, {"comment": "True if served in time"}),
        T.StructField("agente_id", T.StringType(), True, {"comment": "Who served it; unset without service"}),
        T.StructField("tiempo_atencion_seg", T.LongType(), True, {"comment": "Length of service (s); unset without service"}),
        T.StructField("resuelto_primer_contacto", T.BooleanType(), True, {"comment": "Settled at once; unset without service"}),
        T.StructField("csat", T.LongType(), True, {"comment": "Survey mark, 1 to 5; unset without an answer"}),
        T.StructField("orden_asociada", T.StringType(), True, {"comment": "Order it was about, if any"}),
    ]
)

DLQ_SCHEMA = T.StructType(
    [
        T.StructField("raw_payload", T.StringType(), True, {"comment": "Message as it arrived, as text"}),
        T.StructField("error", T.StringType(), False, {"comment": "Why it was rejected"}),
        T.StructField("ingested_at", T.TimestampType(), False, {"comment": "Instant of capture, UTC"}),
    ]
)

SLA_THRESHOLD_SECONDS = 20  # inclusive
SLA_TARGET_PCT = 80.0
WINDOW_SECONDS = 60
MIN_HANDLE_SECONDS = 30
TOPIC = "contactos-eventos"

CHANNELS = [  # canal, weight, base handle time in seconds
    ("voz", 0.45, 320),
    ("chat", 0.30, 210),
    ("app", 0.15, 180),
    ("correo", 0.10, 600),
]

QUEUES = [  # cola, weight
    ("Despacho y entregas", 0.35),
    ("Postventa", 0.25),
    ("Reclamos", 0.20),
    ("Pagos y facturación", 0.12),
    ("Información general", 0.08),
]

REGIONS = [
    "Metropolitana",
    "Valparaíso",
    "Biobío",
    "Maule",
    "La Araucanía",
    "Antofagasta",
    "Coquimbo",
]

HOURLY_FACTOR = [  # demand by UTC hour 0 to 23, as a fraction of the peak hour
    0.10, 0.05, 0.05, 0.05, 0.05, 0.10, 0.30, 0.60, 0.90, 1.00, 1.00, 0.90,
    0.80, 0.70, 0.80, 0.90, 1.00, 0.95, 0.80, 0.60, 0.40, 0.30, 0.20, 0.15,
]
# --- End of fixed values ---------------------------------------------------------------------------

CONTACT_COLUMNS = CONTACT_SCHEMA.names
REQUIRED_FIELDS = tuple(f.name for f in CONTACT_SCHEMA if not f.nullable)
SERVICE_FIELDS = tuple(f.name for f in CONTACT_SCHEMA if f.nullable)
DIMENSIONS = ("canal", "cola", "region", "agente_id", "fecha", "hora_del_dia")

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("value", T.BinaryType()),
        T.StructField(
            "headers",
            T.ArrayType(
                T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])
            ),
        ),
    ]
)


def conform(contacts: DataFrame, *extra: str | Column) -> DataFrame:
    """The 13 contact columns, in order and with their declared types, then ``extra``."""
    return contacts.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CONTACT_SCHEMA], *extra)


def literal_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small lookup as one single-partition relation, independent of the cluster's parallelism."""
    fields = T.StructType.fromDDL(schema).fields
    structs = [
        F.struct(*[F.lit(value).cast(field.dataType).alias(field.name) for field, value in zip(fields, row)])
        for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))


def channel_catalogue(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, CHANNELS, "canal string, peso double, aht_base bigint")


def queue_catalogue(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, QUEUES, "cola string, peso double")


def hourly_catalogue(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, list(enumerate(HOURLY_FACTOR)), "hora bigint, factor double")
