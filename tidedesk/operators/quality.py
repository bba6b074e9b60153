"""Coherence audit, dead-letter summary, and observed demand against the plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidedesk.functions.contact import event_hour, within_sla
from tidedesk.operators.validate import reason_code
from tidedesk.schema import MIN_HANDLE_SECONDS, REQUIRED_FIELDS, SERVICE_FIELDS, hourly_catalogue

# --- Fixed values: identifier formats -----------------------------------------------------------------
AGENT_FORMAT = r"^AG-\d{3}$"
ORDER_FORMAT = r"^ORD-\d{6,}$"
# --- End of fixed values ------------------------------------------------------------------------------


def _rules() -> dict[str, Column]:
    """rule name -> true where a contact breaks it. NULL counts as kept."""
    c = F.col
    empty = c("canal") == ""
    for name in ("cola", "region"):
        empty = empty | (c(name) == "")
    service_set = F.lit(False)
    for name in SERVICE_FIELDS:
        service_set = service_set | c(name).isNotNull()
    service_missing = c("agente_id").isNull() | c("tiempo_atencion_seg").isNull()
    return {
        **{f"nulo_{name}": c(name).isNull() for name in REQUIRED_FIELDS},
        "dimension_vacia": empty,
        "espera_invalida": F.isnan("tiempo_espera_seg") | (c("tiempo_espera_seg") < 0),
        "sla_incoherente": c("dentro_sla") != within_sla(),
        "abandonado_con_atencion": c("abandonado") & service_set,
        "atendido_sin_atencion": ~c("abandonado") & (service_missing | c("resuelto_primer_contacto").isNull()),
        "aht_bajo_minimo": c("tiempo_atencion_seg") < MIN_HANDLE_SECONDS,
        "csat_fuera_de_rango": ~c("csat").between(1, 5),
        "agente_mal_formado": ~c("agente_id").rlike(AGENT_FORMAT),
        "orden_mal_formada": ~c("orden_asociada").rlike(ORDER_FORMAT),
    }


def quality_audit(contacts: DataFrame) -> DataFrame:
    """Violations per rule: one pass, one row of counters, turned into (regla, violaciones)."""
    rules = _rules()
    counters = contacts.agg(*[F.count_if(broken).alias(name) for name, broken in rules.items()])
    pairs = ", ".join(f"'{name}', `{name}`" for name in rules)
    return counters.selectExpr(f"stack({len(rules)}, {pairs}) AS (regla, violaciones)")


def dlq_summary(dlq: DataFrame) -> DataFrame:
    """Rejects per day and reason."""
    return dlq.groupBy(F.to_date("ingested_at").alias("fecha"), reason_code(F.col("error")).alias("motivo")).agg(
        F.count("*").alias("mensajes")
    )


def mix_vs_plan(contacts: DataFrame, plan: DataFrame, dimension: str) -> DataFrame:
    """Observed share of each value against its planned weight ``peso``.

    Values seen but not planned, and planned but not seen, both stay.
    """
    seen = contacts.groupBy(dimension).agg(F.count("*").alias("contactos"))
    total = seen.agg(F.sum("contactos")).scalar()
    shares = seen.withColumn("peso_observado", F.round(F.col("contactos") / total, 4))
    merged = shares.join(plan.select(dimension, F.col("peso").alias("peso_plan")), dimension, "full_outer")
    observed = F.coalesce("peso_observado", F.lit(0.0))
    return merged.select(
        dimension,
        F.coalesce("contactos", F.lit(0)).alias("contactos"),
        observed.alias("peso_observado"),
        "peso_plan",
        F.round(observed - F.col("peso_plan"), 4).alias("desvio"),
    )


def demand_curve(contacts: DataFrame, curve: DataFrame | None = None) -> DataFrame:
    """Contacts per hour as a fraction of the busiest hour, against the configured factor.

    The counts have at most 24 rows, so they may be broadcast and share one window.
    """
    curve = hourly_catalogue(contacts.sparkSession) if curve is None else curve
    by_hour = contacts.groupBy(event_hour().alias("hora")).agg(F.count("*").alias("contactos"))
    peak = F.max("contactos").over(Window.partitionBy())
    observed = by_hour.withColumn("fraccion", F.round(F.col("contactos") / peak, 4))
    fraction = F.coalesce("fraccion", F.lit(0.0))
    return curve.join(F.broadcast(observed), "hora", "left").select(
        "hora",
        F.coalesce("contactos", F.lit(0)).alias("contactos"),
        fraction.alias("fraccion"),
        "factor",
        F.round(fraction - F.col("factor"), 4).alias("desvio"),
    )
