"""KPI views as functions of a contacts DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidedesk.functions import measures
from tidedesk.functions.contact import event_hour, within_sla
from tidedesk.functions.measures import DECIMALS, rounded
from tidedesk.schema import SLA_TARGET_PCT, SLA_THRESHOLD_SECONDS, literal_rows

KPIS = ("sla_pct", "abandono_pct", "aht_seg", "fcr_pct", "csat_prom")


def _total(name: str = "total_contactos") -> Column:
    return F.count("*").alias(name)


def kpis_global(contacts: DataFrame) -> DataFrame:
    return contacts.agg(_total(), *rounded(*KPIS))


def kpis_by(contacts: DataFrame, dimension: str) -> DataFrame:
    return contacts.groupBy(dimension).agg(_total(), *rounded(*KPIS))


def kpis_by_channel(contacts: DataFrame) -> DataFrame:
    return kpis_by(contacts, "canal")


def kpis_by_queue(contacts: DataFrame) -> DataFrame:
    return kpis_by(contacts, "cola")


def kpis_by_region(contacts: DataFrame) -> DataFrame:
    return kpis_by(contacts, "region")


def kpis_by_hour(contacts: DataFrame) -> DataFrame:
    return (
        contacts.groupBy(event_hour().alias("hora"))
        .agg(_total(), *rounded("sla_pct", "abandono_pct", "aht_seg"))
        .orderBy("hora")
    )


def kpis_by_agent(contacts: DataFrame) -> DataFrame:
    served = contacts.where(F.col("agente_id").isNotNull())
    return served.groupBy("agente_id").agg(_total("contactos_atendidos"), *rounded("aht_seg", "fcr_pct", "csat_prom"))


def cpo(contacts: DataFrame, max_error: float | None = None) -> DataFrame:
    """Contacts per order. The distinct count merges map-side, so a hot order costs one row per task.

    ``max_error`` trades the exact count of orders for an estimate within that relative error.
    """
    with_order = contacts.where(F.col("orden_asociada").isNotNull())
    return with_order.agg(
        _total("contactos_con_orden"),
        measures.distinct_orders(max_error).alias("ordenes_distintas"),
        F.round(measures.cpo(F.count("*"), max_error), 2).alias("cpo"),
    )


def kpis_multi(contacts: DataFrame) -> DataFrame:
    """The global, channel, queue and region KPIs from one scan, as (dim, value, measures).

    Sums and counts per (canal, cola, region) come first; the grouping sets then expand those few
    rows instead of every contact.
    """
    dims = ("canal", "cola", "region")
    partial = contacts.groupBy(*dims).agg(*measures.partial_sums())
    # One empty group, so that the global row exists without contacts too.
    nothing = literal_rows(contacts.sparkSession, [(0,)], "n bigint")
    groups = partial.unionByName(nothing, allowMissingColumns=True)
    merged = groups.groupingSets([[], *([name] for name in dims)], *dims).agg(
        F.grouping_id().alias("g"),
        F.sum("n").alias("total_contactos"),
        *[F.round(measures.merged(name), DECIMALS[name]).alias(name) for name in KPIS],
    )
    merged = merged.where((F.col("g") == 0b111) | (F.col("total_contactos") > 0))
    # grouping_id has one bit per column, set when the column is rolled up: canal, cola, region.
    which = {0b011: "canal", 0b101: "cola", 0b110: "region"}
    dim, value = F.lit("global"), F.lit(None).cast("string")
    for g, name in which.items():
        dim = F.when(F.col("g") == g, name).otherwise(dim)
        value = F.when(F.col("g") == g, F.col(name)).otherwise(value)
    return merged.select(dim.alias("dim"), value.alias("value"), "total_contactos", *KPIS)


def sla_breach(kpis: DataFrame, target: float = SLA_TARGET_PCT) -> DataFrame:
    """Marks the rows of a KPI table whose service level is under the target."""
    return kpis.withColumn("sla_breach", F.col("sla_pct") < F.lit(target))


def derive_sla(contacts: DataFrame, threshold: float = SLA_THRESHOLD_SECONDS) -> DataFrame:
    return contacts.withColumn("dentro_sla", within_sla(threshold))
