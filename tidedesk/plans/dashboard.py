"""Dashboard queries over granular contact rows. Apply the filters first, then a tile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidedesk.functions.contact import event_date, event_hour, flag, order_flag
from tidedesk.functions.measures import SCORECARD_DECIMALS, cpo, raw
from tidedesk.schema import CONTACT_COLUMNS

TABLE_MEASURES = ("sla_pct", "aht_seg", "abandono_pct", "fcr_pct", "csat_prom")


def dashboard_rows(contacts: DataFrame) -> DataFrame:
    """The contact columns plus date, hour and numeric flags: 19 columns.

    A ``fecha`` partition column is passed on, so that a later filter on it prunes partitions.
    """
    day = F.col("fecha") if "fecha" in contacts.columns else event_date()
    return contacts.select(
        *CONTACT_COLUMNS,
        day.alias("fecha"),
        event_hour().alias("hora_del_dia"),
        flag("dentro_sla").alias("sla_flag"),
        flag("abandonado").alias("abandono_flag"),
        flag("resuelto_primer_contacto").alias("fcr_flag"),
        order_flag().alias("con_orden_flag"),
    )


def scorecards(rows: DataFrame) -> DataFrame:
    """The six headline figures, one row.

    Contacts per order is an aggregate of its own: with the means in one, every order would carry
    six sums through the shuffle.
    """
    order_ratio = rows.select("con_orden_flag", "orden_asociada").agg(cpo(F.sum("con_orden_flag")).alias("cpo")).scalar()
    figures = rows.agg(*raw(*TABLE_MEASURES)).withColumn("cpo", order_ratio)
    return figures.select(*[F.round(name, places).alias(name) for name, places in SCORECARD_DECIMALS.items()])


def sla_by_hour(rows: DataFrame) -> DataFrame:
    return rows.groupBy("hora_del_dia").agg(*raw("sla_pct")).orderBy("hora_del_dia")


def volume_by_hour(rows: DataFrame) -> DataFrame:
    return rows.groupBy("hora_del_dia").agg(F.count("*").alias("contactos")).orderBy("hora_del_dia")


def tile_by(rows: DataFrame, dimension: str) -> DataFrame:
    return rows.groupBy(dimension).agg(*raw(*TABLE_MEASURES))


def tile_channel(rows: DataFrame) -> DataFrame:
    return tile_by(rows, "canal")


def tile_queue(rows: DataFrame) -> DataFrame:
    return tile_by(rows, "cola")


def top_agents_fcr(rows: DataFrame, n: int = 10) -> DataFrame:
    served = rows.where(F.col("abandono_flag") == 0)
    by_agent = served.groupBy("agente_id").agg(
        *raw("fcr_pct", "aht_seg", "csat_prom"), F.count("*").alias("contactos")
    )
    return best_agents(by_agent, n)


def best_agents(by_agent: DataFrame, n: int) -> DataFrame:
    """The first ``n`` by first-contact resolution; ties go to more contacts, then to the id."""
    return by_agent.orderBy(F.desc_nulls_last("fcr_pct"), F.desc("contactos"), F.asc("agente_id")).limit(n)


def _heatmap(rows: DataFrame, metric: Column) -> DataFrame:
    """A column for every channel that occurs; contacts without one are in the column ``null``."""
    return rows.groupBy("hora_del_dia").pivot("canal").agg(metric).orderBy("hora_del_dia")


def heatmap_sla(rows: DataFrame) -> DataFrame:
    """Hour by channel."""
    return _heatmap(rows, raw("sla_pct")[0])


def heatmap_volume(rows: DataFrame) -> DataFrame:
    return _heatmap(rows, F.count(F.lit(1)))
