"""A full refresh of the dashboard from one aggregation, instead of one scan per tile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidedesk.functions import measures
from tidedesk.functions.measures import SCORECARD_DECIMALS, merged
from tidedesk.plans.dashboard import TABLE_MEASURES, best_agents

CUBE_DIMENSIONS = ("hora_del_dia", "canal", "cola", "agente_id", "abandono_flag")


def dashboard_cube(rows: DataFrame) -> DataFrame:
    """Partial sums per hour, channel, queue and agent of the filtered dashboard rows."""
    return rows.groupBy(*CUBE_DIMENSIONS).agg(*measures.partial_sums())


def store_cube(rows: DataFrame, path: str) -> DataFrame:
    """The cube, written once so that every tile reads the small result and not the rows."""
    cube = dashboard_cube(rows)
    cube.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(cube.schema).parquet(path)


def table_tile(cube: DataFrame, dimension: str) -> DataFrame:
    """Contacts and the five measures per value of one dimension."""
    return cube.groupBy(dimension).agg(
        F.sum("n").alias("contactos"), *[merged(name).alias(name) for name in TABLE_MEASURES]
    )


def refresh_dashboard(rows: DataFrame, path: str) -> dict[str, DataFrame]:
    """Every tile over the same filtered rows; each equals the tile computed on its own.

    Distinct orders cannot be merged from sums, so contacts per order reads its own column once more.
    """
    order_ratio = rows.agg(measures.cpo(F.sum("con_orden_flag")).alias("cpo")).scalar()
    return cube_tiles(store_cube(rows, path), order_ratio)


def cube_tiles(cube: DataFrame, order_ratio: Column) -> dict[str, DataFrame]:
    """Every tile from partial sums by at least ``CUBE_DIMENSIONS``, and contacts per order as a scalar."""
    figures = cube.agg(*[merged(name).alias(name) for name in TABLE_MEASURES]).withColumn("cpo", order_ratio)
    by_hour = table_tile(cube, "hora_del_dia")
    by_agent = table_tile(cube.where(F.col("abandono_flag") == 0), "agente_id")
    heatmap = cube.groupBy("hora_del_dia").pivot("canal")
    return {
        "scorecards": figures.select(*[F.round(n, places).alias(n) for n, places in SCORECARD_DECIMALS.items()]),
        "sla_by_hour": by_hour.select("hora_del_dia", "sla_pct").orderBy("hora_del_dia"),
        "volume_by_hour": by_hour.select("hora_del_dia", "contactos").orderBy("hora_del_dia"),
        "tile_channel": table_tile(cube, "canal").drop("contactos"),
        "tile_queue": table_tile(cube, "cola").drop("contactos"),
        "top_agents_fcr": best_agents(
            by_agent.select("agente_id", "fcr_pct", "aht_seg", "csat_prom", "contactos"), 10
        ),
        "heatmap_sla": heatmap.agg(merged("sla_pct")).orderBy("hora_del_dia"),
        "heatmap_volume": heatmap.agg(F.sum("n")).orderBy("hora_del_dia"),
    }
