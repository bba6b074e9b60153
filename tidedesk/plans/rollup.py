"""A dashboard refreshed from a stored aggregate that follows the loads of the contacts table.

The aggregate holds partial sums per day, hour, channel, queue, region and agent of every live load, which is what all
filters and tiles need. A refresh reads the loads that came since the last one, and no others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidedesk.functions import measures
from tidedesk.functions.contact import event_hour, flag
from tidedesk.operators.filters import DashboardFilter, apply_filters, filter_dimensions
from tidedesk.plans.dashboard import dashboard_rows
from tidedesk.plans.refresh import cube_tiles
from tidedesk.schema import CONTACT_SCHEMA
from tidedesk.sources.tables import DAY, LOAD, ROLLUP, ContactStore, follow_loads, read_contacts, read_parts

ROLLUP_DIMENSIONS = (DAY, "hora_del_dia", "canal", "cola", "region", "agente_id", "abandono_flag")
#: Registers of a sketch of distinct orders, as a power of two.
SKETCH_LG_K = 12
#: Relative error of a sketched count that is exceeded once in some hundred counts: three standard errors.
SKETCH_ERROR = 3 * 1.04 / 2 ** (SKETCH_LG_K / 2)


def rollup_rows(contacts: DataFrame, *keys: str, sketched: bool = False) -> DataFrame:
    """Partial sums of contacts by ``keys`` and the dimensions; with ``sketched`` also their distinct orders."""
    rows = contacts.withColumns({"hora_del_dia": event_hour(), "abandono_flag": flag("abandonado")})
    extra = [F.hll_sketch_agg("orden_asociada", SKETCH_LG_K).alias("ordenes")] if sketched else []
    orders = F.count("orden_asociada").alias("con_orden_n")
    return rows.groupBy(*keys, *ROLLUP_DIMENSIONS).agg(*measures.partial_sums(), orders, *extra)


def refresh_rollup(spark: SparkSession, store: ContactStore, sketched: bool = False) -> int:
    """Brings the aggregate up to date with the live loads; returns how many parts of loads were read.

    ``sketched`` adds mergeable sketches of distinct orders. They are for all loads or for none: asking for them
    over an aggregate without derives it anew, and so does leaving them out again.
    """
    tag = "ordenes" if sketched else "sumas"
    return follow_loads(spark, store, ROLLUP, tag, lambda rows: rollup_rows(rows, LOAD, sketched=sketched))


def read_rollup(spark: SparkSession, store: ContactStore, controls: DashboardFilter = DashboardFilter()) -> DataFrame:
    """The aggregate of the rows that every control lets through; days outside the dates are not opened."""
    parts = store.log(spark).state().parts(ROLLUP, controls.start, controls.end)
    sketched = any(p.load.startswith("ordenes:") for p in parts)
    empty = rollup_rows(read_parts(spark, store.contacts, CONTACT_SCHEMA, DAY, []), sketched=sketched)
    if not parts:
        return empty
    paths = [f"{store.rollup}/{p.day}/{p.name}" for p in parts]
    rows = spark.read.schema(empty.schema).option("basePath", store.rollup).parquet(*paths).select(*empty.columns)
    return filter_dimensions(rows, controls)


def sketched_orders() -> Column:
    """Distinct orders of a group of the aggregate, within ``SKETCH_ERROR``."""
    return F.hll_sketch_estimate(F.hll_union_agg("ordenes"))


def sketched_cpo() -> Column:
    """Contacts per order from the aggregate alone; NULL when there is no order."""
    return F.try_divide(F.sum("con_orden_n"), F.nullif(sketched_orders(), F.lit(0)))


def dashboard_tiles(
    spark: SparkSession, store: ContactStore, controls: DashboardFilter = DashboardFilter(), sketched: bool = False
) -> dict[str, DataFrame]:
    """Every tile of the filtered contacts, from the aggregate as ``refresh_rollup`` has left it.

    Contacts per order is exact and reads that column of the filtered rows, or with ``sketched`` comes from the
    aggregate as well.
    """
    cube = read_rollup(spark, store, controls)
    if sketched:
        ratio = cube.agg(sketched_cpo().alias("cpo")).scalar()
    else:
        contacts = read_contacts(spark, store.contacts, controls.start, controls.end)
        rows = apply_filters(dashboard_rows(contacts), controls)
        ratio = rows.agg(measures.cpo(F.sum("con_orden_flag")).alias("cpo")).scalar()
    return cube_tiles(cube, ratio)
