"""The KPI model as temporary views, for users who query it in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidedesk.operators import kpis
from tidedesk.plans.dashboard import dashboard_rows

# View names are part of the query surface.
VIEWS = {
    "v_kpis_globales": kpis.kpis_global,
    "v_kpis_por_canal": kpis.kpis_by_channel,
    "v_kpis_por_cola": kpis.kpis_by_queue,
    "v_kpis_por_region": kpis.kpis_by_region,
    "v_kpis_horarios": kpis.kpis_by_hour,
    "v_kpis_por_agente": kpis.kpis_by_agent,
    "v_cpo": kpis.cpo,
    "v_contactos_dashboard": dashboard_rows,
}


def register_views(contacts: DataFrame) -> list[str]:
    """Creates or replaces every view over ``contacts``; a view is a plan and reads nothing yet."""
    for name, build in VIEWS.items():
        build(contacts).createOrReplaceTempView(name)
    return list(VIEWS)
