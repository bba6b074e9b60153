"""KPI measures.

Each one averages a 0/1 flag or an integer and skips NULL, so the service level and the
abandonment rate divide by all contacts, handle time and first-contact resolution by the served
ones, and satisfaction by the answered surveys.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidedesk.functions.contact import flag


def rate(name: str) -> Column:
    return 100 * F.avg(flag(name))


def distinct_orders(max_error: float | None = None) -> Column:
    """Exact unless a relative error is allowed, in which case no order id is shuffled."""
    if max_error is None:
        return F.countDistinct("orden_asociada")
    return F.approx_count_distinct("orden_asociada", max_error)


def cpo(contacts_with_order: Column, max_error: float | None = None) -> Column:
    """Contacts per distinct order; NULL when there is no order."""
    return F.try_divide(contacts_with_order, distinct_orders(max_error))


# name -> decimals shown by the KPI views
DECIMALS = {"sla_pct": 1, "abandono_pct": 1, "aht_seg": 1, "fcr_pct": 1, "csat_prom": 2}

# name -> decimals shown by the dashboard's headline figures
SCORECARD_DECIMALS = {"sla_pct": 1, "aht_seg": 0, "abandono_pct": 1, "fcr_pct": 1, "csat_prom": 2, "cpo": 2}

# name -> contact column and factor behind a mean, for jobs that merge partial sums and counts
MEANS = {
    "sla_pct": ("dentro_sla", 100),
    "abandono_pct": ("abandonado", 100),
    "aht_seg": ("tiempo_atencion_seg", 1),
    "fcr_pct": ("resuelto_primer_contacto", 100),
    "csat_prom": ("csat", 1),
}


def measures() -> dict[str, Column]:
    """Built on call: a Column needs a running session."""
    return {
        "sla_pct": rate("dentro_sla"),
        "abandono_pct": rate("abandonado"),
        "aht_seg": F.avg("tiempo_atencion_seg"),
        "fcr_pct": rate("resuelto_primer_contacto"),
        "csat_prom": F.avg("csat"),
    }


def raw(*names: str) -> list[Column]:
    available = measures()
    return [available[n].alias(n) for n in names]


def rounded(*names: str) -> list[Column]:
    available = measures()
    return [F.round(available[n], DECIMALS[n]).alias(n) for n in names]


def partial_sums() -> list[Column]:
    """What the means of a group can be merged from: rows, and sum and count per measure."""
    sums = [F.sum(flag(source)).alias(f"{name}_s") for name, (source, _) in MEANS.items()]
    counts = [F.count(source).alias(f"{name}_n") for name, (source, _) in MEANS.items()]
    return [F.count("*").alias("n"), *sums, *counts]


def merged(name: str) -> Column:
    """The mean ``name`` over groups of partial sums; it equals the mean over their rows."""
    return MEANS[name][1] * F.try_divide(F.sum(f"{name}_s"), F.sum(f"{name}_n"))
