"""Columns derived from one contact."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidedesk.schema import SLA_THRESHOLD_SECONDS


def event_date() -> Column:
    return F.to_date("timestamp_evento")


def event_hour() -> Column:
    return F.hour("timestamp_evento").cast("bigint")


def flag(name: str) -> Column:
    """Boolean to 0/1; NULL ("not applicable") stays NULL so averages skip it."""
    return F.col(name).cast("bigint")


def order_flag() -> Column:
    return F.when(F.col("orden_asociada").isNotNull(), 1).otherwise(0).cast("bigint")


def within_sla(threshold: float = SLA_THRESHOLD_SECONDS) -> Column:
    return ~F.col("abandonado") & (F.col("tiempo_espera_seg") <= F.lit(threshold))


def contact_line() -> Column:
    """One console line per contact: channel, queue and outcome."""
    outcome = F.when(F.col("abandonado"), F.lit("ABANDONO")).otherwise(
        F.format_string("AHT=%ds", F.col("tiempo_atencion_seg"))
    )
    return F.format_string("%-6s | %-22s | %s", F.col("canal"), F.col("cola"), outcome)
