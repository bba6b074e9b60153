from datetime import date

import pytest

from tests.samples import contact_rows, event
from tidedesk.operators.filters import DashboardFilter, apply_filters, cross_filter, last_n_days, this_month
from tidedesk.operators.kpis import kpis_by_region
from tidedesk.plans.dashboard import dashboard_rows, tile_channel
from tidedesk_checks.projection import contacts


@pytest.fixture(scope="module")
def rows(spark):
    def at(i, stamp, **changes):
        return event(contact_id=str(i), timestamp_evento=stamp, **changes)

    return contact_rows(
        spark,
        at(1, "2026-01-31T23:59:59.999999+00:00"),
        at(2, "2026-02-01T00:00:00+00:00", canal="chat"),
        at(3, "2026-02-07T23:59:59.999999+00:00", region="Biobío"),
        at(4, "2026-02-08T00:00:00+00:00", canal="app", region="Coquimbo"),
        at(5, "2026-02-28T12:00:00+00:00", canal="chat", region="Biobío"),
    )


def kept(df):
    return "".join(sorted(r.contact_id for r in df.collect()))


@pytest.mark.parametrize("shape", ["contacts", "dashboard"])
@pytest.mark.parametrize(
    "controls,expected",
    [
        (DashboardFilter(), "12345"),
        (DashboardFilter(start=date(2026, 2, 1)), "2345"),
        (DashboardFilter(end=date(2026, 2, 7)), "123"),
        (last_n_days(date(2026, 2, 8), 7), "23"),
        (last_n_days(date(2026, 2, 8), 7, include_today=True), "34"),
        (this_month(date(2026, 2, 10)), "2345"),
        (DashboardFilter(channels=("chat", "app")), "245"),
        (DashboardFilter(regions=("Biobío",)), "35"),
        (DashboardFilter(start=date(2026, 2, 2), channels=("chat",), regions=("Biobío",)), "5"),
        (DashboardFilter(cross=("hora_del_dia", 23)), "13"),
        (DashboardFilter(cross=("fecha", date(2026, 2, 8))), "4"),
        (DashboardFilter(cross=("agente_id", None)), ""),
    ],
)
def test_controls(rows, shape, controls, expected):
    source = rows if shape == "contacts" else dashboard_rows(rows)
    assert kept(apply_filters(source, controls)) == expected


def test_date_helpers():
    assert last_n_days(date(2026, 3, 3), 7) == DashboardFilter(date(2026, 2, 24), date(2026, 3, 2))
    assert this_month(date(2024, 2, 10)) == DashboardFilter(date(2024, 2, 1), date(2024, 2, 29))


def test_only_dimensions_can_be_clicked(rows):
    with pytest.raises(ValueError, match="csat"):
        cross_filter(rows, "csat", 5)


def test_filter_then_aggregate_equals_the_subset(spark):
    sample = contacts(spark, "/root/testdata/sf0.001")
    all_regions = {r.region: tuple(r) for r in kpis_by_region(sample).collect()}
    asia = kpis_by_region(apply_filters(sample, DashboardFilter(regions=("ASIA",)))).collect()
    assert [tuple(r) for r in asia] == [all_regions["ASIA"]]


def test_filters_reach_the_scan(spark):
    sample = contacts(spark, "/root/testdata/sf0.001")
    controls = DashboardFilter(date(2024, 1, 8), date(2024, 1, 9), channels=("view",))
    plan = tile_channel(apply_filters(dashboard_rows(sample), controls))._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "events.parquet" in line)
    assert "GreaterThanOrEqual(ts,2024-01-08T00:00)" in scan
    assert "LessThan(ts,2024-01-10T00:00)" in scan
    assert "EqualTo(event_type,view)" in scan
