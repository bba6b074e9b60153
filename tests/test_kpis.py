from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.samples import SERVED, abandoned, contact_rows, event
from tidedesk.operators import kpis
from tidedesk.operators.filters import DashboardFilter, apply_filters
from tidedesk.plans import dashboard
from tidedesk.plans.refresh import refresh_dashboard
from tidedesk.plans.views import VIEWS, register_views
from tidedesk_checks.projection import contacts

SF_DIR = "/root/testdata/sf0.001"


def only(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


@pytest.fixture(scope="module")
def sample(spark):
    return contacts(spark, SF_DIR).cache()


def test_golden_values(sample):
    assert only(kpis.kpis_global(sample)) == {
        "total_contactos": 1000,
        "sla_pct": 25.9,
        "abandono_pct": 20.1,
        "aht_seg": 297.9,
        "fcr_pct": 74.3,
        "csat_prom": 3.04,
    }
    assert only(kpis.cpo(sample)) == {"contactos_con_orden": 471, "ordenes_distintas": 293, "cpo": 1.61}


def test_denominators(spark):
    rows = contact_rows(
        spark,
        event(),
        event(contact_id="2", tiempo_atencion_seg=101, resuelto_primer_contacto=False, csat=None, dentro_sla=False),
        abandoned(contact_id="3"),
    )
    assert only(kpis.kpis_global(rows)) == {
        "total_contactos": 3,
        "sla_pct": 33.3,  # of all contacts
        "abandono_pct": 33.3,
        "aht_seg": 200.5,  # of the served
        "fcr_pct": 50.0,
        "csat_prom": 5.0,  # of the answered
    }


def test_no_contacts(spark):
    none = contact_rows(spark, SERVED).limit(0)
    assert only(kpis.kpis_global(none)) == {"total_contactos": 0, **dict.fromkeys(kpis.KPIS)}
    assert only(kpis.cpo(none)) == {"contactos_con_orden": 0, "ordenes_distintas": 0, "cpo": None}
    assert only(dashboard.scorecards(dashboard.dashboard_rows(none)))["cpo"] is None
    assert kpis.kpis_by_channel(none).isEmpty()
    empty = {"dim": "global", "value": None, "total_contactos": 0, **dict.fromkeys(kpis.KPIS)}
    assert only(kpis.kpis_multi(none)) == empty


def test_group_of_abandoned_contacts_only(spark):
    row = only(kpis.kpis_by_queue(contact_rows(spark, abandoned(), abandoned(contact_id="2"))))
    assert (row["abandono_pct"], row["aht_seg"], row["fcr_pct"], row["csat_prom"]) == (100.0, None, None, None)
    rows = contact_rows(spark, abandoned())
    assert kpis.kpis_by_agent(rows).isEmpty()
    assert only(kpis.cpo(rows))["cpo"] is None


def test_groups_add_up_to_the_total(sample):
    for build in (kpis.kpis_by_channel, kpis.kpis_by_queue, kpis.kpis_by_region, kpis.kpis_by_hour):
        assert only(build(sample).agg(F.sum("total_contactos").alias("n"))) == {"n": 1000}
    served = kpis.kpis_by_agent(sample).agg(F.sum("contactos_atendidos").alias("n"))
    assert only(served) == {"n": 1000 - 201}


def test_one_scan_form_equals_the_four_views(sample):
    got = {(r.dim, r.value): tuple(r)[2:] for r in kpis.kpis_multi(sample).collect()}
    expected = {("global", None): tuple(kpis.kpis_global(sample).collect()[0])}
    for dim in ("canal", "cola", "region"):
        expected.update({(dim, r[0]): tuple(r)[1:] for r in kpis.kpis_by(sample, dim).collect()})
    assert got == expected


def test_hours_are_sorted(sample):
    assert [r.hora for r in kpis.kpis_by_hour(sample).collect()] == list(range(24))


def test_agent_filters_agree_on_coherent_data(sample):
    by_id = {r.agente_id: r.contactos_atendidos for r in kpis.kpis_by_agent(sample).collect()}
    rows = dashboard.dashboard_rows(sample)
    by_flag = {r.agente_id: r.contactos for r in dashboard.top_agents_fcr(rows, n=100).collect()}
    assert by_id == by_flag


def test_top_agents_order_and_ties(spark):
    rows = contact_rows(
        spark,
        *[event(contact_id=f"a{i}", agente_id="AG-001") for i in range(2)],
        *[event(contact_id=f"b{i}", agente_id="AG-002") for i in range(3)],
        *[event(contact_id=f"c{i}", agente_id="AG-003") for i in range(2)],
        event(contact_id="d", agente_id="AG-004", resuelto_primer_contacto=False),
        event(contact_id="e", agente_id="AG-005", resuelto_primer_contacto=None),
        abandoned(contact_id="f"),
    )
    top = dashboard.top_agents_fcr(dashboard.dashboard_rows(rows))
    assert [r.agente_id for r in top.collect()] == ["AG-002", "AG-001", "AG-003", "AG-004", "AG-005"]
    assert dashboard.top_agents_fcr(dashboard.dashboard_rows(rows), n=2).count() == 2


def test_distinct_orders_may_be_estimated(sample):
    row = only(kpis.cpo(sample, max_error=0.02))
    assert abs(row["ordenes_distintas"] - 293) <= 293 * 0.1


def test_heatmap_cells_without_contacts_are_null(spark):
    rows = dashboard.dashboard_rows(contact_rows(spark, event(), event(contact_id="2", canal="chat")))
    later = dashboard.dashboard_rows(contact_rows(spark, event(canal="app", timestamp_evento="2026-01-01T11:00:00+00:00")))
    got = {r.hora_del_dia: r.asDict() for r in dashboard.heatmap_volume(rows.unionByName(later)).collect()}
    assert got[10] == {"hora_del_dia": 10, "voz": 1, "chat": 1, "app": None}
    assert got[11] == {"hora_del_dia": 11, "voz": None, "chat": None, "app": 1}
    assert only(dashboard.heatmap_sla(rows)) == {"hora_del_dia": 10, "voz": 100.0, "chat": 100.0}


def test_heatmap_has_a_column_for_every_channel_that_occurs(spark):
    rows = dashboard.dashboard_rows(contact_rows(spark, event(), event(canal="nuevo"), event(canal="")))
    rows = rows.unionByName(rows.limit(1).withColumn("canal", F.lit(None).cast("string")))
    assert only(dashboard.heatmap_volume(rows)) == {"hora_del_dia": 10, "voz": 1, "nuevo": 1, "": 1, "null": 1}


def test_dashboard_row(spark):
    rows = dashboard.dashboard_rows(contact_rows(spark, abandoned()))
    assert len(rows.columns) == 19
    tail = rows.select("fecha", "hora_del_dia", "sla_flag", "abandono_flag", "fcr_flag", "con_orden_flag")
    row = tail.withColumn("fecha", F.col("fecha").cast("string")).collect()[0]
    assert tuple(row) == ("2026-01-01", 10, 0, 1, None, 0)


def test_refresh_equals_the_single_tiles(spark, sample, tmp_path):
    rows = dashboard.dashboard_rows(apply_filters(sample, DashboardFilter(date(2024, 1, 5), date(2024, 1, 20))))
    tiles = refresh_dashboard(rows, str(tmp_path / "cube"))
    single = {name: getattr(dashboard, name)(rows) for name in tiles}
    for name, tile in tiles.items():
        assert tile.columns == single[name].columns
        assert sorted(map(str, tile.collect())) == sorted(map(str, single[name].collect())), name
    scans = tiles["tile_channel"]._jdf.queryExecution().executedPlan().toString()
    assert "events.parquet" not in scans and "cube" in scans


def test_refresh_counts_an_incoherent_agent_as_the_tile_does(spark, tmp_path):
    rows = dashboard.dashboard_rows(contact_rows(spark, event(), abandoned(contact_id="2", agente_id="AG-009")))
    tile = refresh_dashboard(rows, str(tmp_path / "cube"))["top_agents_fcr"]
    assert [r.agente_id for r in tile.collect()] == ["AG-007"]


def test_sla_threshold_is_inclusive(spark):
    rows = contact_rows(
        spark,
        event(contact_id="at", tiempo_espera_seg=20.0),
        event(contact_id="over", tiempo_espera_seg=20.1),
        abandoned(contact_id="gone", tiempo_espera_seg=1.0),
    )
    derived = {r.contact_id: r.dentro_sla for r in kpis.derive_sla(rows).collect()}
    assert derived == {"at": True, "over": False, "gone": False}
    assert kpis.derive_sla(rows, threshold=30).where("dentro_sla").count() == 2


def test_sla_breach(spark):
    rows = contact_rows(spark, event(), event(contact_id="2", cola="Reclamos", dentro_sla=False))
    marked = kpis.sla_breach(kpis.kpis_by_queue(rows))
    assert {r.cola: r.sla_breach for r in marked.collect()} == {"Postventa": False, "Reclamos": True}


def test_views_answer_sql(spark, sample):
    assert register_views(sample) == list(VIEWS)
    for name, build in VIEWS.items():
        assert sorted(map(str, spark.table(name).collect())) == sorted(map(str, build(sample).collect()))
    register_views(sample.where("canal = 'view'"))
    assert spark.sql("SELECT count(*) FROM v_kpis_por_canal").collect()[0][0] == 1
