from datetime import date, datetime

import pytest

from tests.samples import SERVED, abandoned, contact_rows, event
from tidedesk.operators.quality import demand_curve, dlq_summary, mix_vs_plan, quality_audit
from tidedesk.schema import channel_catalogue, hourly_catalogue, literal_rows, queue_catalogue


def audit(spark, *events):
    return {r.regla: r.violaciones for r in quality_audit(contact_rows(spark, *events)).collect()}


def test_coherent_contacts_break_no_rule(spark):
    counts = audit(spark, SERVED, event(csat=None, orden_asociada=None), abandoned())
    assert len(counts) == 17 and set(counts.values()) == {0}


@pytest.mark.parametrize(
    "broken,rule",
    [
        (event(cola=""), "dimension_vacia"),
        (event(tiempo_espera_seg=float("nan"), dentro_sla=False), "espera_invalida"),
        (event(tiempo_espera_seg=-1.0), "espera_invalida"),
        (event(dentro_sla=False), "sla_incoherente"),
        (abandoned(dentro_sla=True), "sla_incoherente"),
        (abandoned(tiempo_atencion_seg=0), "abandonado_con_atencion"),
        (event(agente_id=None), "atendido_sin_atencion"),
        (event(resuelto_primer_contacto=None), "atendido_sin_atencion"),
        (event(tiempo_atencion_seg=29), "aht_bajo_minimo"),
        (event(csat=6), "csat_fuera_de_rango"),
        (event(agente_id="AG-7"), "agente_mal_formado"),
        (event(orden_asociada="ORD-1"), "orden_mal_formada"),
    ],
)
def test_each_rule(spark, broken, rule):
    counts = audit(spark, SERVED, broken)
    assert counts[rule] == 1
    extra = {"aht_bajo_minimo"} if broken["tiempo_atencion_seg"] == 0 else set()
    assert {r for r, n in counts.items() if n} <= {rule} | extra


def test_audit_of_nothing(spark):
    rows = quality_audit(contact_rows(spark, SERVED).limit(0)).collect()
    assert {r.violaciones for r in rows} == {0}


def test_dlq_summary(spark):
    day1, day2 = datetime(2026, 1, 1, 23, 59), datetime(2026, 1, 2)
    dlq = spark.createDataFrame(
        [
            ("a", "Faltan campos obligatorios: ['cola']", day1),
            ("b", "Faltan campos obligatorios: ['region']", day1),
            ("c", "BAD_TYPE", day1),
            ("d", "BAD_TYPE", day2),
        ],
        "raw_payload string, error string, ingested_at timestamp",
    )
    assert {tuple(r) for r in dlq_summary(dlq).collect()} == {
        (date(2026, 1, 1), "MISSING_FIELDS", 2),
        (date(2026, 1, 1), "BAD_TYPE", 1),
        (date(2026, 1, 2), "BAD_TYPE", 1),
    }


def test_mix_keeps_unplanned_and_unseen_values(spark):
    rows = contact_rows(spark, *[event(contact_id=str(i), canal=c) for i, c in enumerate(["voz", "voz", "voz", "fax"])])
    mix = {r.canal: tuple(r)[1:] for r in mix_vs_plan(rows, channel_catalogue(spark), "canal").collect()}
    assert mix == {
        "voz": (3, 0.75, 0.45, 0.3),
        "fax": (1, 0.25, None, None),
        "chat": (0, 0.0, 0.3, -0.3),
        "app": (0, 0.0, 0.15, -0.15),
        "correo": (0, 0.0, 0.1, -0.1),
    }
    queues = mix_vs_plan(rows, queue_catalogue(spark), "cola")
    assert {r.cola: r.desvio for r in queues.collect()}["Postventa"] == 0.75


def test_demand_curve_has_every_hour(spark):
    stamps = ["2026-01-01T09:00:00+00:00"] * 4 + ["2026-01-02T03:10:00+00:00"]
    rows = contact_rows(spark, *[event(contact_id=str(i), timestamp_evento=s) for i, s in enumerate(stamps)])
    curve = {r.hora: tuple(r)[1:] for r in demand_curve(rows).collect()}
    assert len(curve) == 24
    assert curve[9] == (4, 1.0, 1.0, 0.0)
    assert curve[3] == (1, 0.25, 0.05, 0.2)
    assert curve[0] == (0, 0.0, 0.1, -0.1)
    only_nine = demand_curve(rows, literal_rows(spark, [(9, 0.5)], "hora bigint, factor double"))
    assert [tuple(r) for r in only_nine.collect()] == [(9, 4, 1.0, 0.5, 0.5)]


def test_catalogues(spark):
    assert channel_catalogue(spark).agg({"peso": "sum"}).collect()[0][0] == pytest.approx(1.0)
    assert queue_catalogue(spark).agg({"peso": "sum"}).collect()[0][0] == pytest.approx(1.0)
    assert hourly_catalogue(spark).agg({"factor": "max"}).collect()[0][0] == 1.0
