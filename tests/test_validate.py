import json

import pytest
from pyspark.sql import functions as F

from tests.samples import SERVED, contact_rows, event, message_rows
from tidedesk.operators.validate import dlq_rows, reason_code, replay_dlq, valid_rows, validate
from tidedesk.schema import CONTACT_COLUMNS, REQUIRED_FIELDS
from tidedesk.sources.messages import attribute, publish_messages, with_channel

GOOD = json.dumps(SERVED)
ALL_MISSING = "Faltan campos obligatorios: " + str(list(REQUIRED_FIELDS))

CASES = [
    # valid
    (GOOD, None),
    (f"  {GOOD}\n", None),
    (json.dumps(event(extra={"a": [1, {"b": 2}]})), None),
    (json.dumps(event(canal="", tiempo_espera_seg=0, abandonado=False)), None),
    (json.dumps(event(cola="a } b , c ] d {")), None),
    (GOOD[:-1] + ', "canal": "chat"}', None),
    ('{"canal": null, ' + GOOD[1:], None),
    (json.dumps(event(tiempo_espera_seg=float("nan"))), None),
    (json.dumps(event(agente_id=None, csat=None)), None),
    (json.dumps(event(tiempo_espera_seg=7)), None),
    # missing fields, in declared order
    ("{}", ALL_MISSING),
    (json.dumps({"canal": "voz", "x": 1}), ALL_MISSING.replace(" 'canal',", "")),
    (json.dumps(event(region=None, cola=None)), "Faltan campos obligatorios: ['cola', 'region']"),
    (json.dumps(event(abandonado=None)), "Faltan campos obligatorios: ['abandonado']"),
    (json.dumps(event(region=None, tiempo_espera_seg="abc")), "Faltan campos obligatorios: ['region']"),
    (GOOD[:-1] + ', "canal": null}', "Faltan campos obligatorios: ['canal']"),
    (json.dumps({k.upper(): v for k, v in SERVED.items()}), ALL_MISSING),
    # declared types
    (json.dumps(event(tiempo_espera_seg="abc")), "BAD_TYPE"),
    (json.dumps(event(abandonado="true")), "BAD_TYPE"),
    (json.dumps(event(csat="5")), "BAD_TYPE"),
    (json.dumps(event(csat={"x": 1})), "BAD_TYPE"),
    (json.dumps(event(timestamp_evento="yesterday")), "BAD_TYPE"),
    (json.dumps(event(canal={"a": 1})), "BAD_TYPE"),
    (json.dumps(event(canal=True)), "BAD_TYPE"),
    (json.dumps(event(cola=5)), "BAD_TYPE"),
    (json.dumps(event(contact_id=[1, 2])), "BAD_TYPE"),
    (json.dumps(event(agente_id=1.5)), "BAD_TYPE"),
    (GOOD.replace('"voz"', '{"a":1,"a":2}'), "BAD_TYPE"),
    (json.dumps(event(timestamp_evento="2026")), "BAD_TYPE"),
    (json.dumps(event(timestamp_evento=1767261600)), "BAD_TYPE"),
    (json.dumps(event(timestamp_evento="2026-01-01T10:00:00")), "BAD_TYPE"),
    (json.dumps(event(timestamp_evento="2026-01-01")), "BAD_TYPE"),
    (json.dumps(event(timestamp_evento="2026-13-01T10:00:00Z")), "BAD_TYPE"),
    (json.dumps(event(timestamp_evento="2026-01-01T10:00:00Z")), None),
    (json.dumps(event(timestamp_evento="2026-01-01 10:00:00.5-03:00")), None),
    # JSON of another kind
    ("[1,2]", "NOT_OBJECT"),
    (f"[{GOOD}]", "NOT_OBJECT"),
    ("5", "NOT_OBJECT"),
    ("null", "NOT_OBJECT"),
    ("true", "NOT_OBJECT"),
    ('"s"', "NOT_OBJECT"),
    ("[NaN]", "NOT_OBJECT"),
    # not JSON
    ("", "INVALID_JSON"),
    ("   ", "INVALID_JSON"),
    ("not json", "INVALID_JSON"),
    (f"{GOOD},{GOOD}", "INVALID_JSON"),
    (f"{GOOD}], [", "INVALID_JSON"),
    (f'{GOOD}, "x":1', "INVALID_JSON"),
    (f'{GOOD}, "p":{GOOD}', "INVALID_JSON"),
    (GOOD + '}, {"q":1', "INVALID_JSON"),
    (GOOD + "}", "INVALID_JSON"),
    (GOOD + "]", "INVALID_JSON"),
    (GOOD + " trailing", "INVALID_JSON"),
    (GOOD[:-5], "INVALID_JSON"),
    (GOOD[:-1], "INVALID_JSON"),
    (GOOD[:-1] + ', "x": {"y": 1}', "INVALID_JSON"),
    (GOOD[:-1] + ', "x": "}"', "INVALID_JSON"),
    (GOOD[:-1] + ', "x": [1}', "INVALID_JSON"),
    ('{"p":' + GOOD, "INVALID_JSON"),
    (GOOD.replace("}", "") + "]}", "INVALID_JSON"),
    (GOOD.replace('"', "'"), "INVALID_JSON"),
    (GOOD.replace("300", "0300"), "INVALID_JSON"),
    (GOOD.replace("300", "tru"), "INVALID_JSON"),
    (GOOD[:-1] + ', "x": {"y": tru}}', "INVALID_JSON"),
    (GOOD[:-1] + ",}", "INVALID_JSON"),
    (GOOD.replace("Maule", "Ma\nule"), "INVALID_JSON"),
    ("﻿" + GOOD, "INVALID_JSON"),
    ("[1", "INVALID_JSON"),
    ("1,2", "INVALID_JSON"),
    ("/* c */ " + GOOD, "INVALID_JSON"),
    ("5 trailing", "INVALID_JSON"),
]


def python_kind(text):
    try:
        return "object" if isinstance(json.loads(text), dict) else "NOT_OBJECT"
    except json.JSONDecodeError:
        return "INVALID_JSON"


@pytest.fixture(scope="module")
def outcomes(spark):
    rows = validate(message_rows(spark, *[text for text, _ in CASES])).collect()
    return {row.raw_payload: row for row in rows}


@pytest.mark.parametrize("text,expected", CASES, ids=range(len(CASES)))
def test_outcome(outcomes, text, expected):
    assert outcomes[text].error == expected
    assert (outcomes[text].evento is None) == (expected is not None)


@pytest.mark.parametrize("text,expected", CASES, ids=range(len(CASES)))
def test_kind_is_that_of_the_json_module(text, expected):
    kind = expected if expected in ("NOT_OBJECT", "INVALID_JSON") else "object"
    assert python_kind(text) == kind


def test_instants_without_a_fraction_or_with_an_offset(outcomes):
    text = json.dumps(event(timestamp_evento="2026-01-01 10:00:00.5-03:00"))
    assert outcomes[text].evento.timestamp_evento.isoformat() == "2026-01-01T13:00:00.500000"


def test_last_duplicate_wins(outcomes):
    assert outcomes[GOOD[:-1] + ', "canal": "chat"}'].evento.canal == "chat"


def test_bytes_that_are_not_utf8(spark):
    broken = GOOD.encode() + b"\xff"
    validated = validate(message_rows(spark, broken, "señal".encode("latin-1")))
    rows = {r.raw_payload: r.error for r in dlq_rows(validated).collect()}
    assert rows == {GOOD + "�": "INVALID_UTF8", "se�al": "INVALID_UTF8"}


def test_null_message_is_rejected_not_lost(spark):
    rows = validate(spark.createDataFrame([(None, None)], "value binary, headers string")).collect()
    assert [(r.error, r.raw_payload) for r in rows] == [("EMPTY", None)]
    again = replay_dlq(dlq_rows(validate(spark.createDataFrame([(None, None)], "value binary, headers string"))))
    assert [r.error for r in again.collect()] == ["EMPTY"]


def test_counting_reasons_builds_no_payload_or_event(spark):
    reasons = dlq_rows(validate(message_rows(spark, GOOD))).groupBy("error").count()
    plan = reasons._jdf.queryExecution().optimizedPlan().toString()
    assert "make_valid_utf8" not in plan and "named_struct(contact_id" not in plan


def test_split_loses_nothing(spark):
    validated = validate(message_rows(spark, *[text for text, _ in CASES]))
    good, bad = valid_rows(validated).count(), dlq_rows(validated).count()
    assert good == sum(expected is None for _, expected in CASES)
    assert good + bad == len(CASES)


def test_valid_row_is_typed(spark):
    row = valid_rows(validate(message_rows(spark, GOOD))).collect()[0]
    assert row.asDict()["tiempo_atencion_seg"] == 300
    assert row.timestamp_evento.isoformat() == "2026-01-01T10:00:00.123456"
    assert row.asDict().keys() == set(CONTACT_COLUMNS)


def test_offsets_are_converted_to_utc(spark):
    late = json.dumps(event(timestamp_evento="2026-01-01T23:30:00-03:00"))
    day = valid_rows(validate(message_rows(spark, late))).select(F.to_date("timestamp_evento").cast("string"))
    assert day.collect()[0][0] == "2026-01-02"


def test_publish_and_parse_round_trip(spark):
    rows = contact_rows(spark, SERVED, event(contact_id="c2", cola='quote " brace }', csat=None, orden_asociada=None))
    back = valid_rows(validate(publish_messages(rows)))
    assert back.exceptAll(rows).isEmpty() and rows.exceptAll(back).isEmpty()


def test_published_nulls_are_explicit(spark):
    sent = publish_messages(contact_rows(spark, event(csat=None))).select(F.col("value").cast("string")).collect()[0][0]
    assert json.loads(sent) == {**event(csat=None), "timestamp_evento": "2026-01-01T10:00:00.123456+00:00"}


def test_channel_attribute(spark):
    rows = contact_rows(spark, SERVED, event(contact_id="c2", canal="chat"))
    sent = publish_messages(rows)
    assert {r[0] for r in sent.select(attribute("canal")).collect()} == {"voz", "chat"}
    assert sent.select(attribute("nope").alias("a")).where("a IS NOT NULL").isEmpty()
    assert with_channel(sent, "chat").count() == 1


def test_filter_by_attribute_does_not_parse_dropped_messages(spark):
    plan = validate(with_channel(message_rows(spark, GOOD), "chat"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("from_json") < plan.index("headers")  # the filter lies below the parse


def test_replay_with_relaxed_rules(spark):
    bad = [json.dumps(event(cola=None)), json.dumps(event(canal=None)), "not json", GOOD.encode() + b"\xff"]
    rejected = dlq_rows(validate(message_rows(spark, *bad)))
    relaxed = [name for name in REQUIRED_FIELDS if name != "cola"]
    again = replay_dlq(rejected, relaxed)
    assert [r.cola for r in valid_rows(again).collect()] == [None]
    assert {r.error for r in dlq_rows(again).collect()} == {
        "Faltan campos obligatorios: ['canal']",
        "INVALID_JSON",
        "INVALID_UTF8",
    }


def test_replay_never_accepts_replaced_characters(spark):
    broken = json.dumps(event(cola="x")).encode().replace(b'"x"', b'"\xff"')
    rejected = dlq_rows(validate(message_rows(spark, broken)))
    assert [r.error for r in dlq_rows(replay_dlq(rejected)).collect()] == ["INVALID_UTF8"]


def test_reason_code(spark):
    errors = spark.createDataFrame([("Faltan campos obligatorios: ['a']",), ("BAD_TYPE",)], "error string")
    assert [r[0] for r in errors.select(reason_code(F.col("error"))).collect()] == ["MISSING_FIELDS", "BAD_TYPE"]


def test_each_message_is_parsed_once_for_both_branches(spark):
    validated = validate(message_rows(spark, GOOD))
    for branch in (valid_rows(validated), dlq_rows(validated)):
        plan = branch._jdf.queryExecution().optimizedPlan().toString()
        filters = [line for line in plan.splitlines() if "Filter " in line]
        assert filters and not any("from_json" in line for line in filters)
