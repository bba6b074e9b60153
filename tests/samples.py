"""Small hand-made contacts and messages."""

import json
from datetime import datetime, timezone

from tidedesk.schema import CONTACT_COLUMNS, CONTACT_SCHEMA, MESSAGE_SCHEMA

SERVED = {
    "contact_id": "c1",
    "timestamp_evento": "2026-01-01T10:00:00.123456+00:00",
    "canal": "voz",
    "cola": "Postventa",
    "region": "Maule",
    "tiempo_espera_seg": 12.5,
    "abandonado": False,
    "dentro_sla": True,
    "agente_id": "AG-007",
    "tiempo_atencion_seg": 300,
    "resuelto_primer_contacto": True,
    "csat": 5,
    "orden_asociada": "ORD-000001",
}
NO_SERVICE = dict.fromkeys(
    ("agente_id", "tiempo_atencion_seg", "resuelto_primer_contacto", "csat", "orden_asociada")
)


def event(**changes):
    return {**SERVED, **changes}


def abandoned(**changes):
    return {**SERVED, "abandonado": True, "dentro_sla": False, **NO_SERVICE, **changes}


def contact_rows(spark, *events):
    def row(e):
        stamp = e["timestamp_evento"]
        stamp = stamp if isinstance(stamp, datetime) else datetime.fromisoformat(stamp)
        stamp = stamp if stamp.tzinfo else stamp.replace(tzinfo=timezone.utc)
        return tuple(stamp if name == "timestamp_evento" else e[name] for name in CONTACT_COLUMNS)

    return spark.createDataFrame([row(e) for e in events], CONTACT_SCHEMA)


def message(payload, canal="voz"):
    if isinstance(payload, dict):
        payload = json.dumps(payload)
    data = payload if isinstance(payload, bytes) else payload.encode("utf-8")
    return (bytearray(data), [("canal", bytearray(canal.encode("utf-8")))])


def message_rows(spark, *payloads):
    return spark.createDataFrame([message(p) for p in payloads], MESSAGE_SCHEMA)
