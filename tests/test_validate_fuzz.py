"""Randomly damaged payloads: the outcome must be the one Python's json module leads to."""

import json
import random

from tests.samples import SERVED, event, message_rows
from tidedesk.operators.validate import MISSING_PREFIX, validate
from tidedesk.schema import REQUIRED_FIELDS

PIECES = list('{}[]",:\\ \n\t')
PIECES += ["null", "true", "NaN", "0", "1.5", "-", "e", '"x":1', ', "p":{}', "}, {", "], [", "é", "\x00"]
SEEDS = [
    json.dumps(SERVED),
    json.dumps(event(extra={"a": [1, {"b": "}"}]}, cola=None)),
    json.dumps({"contact_id": "x", "canal": None}),
    "{}",
    json.dumps([SERVED]),
    '{"a": {"b": [1, 2, {"c": null}]}}',
    '{"canal":1}',
]


def damaged(rng):
    text = rng.choice(SEEDS)
    for _ in range(rng.randint(0, 3)):
        i, j = sorted(rng.randint(0, len(text)) for _ in range(2))
        how = rng.random()
        if how < 0.4:
            text = text[:i] + rng.choice(PIECES) + text[i:]
        elif how < 0.6:
            text = text[:i] + text[min(len(text), i + rng.randint(1, 3)) :]
        elif how < 0.75:
            text = text + rng.choice(PIECES)
        elif how < 0.85:
            text = rng.choice(PIECES) + text
        else:
            text = text[:i] + text[j:]
    return text


def expected(text):
    """The reason, or None where only the declared types are left to decide."""
    try:
        value = json.loads(text)
    except json.JSONDecodeError:
        return "INVALID_JSON"
    if not isinstance(value, dict):
        return "NOT_OBJECT"
    missing = [name for name in REQUIRED_FIELDS if value.get(name) is None]
    return MISSING_PREFIX + str(missing) if missing else None


def test_outcomes_follow_the_json_module(spark):
    rng = random.Random(7)
    texts = sorted({damaged(rng) for _ in range(12000)})
    rows = validate(message_rows(spark, *texts)).select("raw_payload", "error").collect()
    assert len(rows) == len(texts)
    wrong = [
        (row.raw_payload, row.error, expected(row.raw_payload))
        for row in rows
        if row.error != expected(row.raw_payload)
        and not (row.error == "BAD_TYPE" and expected(row.raw_payload) is None)
    ]
    assert not wrong, wrong[:5]
