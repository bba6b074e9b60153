import json
from datetime import date

import pytest

from tests.samples import event, message_rows
from tidedesk.plans.replay import replay_store
from tidedesk.schema import REQUIRED_FIELDS
from tidedesk.sources.tables import ContactStore, Folder, read_contacts, read_dlq
from tidedesk.streaming.ingest import ingest_rows, write_batch

NO_QUEUE = [name for name in REQUIRED_FIELDS if name != "cola"]
NO_REGION = [name for name in REQUIRED_FIELDS if name != "region"]
MESSAGES = [json.dumps(event(contact_id="a")), json.dumps(event(contact_id="b", cola=None)), json.dumps(event(contact_id="c", region=None)), "x"]


@pytest.fixture
def store(spark, tmp_path):
    store = ContactStore(str(tmp_path / "s"))
    write_batch(ingest_rows(message_rows(spark, *MESSAGES, MESSAGES[1])), store, "b-0")
    return store


def ids(spark, store):
    return sorted(r.contact_id for r in read_contacts(spark, store.contacts).collect())


def test_later_replays_only_add(spark, store):
    replay_store(spark, store, NO_QUEUE)
    assert ids(spark, store) == ["a", "b", "b"]
    replay_store(spark, store)
    assert ids(spark, store) == ["a", "b", "b"]
    replay_store(spark, store, NO_QUEUE)
    assert ids(spark, store) == ["a", "b", "b"]
    replay_store(spark, store, NO_REGION)
    assert ids(spark, store) == ["a", "b", "b", "c"]
    assert read_dlq(spark, store.dlq).count() == 4


def test_relaxed_text_is_stored_as_empty_text(spark, store):
    replay_store(spark, store, NO_QUEUE)
    assert {r.cola for r in read_contacts(spark, store.contacts).collect() if r.contact_id == "b"} == {""}


def test_replay_that_failed_before_its_marks_is_replaced(spark, store):
    replay_store(spark, store, NO_QUEUE)
    marks = Folder(spark, store.repaired)
    marks.delete(marks.matching("repaso=*/_SUCCESS"))
    replay_store(spark, store, NO_QUEUE)
    assert ids(spark, store) == ["a", "b", "b"]


def test_only_the_given_days_are_replayed(spark, store):
    replay_store(spark, store, NO_QUEUE, date(1999, 1, 1), date(1999, 1, 1))
    assert ids(spark, store) == ["a"]
