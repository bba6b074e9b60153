"""Ingestion without repeated messages: one parse of equal messages, state on disk, few files."""

import json

import pytest
from pyspark.sql import functions as F

from tests.samples import event, message, message_rows
from tidedesk.schema import MESSAGE_SCHEMA
from tidedesk.sources.messages import read_message_files
from tidedesk.sources.tables import ContactStore, read_contacts, read_dlq
from tidedesk.streaming.ingest import COPIES, STATE_CONF, counted, start_ingest

GOOD = [json.dumps(event(contact_id=f"c{i}", timestamp_evento=f"2026-01-0{1 + i % 3}T10:00:00+00:00")) for i in range(200)]
BAD = ["not json", json.dumps(event(region=None)), GOOD[0].encode() + b"\xff"]
PROVIDER = next(iter(STATE_CONF))


def thrice(spark):
    nothing = spark.createDataFrame([(None, [])], MESSAGE_SCHEMA)
    return message_rows(spark, *GOOD, *BAD).union(nothing).crossJoin(spark.range(3)).drop("id")


@pytest.fixture
def run(spark, tmp_path):
    def ingest(rows, checkpoint="cp"):
        folder = str(tmp_path / "in")
        rows.repartition(3).write.mode("append").parquet(folder)
        messages = read_message_files(spark, folder)
        query = start_ingest(messages, ContactStore(str(tmp_path / "store")), str(tmp_path / checkpoint), drain=True, unique_within="1 hour")
        query.awaitTermination()
        return query.recentProgress

    return ingest


def test_equal_messages_of_a_task_are_one_row_to_parse(spark):
    rows = spark.createDataFrame([*[message(b) for b in BAD] * 4, *[(None, [])] * 2], MESSAGE_SCHEMA).coalesce(1)
    found = {bytes(r.value) if r.value is not None else None: r[COPIES] for r in counted(rows).collect()}
    assert found == {**{bytes(message(b)[0]): 4 for b in BAD}, None: 2}


def test_rejects_stay_as_often_as_they_came(spark, tmp_path, run):
    run(thrice(spark))
    store = ContactStore(str(tmp_path / "store"))
    assert read_contacts(spark, store.contacts).count() == len(GOOD)
    rejected = read_dlq(spark, store.dlq).groupBy("raw_payload").count().collect()
    assert {r["raw_payload"] for r in rejected} >= {None, BAD[0], BAD[1]}
    assert [r["count"] for r in rejected] == [3] * 4


def test_ids_are_kept_on_disk_and_the_session_stays_as_it_was(spark, run):
    progress = run(thrice(spark))
    assert any(name.startswith("rocksdb") for p in progress for s in p["stateOperators"] for name in s["customMetrics"])
    assert all(spark.conf.get(key, None) is None for key in STATE_CONF)


def test_a_checkpoint_goes_on_with_the_store_that_it_began_with(spark, tmp_path, run):
    on_heap = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    spark.conf.set(PROVIDER, on_heap)
    try:
        run(thrice(spark))
        assert spark.conf.get(PROVIDER) == on_heap
    finally:
        spark.conf.unset(PROVIDER)
    progress = run(message_rows(spark, *GOOD[:5], json.dumps(event(contact_id="new"))))
    assert not any(name.startswith("rocksdb") for p in progress for s in p["stateOperators"] for name in s["customMetrics"])
    assert read_contacts(spark, ContactStore(str(tmp_path / "store")).contacts).count() == len(GOOD) + 1


def test_a_day_is_one_file_and_not_one_for_each_task_of_the_state(spark, tmp_path, run):
    run(thrice(spark))
    files = list((tmp_path / "store" / "contactos").rglob("part-*.parquet"))
    assert len(files) == 3
    assert read_contacts(spark, ContactStore(str(tmp_path / "store")).contacts).groupBy("fecha").agg(F.count("*")).count() == 3
