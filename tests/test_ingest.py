import json
import uuid

import pytest
from pyspark.sql import functions as F

from tests.samples import contact_rows, event, message_rows
from tidedesk.operators.validate import dlq_rows, valid_rows, validate
from tidedesk.schema import CONTACT_COLUMNS
from tidedesk.sources.messages import publish_messages, read_message_files
from tidedesk.sources.tables import LOAD, ContactStore, read_contacts, read_dlq, read_load_log
from tidedesk.streaming.ingest import batch_writer, ingest_rows, start_ingest, write_batch
from tidedesk.streaming.live import message_lines, start_tail

GOOD = [
    json.dumps(event(contact_id=f"c{i}", timestamp_evento=f"2026-01-0{1 + i % 3}T23:59:59+00:00")) for i in range(9)
]
BAD = ["not json", "[1]", json.dumps(event(region=None)), json.dumps(event(csat="x")), GOOD[0].encode() + b"\xff"]


@pytest.fixture
def store(tmp_path):
    return ContactStore(str(tmp_path / "store"))


@pytest.fixture
def inbox(spark, tmp_path):
    """A folder of message files and a function that drops one more file into it."""
    folder = str(tmp_path / "inbox")

    def drop(*payloads):
        message_rows(spark, *payloads).coalesce(1).write.mode("append").parquet(folder)

    return folder, drop


def drain(spark, folder, store, checkpoint, max_files=1000):
    query = start_ingest(read_message_files(spark, folder, max_files), store, str(checkpoint), drain=True)
    query.awaitTermination()
    return query


def ids(df):
    return sorted(r[0] for r in df.select("contact_id").collect())


def test_stream_equals_batch(spark, inbox, store, tmp_path):
    folder, drop = inbox
    drop(*GOOD[:5], *BAD[:2])
    drop(*GOOD[5:], *BAD[2:])
    drain(spark, folder, store, tmp_path / "cp", max_files=1)
    validated = validate(message_rows(spark, *GOOD, *BAD))

    stored = read_contacts(spark, store.contacts).select(*CONTACT_COLUMNS)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, valid_rows(validated).collect()))
    rejected = read_dlq(spark, store.dlq).select("raw_payload", "error")
    assert sorted(map(tuple, rejected.collect())) == sorted(
        map(tuple, dlq_rows(validated).select("raw_payload", "error").collect())
    )
    assert stored.count() + rejected.count() == len(GOOD) + len(BAD)


def test_load_log_counts_each_micro_batch(spark, inbox, store, tmp_path):
    folder, drop = inbox
    drop(*GOOD[:4], *BAD[:3])
    drop(*GOOD[4:])
    drain(spark, folder, store, tmp_path / "cp", max_files=1)
    entries = read_load_log(spark, store.load_log)
    assert entries.select(LOAD).distinct().count() == 2
    assert {(r.tabla, r.filas) for r in entries.collect()} == {
        ("contactos", 4),
        ("contactos_dlq", 3),
        ("contactos", 5),
        ("contactos_dlq", 0),
    }


def test_only_new_messages_are_taken_after_a_restart(spark, inbox, store, tmp_path):
    folder, drop = inbox
    drop(*GOOD[:4])
    drain(spark, folder, store, tmp_path / "cp")
    drop(*GOOD[4:])
    drain(spark, folder, store, tmp_path / "cp")
    assert len(ids(read_contacts(spark, store.contacts))) == len(GOOD)


def test_repeated_micro_batch_adds_nothing(spark, store):
    rows = ingest_rows(message_rows(spark, *GOOD, *BAD))
    for _ in range(2):
        assert write_batch(rows, store, "b-1") == {"contactos": len(GOOD), "contactos_dlq": len(BAD)}
    write_batch(rows, store, "b-2")
    assert read_contacts(spark, store.contacts).count() == 2 * len(GOOD)
    assert read_dlq(spark, store.dlq).count() == 2 * len(BAD)


def test_micro_batch_that_failed_after_writing_is_replaced_on_retry(spark, inbox, store, tmp_path):
    folder, drop = inbox
    drop(*GOOD, *BAD)
    write, seen = batch_writer(store), []

    def run(fail):
        def each(rows, batch_id):
            write(rows, batch_id)
            seen.append(read_dlq(spark, store.dlq).agg(F.min("ingested_at"), F.max("ingested_at")).collect()[0])
            if fail:
                raise RuntimeError("lost after the write")

        stream = ingest_rows(read_message_files(spark, folder))
        query = stream.writeStream.foreachBatch(each).option("checkpointLocation", str(tmp_path / "cp"))
        return query.trigger(availableNow=True).start()

    with pytest.raises(Exception, match="lost after the write"):
        run(fail=True).awaitTermination()
    run(fail=False).awaitTermination()
    assert read_contacts(spark, store.contacts).count() == len(GOOD)
    assert read_dlq(spark, store.dlq).count() == len(BAD)
    assert len(seen) == 2 and seen[0] == seen[1]  # the stamp of capture survives the retry


def test_new_checkpoint_does_not_replace_earlier_loads(spark, inbox, store, tmp_path):
    folder, drop = inbox
    drop(*GOOD)
    drain(spark, folder, store, tmp_path / "cp1")
    drain(spark, folder, store, tmp_path / "cp2")
    assert read_contacts(spark, store.contacts).count() == 2 * len(GOOD)


def test_hot_day_is_split_and_counted(spark, store, tmp_path):
    hot = message_rows(spark, *[json.dumps(event(contact_id=str(i))) for i in range(2000)], *BAD).repartition(16)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8k")
    try:
        assert write_batch(ingest_rows(hot), store, "b") == {"contactos": 2000, "contactos_dlq": 5}
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list(tmp_path.glob("store/contactos/fecha=2026-01-01/lote=b/*.parquet"))) > 1
    assert read_contacts(spark, store.contacts).select("contact_id").distinct().count() == 2000


def test_empty_micro_batch_writes_nothing(spark, store, tmp_path):
    assert write_batch(ingest_rows(message_rows(spark, "x").limit(0)), store, "b") == {}
    assert not list((tmp_path / "store").rglob("*.parquet")) and not (tmp_path / "store" / "cargas").exists()


def test_retry_with_other_days_leaves_none_of_the_first(spark, store):
    write_batch(ingest_rows(message_rows(spark, *GOOD)), store, "b")
    write_batch(ingest_rows(message_rows(spark, GOOD[0])), store, "b")
    assert ids(read_contacts(spark, store.contacts)) == ["c0"]


def test_a_batch_costs_two_writes(spark, store):
    rows = ingest_rows(message_rows(spark, *GOOD, *BAD))
    spark.sparkContext.setJobGroup("batch", "one micro-batch")
    write_batch(rows, store, "b")
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("batch")
    spark.sparkContext.setJobGroup(None, None)
    assert len(jobs) <= 5  # the parse, and for each write the rebalancing stage and the write itself


def test_batch_without_valid_rows(spark, store):
    assert write_batch(ingest_rows(message_rows(spark, *BAD)), store, "b") == {"contactos": 0, "contactos_dlq": 5}
    write_batch(ingest_rows(message_rows(spark, *GOOD)), store, "c")
    assert read_contacts(spark, store.contacts).count() == len(GOOD)


def test_duplicate_messages_are_kept(spark, store):
    write_batch(ingest_rows(message_rows(spark, GOOD[0], GOOD[0])), store, uuid.uuid4().hex)
    assert ids(read_contacts(spark, store.contacts)) == ["c0", "c0"]


def test_session_zone_must_be_utc(spark, inbox, store, tmp_path):
    folder, drop = inbox
    drop(*GOOD)
    spark.conf.set("spark.sql.session.timeZone", "America/Santiago")
    try:
        with pytest.raises(ValueError, match="pin_utc"):
            start_ingest(read_message_files(spark, folder), store, str(tmp_path / "cp"), drain=True)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_tail_writes_one_line_per_contact(spark, inbox, tmp_path):
    lines = message_lines(message_rows(spark, json.dumps(event()), *BAD))
    assert [r.linea for r in lines.collect()] == ["voz    | Postventa              | AHT=300s"]
    folder, drop = inbox
    drop(*GOOD)
    query = start_tail(read_message_files(spark, folder), str(tmp_path / "lines"), str(tmp_path / "cp"), drain=True)
    query.awaitTermination()
    assert spark.read.text(str(tmp_path / "lines")).count() == len(GOOD)


def test_contacts_can_be_published_and_ingested(spark, tmp_path, store):
    rows = contact_rows(spark, *[json.loads(g) for g in GOOD])
    publish_messages(rows).write.parquet(str(tmp_path / "topic"))
    drain(spark, str(tmp_path / "topic"), store, tmp_path / "cp")
    back = read_contacts(spark, store.contacts).select(*CONTACT_COLUMNS)
    assert back.exceptAll(rows).isEmpty() and back.count() == len(GOOD)


def test_a_hot_message_comes_once(spark, tmp_path, store):
    folder = str(tmp_path / "in")
    hot = message_rows(spark, GOOD[0]).crossJoin(spark.range(20_000)).drop("id")
    message_rows(spark, *GOOD, *BAD, BAD[0]).union(hot).repartition(4).write.parquet(folder)

    def run():
        messages = read_message_files(spark, folder)
        query = start_ingest(messages, store, str(tmp_path / "cp"), drain=True, unique_within="1 hour")
        query.awaitTermination()
        return query.recentProgress

    progress = run()
    assert ids(read_contacts(spark, store.contacts)) == sorted(json.loads(g)["contact_id"] for g in GOOD)
    assert read_dlq(spark, store.dlq).count() == len(BAD) + 1
    state = [s for p in progress for s in p["stateOperators"]]
    assert sum(s["customMetrics"]["numDroppedDuplicateRows"] for s in state) < 20  # the others went before they moved
    message_rows(spark, *GOOD[:3], json.dumps(event(contact_id="new"))).write.mode("append").parquet(folder)
    run()
    assert read_contacts(spark, store.contacts).count() == len(GOOD) + 1
