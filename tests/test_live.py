import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.samples import contact_rows, event, message_rows
from tidedesk.operators.validate import valid_rows, validate
from tidedesk.schema import CONTACT_SCHEMA
from tidedesk.sources.messages import read_message_files
from tidedesk.streaming.live import live_kpis, merge_live, read_live, start_live, window_batches
from tidedesk_checks.projection import contacts

START = datetime(2026, 1, 1, 10)


def at(seconds, **changes):
    stamp = START + timedelta(seconds=seconds)
    return event(contact_id=f"c{seconds}", timestamp_evento=stamp.isoformat() + "+00:00", **changes)


@pytest.fixture
def feed(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "cp"))

    def run(events, build=live_kpis, **options):
        contact_rows(spark, *events).coalesce(1).write.mode("append").parquet(folder)
        stream = build(spark.readStream.schema(CONTACT_SCHEMA).parquet(folder), **options)
        start_live(stream, out, checkpoint, drain=True).awaitTermination()
        return read_live(spark, out, stream.schema)

    return run


def starts(df):
    return sorted((r.inicio - START).seconds for r in df.collect())


def test_windows_are_half_open(spark):
    rows = contact_rows(spark, at(0), at(59), at(60), at(179))
    got = {((r.inicio - START).seconds, (r.fin - START).seconds, r.contactos) for r in window_batches(rows).collect()}
    assert got == {(0, 60, 2), (60, 120, 1), (120, 180, 1)}
    assert window_batches(rows, seconds=30).count() == 4


def test_batch_windows_add_up(spark):
    rows = window_batches(contacts(spark, "/root/testdata/sf0.001"))
    assert rows.agg(F.sum("contactos")).collect()[0][0] == 1000
    assert rows.count() == 988


def test_windows_may_follow_broker_time(spark):
    rows = spark.range(4).select(F.timestamp_seconds(F.col("id") * 40).alias("timestamp"))
    assert {r.contactos for r in window_batches(rows, instant="timestamp").collect()} == {2, 1}


def test_live_kpis_from_messages(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "cp"))
    payloads = [json.dumps(at(s)) for s in (10, 20, 400)]
    message_rows(spark, *payloads, "not json").write.parquet(folder)
    windows = live_kpis(valid_rows(validate(read_message_files(spark, folder))))
    start_live(windows, out, checkpoint, drain=True).awaitTermination()
    rows = read_live(spark, out, windows.schema).collect()
    assert sorted((r.inicio, r.canal, r.total_contactos, r.sla_pct) for r in rows) == [
        (START, "voz", 2, 100.0),
        (START + timedelta(seconds=360), "voz", 1, 100.0),
    ]


def test_bounded_run_emits_all_windows(feed, tmp_path):
    out = feed([at(10), at(70), at(130), at(300)])
    assert starts(out) == [0, 60, 120, 300]
    assert len(list(tmp_path.glob("out/fecha=2026-01-01/lote=*/*.parquet"))) == 1


def test_open_window_is_updated(feed):
    feed([at(10)])
    out = feed([at(11), at(12)])
    assert [(r.total_contactos, r.canal) for r in out.collect()] == [(3, "voz")]


def test_windows_equal_the_batch_result(spark, feed):
    events = [at(s, canal="chat" if s % 2 else "voz", csat=1 + s % 5) for s in range(0, 600, 7)]
    streamed = feed(events)
    batch = live_kpis(contact_rows(spark, *events))
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.collect()))


def test_late_row_for_a_closed_window_is_dropped(feed):
    feed([at(10), at(400)])
    out = feed([at(11), at(350), at(900)])
    first = [r for r in out.collect() if r.inicio == START]
    assert [r.total_contactos for r in first] == [1]
    assert 300 in starts(out)  # 350 s was late too, but its window was open


def test_longer_lateness_keeps_it(feed):
    feed([at(10), at(400)], lateness="10 minutes")
    out = feed([at(11), at(900)], lateness="10 minutes")
    assert [r.total_contactos for r in out.collect() if r.inicio == START] == [2]


def relive(spark, tmp_path, events, checkpoint):
    folder, out = str(tmp_path / f"in-{checkpoint}"), str(tmp_path / "out")
    for batch in events:
        contact_rows(spark, *batch).coalesce(1).write.mode("append").parquet(folder)
        stream = live_kpis(spark.readStream.schema(CONTACT_SCHEMA).parquet(folder))
        start_live(stream, out, str(tmp_path / checkpoint), drain=True).awaitTermination()
    return out, stream.schema


def test_a_new_checkpoint_writes_later_states(spark, tmp_path):
    """The older query is far ahead in batches and has counted less."""
    relive(spark, tmp_path, [[at(s)] for s in (1, 2, 3, 4)], "old")
    out, schema = relive(spark, tmp_path, [[at(s) for s in range(50)]], "new")
    assert [r.total_contactos for r in read_live(spark, out, schema).collect()] == [50]


def test_finished_days_are_merged(spark, tmp_path):
    out, schema = relive(spark, tmp_path, [[at(s)] for s in (1, 2, 90)], "cp")
    before = sorted(map(str, read_live(spark, out, schema).collect()))
    day = START.date()
    merge_live(spark, out, schema, day)
    assert len(list(tmp_path.glob("out/fecha=*/lote=*"))) == 3
    merge_live(spark, out, schema, day + timedelta(days=1))
    assert len(list(tmp_path.glob("out/fecha=*/lote=*"))) == 1
    assert sorted(map(str, read_live(spark, out, schema).collect())) == before
    contact_rows(spark, at(91)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in-cp"))
    relive(spark, tmp_path, [[at(92)]], "cp")
    counts = {(r.inicio - START).seconds: r.total_contactos for r in read_live(spark, out, schema).collect()}
    assert counts == {0: 2, 60: 3}
