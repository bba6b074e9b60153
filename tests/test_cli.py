import json

import pytest

from tests.samples import event, message_rows
from tidedesk.__main__ import main
from tidedesk.plans.rollup import read_rollup
from tidedesk.sources.skipping import find_contacts
from tidedesk.sources.tables import ContactStore, read_contacts, read_dlq


@pytest.fixture
def run(spark):
    return lambda *argv: main(argv, spark)


def test_load_and_view(spark, run, tmp_path, capfd):
    lines = [(json.dumps(event(contact_id=str(i))),) for i in range(3)]
    spark.createDataFrame(lines, "v string").write.text(str(tmp_path / "json"))
    root = str(tmp_path / "root")
    run("load", "--json", str(tmp_path / "json"), "--root", root)
    run("load", "--json", str(tmp_path / "json"), "--root", root, "--append")
    assert read_contacts(spark, ContactStore(root).contacts).count() == 6
    run("load", "--json", str(tmp_path / "json"), "--root", root)
    assert read_contacts(spark, ContactStore(root).contacts).count() == 3
    run("view", "--root", root, "--name", "v_cpo")
    assert "contactos_con_orden" in capfd.readouterr().out
    run("view", "--root", root, "--name", "v_contactos_dashboard")
    assert len(capfd.readouterr().out.splitlines()) == 4
    run("view", "--root", root, "--name", "v_contactos_dashboard", "--rows", "2")
    assert capfd.readouterr().out.splitlines()[-1] == "... more than 2 rows"
    run("view", "--root", root, "--name", "v_contactos_dashboard", "--out", str(tmp_path / "csv"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "csv")).count() == 3


def test_ingest_tail_and_replay(spark, run, tmp_path):
    inbox, root = str(tmp_path / "in"), str(tmp_path / "root")
    message_rows(spark, json.dumps(event()), json.dumps(event(cola=None)), "x").write.parquet(inbox)
    run("ingest", "--files", inbox, "--root", root, "--checkpoint", str(tmp_path / "cp"), "--drain", "--ventana", "30")
    run("tail", "--files", inbox, "--out", str(tmp_path / "lines"), "--checkpoint", str(tmp_path / "cp2"), "--drain")
    assert spark.read.text(str(tmp_path / "lines")).count() == 1
    run("live", "--files", inbox, "--root", root, "--checkpoint", str(tmp_path / "cp3"), "--drain")
    run("consolidate", "--root", root, "--start", "2026-01-01", "--end", "2026-01-01")
    store = ContactStore(root)
    assert (read_contacts(spark, store.contacts).count(), read_dlq(spark, store.dlq).count()) == (1, 2)
    for _ in range(2):
        run("replay", "--root", root, "--optional", "cola")
    assert read_contacts(spark, store.contacts).count() == 2
    run("follow", "--root", root, "--sketched")
    assert read_rollup(spark, store).agg({"n": "sum"}).first()[0] == 2
    assert find_contacts(spark, store, "agente_id", "AG-007").count() == 2
    run("vacuum", "--root", root, "--hours", "0")
    assert read_contacts(spark, store.contacts).count() == 2


def test_repeated_messages_are_left_out(spark, run, tmp_path):
    inbox, root = str(tmp_path / "in"), str(tmp_path / "root")
    message_rows(spark, *[json.dumps(event())] * 5, "x", "x").write.parquet(inbox)
    run("ingest", "--files", inbox, "--root", root, "--checkpoint", str(tmp_path / "cp"), "--drain", "--unique", "1 hour", "--spread", "3")
    store = ContactStore(root)
    assert (read_contacts(spark, store.contacts).count(), read_dlq(spark, store.dlq).count()) == (1, 2)
