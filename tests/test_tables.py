import json
from datetime import date

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.samples import SERVED, event, message_rows
from tidedesk.operators.filters import DashboardFilter, apply_filters, last_n_days
from tidedesk.plans.dashboard import dashboard_rows
from tidedesk.schema import CONTACT_COLUMNS
from tidedesk.session import work_dir
from tidedesk.sources.tables import (
    ContactStore,
    consolidate_days,
    create_tables,
    read_contact_json,
    read_contacts,
    register_load,
    write_contacts,
)
from tidedesk.streaming.ingest import ingest_rows, write_batch
from tidedesk_checks.projection import contacts, payloads

SF_DIR = "/root/testdata/sf0.001"
HOT_DAY = "timestamp_ntz'2024-01-05 10:00:00' + make_dt_interval(0, 0, 0, contact_id % 60)"


@pytest.fixture(scope="module")
def rows(spark):
    return contacts(spark, SF_DIR)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_overwrite_refreshes_and_append_adds(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write_contacts(rows, path, mode="append")
    write_contacts(rows, path, mode="append")
    assert read_contacts(spark, path).count() == 2000
    write_contacts(rows, path, mode="overwrite")
    assert read_contacts(spark, path).count() == 1000
    with pytest.raises(ValueError):
        write_contacts(rows, path, mode="ignore")


def test_failed_refresh_leaves_the_old_rows(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write_contacts(rows, path)
    broken = rows.withColumn("canal", F.when(F.col("contact_id") == "7", F.raise_error(F.lit("lost"))).otherwise(F.col("canal")))
    with pytest.raises(Exception, match="lost"):
        write_contacts(broken, path, mode="overwrite")
    assert read_contacts(spark, path).count() == 1000


def test_a_dated_read_lists_its_days_only(spark, rows, tmp_path):
    path, few = str(tmp_path / "t"), rows.limit(40).coalesce(1)
    for _ in range(3):
        write_contacts(few, path)
    for n in range(300):  # as many further loads of other days
        folder = tmp_path / "t" / f"fecha=2023-01-{1 + n % 28:02d}" / f"lote=carga-{n}"
        folder.mkdir(parents=True)
    day = rows.limit(40).select(F.to_date("timestamp_evento")).first()[0]
    read = read_contacts(spark, path, day, day)
    files = read.inputFiles()
    assert len(files) == 3 and all(f"fecha={day}" in f for f in files)
    assert "InMemoryFileIndex(3 paths)" in plan(read)  # the day's live loads
    assert read.count() == read_contacts(spark, path).where(F.col("fecha") == F.lit(day)).count() > 0
    assert read_contacts(spark, path, date(1999, 1, 1), date(1999, 1, 2)).count() == 0


def test_refresh_also_replaces_streamed_loads(spark, rows, tmp_path):
    store = ContactStore(str(tmp_path))
    write_batch(ingest_rows(message_rows(spark, json.dumps(SERVED))), store, "b-0")
    write_contacts(rows, store.contacts, mode="overwrite")
    assert read_contacts(spark, store.contacts).count() == 1000


def test_stored_rows_equal_the_source(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write_contacts(rows, path)
    source = rows.withColumn("timestamp_evento", F.col("timestamp_evento").cast("timestamp"))
    assert read_contacts(spark, path).select(*CONTACT_COLUMNS).exceptAll(source).isEmpty()


def test_only_a_date_bound_prunes_partitions(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write_contacts(rows, path)
    stored = read_contacts(spark, path)
    picked = apply_filters(dashboard_rows(stored), last_n_days(date(2024, 1, 24), 7))
    assert "PartitionFilters: [isnotnull(fecha" in plan(picked)
    assert "PushedFilters: [IsNotNull(timestamp_evento), GreaterThanOrEqual(timestamp_evento" in plan(picked)
    week = rows.where(F.to_date("timestamp_evento").between("2024-01-17", "2024-01-23"))
    assert picked.count() == week.count() > 0
    by_channel = apply_filters(stored, DashboardFilter(channels=("view",)))
    assert "PushedFilters: [IsNotNull(canal), EqualTo(canal,view)]" in plan(by_channel)


def test_a_kpi_reads_only_its_columns(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    write_contacts(rows, path)
    text = plan(read_contacts(spark, path).groupBy("canal").agg(F.avg("csat")))
    assert "ReadSchema: struct<canal:string,csat:bigint>" in text


def test_files_are_clustered_and_bounded(spark, rows, tmp_path):
    path = tmp_path / "t"
    write_contacts(rows, str(path), max_records_per_file=20)
    files = list(path.glob("fecha=*/lote=*/*.parquet"))
    assert len({f.parent.parent.name for f in files}) == 30
    for file in files:
        table = pq.read_table(file, columns=["canal", "cola"], partitioning=None)
        keys = list(zip(*[table[c].to_pylist() for c in ("canal", "cola")]))
        assert len(keys) <= 20 and keys == sorted(keys)


def test_a_hot_day_is_split_over_several_tasks(spark, rows, tmp_path):
    path = tmp_path / "t"
    hot = rows.withColumn("timestamp_evento", F.expr(HOT_DAY)).repartition(16)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8k")
    try:
        write_contacts(hot, str(path))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list(path.glob("fecha=2024-01-05/lote=*/*.parquet"))) > 1
    assert read_contacts(spark, str(path)).count() == 1000


def test_without_adaptive_execution_no_day_is_gathered(spark, rows, tmp_path):
    path = tmp_path / "t"
    hot = rows.withColumn("timestamp_evento", F.lit("2024-01-05 10:00:00").cast("timestamp")).repartition(6)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        write_contacts(hot, str(path))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(list(path.glob("fecha=2024-01-05/lote=*/*.parquet"))) == 6
    assert read_contacts(spark, str(path)).count() == 1000


def test_days_are_consolidated_and_replaced(spark, rows, tmp_path):
    store = ContactStore(str(tmp_path))
    write_contacts(rows, store.contacts)
    consolidate_days(spark, store, date(2024, 1, 3), date(2024, 1, 5))
    write_contacts(rows.where(F.to_date("timestamp_evento") == "2024-01-05"), store.contacts)
    consolidate_days(spark, store, date(2024, 1, 5), date(2024, 1, 6))
    per_day = dict(rows.groupBy(F.to_date("timestamp_evento")).count().collect())
    expected = {date(2024, 1, d): per_day[date(2024, 1, d)] for d in (3, 4, 5, 6)}
    expected[date(2024, 1, 5)] *= 2
    stored = read_contacts(spark, store.contacts)
    got = dict(stored.groupBy("fecha").count().collect())
    assert got == {**per_day, **expected}
    for d in (3, 4, 5, 6):
        assert len(list(tmp_path.glob(f"contactos/fecha=2024-01-0{d}/lote=*"))) == 1
    assert not list(tmp_path.glob("contactos/_dia*"))


def test_json_lines_load(spark, tmp_path):
    good, bad = tmp_path / "good", tmp_path / "bad"
    spark.createDataFrame([(json.dumps(SERVED),), (json.dumps(event(csat=None)),)], "v string").write.text(str(good))
    assert {r.csat for r in read_contact_json(spark, str(good)).collect()} == {5, None}
    for i, line in enumerate([json.dumps(event(cola=None)), json.dumps(event(csat="x")), "{"]):
        spark.createDataFrame([(line,)], "v string").write.text(f"{bad}{i}")
        with pytest.raises(Exception):
            read_contact_json(spark, f"{bad}{i}").collect()


def test_create_tables_twice(spark, tmp_path):
    store = ContactStore(str(tmp_path / "s"))
    names = create_tables(spark, store, "twice")
    write_batch(ingest_rows(payloads(contacts(spark, SF_DIR))), store, "b-0")
    assert create_tables(spark, store, "twice") == names
    assert [spark.table(n).count() for n in names] == [0, 0]
    register_load(spark, store, "b-0", "twice")
    assert [spark.table(n).count() for n in names] == [800, 200]
    fields = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE {names[0]}").collect()}
    assert fields["csat"] == "Survey mark, 1 to 5; unset without an answer"


def test_work_dir_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first.startswith(shared) and first != second
