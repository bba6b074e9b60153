"""The contacts table and its dead-letter table as partitioned Parquet.

Layout: ``<table>/<day>/lote=<load>/part-*``, one ``lote`` per load job or micro-batch. The store's commit log says
which of these folders are live, so what a job writes is seen whole once it is committed, and a read of some days
looks into their live folders only. Rows are clustered by channel and queue inside a load, for row-group skipping.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidedesk.functions.contact import event_date
from tidedesk.schema import CONTACT_SCHEMA, DLQ_SCHEMA, REQUIRED_FIELDS, conform
from tidedesk.session import require_utc
from tidedesk.sources.commits import Change, CommitLog, Folder, Part, State

LOAD, DAY, DLQ_DAY = "lote", "fecha", "ingested_date"
CLUSTER_BY = ("canal", "cola")
MAX_RECORDS_PER_FILE = 5_000_000

_PARTS = {
    DAY: T.StructField(DAY, T.DateType(), True, {"comment": "UTC day of the event"}),
    DLQ_DAY: T.StructField(DLQ_DAY, T.DateType(), True, {"comment": "UTC day of capture"}),
    LOAD: T.StructField(LOAD, T.StringType(), True, {"comment": "Load job or micro-batch"}),
}


CONTACTS, DLQ, REPAIRED, LIVE, LOADS = "contactos", "contactos_dlq", "reprocesados", "kpis_en_vivo", "cargas"
ROLLUP, INDEX = "resumen", "indice"
STORE_TABLES = (CONTACTS, DLQ, REPAIRED, LIVE, LOADS, ROLLUP, INDEX)


@dataclass(frozen=True)
class ContactStore:
    """Paths of the tables under one root folder."""

    root: str

    @property
    def contacts(self) -> str:
        return f"{self.root}/{CONTACTS}"

    @property
    def dlq(self) -> str:
        return f"{self.root}/{DLQ}"

    @property
    def repaired(self) -> str:
        return f"{self.root}/{REPAIRED}"

    @property
    def live(self) -> str:
        return f"{self.root}/{LIVE}"

    @property
    def load_log(self) -> str:
        return f"{self.root}/{LOADS}"

    @property
    def rollup(self) -> str:
        return f"{self.root}/{ROLLUP}"

    @property
    def index(self) -> str:
        return f"{self.root}/{INDEX}"

    def log(self, spark: SparkSession) -> CommitLog:
        return CommitLog(spark, self.root, STORE_TABLES)


def log_of(spark: SparkSession, path: str) -> tuple[CommitLog, str]:
    """The commit log of the store that the table in ``path`` belongs to, and the table's name."""
    root, _, table = path.rstrip("/").rpartition("/")
    return CommitLog(spark, root, dict.fromkeys((*STORE_TABLES, table))), table


def new_load_id() -> str:
    return f"carga-{uuid.uuid4().hex}"


def _arranged(rows: DataFrame, day: str, load: str, *within: str, count: Observation | None = None) -> DataFrame:
    """Rows of a day together, in tasks of the advisory size: AQE splits a day that is too big for one.

    Without AQE a hash shuffle by day would leave a hot day to one task, so rows stay where they are.
    Rows and their days are told by the writing stage, whose finished tasks count once even if executors are lost.
    """
    adaptive = rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true"
    arranged = rows.hint("rebalance", day) if adaptive else rows
    if count is not None:
        days = F.collect_set(F.coalesce(F.col(day).cast("string"), F.lit(NO_DAY))).alias("dias")
        arranged = arranged.observe(count, F.count("*").alias("filas"), days)
    # The writer asks for its partition columns first; named here, it sorts no second time.
    return arranged.withColumn(LOAD, F.lit(load)).sortWithinPartitions(day, LOAD, *within)


#: The folder name of rows without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _write(rows: DataFrame, path: str, day: str, max_records_per_file: int = MAX_RECORDS_PER_FILE) -> None:
    rows.write.mode("append").option("maxRecordsPerFile", max_records_per_file).partitionBy(day, LOAD).parquet(path)


def stage_load(
    rows: DataFrame,
    path: str,
    load: str,
    day: str,
    *within: str,
    folders: str | None = None,
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
) -> list[Part]:
    """Writes ``rows`` as a load that nobody sees yet; returns its parts, for a commit to add.

    They are written aside and moved, folder by folder, so that jobs that write to the same table at the same time do
    not meet. ``folders`` names them if not the load itself does.
    """
    folders, table = folders or load, path.rstrip("/").rpartition("/")[2]
    aside, target = f"{path}/_etapa-{folders}", f"{LOAD}={folders}"
    _write(_arranged(rows, day, folders, *within), aside, day, max_records_per_file)
    folder, parts = Folder(rows.sparkSession, aside), []
    for written in folder.matching(f"{day}=*/{LOAD}=*"):
        part = Part(table, written.split("/")[-2], target, load)
        folder.move(written, f"{path}/{part.day}/{part.name}")
        parts.append(part)
    folder.delete([aside])
    return parts


def follow_loads(
    spark: SparkSession, store: ContactStore, table: str, tag: str, derive: Callable[[DataFrame], DataFrame]
) -> int:
    """Brings a ``table`` that is derived from each load of the contacts up to date; returns the parts it derived.

    ``derive`` makes, from contacts with their day and ``lote``, the rows to keep for them, with both columns. A part of
    the derived table follows one part of the contacts: only those that came since the last call are read, and what
    follows one that is gone is taken out, in one commit. ``tag`` names what was derived; with another one all
    is derived again.
    """
    log, path, job = store.log(spark), f"{store.root}/{table}", uuid.uuid4().hex[:12]
    state = log.open()
    source = {(p.day, p.name): p for p in state.parts(CONTACTS)}
    follows = {(p.day, p.load.partition(":")[2]): p for p in state.parts(table) if p.load.startswith(f"{tag}:")}
    new = [p for key, p in source.items() if key not in follows]
    kept = {p for key, p in follows.items() if key in source}
    gone = [p for p in state.parts(table) if p not in kept]
    parts: list[Part] = []
    if new:
        rows = derive(read_parts(spark, store.contacts, CONTACT_SCHEMA, DAY, new))
        aside = f"{path}/_etapa-{job}"
        named = rows.withColumn(LOAD, F.concat(LOAD, F.lit(f"+{job}")))
        # As with the contacts, a large part is left to several tasks.
        adaptive = spark.conf.get("spark.sql.adaptive.enabled") == "true"
        named = named.hint("rebalance", DAY, LOAD) if adaptive else named
        named.sortWithinPartitions(DAY, LOAD).write.partitionBy(DAY, LOAD).parquet(aside)
        folder = Folder(spark, aside)
        for written in folder.matching(f"{DAY}=*/{LOAD}=*"):
            day, name = written.split("/")[-2:]
            folder.move(written, f"{path}/{day}/{name}")
            parts.append(Part(table, day, name, f"{tag}:{name.rpartition('+')[0]}"))
        folder.delete([aside])
    before = state.parts(table)

    def change(now: State) -> Change:
        if now.parts(table) != before:
            return Change()  # another call came first
        there = {(p.day, p.name) for p in now.parts(CONTACTS)}
        lost = [p for p in kept if (p.day, p.load.partition(":")[2]) not in there]
        return Change([p for p in parts if (p.day, p.load.partition(":")[2]) in there], [*gone, *lost])

    after = log.commit(change, state)
    drop_parts(spark, store.root, [p for p in (*before, *parts) if p not in after])
    return sum(p in after for p in parts)


def drop_parts(spark: SparkSession, root: str, parts: Sequence[Part]) -> None:
    """Removes folders that a commit has taken out."""
    Folder(spark, root).delete([f"{root}/{p.table}/{p.day}/{p.name}" for p in parts])


def write_contacts(
    contacts: DataFrame,
    path: str,
    mode: str = "append",
    max_records_per_file: int = MAX_RECORDS_PER_FILE,
    keep_replaced: bool = False,
) -> str:
    """A load job: ``append`` adds a load, ``overwrite`` is a full refresh of the table. Returns the load's id.

    One commit brings the new load and, in a refresh, takes out all others: readers see the old rows or the new
    ones. Folders taken out are removed at once; with ``keep_replaced`` they stay for reads that began before,
    until ``vacuum``.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode must be append or overwrite, not {mode!r}")
    spark, load = contacts.sparkSession, new_load_id()
    require_utc(spark)
    log, table = log_of(spark, path)
    rows = conform(contacts, event_date().alias(DAY))
    opened = log.open()
    parts = stage_load(rows, path, load, DAY, *CLUSTER_BY, max_records_per_file=max_records_per_file)
    old: list[Part] = []

    def change(state: State) -> Change:
        old[:] = state.parts(table) if mode == "overwrite" else []
        return Change(parts, old)

    log.commit(change, opened)
    if not keep_replaced:
        drop_parts(spark, path.rstrip("/").rpartition("/")[0], old)
    return load


@dataclass(frozen=True)
class Sink:
    """Rows of one load for one table: its path, its day column and the order within a file."""

    rows: DataFrame
    path: str
    day: str
    within: tuple[str, ...] = ()


def commit_load(
    spark: SparkSession, log: CommitLog, load: str, sinks: Sequence[Sink], prefix: str = "", logged: str | None = None
) -> dict[str, int]:
    """Writes all ``sinks`` of a load and makes them live in one commit; returns the rows per table.

    A repeated load takes the place of what it has live on any day, and no folder of another load is looked at.
    ``logged`` is the load log's path, which then gets a line per table. A load without rows leaves nothing.
    """
    state = log.open()
    name = log.begin(load, state, prefix)
    told = [Observation() for _ in sinks]
    for sink, count in zip(sinks, told):
        _write(_arranged(sink.rows, sink.day, name, *sink.within, count=count), sink.path, sink.day)
    written, parts = {}, []
    for sink, count in zip(sinks, told):
        table, got = sink.path.rpartition("/")[2], count.get
        written[table] = got["filas"]
        parts += [Part(table, f"{sink.day}={value}", f"{LOAD}={name}", load) for value in got["dias"]]
    if logged and any(written.values()):
        day = f"{DAY}={datetime.now(timezone.utc).date()}"
        lines = [json.dumps({"tabla": t, "filas": n, LOAD: load}) for t, n in written.items()]
        Folder(spark, logged).put(f"{day}/{name}.json", "\n".join(lines) + "\n")
        parts.append(Part(logged.rpartition("/")[2], day, f"{name}.json", load))
    replaced: list[Part] = []

    def change(now: State) -> Change:
        replaced[:] = now.of_load(load)
        return Change(parts, replaced)

    log.commit(change, state)
    drop_parts(spark, sinks[0].path.rpartition("/")[0], replaced)
    log.end(name)
    return written


def consolidate_days(
    spark: SparkSession, store: ContactStore, start: date, end: date, keep_replaced: bool = False
) -> None:
    """Rewrites each day from ``start`` to ``end`` as one clustered load in place of its loads.

    The new load is written aside, and one commit swaps it for the loads it was made from; a load that came meanwhile
    stays. A run that dies changes nothing, and repeating it does the whole. If another job has taken one
    of these loads out meanwhile, nothing is swapped. Replaced folders are removed as in ``write_contacts``.
    """
    log, load = store.log(spark), f"dia-{uuid.uuid4().hex}"
    state = log.open()
    merged = state.parts(CONTACTS, start, end)
    if not merged:
        return
    rows = read_parts(spark, store.contacts, CONTACT_SCHEMA, DAY, merged).drop(LOAD)
    parts = stage_load(rows, store.contacts, load, DAY, *CLUSTER_BY)

    swapped = log.commit(lambda now: Change(parts, merged) if all(p in now for p in merged) else Change(), state)
    done = all(p in swapped for p in parts)
    if not done or not keep_replaced:
        drop_parts(spark, store.root, merged if done else parts)


def vacuum(spark: SparkSession, store: ContactStore, older_than: timedelta = timedelta(days=1)) -> list[str]:
    """Removes what no commit has live and nothing has changed for ``older_than``; returns these paths.

    That is what jobs have left that died, and folders taken out of a table that were kept for its readers. It lists
    all folders of the store's tables.
    """
    log, folder = store.log(spark), Folder(spark, store.root)
    now, limit = int(time.time() * 1000), older_than.total_seconds() * 1000
    live = {(p.table, p.day, p.name) for p in log.open()}
    old = []
    for table in STORE_TABLES:
        old += folder.matching(f"{table}/_etapa-*")
        old += [path for path in folder.matching(f"{table}/*=*/*") if tuple(path.split("/")[-3:]) not in live]
    old = [path for path in old if folder.age_ms(path, now) > limit]
    folder.delete(old)
    # A mark keeps a name from being used again, as long as something bears it.
    marks = {name: mark for name, mark in log.begun().items() if folder.age_ms(mark, now) > limit}
    free = [mark for name, mark in marks.items() if not folder.matching(f"*/*=*/{LOAD}={name}")]
    folder.delete(free)
    return [*old, *free]


def read_parts(spark: SparkSession, path: str, schema: T.StructType, day: str, parts: Sequence[Part]) -> DataFrame:
    declared = T.StructType([*schema, _PARTS[day], _PARTS[LOAD]])
    if not parts:
        return spark.createDataFrame([], declared)
    return spark.read.schema(declared).option("basePath", path).parquet(*[f"{path}/{p.day}/{p.name}" for p in parts])


def _read(
    spark: SparkSession, path: str, schema: T.StructType, day: str, start: date | None, end: date | None
) -> DataFrame:
    log, table = log_of(spark, path)
    state = log.state()
    if state.number:
        return read_parts(spark, path, schema, day, state.parts(table, start, end))
    declared = T.StructType([*schema, _PARTS[day], _PARTS[LOAD]])
    reader = spark.read.schema(declared)
    if start is None or end is None:
        return reader.parquet(path)
    days = [start + timedelta(days=n) for n in range((end - start).days + 1)]
    folder = Folder(spark, path)
    there = [found for d in days for found in folder.matching(f"{day}={d}")]
    if not there:
        return spark.createDataFrame([], declared)
    return reader.option("basePath", path).parquet(*there)


def read_contacts(spark: SparkSession, path: str, start: date | None = None, end: date | None = None) -> DataFrame:
    """The 13 contact columns and ``fecha`` of the live loads.

    With ``start`` and ``end`` only the live folders of these days are looked into. Without them those of all days are
    listed, and a filter on ``fecha`` still prunes what is read.
    """
    return _read(spark, path, CONTACT_SCHEMA, DAY, start, end).drop(LOAD)


def read_dlq(spark: SparkSession, path: str, start: date | None = None, end: date | None = None) -> DataFrame:
    """Dead letters with their day of capture; the dates are such days."""
    return _read(spark, path, DLQ_SCHEMA, DLQ_DAY, start, end).drop(LOAD)


_LOAD_LINE = f"tabla string, filas bigint, {LOAD} string, {DAY} date"


def read_load_log(spark: SparkSession, path: str) -> DataFrame:
    """Rows per table and load, with the day of the load."""
    log, table = log_of(spark, path)
    state = log.state()
    if not state.number:
        return spark.read.schema(_LOAD_LINE).json(path)
    return _read_lines(spark, path, state.parts(table))


def _read_lines(spark: SparkSession, path: str, parts: Sequence[Part]) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], _LOAD_LINE)
    return spark.read.schema(_LOAD_LINE).option("basePath", path).json([f"{path}/{p.day}/{p.name}" for p in parts])


def merge_load_log(spark: SparkSession, store: ContactStore, before: date) -> None:
    """Puts one file in place of the load log's files of each day before ``before``, in one commit."""
    log, load = store.log(spark), f"dia-{uuid.uuid4().hex}"
    state = log.open()
    days: dict[str, list[Part]] = {}
    for part in state.parts(LOADS):
        if part.value < str(before):
            days.setdefault(part.day, []).append(part)
    merged = [p for parts in days.values() if len(parts) > 1 for p in parts]
    if not merged:
        return
    aside = f"{store.load_log}/_etapa-{load}"
    _read_lines(spark, store.load_log, merged).repartition(DAY).sortWithinPartitions(DAY, LOAD, "tabla").write.partitionBy(DAY).json(aside)
    folder, parts = Folder(spark, aside), []
    for written in folder.matching(f"{DAY}=*"):
        part = Part(LOADS, written.rpartition("/")[2], load, load)
        folder.move(written, f"{store.load_log}/{part.day}/{part.name}")
        parts.append(part)
    swapped = log.commit(lambda now: Change(parts, merged) if all(p in now for p in merged) else Change(), state)
    drop_parts(spark, store.root, merged if all(p in swapped for p in parts) else parts)
    folder.delete([aside])


def _required(field: T.StructField) -> Column:
    column = F.col(field.name)
    if field.name in REQUIRED_FIELDS:
        column = F.coalesce(column, F.raise_error(F.lit(f"{field.name} is NULL but required")).cast(field.dataType))
    return column.alias(field.name)


def read_contact_json(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines with the declared schema. As in any load job, one bad row fails the load."""
    options = {"mode": "FAILFAST", "allowSingleQuotes": "false", "timeZone": "UTC"}
    rows = spark.read.schema(CONTACT_SCHEMA).options(**options).json(path)
    return rows.select(*[_required(field) for field in CONTACT_SCHEMA])


def _create(spark: SparkSession, name: str, schema: T.StructType, day: str, path: str, comment: str) -> None:
    def column(field: T.StructField) -> str:
        null = "" if field.nullable else " NOT NULL"
        return f"{field.name} {field.dataType.simpleString()}{null} COMMENT '{field.metadata['comment']}'"

    columns = ", ".join(column(f) for f in [*schema, _PARTS[day], _PARTS[LOAD]])
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"PARTITIONED BY ({day}, {LOAD}) LOCATION '{path}' COMMENT '{comment}'"
    )


def create_tables(spark: SparkSession, store: ContactStore, database: str = "default") -> tuple[str, str]:
    """Declares both tables over the store unless they exist, and opens its log. Returns their names."""
    store.log(spark).open()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{store.root}/catalogo'")
    contacts, dlq = f"{database}.contactos", f"{database}.contactos_dlq"
    _create(spark, contacts, CONTACT_SCHEMA, DAY, store.contacts, "Ingested customer contacts")
    _create(spark, dlq, DLQ_SCHEMA, DLQ_DAY, store.dlq, "Rejected messages and the reason")
    return contacts, dlq


def _partition(day: str, part: Part) -> str:
    value = "NULL" if part.value == NO_DAY else f"DATE '{part.value}'"
    return f"PARTITION ({day} = {value}, {LOAD} = '{part.name.partition('=')[2]}')"


CATALOGUED = ((CONTACTS, DAY), (DLQ, DLQ_DAY))


def register_load(spark: SparkSession, store: ContactStore, load: str, database: str = "default") -> None:
    """Makes one load visible in the catalog: its own partitions are added, no other is looked at."""
    state = store.log(spark).state()
    for table, day in CATALOGUED:
        parts = " ".join(_partition(day, p) for p in state.of_load(load) if p.table == table)
        if parts:
            spark.sql(f"ALTER TABLE {database}.{table} ADD IF NOT EXISTS {parts}")


#: The commit that a catalogued table shows.
SHOWN = "tidedesk.commit"


def sync_catalog(spark: SparkSession, store: ContactStore, database: str = "default") -> None:
    """Makes the catalogued tables show what is live: loads that came are added, loads that went are dropped.

    Only the commits since the last call are gone through; where these are tidied up, or at the first call, all
    partitions are compared. The catalog has no transaction over partitions, so a query between the two statements
    misses loads that are being replaced; it sees none twice.
    """
    log = store.log(spark)
    state = log.state()
    for table, day in CATALOGUED:
        name = f"{database}.{table}"
        told = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        changes = log.changes_since(int(told.get(SHOWN, 0)), state)
        live = {(p.value, p.name.partition("=")[2]): p for p in state.parts(table)}
        if changes is None:
            shown = [dict(x.split("=", 1) for x in r.partition.split("/")) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
            there = {(s[day], s[LOAD]): Part(table, f"{day}={s[day]}", f"{LOAD}={s[LOAD]}") for s in shown}
        else:
            touched = [p for c in changes for p in [*c.add, *c.remove] if p.table == table]
            there = {(p.value, p.name.partition("=")[2]): p for p in touched}
            live = {k: p for k, p in live.items() if k in there}
        drop = [_partition(day, p) for k, p in there.items() if k not in live]
        if drop:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(drop)}")
        if live:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(_partition(day, p) for p in live.values())}")
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{SHOWN}' = '{state.number}')")


def logged_loads(spark: SparkSession, store: ContactStore, day: date | None = None) -> list[str]:
    """Loads in the log, of one day or of all."""
    entries = read_load_log(spark, store.load_log)
    entries = entries.where(F.col(DAY) == F.lit(day)) if day else entries
    return [row[0] for row in entries.select(LOAD).distinct().orderBy(LOAD).collect()]
