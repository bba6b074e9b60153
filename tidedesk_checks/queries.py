"""Every query key, as a function of the session and the folder with the driver's tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidedesk.functions.contact import contact_line, event_date
from tidedesk.operators import filters, kpis, quality
from tidedesk.operators.validate import dlq_rows, valid_rows, validate
from tidedesk.plans import dashboard
from tidedesk.plans.refresh import refresh_dashboard
from tidedesk.plans.replay import replay_store
from tidedesk.plans.rollup import SKETCH_ERROR, dashboard_tiles, read_rollup, refresh_rollup, sketched_orders
from tidedesk.plans.views import register_views
from tidedesk.schema import CONTACT_COLUMNS, REQUIRED_FIELDS, conform, literal_rows
from tidedesk.session import pin_utc
from tidedesk.sources import messages, skipping, tables
from tidedesk.sources.tables import CLUSTER_BY, DAY, ContactStore, Sink
from tidedesk.streaming.ingest import start_ingest
from tidedesk.streaming.live import live_kpis, read_live, start_live, window_batches
from tidedesk_checks.folders import work_dir
from tidedesk_checks.projection import contact_stream, contacts, payloads

# --- Fixed values: parameters shared with the SQL in oracle.py ----------------------------------------
AS_OF = date(2024, 1, 24)
CHANNEL_PLAN = [("view", 0.45), ("click", 0.30), ("purchase", 0.15), ("correo", 0.10)]
QUEUE_PLAN = [("AUTOMOBILE", 0.35), ("BUILDING", 0.25), ("FURNITURE", 0.20), ("Pagos", 0.20)]
REPLAY_OPTIONAL = ("cola", "region")
LOOKED_UP = "AG-007"
ORDER_DIMENSIONS = ("canal", "cola", "region", "hora_del_dia", "fecha")
# --- End of fixed values ------------------------------------------------------------------------------

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: wall_clock(build(pin_utc(spark), sf_dir))
        return build

    return register


def wall_clock(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock time, so that no client zone changes them."""
    stamps = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in stamps}) if stamps else df


def over_contacts(name: str, job: Callable[[DataFrame], DataFrame]) -> None:
    query(name)(lambda spark, sf_dir: job(contacts(spark, sf_dir)))


def over_dashboard(name: str, job: Callable[[DataFrame], DataFrame]) -> None:
    over_contacts(name, lambda rows: job(dashboard.dashboard_rows(rows)))


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate(_payloads(spark, sf_dir))


def _payloads(spark: SparkSession, sf_dir: str, keep: Sequence[str] = ()) -> DataFrame:
    """Messages from one file of events, which one task reads, dealt out to all cores."""
    return payloads(messages.spread(contacts(spark, sf_dir)), keep=keep)


# KPI views
over_contacts("kpis_global", kpis.kpis_global)
over_contacts("kpis_by_channel", kpis.kpis_by_channel)
over_contacts("kpis_by_queue", kpis.kpis_by_queue)
over_contacts("kpis_by_region", kpis.kpis_by_region)
over_contacts("kpis_by_hour", kpis.kpis_by_hour)
over_contacts("kpis_by_agent", kpis.kpis_by_agent)
over_contacts("cpo", kpis.cpo)
over_contacts("kpis_multi", kpis.kpis_multi)
over_contacts("contacts_dashboard", dashboard.dashboard_rows)
over_contacts("scan_contacts", lambda rows: rows.select(*CONTACT_COLUMNS))


def long_form(name: str, rows: DataFrame, key: str | None) -> DataFrame:
    """Every measure of ``rows`` as rows of (vista, clave, medida, valor)."""
    measures = [c for c in rows.columns if c != key]
    cells = F.explode(
        F.array(*[F.struct(F.lit(c).alias("medida"), F.col(f"`{c}`").cast("double").alias("valor")) for c in measures])
    )
    clave = F.col(key).cast("string") if key else F.lit("")
    return rows.select(F.lit(name).alias("vista"), clave.alias("clave"), cells.alias("c")).select("vista", "clave", "c.*")


VIEW_KEYS = {
    "v_kpis_por_canal": "canal",
    "v_kpis_por_cola": "cola",
    "v_kpis_por_region": "region",
    "v_kpis_horarios": "hora",
    "v_kpis_por_agente": "agente_id",
    "v_contactos_dashboard": "contact_id",
}
DASHBOARD_NUMBERS = (
    "tiempo_espera_seg", "tiempo_atencion_seg", "csat", "hora_del_dia", "sla_flag", "abandono_flag", "fcr_flag",
    "con_orden_flag",
)


@query("registered_views")
def _registered_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All figures of the eight views over a stored table."""
    path = ContactStore(work_dir(spark, "views")).contacts
    tables.write_contacts(contacts(spark, sf_dir), path)
    views = []
    for name in register_views(tables.read_contacts(spark, path)):
        rows = spark.sql(f"SELECT * FROM {name}")
        if name == "v_contactos_dashboard":
            rows = rows.select("contact_id", *DASHBOARD_NUMBERS)
        views.append(long_form(name, rows, VIEW_KEYS.get(name)))
    return reduce(DataFrame.unionByName, views)


@query("scan_table")
def _scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = ContactStore(work_dir(spark, "scan")).contacts
    tables.write_contacts(contacts(spark, sf_dir), path)
    return tables.read_contacts(spark, path).select(*CONTACT_COLUMNS)


# Dashboard
over_dashboard("scorecards", dashboard.scorecards)
over_dashboard("sla_by_hour", dashboard.sla_by_hour)
over_dashboard("volume_by_hour", dashboard.volume_by_hour)
over_dashboard("tile_channel", dashboard.tile_channel)
over_dashboard("tile_queue", dashboard.tile_queue)
over_dashboard("top_agents_fcr", dashboard.top_agents_fcr)
over_dashboard("heatmap_sla", dashboard.heatmap_sla)
over_dashboard("heatmap_volume", dashboard.heatmap_volume)


TILE_KEYS = {"tile_channel": "canal", "tile_queue": "cola", "top_agents_fcr": "agente_id", "scorecards": None}


@query("dashboard_refresh")
def _dashboard_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All figures of the eight tiles of one refresh."""
    tiles = refresh_dashboard(dashboard.dashboard_rows(contacts(spark, sf_dir)), work_dir(spark, "cube"))
    return reduce(
        DataFrame.unionByName,
        [long_form(name, tile, TILE_KEYS.get(name, "hora_del_dia")) for name, tile in tiles.items()],
    )


def _load(spark: SparkSession, store: ContactStore, load: str, rows: DataFrame) -> None:
    """One load of contacts, in place of what the same load has brought before."""
    sink = Sink(conform(rows, event_date().alias(DAY)), store.contacts, DAY, CLUSTER_BY)
    tables.commit_load(spark, store.log(spark), load, [sink])


@query("refresh_after_loads")
def _refresh_after_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All figures of the eight tiles from the stored aggregate, after three loads and a replaced one."""
    store, rows = ContactStore(work_dir(spark, "rollup")), contacts(spark, sf_dir)
    third = F.col("contact_id").cast("bigint") % 3
    loads = [rows.where(third == 0), rows.where((third == 1) & (F.col("canal") == "view")), rows.where(third == 2)]
    for k, part in enumerate(loads):
        _load(spark, store, f"carga-{k}", part)
        refresh_rollup(spark, store)
    _load(spark, store, "carga-1", rows.where(third == 1))
    refresh_rollup(spark, store)
    return reduce(
        DataFrame.unionByName,
        [long_form(name, tile, TILE_KEYS.get(name, "hora_del_dia")) for name, tile in dashboard_tiles(spark, store).items()],
    )


@query("cpo_sketch")
def _cpo_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contacts with an order per value of each dimension, and whether the sketched orders are within their bound."""
    store = ContactStore(work_dir(spark, "sketch"))
    _load(spark, store, "carga-0", contacts(spark, sf_dir))
    refresh_rollup(spark, store, sketched=True)
    cube = read_rollup(spark, store)
    rows = dashboard.dashboard_rows(tables.read_contacts(spark, store.contacts))
    out = []
    for dim in ORDER_DIMENSIONS:
        told = cube.groupBy(dim).agg(F.sum("con_orden_n").alias("contactos_con_orden"), sketched_orders().alias("k"))
        exact = rows.groupBy(dim).agg(F.countDistinct("orden_asociada").alias("ordenes_distintas"))
        near = F.abs(F.col("k") - F.col("ordenes_distintas")) <= SKETCH_ERROR * F.col("ordenes_distintas")
        value = F.col(dim).cast("string").alias("valor")
        counts = ["contactos_con_orden", "ordenes_distintas"]
        out.append(told.join(exact, dim).select(F.lit(dim).alias("dim"), value, *counts, near.alias("dentro")))
    return reduce(DataFrame.unionByName, out)


@query("agent_lookup")
def _agent_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contacts of one agent, from the files that may hold them."""
    store, rows = ContactStore(work_dir(spark, "lookup")), contacts(spark, sf_dir)
    group = F.coalesce(F.substring("agente_id", 4, 3).cast("int"), F.lit(0)) % 4
    for k in range(4):
        _load(spark, store, f"carga-{k}", rows.where(group == k))
    skipping.index_loads(spark, store)
    return skipping.find_contacts(spark, store, "agente_id", LOOKED_UP).select(*CONTACT_COLUMNS)


def over_filtered(name: str, controls: filters.DashboardFilter, job: Callable[[DataFrame], DataFrame]) -> None:
    over_contacts(name, lambda rows: job(dashboard.dashboard_rows(filters.apply_filters(rows, controls))))


over_filtered("filter_date_range", filters.last_n_days(AS_OF, 7), lambda rows: rows)
over_filtered("filter_this_month", filters.this_month(AS_OF), lambda rows: rows)
over_filtered("filter_channel", filters.DashboardFilter(channels=("click", "purchase")), lambda rows: rows)
over_filtered("filter_region", filters.DashboardFilter(regions=("ASIA", "EUROPE")), lambda rows: rows)
over_filtered(
    "filtered_kpis",
    filters.DashboardFilter(date(2024, 1, 8), date(2024, 1, 21), ("click", "view"), ("AFRICA", "AMERICA", "ASIA")),
    dashboard.scorecards,
)
over_filtered("cross_filter", filters.DashboardFilter(cross=("hora_del_dia", 9)), dashboard.tile_channel)

# Single-contact columns
over_contacts("derive_sla", lambda rows: kpis.derive_sla(rows).select("contact_id", "dentro_sla"))
over_contacts("contact_line", lambda rows: rows.select("contact_id", contact_line().alias("linea")))


# Validation
@query("validate_messages")
def _validate_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(spark, sf_dir).select("raw_payload", "error")


@query("valid_rows")
def _valid_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_rows(_validated(spark, sf_dir))



@query("dlq_rows")
def _rejected_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dlq_rows(_validated(spark, sf_dir)).select("raw_payload", "error")



@query("missing_fields")
def _missing_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    validated = _validated(spark, sf_dir).where(F.size("faltantes") > 0)
    return validated.select("raw_payload", F.array_join("faltantes", ",").alias("faltantes"), "error")


@query("publish_messages")
def _publish_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = messages.publish_messages(contacts(spark, sf_dir))
    return sent.select(F.col("value").cast("string").alias("mensaje"), messages.attribute("canal").alias("canal"))


@query("attr_filter")
def _attr_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = messages.with_channel(_payloads(spark, sf_dir), "click", "view")
    return validate(picked).select("raw_payload", "error")


@query("dlq_summary")
def _dlq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejects per day and reason, taken for captured when their contact happened."""
    sent = _payloads(spark, sf_dir, keep=["timestamp_evento"])
    rejected = dlq_rows(validate(sent, keep=["timestamp_evento"]), ingested_at=F.col("timestamp_evento"))
    return quality.dlq_summary(rejected)


RELAXED = [name for name in REQUIRED_FIELDS if name not in REPLAY_OPTIONAL]


@query("dlq_replay")
def _dlq_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contacts after replaying stored rejects under a rule that no longer asks for queue and region."""
    store = _ingested(spark, sf_dir)
    replay_store(spark, store, RELAXED)
    return tables.read_contacts(spark, store.contacts).select(*CONTACT_COLUMNS)


@query("dlq_replay_twice")
def _dlq_replay_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after a further replay under the strict rules, which takes nothing back."""
    store = _ingested(spark, sf_dir)
    replay_store(spark, store, RELAXED)
    replay_store(spark, store)
    return tables.read_contacts(spark, store.contacts).select(*CONTACT_COLUMNS)


@query("quality_audit")
def _quality_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_audit(valid_rows(_validated(spark, sf_dir)))


@query("mix_vs_plan")
def _mix_vs_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = literal_rows(spark, CHANNEL_PLAN, "canal string, peso double")
    return quality.mix_vs_plan(contacts(spark, sf_dir), plan, "canal")


@query("mix_vs_plan_queue")
def _mix_vs_plan_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = literal_rows(spark, QUEUE_PLAN, "cola string, peso double")
    return quality.mix_vs_plan(contacts(spark, sf_dir), plan, "cola")


over_contacts("demand_curve", quality.demand_curve)
over_contacts("sla_breach", lambda rows: kpis.sla_breach(kpis.kpis_by_queue(rows)))


# Tables
@query("batch_load_json")
def _batch_load_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "json")
    sent = messages.publish_messages(contacts(spark, sf_dir))
    sent.select(F.col("value").cast("string")).write.text(path)
    return tables.read_contact_json(spark, path)


def _per_day(rows: DataFrame) -> DataFrame:
    return rows.groupBy("fecha").agg(
        F.count("*").alias("filas"), F.count("agente_id").alias("atendidos"), F.sum("csat").alias("csat")
    )


@query("load_overwrite")
def _load_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, rows = ContactStore(work_dir(spark, "overwrite")).contacts, contacts(spark, sf_dir)
    for _ in range(2):
        tables.write_contacts(rows, path, mode="overwrite")
    return _per_day(tables.read_contacts(spark, path))


@query("load_append")
def _load_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, rows = ContactStore(work_dir(spark, "append")).contacts, contacts(spark, sf_dir)
    for _ in range(2):
        tables.write_contacts(rows, path, mode="append")
    return _per_day(tables.read_contacts(spark, path))


@query("partitioned_scan")
def _partitioned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = ContactStore(work_dir(spark, "partitioned")).contacts
    tables.write_contacts(contacts(spark, sf_dir), path)
    week = filters.last_n_days(AS_OF, 7)
    return filters.apply_filters(tables.read_contacts(spark, path, week.start, week.end), week)


@query("create_tables")
def _create_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = work_dir(spark, "catalog")
    store, database = ContactStore(root), "checks_" + root.rsplit("-", 1)[1]
    names = tables.create_tables(spark, store, database)
    _ingested(spark, sf_dir, store)
    tables.create_tables(spark, store, database)
    for load in tables.logged_loads(spark, store):
        tables.register_load(spark, store, load, database)
    return spark.sql(
        " UNION ALL ".join(f"SELECT '{n.split('.')[1]}' AS tabla, count(*) AS filas FROM {n}" for n in names)
    )


@query("catalog_after_maintenance")
def _catalog_after_maintenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the catalogued tables show after each step of a store's life."""
    root = work_dir(spark, "maintained")
    store, database = ContactStore(root), "kept_" + root.rsplit("-", 1)[1]
    names = tables.create_tables(spark, store, database)
    shown = []

    def step(name: str) -> None:
        tables.sync_catalog(spark, store, database)
        shown.extend((name, n.split(".")[1], spark.table(n).count()) for n in names)

    _ingested(spark, sf_dir, store)
    step("ingesta")
    replay_store(spark, store, RELAXED)
    step("reproceso")
    tables.consolidate_days(spark, store, date(2024, 1, 1), date(2024, 1, 31))
    step("consolidacion")
    tables.write_contacts(contacts(spark, sf_dir), store.contacts, mode="overwrite")
    step("refresco")
    return literal_rows(spark, shown, "paso string, tabla string, filas bigint")


# Streaming
def _ingested(spark: SparkSession, sf_dir: str, store: ContactStore | None = None) -> ContactStore:
    store = store or ContactStore(work_dir(spark, "ingest"))
    stream = payloads(messages.spread(contact_stream(spark, sf_dir, max_files=1000)))
    start_ingest(stream, store, f"{store.root}/checkpoint", drain=True).awaitTermination()
    return store


@query("stream_ingest")
def _stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_contacts(spark, _ingested(spark, sf_dir).contacts).select(*CONTACT_COLUMNS)


@query("stream_ingest_dlq")
def _stream_ingest_dlq(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = tables.read_dlq(spark, _ingested(spark, sf_dir).dlq)
    return rejected.groupBy("error").agg(F.count("*").alias("mensajes"))


@query("stream_ingest_unique")
def _stream_ingest_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contacts of a stream that brings every message three times."""
    store = ContactStore(work_dir(spark, "unique"))
    sent = payloads(messages.spread(contact_stream(spark, sf_dir, max_files=1000)))
    thrice = sent.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(3)))).drop("k")
    start_ingest(thrice, store, f"{store.root}/checkpoint", drain=True, unique_within="1 hour").awaitTermination()
    return tables.read_contacts(spark, store.contacts).select(*CONTACT_COLUMNS)


@query("ingest_metrics")
def _ingest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = tables.read_load_log(spark, _ingested(spark, sf_dir).load_log)
    return entries.groupBy("tabla").agg(F.sum("filas").alias("filas"))


over_contacts("window_batches", window_batches)


@query("live_kpis")
def _live_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "live")
    stream = live_kpis(contact_stream(spark, sf_dir))
    start_live(stream, f"{path}/windows", f"{path}/checkpoint", drain=True).awaitTermination()
    return read_live(spark, f"{path}/windows", stream.schema)


@query("live_kpis_restarted")
def _live_windows_restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The windows after a query over half of the contacts and one with a new checkpoint over all of them."""
    path = work_dir(spark, "relive")
    for name, share in (("first", F.col("contact_id").cast("bigint") % 2 == 0), ("second", F.lit(True))):
        stream = live_kpis(contact_stream(spark, sf_dir).where(share))
        start_live(stream, f"{path}/windows", f"{path}/{name}", drain=True).awaitTermination()
    return read_live(spark, f"{path}/windows", stream.schema)
