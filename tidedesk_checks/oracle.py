"""DuckDB SQL for each query key, over the same tables."""

from __future__ import annotations

from tidedesk.schema import HOURLY_FACTOR
from tidedesk_checks.projection import CHANNELS
from tidedesk_checks.queries import CHANNEL_PLAN, QUEUE_PLAN

_CONTACTS = """
base AS (
  SELECT event_id AS e, ts, user_id AS u, event_type, value, c_mktsegment, r_name,
         CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 = 0 AS ab
  FROM events
  JOIN customer ON c_custkey = user_id
  JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey
),
contacts AS (
  SELECT CAST(e AS VARCHAR) AS contact_id,
         ts AS timestamp_evento,
         event_type AS canal,
         c_mktsegment AS cola,
         r_name AS region,
         value AS tiempo_espera_seg,
         ab AS abandonado,
         NOT ab AND value <= 20 AS dentro_sla,
         CASE WHEN NOT ab THEN 'AG-' || lpad(CAST(u % 40 + 1 AS VARCHAR), 3, '0') END AS agente_id,
         CASE WHEN NOT ab THEN 45 + (e * 37) % 500 END AS tiempo_atencion_seg,
         CASE WHEN NOT ab THEN (e * 7) % 4 < 3 END AS resuelto_primer_contacto,
         CASE WHEN NOT ab AND e % 2 = 0 THEN 1 + (e * 3) % 5 END AS csat,
         CASE WHEN NOT ab AND (e * 11) % 5 < 3
              THEN 'ORD-' || lpad(CAST(e - e % 3 AS VARCHAR), CAST(greatest(6, length(CAST(e - e % 3 AS VARCHAR))) AS INTEGER), '0') END AS orden_asociada
  FROM base
)"""

_COLUMNS = (
    "contact_id, timestamp_evento, canal, cola, region, tiempo_espera_seg, abandonado, dentro_sla, "
    "agente_id, tiempo_atencion_seg, resuelto_primer_contacto, csat, orden_asociada"
)


def _json(source: str) -> str:
    def quoted(name: str) -> str:
        return f"'\"{name}\":' || coalesce('\"' || {name} || '\"', 'null')"

    def plain(name: str) -> str:
        return f"'\"{name}\":' || coalesce(CAST({name} AS VARCHAR), 'null')"

    members = [
        quoted("contact_id"),
        "'\"timestamp_evento\":\"' || strftime(timestamp_evento, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00\"'",
        quoted("canal"),
        quoted("cola"),
        quoted("region"),
        plain("tiempo_espera_seg"),
        plain("abandonado"),
        plain("dentro_sla"),
        quoted("agente_id"),
        plain("tiempo_atencion_seg"),
        plain("resuelto_primer_contacto"),
        plain("csat"),
        quoted("orden_asociada"),
    ]
    return f"SELECT *, '{{' || {" || ',' || ".join(members)} || '}}' AS text FROM {source}"


_MESSAGES = f"""
numbered AS (SELECT *, CAST(contact_id AS BIGINT) % 50 AS m FROM contacts),
altered AS (
  SELECT * REPLACE (
    CASE WHEN m = 6 THEN '' ELSE canal END AS canal,
    CASE WHEN m <> 1 THEN cola END AS cola,
    CASE WHEN m <> 1 THEN region END AS region,
    CASE WHEN m <> 8 THEN abandonado END AS abandonado)
  FROM numbered
),
written AS ({_json("altered")}),
messages AS (
  SELECT *,
    CASE m
      WHEN 0 THEN left(text, length(text) - 5)
      WHEN 2 THEN '[' || text || ']'
      WHEN 3 THEN regexp_replace(text, '"tiempo_espera_seg":[^,]+', '"tiempo_espera_seg":"abc"')
      WHEN 4 THEN text || chr(65533)
      WHEN 5 THEN text || ' trailing'
      WHEN 7 THEN left(text, length(text) - 1) || ',"extra":1}}'
      WHEN 9 THEN regexp_replace(text, '"canal":"[^"]*"', '"canal":{{"a":1}}')
      WHEN 10 THEN regexp_replace(text, '"timestamp_evento":"[^"]*"', '"timestamp_evento":"2026"')
      WHEN 11 THEN NULL
      ELSE text END AS raw_payload,
    CASE m
      WHEN 0 THEN 'INVALID_JSON'
      WHEN 1 THEN 'Faltan campos obligatorios: [''cola'', ''region'']'
      WHEN 2 THEN 'NOT_OBJECT'
      WHEN 3 THEN 'BAD_TYPE'
      WHEN 4 THEN 'INVALID_UTF8'
      WHEN 5 THEN 'INVALID_JSON'
      WHEN 9 THEN 'BAD_TYPE'
      WHEN 10 THEN 'BAD_TYPE'
      WHEN 11 THEN 'EMPTY'
      WHEN 8 THEN 'Faltan campos obligatorios: [''abandonado'']'
      END AS error
  FROM written
)"""

_RATE = "100 * avg(CAST({} AS BIGINT))"
_MEASURES = {
    "sla_pct": _RATE.format("dentro_sla"),
    "abandono_pct": _RATE.format("abandonado"),
    "aht_seg": "avg(tiempo_atencion_seg)",
    "fcr_pct": _RATE.format("resuelto_primer_contacto"),
    "csat_prom": "avg(csat)",
}


def _rounded(*names: str) -> str:
    return ", ".join(f"round({_MEASURES[n]}, {2 if n == 'csat_prom' else 1}) AS {n}" for n in names)


def _raw(*names: str) -> str:
    return ", ".join(f"{_MEASURES[n]} AS {n}" for n in names)


_KPIS = _rounded("sla_pct", "abandono_pct", "aht_seg", "fcr_pct", "csat_prom")
_TABLE = _raw("sla_pct", "aht_seg", "abandono_pct", "fcr_pct", "csat_prom")

_ROWS = f"""
rows_ AS (
  SELECT {_COLUMNS},
         CAST(timestamp_evento AS DATE) AS fecha,
         hour(timestamp_evento) AS hora_del_dia,
         CAST(dentro_sla AS BIGINT) AS sla_flag,
         CAST(abandonado AS BIGINT) AS abandono_flag,
         CAST(resuelto_primer_contacto AS BIGINT) AS fcr_flag,
         CAST(orden_asociada IS NOT NULL AS BIGINT) AS con_orden_flag
  FROM contacts
)"""

_SCORECARDS = """
SELECT round(100 * avg(sla_flag), 1) AS sla_pct, round(avg(tiempo_atencion_seg), 0) AS aht_seg,
       round(100 * avg(abandono_flag), 1) AS abandono_pct, round(100 * avg(fcr_flag), 1) AS fcr_pct,
       round(avg(csat), 2) AS csat_prom,
       round(CAST(sum(con_orden_flag) AS DOUBLE) / nullif(count(DISTINCT orden_asociada), 0), 2) AS cpo
FROM rows_"""

_WEEK = "fecha BETWEEN DATE '2024-01-17' AND DATE '2024-01-23'"


def _over_contacts(select: str) -> str:
    return f"WITH {_CONTACTS} {select}"


def _over_rows(select: str) -> str:
    return f"WITH {_CONTACTS}, {_ROWS} {select}"


def _over_messages(select: str) -> str:
    return f"WITH {_CONTACTS}, {_MESSAGES} {select}"


def _pivot(cell: str) -> str:
    cells = ", ".join(f"{cell.format(c=channel)} AS {channel}" for channel in CHANNELS)
    return _over_rows(f"SELECT hora_del_dia, {cells} FROM rows_ GROUP BY hora_del_dia")


def _windows(kpis: str, dimensions: str = "") -> str:
    start = "time_bucket(INTERVAL 60 SECOND, timestamp_evento)"
    return f"""SELECT {start} AS inicio, {start} + INTERVAL 60 SECOND AS fin, {dimensions} {kpis}
               FROM contacts GROUP BY ALL"""


_VALID = f"SELECT {_COLUMNS} FROM messages WHERE error IS NULL"
_REPLAYED = f"""SELECT * REPLACE (coalesce(cola, '') AS cola, coalesce(region, '') AS region)
                FROM (SELECT {_COLUMNS} FROM messages WHERE error IS NULL OR m = 1)"""
_PER_DAY = """SELECT CAST(timestamp_evento AS DATE) AS fecha, {n} * count(*) AS filas,
                     {n} * count(agente_id) AS atendidos, CAST({n} * sum(csat) AS BIGINT) AS csat
              FROM contacts GROUP BY ALL"""

_SERVICE = ("agente_id", "tiempo_atencion_seg", "resuelto_primer_contacto", "csat", "orden_asociada")
_AUDIT = {
    **{
        f"nulo_{name}": f"{name} IS NULL"
        for name in (
            "contact_id",
            "timestamp_evento",
            "canal",
            "cola",
            "region",
            "tiempo_espera_seg",
            "abandonado",
            "dentro_sla",
        )
    },
    "dimension_vacia": "canal = '' OR cola = '' OR region = ''",
    "espera_invalida": "isnan(tiempo_espera_seg) OR tiempo_espera_seg < 0",
    "sla_incoherente": "dentro_sla <> (NOT abandonado AND tiempo_espera_seg <= 20)",
    "abandonado_con_atencion": f"abandonado AND ({' OR '.join(f'{n} IS NOT NULL' for n in _SERVICE)})",
    "atendido_sin_atencion": f"NOT abandonado AND ({' OR '.join(f'{n} IS NULL' for n in _SERVICE[:3])})",
    "aht_bajo_minimo": "tiempo_atencion_seg < 30",
    "csat_fuera_de_rango": "csat NOT BETWEEN 1 AND 5",
    "agente_mal_formado": "NOT regexp_full_match(agente_id, 'AG-[0-9]{3}')",
    "orden_mal_formada": "NOT regexp_full_match(orden_asociada, 'ORD-[0-9]{6,}')",
}


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)


def _mix(dim: str, plan: list[tuple]) -> str:
    return _over_contacts(
        f"""SELECT coalesce(o.{dim}, p.{dim}) AS {dim}, coalesce(n, 0) AS contactos,
                   coalesce(share, 0.0) AS peso_observado, p.peso AS peso_plan,
                   round(coalesce(share, 0.0) - p.peso, 4) AS desvio
            FROM (SELECT {dim}, count(*) AS n,
                         round(CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE), 4) AS share
                  FROM contacts GROUP BY {dim}) o
            FULL JOIN (SELECT {dim}, CAST(peso AS DOUBLE) AS peso
                       FROM (VALUES {_values(plan)}) v({dim}, peso)) p ON o.{dim} = p.{dim}"""
    )


def _long(source: str, name: str, key: str, measures: dict[str, str], group: str = "") -> str:
    """Every measure of a view as rows of (vista, clave, medida, valor)."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS vista, {key} AS clave, '{measure}' AS medida, CAST({value} AS DOUBLE) AS valor FROM {source} {group}"
        for measure, value in measures.items()
    )


def _round(name: str) -> str:
    return f"round({_MEASURES[name]}, {2 if name == 'csat_prom' else 1})"


_ALL = {"total_contactos": "count(*)", **{n: _round(n) for n in ("sla_pct", "abandono_pct", "aht_seg", "fcr_pct", "csat_prom")}}
_SERVED = "(SELECT * FROM contacts WHERE agente_id IS NOT NULL)"
_ORDERS = "(SELECT * FROM contacts WHERE orden_asociada IS NOT NULL)"
_VIEWS = " UNION ALL ".join(
    [
        _long("contacts", "v_kpis_globales", "''", _ALL),
        *[
            _long("contacts", f"v_kpis_por_{dim}", dim, _ALL, f"GROUP BY {dim}")
            for dim in ("canal", "cola", "region")
        ],
        _long(
            "contacts",
            "v_kpis_horarios",
            "CAST(hour(timestamp_evento) AS VARCHAR)",
            {n: _ALL[n] for n in ("total_contactos", "sla_pct", "abandono_pct", "aht_seg")},
            "GROUP BY hour(timestamp_evento)",
        ),
        _long(
            _SERVED,
            "v_kpis_por_agente",
            "agente_id",
            {"contactos_atendidos": "count(*)", **{n: _ALL[n] for n in ("aht_seg", "fcr_pct", "csat_prom")}},
            "GROUP BY agente_id",
        ),
        _long(
            _ORDERS,
            "v_cpo",
            "''",
            {
                "contactos_con_orden": "count(*)",
                "ordenes_distintas": "count(DISTINCT orden_asociada)",
                "cpo": "round(CAST(count(*) AS DOUBLE) / nullif(count(DISTINCT orden_asociada), 0), 2)",
            },
        ),
        _long(
            "rows_",
            "v_contactos_dashboard",
            "contact_id",
            {
                n: n
                for n in (
                    "tiempo_espera_seg", "tiempo_atencion_seg", "csat", "hora_del_dia", "sla_flag", "abandono_flag",
                    "fcr_flag", "con_orden_flag",
                )
            },
        ),
    ]
)
_TILE = {n: _MEASURES[n] for n in ("sla_pct", "aht_seg", "abandono_pct", "fcr_pct", "csat_prom")}
_SCORES = {
    "sla_pct": f"round({_MEASURES['sla_pct']}, 1)",
    "aht_seg": f"round({_MEASURES['aht_seg']}, 0)",
    "abandono_pct": f"round({_MEASURES['abandono_pct']}, 1)",
    "fcr_pct": f"round({_MEASURES['fcr_pct']}, 1)",
    "csat_prom": f"round({_MEASURES['csat_prom']}, 2)",
    "cpo": "round(CAST(sum(con_orden_flag) AS DOUBLE) / nullif(count(DISTINCT orden_asociada), 0), 2)",
}
_BEST = f"""(SELECT agente_id, {_raw("fcr_pct", "aht_seg", "csat_prom")}, count(*) AS contactos
             FROM rows_ WHERE abandono_flag = 0 GROUP BY agente_id
             ORDER BY fcr_pct DESC NULLS LAST, contactos DESC, agente_id LIMIT 10)"""
_HOUR = "CAST(hora_del_dia AS VARCHAR)"
_TILES = " UNION ALL ".join(
    [
        _long("rows_", "scorecards", "''", _SCORES),
        _long("rows_", "sla_by_hour", _HOUR, {"sla_pct": _MEASURES["sla_pct"]}, "GROUP BY hora_del_dia"),
        _long("rows_", "volume_by_hour", _HOUR, {"contactos": "count(*)"}, "GROUP BY hora_del_dia"),
        _long("rows_", "tile_channel", "canal", _TILE, "GROUP BY canal"),
        _long("rows_", "tile_queue", "cola", _TILE, "GROUP BY cola"),
        _long(_BEST, "top_agents_fcr", "agente_id", {n: n for n in ("fcr_pct", "aht_seg", "csat_prom", "contactos")}),
        _long(
            "rows_",
            "heatmap_sla",
            _HOUR,
            {c: f"100 * avg(sla_flag) FILTER (canal = '{c}')" for c in CHANNELS},
            "GROUP BY hora_del_dia",
        ),
        _long(
            "rows_",
            "heatmap_volume",
            _HOUR,
            {c: f"nullif(count(*) FILTER (canal = '{c}'), 0)" for c in CHANNELS},
            "GROUP BY hora_del_dia",
        ),
    ]
)


ORACLE: dict[str, str] = {
    "scan_table": _over_contacts(f"SELECT {_COLUMNS} FROM contacts"),
    "scan_contacts": _over_contacts(f"SELECT {_COLUMNS} FROM contacts"),
    "kpis_global": _over_contacts(f"SELECT count(*) AS total_contactos, {_KPIS} FROM contacts"),
    **{
        key: _over_contacts(f"SELECT {dim}, count(*) AS total_contactos, {_KPIS} FROM contacts GROUP BY {dim}")
        for key, dim in (("kpis_by_channel", "canal"), ("kpis_by_queue", "cola"), ("kpis_by_region", "region"))
    },
    "kpis_by_hour": _over_contacts(
        f"""SELECT hour(timestamp_evento) AS hora, count(*) AS total_contactos,
                   {_rounded("sla_pct", "abandono_pct", "aht_seg")}
            FROM contacts GROUP BY hora ORDER BY hora"""
    ),
    "kpis_by_agent": _over_contacts(
        f"""SELECT agente_id, count(*) AS contactos_atendidos, {_rounded("aht_seg", "fcr_pct", "csat_prom")}
            FROM contacts WHERE agente_id IS NOT NULL GROUP BY agente_id"""
    ),
    "cpo": _over_contacts(
        """SELECT count(*) AS contactos_con_orden, count(DISTINCT orden_asociada) AS ordenes_distintas,
                  round(CAST(count(*) AS DOUBLE) / nullif(count(DISTINCT orden_asociada), 0), 2) AS cpo
           FROM contacts WHERE orden_asociada IS NOT NULL"""
    ),
    "kpis_multi": _over_contacts(
        f"SELECT 'global' AS dim, CAST(NULL AS VARCHAR) AS value, count(*) AS total_contactos, {_KPIS} FROM contacts"
        + "".join(
            f" UNION ALL SELECT '{dim}', {dim}, count(*), {_KPIS} FROM contacts GROUP BY {dim}"
            for dim in ("canal", "cola", "region")
        )
    ),
    "registered_views": _over_rows(_VIEWS),
    "contacts_dashboard": _over_rows("SELECT * FROM rows_"),
    "scorecards": _over_rows(_SCORECARDS),
    "sla_by_hour": _over_rows(
        "SELECT hora_del_dia, 100 * avg(sla_flag) AS sla_pct FROM rows_ GROUP BY ALL ORDER BY hora_del_dia"
    ),
    "volume_by_hour": _over_rows(
        "SELECT hora_del_dia, count(*) AS contactos FROM rows_ GROUP BY ALL ORDER BY hora_del_dia"
    ),
    "tile_channel": _over_rows(f"SELECT canal, {_TABLE} FROM rows_ GROUP BY canal"),
    "tile_queue": _over_rows(f"SELECT cola, {_TABLE} FROM rows_ GROUP BY cola"),
    "top_agents_fcr": _over_rows(
        f"""SELECT agente_id, {_raw("fcr_pct", "aht_seg", "csat_prom")}, count(*) AS contactos
            FROM rows_ WHERE abandono_flag = 0 GROUP BY agente_id
            ORDER BY fcr_pct DESC NULLS LAST, contactos DESC, agente_id LIMIT 10"""
    ),
    "heatmap_sla": _pivot("100 * avg(sla_flag) FILTER (canal = '{c}')"),
    "heatmap_volume": _pivot("nullif(count(*) FILTER (canal = '{c}'), 0)"),
    "dashboard_refresh": _over_rows(_TILES),
    "refresh_after_loads": _over_rows(_TILES),
    "cpo_sketch": _over_rows(
        " UNION ALL ".join(
            f"""SELECT '{dim}' AS dim, CAST({dim} AS VARCHAR) AS valor, count(orden_asociada) AS contactos_con_orden,
                       count(DISTINCT orden_asociada) AS ordenes_distintas, true AS dentro FROM rows_ GROUP BY {dim}"""
            for dim in ("canal", "cola", "region", "hora_del_dia", "fecha")
        )
    ),
    "agent_lookup": _over_contacts(f"SELECT {_COLUMNS} FROM contacts WHERE agente_id = 'AG-007'"),
    "filter_date_range": _over_rows(f"SELECT * FROM rows_ WHERE {_WEEK}"),
    "filter_this_month": _over_rows(
        "SELECT * FROM rows_ WHERE fecha BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'"
    ),
    "filter_channel": _over_rows("SELECT * FROM rows_ WHERE canal IN ('click', 'purchase')"),
    "filter_region": _over_rows("SELECT * FROM rows_ WHERE region IN ('ASIA', 'EUROPE')"),
    "filtered_kpis": _over_rows(
        _SCORECARDS
        + """ WHERE fecha BETWEEN DATE '2024-01-08' AND DATE '2024-01-21' AND canal IN ('click', 'view')
              AND region IN ('AFRICA', 'AMERICA', 'ASIA')"""
    ),
    "cross_filter": _over_rows(f"SELECT canal, {_TABLE} FROM rows_ WHERE hora_del_dia = 9 GROUP BY canal"),
    "derive_sla": _over_contacts(
        "SELECT contact_id, NOT abandonado AND tiempo_espera_seg <= 20 AS dentro_sla FROM contacts"
    ),
    "contact_line": _over_contacts(
        """SELECT contact_id, printf('%-6s | %-22s | %s', canal, cola,
                  CASE WHEN abandonado THEN 'ABANDONO' ELSE printf('AHT=%ds', tiempo_atencion_seg) END) AS linea
           FROM contacts"""
    ),
    "validate_messages": _over_messages("SELECT raw_payload, error FROM messages"),
    "valid_rows": _over_messages(_VALID),
    "dlq_rows": _over_messages("SELECT raw_payload, error FROM messages WHERE error IS NOT NULL"),
    "missing_fields": _over_messages(
        """SELECT raw_payload, CASE m WHEN 1 THEN 'cola,region' ELSE 'abandonado' END AS faltantes, error
           FROM messages WHERE m IN (1, 8)"""
    ),
    "publish_messages": f"WITH {_CONTACTS}, sent AS ({_json('contacts')}) SELECT text AS mensaje, canal FROM sent",
    "attr_filter": _over_messages("SELECT raw_payload, error FROM messages WHERE canal IN ('click', 'view')"),
    "dlq_summary": _over_messages(
        """SELECT CAST(timestamp_evento AS DATE) AS fecha,
                  CASE WHEN m IN (1, 8) THEN 'MISSING_FIELDS' ELSE error END AS motivo, count(*) AS mensajes
           FROM messages WHERE error IS NOT NULL GROUP BY ALL"""
    ),
    "dlq_replay": _over_messages(_REPLAYED),
    "dlq_replay_twice": _over_messages(_REPLAYED),
    "quality_audit": _over_messages(
        " UNION ALL ".join(
            f"SELECT '{rule}' AS regla, count(*) FILTER ({broken}) AS violaciones FROM messages WHERE error IS NULL"
            for rule, broken in _AUDIT.items()
        )
    ),
    "mix_vs_plan": _mix("canal", CHANNEL_PLAN),
    "mix_vs_plan_queue": _mix("cola", QUEUE_PLAN),
    "demand_curve": _over_contacts(
        f"""SELECT c.hora, coalesce(n, 0) AS contactos, coalesce(share, 0.0) AS fraccion, c.factor,
                   round(coalesce(share, 0.0) - c.factor, 4) AS desvio
            FROM (SELECT CAST(hora AS BIGINT) AS hora, CAST(factor AS DOUBLE) AS factor
                  FROM (VALUES {_values(list(enumerate(HOURLY_FACTOR)))}) v(hora, factor)) c
            LEFT JOIN (SELECT hour(timestamp_evento) AS hora, count(*) AS n,
                              round(CAST(count(*) AS DOUBLE) / max(count(*)) OVER (), 4) AS share
                       FROM contacts GROUP BY ALL) o ON o.hora = c.hora"""
    ),
    "sla_breach": _over_contacts(
        f"""SELECT *, sla_pct < 80.0 AS sla_breach
            FROM (SELECT cola, count(*) AS total_contactos, {_KPIS} FROM contacts GROUP BY cola)"""
    ),
    "batch_load_json": _over_contacts(f"SELECT {_COLUMNS} FROM contacts"),
    "load_overwrite": _over_contacts(_PER_DAY.format(n=1)),
    "load_append": _over_contacts(_PER_DAY.format(n=2)),
    "partitioned_scan": _over_contacts(
        f"SELECT {_COLUMNS}, CAST(timestamp_evento AS DATE) AS fecha FROM contacts WHERE {_WEEK}"
    ),
    "create_tables": _over_messages(
        """SELECT CASE WHEN error IS NULL THEN 'contactos' ELSE 'contactos_dlq' END AS tabla, count(*) AS filas
           FROM messages GROUP BY ALL"""
    ),
    "catalog_after_maintenance": _over_messages(
        f"""SELECT paso, tabla, CASE WHEN tabla = 'contactos_dlq' THEN malos WHEN paso = 'ingesta' THEN buenos
                                     WHEN paso = 'refresco' THEN todos ELSE reparados END AS filas
            FROM (VALUES ('ingesta'), ('reproceso'), ('consolidacion'), ('refresco')) p(paso),
                 (VALUES ('contactos'), ('contactos_dlq')) t(tabla),
                 (SELECT count(*) AS todos, count(*) FILTER (error IS NULL) AS buenos,
                         count(*) FILTER (error IS NOT NULL) AS malos FROM messages) m,
                 (SELECT count(*) AS reparados FROM ({_REPLAYED})) r"""
    ),
    "stream_ingest": _over_messages(_VALID),
    "stream_ingest_unique": _over_messages(_VALID),
    "stream_ingest_dlq": _over_messages(
        "SELECT error, count(*) AS mensajes FROM messages WHERE error IS NOT NULL GROUP BY error"
    ),
    "ingest_metrics": _over_messages(
        """SELECT CASE WHEN error IS NULL THEN 'contactos' ELSE 'contactos_dlq' END AS tabla, count(*) AS filas
           FROM messages GROUP BY ALL"""
    ),
    "window_batches": _over_contacts(_windows("count(*) AS contactos")),
    "live_kpis_restarted": _over_contacts(_windows(f"count(*) AS total_contactos, {_KPIS}", "canal,")),
    "live_kpis": _over_contacts(_windows(f"count(*) AS total_contactos, {_KPIS}", "canal,")),
}
