"""Registered queries over incident messages and operator pages."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..constants import ALERT_OPERATOR_CODES, EXTRA_OPERATORS
from ..operators import incidents as I
from ..session import materialize, run_root
from ..sources.html import extract_html_table, table_columns
from ..sources.xml_docs import parse_incidents
from ..streaming.incidents import read_outbox
from .captures import capture

OP_COLUMNS = ["Operator", "Code", "Passenger satisfaction[1]"]


def _details(spark, sf_dir):
    return I.incident_details(parse_incidents(capture(spark, sf_dir, "incident_messages"), keep_text=False))


def _good(spark, sf_dir):
    return I.split_messages(_details(spark, sf_dir))[0]


def _flat(spark, sf_dir):
    return I.flatten_incidents(_good(spark, sf_dir))


def _messages(spark, sf_dir):
    """The parsable messages, written once: the loads read them several times."""
    return materialize(_good(spark, sf_dir).drop("corrupt_record"), "incident-messages")


def incident_xml_parse(spark, sf_dir):
    d = parse_incidents(capture(spark, sf_dir, "incident_messages"))
    return d.select(F.col("message_key").alias("message_version"),
                    F.col("msg._corrupt_record").isNotNull().alias("is_malformed"),
                    F.col("msg.Version").alias("parsed_version"))


def incident_details(spark, sf_dir):
    return _details(spark, sf_dir).select(*I.FLAT_INCIDENT_COLUMNS[:9])


def incident_operators(spark, sf_dir):
    d = _details(spark, sf_dir)
    return d.select("version", F.explode("operators_affected").alias("o")).select(
        "version", "o.affected_operator_ref", "o.affected_operator_name")


def iso_wallclock(spark, sf_dir):
    return _details(spark, sf_dir).select("version", "creation_time", "start_time", "end_time")


def incident_coerce(spark, sf_dir):
    return _details(spark, sf_dir).select("version", "planned", "incident_priority")


def routes_split(spark, sf_dir):
    return _details(spark, sf_dir).select("version", F.explode("routes_affected").alias("route"))


def incident_quarantine(spark, sf_dir):
    _, bad = I.split_messages(_details(spark, sf_dir))
    return bad.select("message_key", F.col("quarantine_reason").alias("reason"))


def _op_rows(spark, sf_dir):
    rows = extract_html_table(capture(spark, sf_dir, "operator_pages"), "wikitable", 0)
    return table_columns(rows, OP_COLUMNS)


def html_table_extract(spark, sf_dir):
    return _op_rows(spark, sf_dir)


def cancel_code_list(spark, sf_dir):
    """Column ``Code`` of the first wikitable of each page, as the code set."""
    return _op_rows(spark, sf_dir).select("Code").where(F.col("Code").isNotNull()).distinct()


def operator_info(spark, sf_dir):
    return I.operator_info(_op_rows(spark, sf_dir), spark)


def _operators(spark, sf_dir):
    return I.load_operators(operator_info(spark, sf_dir))[0]


def _load(spark, sf_dir):
    """I14 into a fresh folder: (tables, operator)."""
    root = f"{run_root(spark)}/incidents-{uuid.uuid4().hex}"
    operator = materialize(_operators(spark, sf_dir), "operator")

    def append(name, rows):
        rows.write.mode("append").parquet(f"{root}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{root}/{name}")
    tables = I.load_all_incidents(_messages(spark, sf_dir), operator, lambda name: None, append,
                                  lambda name, rows: rows.write.parquet(f"{root}/_rejects/{name}"))
    return tables, operator


def dim_priority(spark, sf_dir):
    return I.load_priorities(_good(spark, sf_dir))


def fact_incident(spark, sf_dir):
    rows = _messages(spark, sf_dir)
    return I.load_incidents(rows, I.load_priorities(rows))[0]


def incident_rejects(spark, sf_dir):
    rows = _messages(spark, sf_dir)
    rej = I.load_incidents(rows, I.load_priorities(rows))[1]
    return rej.select("incident_version", "reject_reason")


def dim_route(spark, sf_dir):
    return I.load_routes(_good(spark, sf_dir))


def _incident_ids(rows):
    return materialize(I.load_incidents(rows, I.load_priorities(rows))[0].select("incident_id", "incident_version"), "incident")


def link_incident_route(spark, sf_dir):
    rows = _messages(spark, sf_dir)
    return I.link_routes(rows, _incident_ids(rows), I.load_routes(rows))[0]


def link_incident_operator(spark, sf_dir):
    rows = _messages(spark, sf_dir)
    return I.link_operators(rows, _incident_ids(rows), _operators(spark, sf_dir))[0]


def incident_load_counts(spark, sf_dir):
    tables, operator = _load(spark, sf_dir)
    out = None
    for name, df in {"operator": operator, **tables._asdict()}.items():
        c = df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"),
                                                                "row_count")
        out = c if out is None else out.unionByName(c)
    return out


def alert_scope(spark, sf_dir):
    return I.alert_scope(_flat(spark, sf_dir)).select("version", "affected_operator_ref").distinct()


def alert_text(spark, sf_dir):
    return I.alerts(_good(spark, sf_dir))


def alert_outbox(spark, sf_dir):
    """Alerts written to an outbox partitioned by operator code, read back."""
    path = f"{run_root(spark)}/outbox-{uuid.uuid4().hex}"
    I.alerts(_good(spark, sf_dir)).write.partitionBy("operator_code").parquet(path)
    return read_outbox(spark, path)


QUERIES = {
    "incident_xml_parse": incident_xml_parse,
    "incident_details": incident_details,
    "incident_operators": incident_operators,
    "iso_wallclock": iso_wallclock,
    "incident_coerce": incident_coerce,
    "routes_split": routes_split,
    "incident_flatten": lambda s, d: _flat(s, d),
    "incident_quarantine": incident_quarantine,
    "html_table_extract": html_table_extract,
    "cancel_code_list": cancel_code_list,
    "operator_info": operator_info,
    "dim_operator": _operators,
    "dim_priority": dim_priority,
    "fact_incident": fact_incident,
    "incident_rejects": incident_rejects,
    "dim_route": dim_route,
    "link_incident_route": link_incident_route,
    "link_incident_operator": link_incident_operator,
    "incident_load_counts": incident_load_counts,
    "alert_scope": alert_scope,
    "alert_text": alert_text,
    "alert_outbox": alert_outbox,
}

_CODE = "chr(CAST(floor({k} / 26) % 26 + 65 AS INTEGER)) || chr(CAST({k} % 26 + 65 AS INTEGER))"

INCIDENT_CTE = f"""WITH
ords AS (
  SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus, o_orderpriority,
         CAST(o_orderkey AS VARCHAR) AS key,
         CASE WHEN NOT (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT') THEN key END AS given, strftime(o_orderdate, '%Y-%m-%d') AS day,
         (o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED') AS malformed,
         (o_orderstatus = 'P' AND o_orderpriority = '3-MEDIUM') AS no_routes,
         (o_orderstatus = 'P' AND o_orderpriority = '2-HIGH') AS no_priority,
         (o_orderpriority = '5-LOW') AS no_end
  FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)
),
det AS (
  SELECT o_orderkey, key, given AS version, malformed, no_routes,
         CAST(day || ' 08:30:00' AS TIMESTAMP) AS creation_time,
         'INC' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS incident_number,
         (o_orderstatus = 'O') AS planned,
         CAST(day || ' 09:00:00' AS TIMESTAMP) AS start_time,
         CASE WHEN NOT no_end THEN CAST(day || ' 23:59:00' AS TIMESTAMP) END AS end_time,
         'https://incidents.example/' || key AS info_link,
         'Disruption <' || o_orderpriority || '> & delays' AS summary,
         CASE WHEN NOT no_priority THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS incident_priority
  FROM ords
),
ops AS (
  SELECT DISTINCT l_orderkey, l_suppkey, {_CODE.format(k="l_suppkey")} AS affected_operator_ref,
         s_name AS affected_operator_name
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
),
rts AS (SELECT DISTINCT l_orderkey, p_name FROM lineitem JOIN part ON l_partkey = p_partkey),
good AS (SELECT * FROM det WHERE NOT malformed AND NOT no_routes),
flat AS (
  SELECT g.creation_time, g.incident_number, g.version, g.planned, g.start_time, g.end_time,
         g.info_link, g.summary, g.incident_priority, o.affected_operator_ref,
         o.affected_operator_name, r.p_name AS route_affected
  FROM good g JOIN ops o ON o.l_orderkey = g.o_orderkey JOIN rts r ON r.l_orderkey = g.o_orderkey
),
priority AS (
  SELECT row_number() OVER (ORDER BY priority_code) AS priority_id, priority_code
  FROM (SELECT DISTINCT incident_priority AS priority_code FROM flat WHERE incident_priority IS NOT NULL)
),
inc_first AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY version ORDER BY creation_time NULLS FIRST,
      incident_number NULLS FIRST, start_time NULLS FIRST, end_time NULLS FIRST, info_link NULLS FIRST,
      summary NULLS FIRST, incident_priority NULLS FIRST, planned NULLS FIRST) AS rn_
    FROM flat WHERE version IS NOT NULL) WHERE rn_ = 1
  UNION ALL BY NAME SELECT DISTINCT creation_time, incident_number, version, planned, start_time, end_time, info_link,
    summary, incident_priority FROM flat WHERE version IS NULL
),
inc_cand AS (
  SELECT f.incident_number AS incident_num, f.version AS incident_version, f.info_link AS link,
         f.summary, p.priority_id, f.planned AS is_planned, f.creation_time, f.start_time, f.end_time
  FROM inc_first f LEFT JOIN priority p ON f.incident_priority = p.priority_code
),
incident AS (
  SELECT row_number() OVER (ORDER BY incident_version) AS incident_id, incident_num, incident_version,
         link, summary, priority_id, is_planned, creation_time, start_time, end_time
  FROM inc_cand
  WHERE incident_num IS NOT NULL AND incident_version IS NOT NULL AND link IS NOT NULL
    AND summary IS NOT NULL AND priority_id IS NOT NULL AND is_planned IS NOT NULL
    AND creation_time IS NOT NULL AND start_time IS NOT NULL
),
route AS (
  SELECT row_number() OVER (ORDER BY route_name) AS route_id, route_name
  FROM (SELECT DISTINCT route_affected AS route_name FROM flat WHERE route_affected IS NOT NULL)
),
oprows AS (
  SELECT s_suppkey // 50 AS page_id,
         row_number() OVER (PARTITION BY s_suppkey // 50 ORDER BY s_suppkey) - 1 AS row_pos,
         s_name || CASE WHEN s_nationkey = 3 THEN ' & Sons' ELSE '' END AS "Operator",
         {_CODE.format(k="s_suppkey")} AS "Code",
         CASE WHEN s_acctbal < 0 THEN 'n/a'
              ELSE CAST(CAST(floor(s_acctbal) AS BIGINT) % 100 AS VARCHAR) || '%' END
           AS "Passenger satisfaction[1]"
  FROM supplier
),
opinfo AS (
  SELECT "Operator" AS operator_name, "Code" AS operator_code,
         TRY_CAST(regexp_replace("Passenger satisfaction[1]", '^%+|%+$', '', 'g') AS DOUBLE) AS customer_satisfaction
  FROM oprows
  UNION ALL
  SELECT * FROM (VALUES {", ".join(f"('{n}', '{c}', {p}::DOUBLE)" for n, c, p in EXTRA_OPERATORS)})
    v(operator_name, operator_code, customer_satisfaction)
),
op_first AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY operator_name ORDER BY operator_code NULLS FIRST,
                                              customer_satisfaction NULLS FIRST) AS rn_
                 FROM opinfo WHERE operator_name IS NOT NULL AND operator_code IS NOT NULL) WHERE rn_ = 1
),
operator AS (
  SELECT row_number() OVER (ORDER BY operator_name) AS operator_id, operator_code, operator_name,
         customer_satisfaction FROM op_first
),
route_link AS (
  SELECT row_number() OVER (ORDER BY incident_id, route_id) AS incident_route_link_id, route_id, incident_id
  FROM (SELECT DISTINCT r.route_id, i.incident_id FROM flat f
        LEFT JOIN route r ON f.route_affected = r.route_name
        LEFT JOIN incident i ON f.version = i.incident_version
        WHERE r.route_id IS NOT NULL AND i.incident_id IS NOT NULL)
),
op_by_code AS (SELECT operator_code, min(operator_id) AS operator_id FROM operator GROUP BY 1),
operator_link AS (
  SELECT row_number() OVER (ORDER BY incident_id, operator_id) AS incident_operator_link_id, operator_id,
         incident_id
  FROM (SELECT DISTINCT o.operator_id, i.incident_id FROM flat f
        LEFT JOIN op_by_code o ON f.affected_operator_ref = o.operator_code
        LEFT JOIN incident i ON f.version = i.incident_version
        WHERE o.operator_id IS NOT NULL AND i.incident_id IS NOT NULL)
),
allow AS (SELECT unnest({ALERT_OPERATOR_CODES}) AS code),
route_text AS (
  SELECT g.o_orderkey, string_agg(chr(10) || '• ' || r.p_name, '' ORDER BY r.p_name) AS bullets
  FROM good g JOIN rts r ON r.l_orderkey = g.o_orderkey GROUP BY g.o_orderkey
),
alerts AS (
  SELECT g.version, o.affected_operator_ref AS operator_code,
         chr(10) || chr(10) || '🚄 ' || o.affected_operator_name || ' incident 🚄:'
         || chr(10) || chr(10) || 'Summary: ' || g.summary
         || chr(10) || chr(10) || 'Priority: ' || coalesce(CAST(g.incident_priority AS VARCHAR), 'None')
         || chr(10) || chr(10) || 'Routes affected:' || rt.bullets
         || CASE WHEN g.end_time IS NOT NULL THEN chr(10) || chr(10) || 'Duration: '
                      || strftime(g.start_time, '%Y-%m-%d %H:%M:%S') || ' to ' || strftime(g.end_time, '%Y-%m-%d %H:%M:%S')
                 ELSE chr(10) || chr(10) || 'Start time: ' || strftime(g.start_time, '%Y-%m-%d %H:%M:%S')
                      || ' End time: Unknown' END AS message
  FROM good g JOIN ops o ON o.l_orderkey = g.o_orderkey JOIN route_text rt ON rt.o_orderkey = g.o_orderkey
  WHERE o.affected_operator_ref IN (SELECT code FROM allow)
)"""

def _parsed(*columns: str) -> str:
    """A message that is not valid XML has no fields."""
    return ", ".join(f"CASE WHEN NOT malformed THEN {c} END AS {c}" for c in columns)


ORACLE = {
    "incident_xml_parse": """SELECT key AS message_version, malformed AS is_malformed,
        CASE WHEN NOT malformed THEN given END AS parsed_version FROM ords""",
    "incident_details": f"""SELECT {_parsed("creation_time", "incident_number", "version", "planned", "start_time", "end_time",
                                         "info_link", "summary", "incident_priority")} FROM det""",
    "incident_operators": """SELECT d.version, o.affected_operator_ref, o.affected_operator_name
        FROM det d JOIN ops o ON o.l_orderkey = d.o_orderkey WHERE NOT d.malformed""",
    "iso_wallclock": f"SELECT {_parsed('version', 'creation_time', 'start_time', 'end_time')} FROM det",
    "incident_coerce": f"SELECT {_parsed('version', 'planned', 'incident_priority')} FROM det",
    "routes_split": """SELECT d.version, r.p_name AS route FROM det d JOIN rts r ON r.l_orderkey = d.o_orderkey
        WHERE NOT d.malformed AND NOT d.no_routes""",
    "incident_flatten": "SELECT * FROM flat",
    "incident_quarantine": """SELECT key AS message_key, CASE WHEN malformed THEN 'malformed' ELSE 'no routes' END AS reason
        FROM det WHERE malformed OR no_routes""",
    "html_table_extract": 'SELECT page_id, row_pos, "Operator", "Code", "Passenger satisfaction[1]" FROM oprows',
    "cancel_code_list": 'SELECT DISTINCT "Code" FROM oprows',
    "operator_info": "SELECT * FROM opinfo",
    "dim_operator": "SELECT * FROM operator",
    "dim_priority": "SELECT * FROM priority",
    "fact_incident": "SELECT * FROM incident",
    "incident_rejects": """SELECT incident_version, 'missing: ' || concat_ws(',',
          CASE WHEN incident_num IS NULL THEN 'incident_num' END,
          CASE WHEN incident_version IS NULL THEN 'incident_version' END,
          CASE WHEN link IS NULL THEN 'link' END, CASE WHEN summary IS NULL THEN 'summary' END,
          CASE WHEN priority_id IS NULL THEN 'priority_id' END,
          CASE WHEN is_planned IS NULL THEN 'is_planned' END,
          CASE WHEN creation_time IS NULL THEN 'creation_time' END,
          CASE WHEN start_time IS NULL THEN 'start_time' END) AS reject_reason
        FROM inc_cand
        WHERE incident_num IS NULL OR incident_version IS NULL OR link IS NULL OR summary IS NULL
           OR priority_id IS NULL OR is_planned IS NULL OR creation_time IS NULL OR start_time IS NULL""",
    "dim_route": "SELECT * FROM route",
    "link_incident_route": "SELECT * FROM route_link",
    "link_incident_operator": "SELECT * FROM operator_link",
    "incident_load_counts": """SELECT * FROM (
        SELECT 'operator' AS table_name, count(*) AS row_count FROM operator
        UNION ALL SELECT 'priority', count(*) FROM priority
        UNION ALL SELECT 'incident', count(*) FROM incident
        UNION ALL SELECT 'route_affected', count(*) FROM route
        UNION ALL SELECT 'incident_route_link', count(*) FROM route_link
        UNION ALL SELECT 'incident_operator_link', count(*) FROM operator_link)""",
    "alert_scope": """SELECT DISTINCT version, affected_operator_ref FROM flat
        WHERE affected_operator_ref IN (SELECT code FROM allow)""",
    "alert_text": "SELECT * FROM alerts",
    "alert_outbox": "SELECT operator_code, version, message FROM alerts",
}


def oracle_sql() -> dict[str, str]:
    return {k: INCIDENT_CTE + "\n" + v for k, v in ORACLE.items()}
