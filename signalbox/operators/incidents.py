"""Incident messages: extract, flatten, load, alert."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import ALERT_OPERATOR_CODES, EXTRA_OPERATORS
from ..functions.cleaning import boolean_or_null, int_or_null, percent_or_null, split_routes
from ..functions.timestamps import iso_wallclock
from .keys import absent_rows, assign_ids, first_per_key, max_id
from ..session import materialize
from .warehouse import check_required, lookup

FLAT_INCIDENT_COLUMNS = [
    "creation_time", "incident_number", "version", "planned", "start_time", "end_time",
    "info_link", "summary", "incident_priority", "affected_operator_ref",
    "affected_operator_name", "route_affected",
]


def incident_details(parsed: DataFrame, msg: str = "msg") -> DataFrame:
    """Typed scalar fields, the operator list and the route list."""
    m = F.col(msg)
    others = [c for c in parsed.columns if c not in (msg, "raw")]
    return parsed.select(
        *others,
        m["_corrupt_record"].alias("corrupt_record"),
        iso_wallclock(m["CreationTime"]).alias("creation_time"),
        m["IncidentNumber"].alias("incident_number"),
        m["Version"].alias("version"),
        boolean_or_null(m["Planned"]).alias("planned"),
        iso_wallclock(m["StartTime"]).alias("start_time"),
        iso_wallclock(m["EndTime"]).alias("end_time"),
        m["Uri"].alias("info_link"),
        m["Summary"].alias("summary"),
        int_or_null(m["IncidentPriority"]).alias("incident_priority"),
        F.transform(m["Operators"], lambda o: F.struct(
            o["OperatorRef"].alias("affected_operator_ref"),
            o["OperatorName"].alias("affected_operator_name"))).alias("operators_affected"),
        split_routes(m["RoutesAffected"]).alias("routes_affected"))


def quarantine_reason() -> Column:
    """Why a message of ``incident_details`` cannot be flattened; null if it can."""
    return (F.when(F.col("corrupt_record").isNotNull(), F.lit("malformed"))
            .when(F.col("routes_affected").isNull(), F.lit("no routes"))
            .when(F.coalesce(F.size("operators_affected"), F.lit(-1)) <= 0, F.lit("no operators")))


def split_messages(details: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsable messages with operators and routes / quarantine with a reason."""
    d = details.withColumn("quarantine_reason", quarantine_reason())
    return (d.where(F.col("quarantine_reason").isNull()).drop("quarantine_reason"),
            d.where(F.col("quarantine_reason").isNotNull()))


#: Values without which an incident is not stored.
MESSAGE_REQUIRED = ["incident_number", "version", "info_link", "summary", "incident_priority", "planned",
                    "creation_time", "start_time"]


def incomplete() -> Column:
    """True for a message (or flat row) whose incident would be rejected."""
    missing = F.lit(False)
    for c in MESSAGE_REQUIRED:
        missing = missing | F.col(c).isNull()
    return missing


def flatten_incidents(good: DataFrame) -> DataFrame:
    """One row per (affected operator, affected route) of each message."""
    ops = good.select("*", F.explode("operators_affected").alias("_op"))
    both = ops.select("*", F.explode("routes_affected").alias("route_affected"))
    return both.select(
        "creation_time", "incident_number", "version", "planned", "start_time", "end_time",
        "info_link", "summary", "incident_priority",
        F.col("_op.affected_operator_ref").alias("affected_operator_ref"),
        F.col("_op.affected_operator_name").alias("affected_operator_name"),
        "route_affected")


# --- operator reference table (I07, I08) ---------------------------------------

def operator_info(table_rows: DataFrame, spark: SparkSession | None = None,
                  known_bad: tuple[str, dict[str, list[int]]] | None = None,
                  position_col: str = "row_pos") -> DataFrame:
    """Operator table rows -> satisfaction as a number, renamed, the six
    missing operators appended.

    ``table_rows`` has columns Operator, Code, ``Passenger satisfaction[1]``
    and the data-row position within its table. ``known_bad`` = (column that
    names the page, rows to drop by position for each page); none by default.
    """
    spark = spark or table_rows.sparkSession
    if known_bad:
        page_col, bad = known_bad
        for page, positions in bad.items():
            table_rows = table_rows.where(~(F.col(page_col).eqNullSafe(page) & F.col(position_col).isin(positions)))
    rows = table_rows.select(
        F.col("Operator").alias("operator_name"), F.col("Code").alias("operator_code"),
        percent_or_null(F.col("`Passenger satisfaction[1]`")).alias("customer_satisfaction"))
    extra = spark.createDataFrame(EXTRA_OPERATORS,
                                  "operator_name string, operator_code string, customer_satisfaction double")
    return rows.unionByName(extra)


def load_operators(info: DataFrame, existing: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Insert-if-absent on operator name (first row by code, satisfaction);
    rows to append and rejects."""
    info = materialize(info.select("operator_name", "operator_code", "customer_satisfaction"), "operator-info")
    good, rejects = check_required(info, ["operator_name", "operator_code"])
    first = first_per_key(good, ["operator_name"], ["operator_code", "customer_satisfaction"])
    new = absent_rows(first, existing, ["operator_name"])
    return assign_ids(new, ["operator_name"], "operator_id", max_id(existing, "operator_id")).select(
        "operator_id", "operator_code", "operator_name", "customer_satisfaction"), rejects


# --- incident star schema (I09-I14) ---------------------------------------------
#
# The loads read either one row per message (``split_messages``) or flat rows;
# the pipeline gives them messages, as flat rows are operators times routes.

def _each(rows: DataFrame, array: str, field: str | None, name: str) -> DataFrame:
    """(name, version) with one array of a message exploded, or as flat rows have it."""
    if name in rows.columns:
        return rows.select(name, "version")
    x = rows.select("version", F.explode(array).alias("_x"))
    return x.select((F.col("_x")[field] if field else F.col("_x")).alias(name), "version")


def each_route(rows: DataFrame) -> DataFrame:
    return _each(rows, "routes_affected", None, "route_affected")


def each_operator(rows: DataFrame) -> DataFrame:
    return _each(rows, "operators_affected", "affected_operator_ref", "affected_operator_ref")


def load_priorities(rows: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Distinct priority codes."""
    codes = rows.select(F.col("incident_priority").alias("priority_code")).where(
        F.col("priority_code").isNotNull()).distinct()
    new = absent_rows(codes, existing, ["priority_code"])
    return assign_ids(new, ["priority_code"], "priority_id", max_id(existing, "priority_id")).select(
        "priority_id", "priority_code")


INCIDENT_COLUMNS = ["incident_id", "incident_num", "incident_version", "link", "summary",
                    "priority_id", "is_planned", "creation_time", "start_time", "end_time"]
INCIDENT_REQUIRED = ["incident_num", "incident_version", "link", "summary", "priority_id",
                     "is_planned", "creation_time", "start_time"]


INCIDENT_ORDER = ["_incomplete", "creation_time", "incident_num", "start_time", "end_time", "link", "summary",
                  "incident_priority", "is_planned"]


def load_incidents(rows: DataFrame, priority: DataFrame,
                   existing: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """One incident per version (the first complete message by creation
    time), priority looked up; a version without a complete message, or a message
    without a version, is rejected with a reason. ``rows`` is read more than
    once: hand in a written table."""
    cand = rows.select(
        incomplete().alias("_incomplete"),
        F.col("incident_number").alias("incident_num"), F.col("version").alias("incident_version"),
        F.col("info_link").alias("link"), "summary", "incident_priority",
        F.col("planned").alias("is_planned"), "creation_time", "start_time", "end_time")
    named = F.col("incident_version").isNotNull()
    first = first_per_key(cand.where(named), ["incident_version"], INCIDENT_ORDER)
    j = lookup(first.unionByName(cand.where(~named).distinct()).drop("_incomplete"), priority, "incident_priority", "priority_code", "priority_id")
    good, rejects = check_required(j, INCIDENT_REQUIRED)
    new = absent_rows(good, existing, ["incident_version"])
    out = assign_ids(new, ["incident_version"], "incident_id", max_id(existing, "incident_id"))
    return out.select(*INCIDENT_COLUMNS), rejects


def load_routes(rows: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Distinct route names."""
    names = each_route(rows).select(F.col("route_affected").alias("route_name")).where(
        F.col("route_name").isNotNull()).distinct()
    new = absent_rows(names, existing, ["route_name"])
    return assign_ids(new, ["route_name"], "route_id", max_id(existing, "route_id")).select(
        "route_id", "route_name")


def _link(pairs: DataFrame, left: str, right: str, id_col: str,
          existing: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    good, rejects = check_required(pairs, [left, right])
    distinct = good.select(left, right).distinct()
    new = absent_rows(distinct, existing, [left, right])
    out = assign_ids(new, ["incident_id", left if left != "incident_id" else right], id_col,
                     max_id(existing, id_col))
    return out.select(id_col, left, right), rejects


def link_routes(rows: DataFrame, incident: DataFrame, route: DataFrame,
                existing: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Distinct (route, incident) pairs."""
    p = lookup(each_route(rows), route, "route_affected", "route_name",
               "route_id")
    p = lookup(p, incident, "version", "incident_version", "incident_id")
    return _link(p, "route_id", "incident_id", "incident_route_link_id", existing)


def operator_by_code(operator: DataFrame) -> DataFrame:
    """Code -> one operator id (the smallest: codes are not unique)."""
    return operator.groupBy("operator_code").agg(F.min("operator_id").alias("operator_id"))


def link_operators(rows: DataFrame, incident: DataFrame, operator: DataFrame,
                   existing: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Distinct (operator, incident) pairs, operator found by code."""
    p = lookup(each_operator(rows), operator_by_code(operator),
               "affected_operator_ref", "operator_code", "operator_id")
    p = lookup(p, incident, "version", "incident_version", "incident_id")
    return _link(p, "operator_id", "incident_id", "incident_operator_link_id", existing)


# --- alerts (I15-I17) -------------------------------------------------------------

def alert_scope(messages: DataFrame, code_col: str = "affected_operator_ref") -> DataFrame:
    """Keep operators on the alert allow-list (a fixed 29-code list, so
    the semi join's broadcast side has a proven size)."""
    codes = messages.sparkSession.createDataFrame([(c,) for c in ALERT_OPERATOR_CODES],
                                                  f"{code_col} string")
    return messages.join(F.broadcast(codes), code_col, "left_semi")


def alert_text(operator_name: Column, summary: Column, priority: Column, routes: Column,
               start: Column, end: Column) -> Column:
    """I16: the alert text of one operator of one message."""
    train = "\U0001F684"
    bullets = F.array_join(F.transform(routes, lambda r: F.concat(F.lit("\n• "), r)), "")
    times = (F.when(start.isNotNull() & end.isNotNull(),
                    F.concat(F.lit("\n\nDuration: "), start.cast("string"), F.lit(" to "),
                             end.cast("string")))
             .when(start.isNotNull(), F.concat(F.lit("\n\nStart time: "), start.cast("string"),
                                               F.lit(" End time: Unknown")))
             .otherwise(F.lit("")))
    return F.concat(
        F.lit(f"\n\n{train} "), F.coalesce(operator_name, F.lit("None")), F.lit(f" incident {train}:"),
        F.lit("\n\nSummary: "), F.coalesce(summary, F.lit("None")),
        F.lit("\n\nPriority: "), F.coalesce(priority.cast("string"), F.lit("None")),
        F.lit("\n\nRoutes affected:"), F.coalesce(bullets, F.lit("")), times)


def alerts(good_messages: DataFrame) -> DataFrame:
    """I15 + I16: one alert per (message, allow-listed operator)."""
    per_op = good_messages.select("version", "summary", "incident_priority", "routes_affected",
                                  "start_time", "end_time",
                                  F.explode("operators_affected").alias("_op"))
    per_op = per_op.select("*", F.col("_op.affected_operator_ref").alias("affected_operator_ref"),
                           F.col("_op.affected_operator_name").alias("affected_operator_name"))
    scoped = alert_scope(per_op)
    return scoped.select(
        "version", F.col("affected_operator_ref").alias("operator_code"),
        alert_text(F.col("affected_operator_name"), F.col("summary"), F.col("incident_priority"),
                   F.col("routes_affected"), F.col("start_time"), F.col("end_time")).alias("message"))


MESSAGE_ORDER = ["creation_time", "incident_number", "start_time", "end_time", "info_link", "summary",
                 "incident_priority", "planned"]


def stored_alerts(good_messages: DataFrame, stored: DataFrame) -> DataFrame:
    """The alerts of the versions in ``stored`` (column version), from the
    message that was stored: the first of its version. One alert per (version,
    operator), however often and in whatever container a message names it."""
    mine = good_messages.drop("corrupt_record").where(~incomplete()).join(stored, "version", "left_semi")
    found = alerts(first_per_key(materialize(mine, "alert-messages"), ["version"], MESSAGE_ORDER))
    return found.groupBy("version", "operator_code").agg(F.min("message").alias("message"))


# --- the whole load (I14) -----------------------------------------------------------

class IncidentTables(NamedTuple):
    priority: DataFrame
    incident: DataFrame
    route_affected: DataFrame
    incident_route_link: DataFrame
    incident_operator_link: DataFrame


INCIDENT_KEYS = {"priority": ["priority_code"], "incident": ["incident_version"], "route_affected": ["route_name"],
                 "incident_route_link": ["route_id", "incident_id"],
                 "incident_operator_link": ["operator_id", "incident_id"]}


def load_all_incidents(rows: DataFrame, operator: DataFrame,
                       existing: Callable[[str], DataFrame | None],
                       append: Callable[[str, DataFrame], DataFrame],
                       reject: Callable[[str, DataFrame], None]) -> IncidentTables:
    """One batch of messages into the incident tables, in dependency order.

    ``existing(name)`` gives the stored table or None, ``append(name, rows)``
    stores new rows and returns the whole table, ``reject(name, rows)`` gets the
    rows that a load refuses. Batch and stream differ in these alone.
    """
    priority = append("priority", load_priorities(rows, existing("priority")))
    new, refused = load_incidents(rows, priority, existing("incident"))
    incident = append("incident", new)
    reject("incident", refused)
    route = append("route_affected", load_routes(rows, existing("route_affected")))
    new, refused = link_routes(rows, incident, route, existing("incident_route_link"))
    route_link = append("incident_route_link", new)
    reject("incident_route_link", refused)
    new, refused = link_operators(rows, incident, operator, existing("incident_operator_link"))
    operator_link = append("incident_operator_link", new)
    reject("incident_operator_link", refused)
    return IncidentTables(priority, incident, route, route_link, operator_link)
