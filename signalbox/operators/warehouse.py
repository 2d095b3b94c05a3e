"""Services star schema loads.

Every load is: candidate rows from the batch -> natural-key lookups (left
joins to unique-key dimensions) -> required-column check that splits good
rows from rejects -> insert-if-absent against what is already stored.
Each function returns the rows to append; ``load_all`` in plans writes them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import SERVICE_TYPES
from ..sources.binding import SERVICE_ORDER
from .keys import absent_rows, assign_ids, first_per_key, insert_if_absent, max_id

STATION_PAIRS = [
    ("origin_crs", "origin_stn_name"),
    ("planned_final_crs", "planned_final_destination"),
    ("destination_reached_crs", "destination_reached_name"),
    ("cancellation_station_crs", "cancellation_station_name"),
]


def check_required(df: DataFrame, required: Sequence[str],
                   reason_col: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """Split into rows with all ``required`` columns set, and rejects with a
    reason naming the missing columns (NOT NULL / foreign-key misses)."""
    missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    good = df.where(ok)
    rejects = df.where(~ok).withColumn(reason_col, F.concat(F.lit("missing: "), missing))
    return good, rejects


def lookup(df: DataFrame, dim: DataFrame, left_key: str | Sequence[str],
           dim_key: str | Sequence[str], id_col: str, as_col: str | None = None) -> DataFrame:
    """Natural key -> surrogate id as a left join to a unique-key dimension.

    The join strategy is left to the planner: dimensions read from storage
    carry size statistics and are broadcast when under the threshold, larger
    ones shuffle.
    """
    lk = [left_key] if isinstance(left_key, str) else list(left_key)
    dk = [dim_key] if isinstance(dim_key, str) else list(dim_key)
    out = as_col or id_col
    tmp = [f"_lk{i}_{out}" for i in range(len(dk))]
    d = dim.select(*[F.col(k).alias(t) for k, t in zip(dk, tmp)], F.col(id_col).alias(out))
    cond = None
    for l, t in zip(lk, tmp):
        c = df[l] == d[t]
        cond = c if cond is None else cond & c
    return df.join(d, cond, "left").drop(*tmp)


# --- dimensions -----------------------------------------------------------

def service_type_seed(spark: SparkSession) -> DataFrame:
    """Seed dimension: bus, train with ids 1, 2."""
    rows = [(i + 1, name) for i, name in enumerate(SERVICE_TYPES)]
    return spark.createDataFrame(rows, "service_type_id long, service_type_name string")


def load_cancel_codes(codes: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Cancel codes (code, reason, abbreviation), unique on code."""
    src = codes.select("code", "reason", "abbreviation").where(F.col("code").isNotNull())
    new = insert_if_absent(src, existing, ["code"], ["reason", "abbreviation"],
                           id_col="cancel_code_id")
    return new.select("cancel_code_id", "code", "reason", "abbreviation")


def load_companies(svc: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Distinct company names."""
    names = svc.select("company_name").where(F.col("company_name").isNotNull()).distinct()
    new = absent_rows(names, existing, ["company_name"])
    return assign_ids(new, ["company_name"], "company_id",
                      max_id(existing, "company_id")).select("company_id", "company_name")


def station_rows(svc: DataFrame) -> DataFrame:
    """The four (crs, name) pairs of every row stacked in one scan; one name
    per code (the smallest, so the choice does not depend on row order)."""
    pairs = F.explode(F.array(*[F.struct(F.col(c).alias("crs"), F.col(n).alias("station_name"))
                                for c, n in STATION_PAIRS]))
    stacked = svc.select(pairs.alias("p")).select("p.crs", "p.station_name")
    return (stacked.where(F.col("crs").isNotNull())
            .groupBy("crs").agg(F.min("station_name").alias("station_name")))


def load_stations(svc: DataFrame, existing: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Station dimension rows to append, and rejects (no name)."""
    good, rejects = check_required(station_rows(svc), ["station_name"])
    new = absent_rows(good, existing, ["crs"])
    out = assign_ids(new, ["crs"], "station_id", max_id(existing, "station_id"))
    return out.select("station_id", "crs", "station_name"), rejects


# --- facts ----------------------------------------------------------------

def _staged(df: DataFrame, stage) -> DataFrame:
    """Apply the caller's staging (e.g. a written table) to the looked-up
    candidates, which the good / reject split and the id numbering all read."""
    return stage(df) if stage is not None else df


def _month_prune(existing: DataFrame | None, batch: DataFrame):
    """Partition pruning for insert-if-absent on a stored fact: the months the
    batch's run dates fall in (stored facts are partitioned by ``run_month``)."""
    if existing is None or "run_month" not in existing.columns:
        return None
    run = "run_date" if "run_date" in batch.columns else "origin_run_datetime"
    return ("run_month", batch.select(F.trunc(run, "month").alias("run_month")))


SERVICE_DETAIL_ID_ORDER = ["run_date", "service_uid"]
SERVICE_DETAIL_COLUMNS = ["service_details_id", "service_uid", "company_id", "service_type_id",
                          "origin_station_id", "destination_station_id", "run_date"]


def service_detail_candidates(svc: DataFrame, company: DataFrame, service_type: DataFrame,
                              station: DataFrame,
                              order_cols: Sequence[str] = SERVICE_ORDER, stage=None, **repeats
                              ) -> tuple[DataFrame, DataFrame]:
    """First row per (service_uid, run date) with its four lookups; good /
    rejects. ``repeated``, if given, is passed on to ``first_per_key``."""
    cols = ["service_uid", "origin_run_datetime", "company_name", "service_type",
            "origin_crs", "planned_final_crs", *order_cols]
    first = first_per_key(svc.select(*dict.fromkeys(cols)), ["service_uid", "origin_run_datetime"],
                          order_cols, **repeats)
    j = lookup(first, company, "company_name", "company_name", "company_id")
    j = lookup(j, service_type, "service_type", "service_type_name", "service_type_id")
    j = lookup(j, station, "origin_crs", "crs", "station_id", "origin_station_id")
    j = lookup(j, station, "planned_final_crs", "crs", "station_id", "destination_station_id")
    j = _staged(j.withColumnRenamed("origin_run_datetime", "run_date"), stage)
    return check_required(j, ["service_uid", "run_date", "company_id", "service_type_id",
                              "origin_station_id", "destination_station_id"])


def load_service_details(svc: DataFrame, company: DataFrame, service_type: DataFrame,
                         station: DataFrame, existing: DataFrame | None = None, stage=None,
                         order_cols: Sequence[str] = SERVICE_ORDER, **repeats
                         ) -> tuple[DataFrame, DataFrame]:
    """service_details rows to append (unique on service_uid, run_date)."""
    good, rejects = service_detail_candidates(svc, company, service_type, station, order_cols, stage, **repeats)
    new = absent_rows(good, existing, ["service_uid", "run_date"], _month_prune(existing, good))
    # Ids follow load order (run date, then uid), as daily appends number
    # them; id ranges are then also run-month ranges, so the partitioned
    # write needs no second shuffle.
    # Only what is stored goes along: the order columns end here.
    out = assign_ids(new.select(*SERVICE_DETAIL_COLUMNS[1:]), SERVICE_DETAIL_ID_ORDER, "service_details_id",
                     max_id(existing, "service_details_id"))
    return out.select(*SERVICE_DETAIL_COLUMNS), rejects


def _month(wanted: bool) -> list:
    """The run month of a fact's candidate row, as the stored facts are partitioned."""
    return [F.trunc("origin_run_datetime", "month").alias("run_month")] if wanted else []


def _fact_first(svc: DataFrame, keep, cols: Sequence[str],
                order_cols: Sequence[str], **repeats) -> DataFrame:
    rows = svc.where(keep).select(*dict.fromkeys(["service_uid", "origin_run_datetime",
                                                  *cols, *order_cols]))
    return first_per_key(rows, ["service_uid", "origin_run_datetime"], order_cols, joined=True, **repeats)


def load_delays(svc: DataFrame, service_details: DataFrame,
                existing: DataFrame | None = None,
                order_cols: Sequence[str] = SERVICE_ORDER, stage=None,
                with_month: bool = False, **repeats) -> tuple[DataFrame, DataFrame]:
    """Lateness > 0, fact id by (uid, run date), unique on the fact id;
    ``with_month`` adds the storage partition ``run_month``."""
    first = _fact_first(svc, F.col("arrival_lateness") > 0,
                        ["arrival_lateness", "scheduled_arrival_datetime"], order_cols, **repeats)
    j = lookup(first, service_details, ["service_uid", "origin_run_datetime"],
               ["service_uid", "run_date"], "service_details_id")
    j = _staged(j, stage)
    good, rejects = check_required(j, ["service_details_id"])
    new = absent_rows(good, existing, ["service_details_id"], _month_prune(existing, first))
    new = new.select("service_details_id", "arrival_lateness", "scheduled_arrival_datetime", *_month(with_month))
    out = assign_ids(new, ["service_details_id"], "delay_details_id",
                     max_id(existing, "delay_details_id"))
    return out.select("delay_details_id", "service_details_id",
                      F.col("arrival_lateness").cast("int").alias("arrival_lateness"),
                      F.col("scheduled_arrival_datetime").alias("scheduled_arrival"),
                      *(["run_month"] if with_month else [])), rejects


def load_cancellations(svc: DataFrame, service_details: DataFrame, station: DataFrame,
                       cancel_code: DataFrame, existing: DataFrame | None = None,
                       order_cols: Sequence[str] = SERVICE_ORDER, stage=None,
                       with_month: bool = False, **repeats) -> tuple[DataFrame, DataFrame]:
    """Rows with a cancel code; fact id, two stations and the code id;
    ``with_month`` adds the storage partition ``run_month``."""
    first = _fact_first(svc, F.col("cancel_code").isNotNull(),
                        ["cancellation_station_crs", "destination_reached_crs", "cancel_code"],
                        order_cols, **repeats)
    j = lookup(first, service_details, ["service_uid", "origin_run_datetime"],
               ["service_uid", "run_date"], "service_details_id")
    j = lookup(j, station, "cancellation_station_crs", "crs", "station_id", "cancelled_station_id")
    j = lookup(j, station, "destination_reached_crs", "crs", "station_id", "reached_station_id")
    j = _staged(lookup(j, cancel_code, "cancel_code", "code", "cancel_code_id"), stage)
    good, rejects = check_required(j, ["service_details_id", "cancelled_station_id",
                                       "reached_station_id", "cancel_code_id"])
    new = absent_rows(good, existing, ["service_details_id"], _month_prune(existing, first))
    new = new.select("service_details_id", "cancelled_station_id", "reached_station_id", "cancel_code_id", *_month(with_month))
    out = assign_ids(new, ["service_details_id"], "cancellation_id",
                     max_id(existing, "cancellation_id"))
    return out.select("cancellation_id", "service_details_id", "cancelled_station_id",
                      "reached_station_id", "cancel_code_id", *(["run_month"] if with_month else [])), rejects
