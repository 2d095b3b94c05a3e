"""Services star schema as one lazy plan, or loaded into storage."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import warehouse as W
from ..operators.keys import check_unique, repeated_keys
from ..sources.binding import cancel_code_rows, service_rows
from ..session import counted, materialize, path_exists, work_path
from ..sources.tables import Tables

TABLES = ("cancel_code", "company", "station", "service_type", "service_details",
          "delay_details", "cancellation")
FACTS = ("service_details", "delay_details", "cancellation")


def run_month(run_date):
    """Storage partition of the facts: first day of the run month."""
    return F.trunc(run_date, "month")


@dataclass
class ServiceTables:
    cancel_code: DataFrame
    company: DataFrame
    station: DataFrame
    service_type: DataFrame
    service_details: DataFrame
    delay_details: DataFrame
    cancellation: DataFrame

    def items(self):
        return [(f.name, getattr(self, f.name)) for f in fields(self)]


class LazyStarSchema:
    """The seven tables of one batch loaded into empty targets; each table is
    built on first access (id numbering runs a job), so asking for one
    dimension does not load the facts."""

    def __init__(self, spark: SparkSession, svc: DataFrame, codes: DataFrame):
        self.spark, self._svc_plan, self.codes = spark, svc, codes

    @cached_property
    def svc(self):
        """The batch, written once to the shared folder: every table reads it."""
        return materialize(self._svc_plan, "svc")

    @cached_property
    def repeated(self):
        """The batch's repeated keys, found once for the three facts."""
        return repeated_keys(self.svc, ["service_uid", "origin_run_datetime"])

    @cached_property
    def cancel_code(self):
        return W.load_cancel_codes(self.codes)

    @cached_property
    def company(self):
        return W.load_companies(self.svc)

    @cached_property
    def station(self):
        return W.load_stations(self.svc)[0]

    @cached_property
    def service_type(self):
        return W.service_type_seed(self.spark)

    @cached_property
    def service_details(self):
        return W.load_service_details(self.svc, self.company, self.service_type, self.station, repeated=self.repeated)[0]

    @cached_property
    def delay_details(self):
        return W.load_delays(self.svc, self.service_details, repeated=self.repeated)[0]

    @cached_property
    def cancellation(self):
        return W.load_cancellations(self.svc, self.service_details, self.station,
                                    self.cancel_code, repeated=self.repeated)[0]

    def items(self):
        return [(name, getattr(self, name)) for name in TABLES]


def star_schema(spark: SparkSession, svc: DataFrame, codes: DataFrame) -> LazyStarSchema:
    return LazyStarSchema(spark, svc, codes)


def star_schema_from_tables(t: Tables) -> LazyStarSchema:
    return star_schema(t.spark, service_rows(t), cancel_code_rows(t))


#: Natural key of each stored table.
KEYS = {"cancel_code": ["code"], "company": ["company_name"], "station": ["crs"],
        "service_type": ["service_type_name"], "service_details": ["service_uid", "run_date"],
        "delay_details": ["service_details_id"], "cancellation": ["service_details_id"]}


def open_star_schema(spark: SparkSession, root: str) -> ServiceTables:
    return ServiceTables(**{name: spark.read.parquet(f"{root}/{name}") for name in TABLES})


class Loaded(dict):
    """Rows appended per table; ``steps`` has what went into each load: rows in,
    appended, rejected, and stored before or repeated within the batch."""

    def __init__(self):
        super().__init__()
        self.steps: dict[str, dict[str, int]] = {}


def load_all(spark: SparkSession, svc: DataFrame, codes: DataFrame, root: str,
             rejects_root: str | None = None, order_cols: Sequence[str] = W.SERVICE_ORDER,
             states: bool = False) -> Loaded:
    """Load one batch into the tables under ``root`` in dependency order.

    Dimensions are written first and read back, so the fact loads see stored
    (statistics-carrying) dimensions. Facts are partitioned by run month
    (``run_month``) so the day view prunes to one month in every fact scan. The
    batch is written once to the shared folder, and its repeated keys are found
    once for all facts. Re-running with the same batch appends nothing; a target
    that repeats a key is refused. Returns rows appended per table, counted by
    the writes themselves; a load whose rows in are not what came out of it
    fails. ``order_cols`` says which of rows with one key is the first. With
    ``states`` the month states of ``plans.month_states`` are brought up to date.
    """
    def existing(name):
        p = f"{root}/{name}"
        found = spark.read.parquet(p) if path_exists(spark, p) else None
        prune = ("run_month", months) if name in FACTS and found is not None else None
        check_unique(found, KEYS[name], name, prune)
        return found

    def write(name, partitioned):
        def to(df):
            w = df.write.mode("append")
            (w.partitionBy("run_month") if partitioned else w).parquet(f"{root}/{name}")
        return to

    counts = Loaded()
    svc = materialize(svc, "load-batch")
    again = {"repeated": repeated_keys(svc, ["service_uid", "origin_run_datetime"]), "order_cols": order_cols}
    months = materialize(svc.select(run_month(F.col("origin_run_datetime")).alias("run_month")).distinct(), "load-months")

    def step(name, new, rejects=None, rows_in=None, fresh=False):
        partitioned = name in FACTS
        if partitioned:
            # Fact ids follow run date, and each task holds a contiguous id
            # range (from the numbering), so a task writes one or two month
            # folders: no extra shuffle for the file layout.
            new = new.sortWithinPartitions("run_month", new.columns[0])
        counts[name] = counted(new, write(name, partitioned))
        refused = 0
        if rejects is not None and rejects_root:
            refused = counted(rejects, lambda df: df.write.mode("append").parquet(f"{rejects_root}/{name}"))
        if rows_in is not None and rejects_root:
            before = rows_in - counts[name] - refused
            if before < 0 or fresh and before:
                raise RuntimeError(f"{name}: {rows_in} rows in, {counts[name]} appended, {refused} rejected")
            counts.steps[name] = {"rows_in": rows_in, "appended": counts[name], "rejected": refused, "stored_before": before}
        # an empty partitioned table has no file to take the schema from
        return spark.read.schema(new.schema).parquet(f"{root}/{name}")

    prev = existing("cancel_code")
    cancel_code = step("cancel_code", W.load_cancel_codes(codes, prev))
    prev = existing("company")
    company = step("company", W.load_companies(svc, prev))
    prev = existing("station")
    station = step("station", *W.load_stations(svc, prev))
    prev = existing("service_type")
    service_type = step("service_type", W.absent_rows(
        W.service_type_seed(spark), prev, ["service_type_name"]))
    seen = {}

    def stage(df):
        path = work_path(spark, "load-candidates")
        seen["in"] = counted(df, lambda rows: rows.write.option("compression", "zstd").parquet(path))
        return spark.read.schema(df.schema).parquet(path)
    prev = existing("service_details")
    new, rejects = W.load_service_details(svc, company, service_type, station, prev, stage=stage, **again)
    sd = step("service_details", new.withColumn("run_month", run_month(F.col("run_date"))), rejects, seen["in"], prev is None)
    keys = sd.select("service_details_id", "service_uid", "run_date", "run_month")
    prev = existing("delay_details")
    new, rejects = W.load_delays(svc, keys, prev, stage=stage, with_month=True, **again)
    step("delay_details", new, rejects, seen["in"], prev is None)
    prev = existing("cancellation")
    new, rejects = W.load_cancellations(svc, keys, station, cancel_code, prev, stage=stage, with_month=True, **again)
    step("cancellation", new, rejects, seen["in"], prev is None)
    if states and any(counts[f] for f in FACTS):
        from .month_states import refresh
        refresh(spark, root, months)
    return counts
