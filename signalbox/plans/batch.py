"""The services batch as one chain: extraction, CSV, cleaning, load.

``batch_run`` takes captured station searches and service documents through
every step, each on what the step before it wrote: X01 pairs and flattens them,
K01 writes CSV and S04 reads it back, N08 cleans the rows against the published
codes, W10 loads the star schema. Each step's rows in are its rows out, set
aside (quarantined, dropped or rejected) and repeats of a key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.extract import FLAT_COLUMNS, relevant_fields
from ..operators.normalize import transform_services
from ..session import counted
from ..sinks.files import write_csv
from ..sources.json_docs import read_service_csv
from .services import Loaded, load_all

#: Which of several rows of one service is the first.
BATCH_ORDER = ["company_name", "service_type", "origin_crs", "planned_final_crs", "destination_reached_crs",
               "scheduled_arrival_datetime", "arrival_lateness", "cancellation_station_crs", "cancel_code"]
#: Rows of a compressed CSV file, which one task reads whole.
CSV_ROWS = 500_000


def batch_run(spark: SparkSession, journeys: DataFrame, services: DataFrame, valid_codes: DataFrame,
              code_rows: DataFrame, root: str) -> tuple[DataFrame, Loaded]:
    """Runs the chain into the folder ``root``; (step, rows_in, rows_out,
    set_aside, repeated) of each step, and what the load reports."""
    n = counted(journeys, lambda df: df.write.option("compression", "zstd").parquet(f"{root}/journeys"))
    journeys = spark.read.schema(journeys.schema).parquet(f"{root}/journeys")
    flat, quarantine = relevant_fields(journeys, services)
    out = counted(flat.select(*FLAT_COLUMNS), lambda df: write_csv(df, f"{root}/csv", compression="gzip", maxRecordsPerFile=CSV_ROWS))
    aside = counted(quarantine, lambda df: df.write.option("compression", "zstd").parquet(f"{root}/quarantine"))
    steps = [("extract", n, out, aside, 0)]
    read = read_service_csv(spark, f"{root}/csv")
    clean = counted(transform_services(read, valid_codes), lambda df: df.write.option("compression", "zstd").parquet(f"{root}/clean"))
    steps.append(("clean", out, clean, out - clean, 0))
    svc = spark.read.parquet(f"{root}/clean")
    done = load_all(spark, svc, code_rows, f"{root}/warehouse", f"{root}/rejects", order_cols=BATCH_ORDER)
    fact = done.steps["service_details"]
    steps.append(("load service_details", clean, fact["appended"], fact["rejected"], clean - fact["rows_in"] + fact["stored_before"]))
    for name in ("delay_details", "cancellation"):
        fact = done.steps[name]
        steps.append((f"load {name}", fact["rows_in"], fact["appended"], fact["rejected"], fact["stored_before"]))
    for step, rows_in, rows_out, aside, repeated in steps:
        if rows_in != rows_out + aside + repeated:
            raise RuntimeError(f"{step}: {rows_in} rows in, {rows_out} out, {aside} set aside, {repeated} repeated")
    return spark.createDataFrame(steps, "step string, rows_in long, rows_out long, set_aside long, repeated long"), done
