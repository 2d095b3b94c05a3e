"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total Spark seconds), "unit",
"queries": {name: sec}, "duckdb": {name: sec}, "sf"}. Each Spark query is
forced with a no-op write (full computation, nothing collected). Rendering
the captured documents is timed as ``render_documents`` and the warehouse load
(W10) as ``services_load``, both first and once; dashboard and
report queries then read the stored tables, as in production. DuckDB runs
the same queries' oracle SQL on the same parquet files, single node, for
reference.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "avg_delay_station_top", "wide_services", "wide_services_day", "kpi_totals",
    "cancel_code_frequency", "reached_pct_company", "daily_report",
    "fact_service_details", "insert_if_absent", "service_transform", "service_flatten",
    "incident_flatten", "fact_incident", "link_incident_route",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from signalbox.plans import registry
    from signalbox.plans.captures import capture_all
    from signalbox.plans.store import services_store
    from signalbox.session import get_session

    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                        extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    qs = registry.queries()
    times: dict[str, float] = {}

    t0 = time.time()
    capture_all(spark, sf_dir)
    times["render_documents"] = round(time.time() - t0, 3)
    t0 = time.time()
    services_store(spark, sf_dir)
    times["services_load"] = round(time.time() - t0, 3)
    for name in names:
        t0 = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    spark.stop()

    duck: dict[str, float] = {}
    try:
        import duckdb
        from signalbox.plans.oracle import SERVICES_CTE
        sqls = registry.oracle_sql()
        con = duckdb.connect()
        con.execute(f"SET threads TO {cpus}")
        for t in ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        t0 = time.time()
        con.execute(SERVICES_CTE + "\nSELECT count(*) FROM wide").fetchall()
        duck["services_load"] = round(time.time() - t0, 3)
        for name in names:
            if name in sqls:
                t0 = time.time()
                con.execute(sqls[name]).fetchall()
                duck[name] = round(time.time() - t0, 3)
    except Exception as e:  # noqa: BLE001 - the reference timing is optional
        duck["error"] = str(e)[:200]

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "duckdb": duck,
                      "sf": float(sf.group(1)) if sf else sf_dir}))


if __name__ == "__main__":
    main()
