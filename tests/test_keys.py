"""Surrogate ids and insert-if-absent."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from signalbox.operators.keys import assign_ids, first_per_key, insert_if_absent


def test_assign_ids_equals_global_row_number(spark):
    keys = spark.range(0, 5000).select((F.col("id") * 7919 % 10007).cast("string").alias("k"),
                                       (F.col("id") % 3).alias("j")).distinct()
    got = assign_ids(keys, ["k", "j"], "kid", 10)
    expect = keys.withColumn("kid", F.row_number().over(Window.orderBy("k", "j")) + 10)
    assert got.count() == 5000
    assert got.exceptAll(expect.select(*got.columns)).count() == 0


def test_first_per_key_takes_smallest(spark):
    df = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("b", 5, "only")],
                               "k string, o int, v string")
    got = {r["k"]: r["v"] for r in first_per_key(df, ["k"], ["o"]).collect()}
    assert got == {"a": "early", "b": "only"}


def test_insert_if_absent_is_idempotent(spark):
    batch = spark.createDataFrame([("x", 1), ("y", 1), ("x", 2)], "name string, o int")
    first = insert_if_absent(batch, None, ["name"], ["o"], id_col="nid")
    assert sorted((r["nid"], r["name"], r["o"]) for r in first.collect()) == [(1, "x", 1), (2, "y", 1)]
    again = insert_if_absent(batch, first, ["name"], ["o"], id_col="nid")
    assert again.count() == 0
    more = spark.createDataFrame([("z", 0), ("x", 0)], "name string, o int")
    added = insert_if_absent(more, first, ["name"], ["o"], id_col="nid")
    assert [(r["nid"], r["name"]) for r in added.collect()] == [(3, "z")]


def test_many_repeated_keys_are_combined_at_once(spark, monkeypatch):
    """With many repeated keys no join shuffles the rows before they are combined."""
    from signalbox.operators import keys as K
    rows = [(k, o, None if o == 1 else f"{k}-{o}", t) for k in range(40) for o in (3, 1, 2) for t in (5, None)]
    df = spark.createDataFrame(rows + [(None, 2, "b", 1), (None, 1, "a", 1)], "k int, o int, v string, t int")
    few = K.first_per_key(df, ["k"], ["o"])
    monkeypatch.setattr(K, "MANY_REPEATED", 10)
    many = K.first_per_key(df, ["k"], ["o"])
    want = {(k, 1, None, None) for k in range(40)} | {(None, 1, "a", 1)}
    assert {tuple(r) for r in few.collect()} == want == {tuple(r) for r in many.collect()}
    assert "Join" not in many._jdf.queryExecution().optimizedPlan().toString()


def test_rows_that_stand_alone_pass_beside_many_repeated_keys(spark, monkeypatch):
    """With many repeated keys only those that may repeat are combined, not every row."""
    from signalbox.operators import keys as K
    rows = [(f"k{k}", o, f"{k}-{o}") for k in range(40) for o in (3, 1, 2)] + [(f"s{k}", 9, None) for k in range(400)]
    df = spark.createDataFrame(rows + [(None, 2, "b"), (None, 1, "a")], "k string, o int, v string")
    monkeypatch.setattr(K, "MANY_REPEATED", 10)
    out = K.first_per_key(df, ["k"], ["o"])
    want = [(f"k{k}", 1, f"{k}-1") for k in range(40)] + [(f"s{k}", 9, None) for k in range(400)] + [(None, 1, "a")]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Union") and plan.count("Aggregate") == 1 and "Filter pythonUDF" in plan, plan


def test_numbering_shuffles_only_stored_columns(spark):
    """The columns that order repeated rows do not go through the numbering."""
    from signalbox.operators import warehouse as W
    from signalbox.sources.binding import SERVICE_ORDER
    types = {"l_partkey": "long", "l_suppkey": "long", "arrival_lateness": "int", "scheduled_arrival_datetime": "timestamp_ntz"}
    extra = [c for c in SERVICE_ORDER if c not in ("scheduled_arrival_datetime", "arrival_lateness", "cancel_code")]
    svc = spark.sql("SELECT 'S1' service_uid, timestamp_ntz'2020-01-02 00:00:00' origin_run_datetime, 'c' company_name, 'bus' service_type, "
                    "'N01' origin_crs, 'N02' planned_final_crs, timestamp_ntz'2020-01-03 00:00:00' scheduled_arrival_datetime, 4 arrival_lateness, "
                    "'B' cancel_code, " + ", ".join(f"CAST(1 AS {types.get(c, 'double')}) {c}" for c in extra))
    one = lambda sql: spark.sql("SELECT " + sql)
    seen, assign = [], W.assign_ids
    W.assign_ids = lambda df, *a, **k: (seen.append(df.columns), assign(df, *a, **k))[1]
    try:
        out, _ = W.load_service_details(svc, one("1L company_id, 'c' company_name"), one("1L service_type_id, 'bus' service_type_name"),
                                        spark.sql("SELECT * FROM VALUES (1L, 'N01'), (2L, 'N02') AS t(station_id, crs)"))
        late, _ = W.load_delays(svc, out)
    finally:
        W.assign_ids = assign
    assert seen == [W.SERVICE_DETAIL_COLUMNS[1:], ["service_details_id", "arrival_lateness", "scheduled_arrival_datetime"]]
    assert [r.service_details_id for r in out.collect()] == [1] and [r.arrival_lateness for r in late.collect()] == [4]
