"""Golden values of the scalar rules (cleaning, timestamps, codes)."""

import datetime as dt

from pyspark.sql import functions as F

from signalbox.functions import cleaning as C
from signalbox.functions import timestamps as TS
from signalbox.operators import normalize as N


def _col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_timestamp_from_date_and_time(spark):
    df = spark.createDataFrame(
        [("2023-09-05", "123045"), ("2023-09-06", "081530"), ("2023-09-08", "153024"),
         ("not-a-date", "123045"), ("2023-09-05", "not-a-time"), ("2023-09-05", "250000")],
        "d string, t string")
    got = [r[0] for r in df.select(TS.date_time_to_timestamp("d", "t")).collect()]
    assert got == [dt.datetime(2023, 9, 5, 12, 30, 45), dt.datetime(2023, 9, 6, 8, 15, 30),
                   dt.datetime(2023, 9, 8, 15, 30, 24), None, None, None]


def test_lost_leading_zeros(spark):
    df = spark.createDataFrame([(t,) for t in ["000500", "500", "1000", "143200.0"]], "t string")
    got = [r[0] for r in df.select(TS.date_time_to_timestamp(F.lit("2023-09-10"), "t")).collect()]
    assert [g.time() for g in got] == [dt.time(0, 5), dt.time(0, 5), dt.time(0, 10), dt.time(14, 32)]


def test_hhmmss_epoch(spark):
    got = _col(spark, ["000001", "bad"], lambda c: TS.hhmmss_epoch(c, "1970-01-02"))
    assert got == [86401, None]


def test_integers_or_null(spark):
    got = _col(spark, ["12", "-5", "cancelled at origin", "5.0", "5.5", "1e3", "", None],
               C.integers_or_null)
    assert got == [12, -5, None, 5, None, None, None, None]


def test_three_char_code(spark):
    got = _col(spark, ["ABC", "0", "FUDGE", " abc\t", "ab", "", None], C.three_char_code)
    assert got == ["ABC", None, None, "ABC", None, None, None]


def test_check_three_chars_drop_and_null(spark):
    df = spark.createDataFrame([("ABC",), ("0",), ("FUDGE",)], "crs string")
    assert [r[0] for r in N.check_three_chars(df, "crs", True).collect()] == ["ABC"]
    assert [r[0] for r in N.check_three_chars(df, "crs", False).collect()] == ["ABC", None, None]


def test_valid_codes(spark):
    codes = spark.createDataFrame([(c,) for c in ["AA", "AC", "AD", "ZZ"]], "Code string")
    df = spark.createDataFrame([(1, "AA"), (2, "tabbycat"), (3, "ZZ"), (4, " aa "), (5, None)],
                               "i int, cancel_code string")
    got = [r["cancel_code"] for r in N.valid_codes(df, "cancel_code", codes).orderBy("i").collect()]
    assert got == ["AA", None, "ZZ", "AA", None]


def test_iso_wallclock(spark):
    got = _col(spark, ["2023-09-10T10:15:30.123+01:00", "2023-09-10T10:15:30Z", "junk", None],
               TS.iso_wallclock)
    assert got == [dt.datetime(2023, 9, 10, 10, 15, 30), dt.datetime(2023, 9, 10, 10, 15, 30),
                   None, None]


def test_routes_split(spark):
    got = _col(spark, ["<p>A to B / C to D</p>", None], C.split_routes)
    assert got == [["A to B", "C to D"], None]


def test_coercions(spark):
    assert _col(spark, ["false", "true", "maybe"], C.boolean_or_null) == [False, True, None]
    assert _col(spark, ["80%", "n/a", " 75 "], C.percent_or_null) == [80.0, None, 75.0]
    assert _col(spark, ["2", " 3 ", "x"], C.int_or_null) == [2, 3, None]


def test_selection_has_no_cap_and_both_forms_agree(spark):
    from signalbox.operators.analytics import filter_selected
    view = spark.createDataFrame([(f"S{i:02d}", i) for i in range(60)], "origin_station_name string, n int")
    names = [f"S{i:02d}" for i in range(45, 5, -1)]
    chosen = spark.createDataFrame([(n,) for n in names] * 2, "name string")
    by_list = filter_selected(view, "origin_station_name", names).collect()
    by_frame = filter_selected(view, "origin_station_name", chosen).collect()
    assert len(by_list) == 40 and sorted(by_list) == sorted(by_frame)
    assert filter_selected(view, "origin_station_name", []).count() == 60
