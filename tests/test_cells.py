"""Cell cleaning, bands and calendar expressions on small literals."""

import datetime as dt

import pandas as pd
from pandas.tseries.holiday import USFederalHolidayCalendar
from pyspark.sql import functions as F

from velomet.functions.bands import band
from velomet.functions.calendar import clock_hour, is_federal_holiday
from velomet.functions.flags import clip, condition_label, degree_days, three_valued
from velomet.functions.geo import great_circle_meters
from velomet.functions.text import (
    coerce_cells,
    name_key,
    observation_cells,
    observation_number,
    present_weather_flag,
)
from velomet.functions.units import steady_round
from velomet.operators.weather_hourly import local_time


def column(spark, values, kind, *expressions):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    rows = df.select("i", *[e.alias(f"x{k}") for k, e in enumerate(expressions)]).orderBy("i").collect()
    return [row[1] if len(expressions) == 1 else tuple(row)[1:] for row in rows]


def cells(spark, values, kind):
    df = spark.createDataFrame(list(enumerate(values)), "i int, c string")
    return [r.c for r in coerce_cells(df, {"c": kind}).orderBy("i").collect()]


def test_text_cells(spark):
    raw = ["497.0", "7079.05", "\\N", "NULL", "  ", " HB102 ", None, "\tA B\n"]
    assert cells(spark, raw, "string") == [
        "497", "7079.05", None, None, None, "HB102", None, "A B",
    ]


def test_number_cells(spark):
    raw = ["438", "12.0", "12.7", "1d", "junk", "\\N", " 7 ", "1e3", "-3", ""]
    assert cells(spark, raw, "bigint") == [
        438, 12, None, None, None, None, 7, 1000, -3, None,
    ]
    raw = ["1985.0", "\\N", "40.737", ".5", "0x10", "nan", "1-2", "Infinity"]
    assert cells(spark, raw, "double") == [1985.0, None, 40.737, 0.5, None, None, None, None]


def test_time_cells(spark):
    raw = [
        "2016-04-01 00:00:30", "2016-04-01 00:00:30.0", "4/1/2016 0:00:30", "9/1/2014 0:00",
        "2024-07-15T14:51:00", "2024-03-10 02:30:00", "junk", "2016", "2016-04",
    ]
    assert cells(spark, raw, "timestamp_ntz") == [
        dt.datetime(2016, 4, 1, 0, 0, 30), dt.datetime(2016, 4, 1, 0, 0, 30), dt.datetime(2016, 4, 1, 0, 0, 30),
        dt.datetime(2014, 9, 1), dt.datetime(2024, 7, 15, 14, 51), dt.datetime(2024, 3, 10, 2, 30), None, None, None,
    ]


def test_short_years_and_halves_of_the_day(spark):
    raw = ["1/1/15 0:01", "12/31/68 23:59", "7/4/69 1:02:03", "01/02/2015 03:04:05 PM", "1/2/2015 12:30 am", "1/2/2015 12:30 PM",
           "2016-04-01 07:00:00 PM", "1/2/2015 13:00 PM", "1/2/155 3:00", "PM"]
    assert cells(spark, raw, "timestamp_ntz") == [
        dt.datetime(2015, 1, 1, 0, 1), dt.datetime(2068, 12, 31, 23, 59), dt.datetime(1969, 7, 4, 1, 2, 3), dt.datetime(2015, 1, 2, 15, 4, 5),
        dt.datetime(2015, 1, 2, 0, 30), dt.datetime(2015, 1, 2, 12, 30), dt.datetime(2016, 4, 1, 19, 0), None, None, None,
    ]


def test_observation_values(spark):
    raw = ["5.6", "T", "0.805s", "3.219V", "VRB", "", "*", None, "NA", " 7.2 ", "1VV"]
    df = observation_cells(spark.createDataFrame(list(enumerate(raw)), "i int, c string"), ["c"])
    got = df.select("i", observation_number(F.col("c"), True), observation_number(F.col("c"))).orderBy("i").collect()
    assert [g[1] for g in got] == [5.6, 0.0, None, 3.219, None, None, None, None, None, 7.2, None]
    assert got[1][2] is None


def test_present_weather_flags(spark):
    texts = ["-RA:02 |RA |RA", "BR:1 |", "-SN:03 |SN", None, "TS:7 |+RA |FG", "HZ:7"]
    flags = [present_weather_flag(F.col("c"), f) for f in ("is_raining", "is_snowing", "is_foggy", "is_thunder", "is_hazy")]
    assert column(spark, texts, "string", *flags) == [
        (1, 0, 0, 0, 0), (0, 0, 0, 0, 0), (0, 1, 0, 0, 0), (0, 0, 0, 0, 0), (1, 0, 1, 1, 0), (0, 0, 0, 0, 1),
    ]


def test_name_key(spark):
    assert column(spark, ["  W 42\t St ", "w 42 st", None], "string", name_key(F.col("c"))) == ["W 42 ST", "W 42 ST", None]


def test_bands_are_right_closed(spark):
    values = [-100.0, 31.9, 32.0, 32.1, 85.0, 85.1, 200.0, 201.0, None]
    assert column(spark, values, "double", band(F.col("c"), [-100, 32, 85, 200], ["a", "b", "c"])) == [
        None, "a", "a", "b", "b", "c", "c", None, None,
    ]


def test_steady_round_on_ties(spark):
    values = [1.005, 0.125, -0.125, 0.1 + 0.2, 2.675, None, 1e30]
    assert column(spark, values, "double", steady_round(F.col("c"), 2)) == [1.01, 0.13, -0.13, 0.3, 2.68, None, 1e30]


def test_three_valued_rules(spark):
    got = column(
        spark, [None, 0.0, 2.0], "double",
        three_valued(F.col("c"), F.col("c") > 0), clip(F.col("c"), 0.0, 1.25), degree_days(F.col("c"), True),
    )
    assert got == [(None, None, None), (0, 0.0, 65.0), (1, 1.25, 63.0)]


def test_condition_label(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (0, 0), (None, None), (None, 0)], "s int, r int")
    assert [r[0] for r in df.select(condition_label(F.col("s"), F.col("r"))).collect()] == ["Snowy", "Rainy", "Dry", None, "Dry"]


def test_holidays_match_the_calendar(spark):
    days = pd.date_range("1980-01-01", "2045-12-31", freq="D")
    want = set(USFederalHolidayCalendar().holidays(days[0], days[-1]).date)
    df = spark.sql("SELECT explode(sequence(date'1980-01-01', date'2045-12-31')) AS d")
    got = {r.d for r in df.filter(is_federal_holiday(F.col("d")) == 1).collect()}
    assert got == want
    assert dt.date(2021, 12, 31) in got and dt.date(2020, 6, 19) not in got


def test_local_time_over_clock_changes(spark):
    stamps = [
        dt.datetime(2024, 1, 5, 7, 51), dt.datetime(2024, 7, 5, 7, 51), dt.datetime(2024, 11, 3, 0, 51),
        dt.datetime(2024, 11, 3, 1, 51), dt.datetime(2024, 3, 10, 2, 51),
    ]
    assert column(spark, stamps, "timestamp_ntz", local_time(F.col("c"))) == [
        dt.datetime(2024, 1, 5, 7, 51), dt.datetime(2024, 7, 5, 8, 51), dt.datetime(2024, 11, 3, 1, 51),
        dt.datetime(2024, 11, 3, 1, 51), dt.datetime(2024, 3, 10, 3, 51),
    ]


def test_clock_hour_ignores_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = column(spark, [dt.datetime(2024, 3, 10, 2, 30)], "timestamp_ntz", clock_hour(F.col("c")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [dt.datetime(2024, 3, 10, 2, 0)]


def test_distance(spark):
    df = spark.sql("SELECT 0d AS a, 0d AS b, 0d AS c, 90d AS d UNION ALL SELECT NULL, 0d, 0d, 0d UNION ALL SELECT 0d, 0d, 180d, 0d")
    got = [r[0] for r in df.select(great_circle_meters(*[F.col(x) for x in "abcd"])).collect()]
    quarter = 3.141592653589793 / 2 * 6371010
    assert abs(got[0] - quarter) < 1e-6 and got[1] is None and abs(got[2] - 2 * quarter) < 1e-6
