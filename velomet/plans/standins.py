"""Roles the provided tables play: trips, stations, daily and hourly observations.

Each function is a projection of whole tables into the shape a source reader would deliver, so
the marts and analyses above them run unchanged. Values are whole-number arithmetic on keys,
which every engine computes alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from velomet.fixed_values import HOME_STATION
from velomet.operators.trip_marts import daily_trips, hourly_trips
from velomet.operators.trip_marts import join_daily_weather, join_hourly_weather
from velomet.operators.unify import unified_branch, unify
from velomet.operators.weather_daily import station_map, weather_daily, weather_daily_home
from velomet.operators.weather_hourly import collapse_hours, weather_hourly
from velomet.sources.weather_files import daily_elements, hourly_observations

# Fixed values of the stand-ins.
CUTOVER = "1998-07-01"
ELEMENT_ORDER = daily_elements()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _after(ts: Column, seconds: Column) -> Column:
    return ts + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def _longitude(key: Column) -> Column:
    return F.lit(-74.0) + (key % 100) / F.lit(500.0)


def _latitude(key: Column) -> Column:
    return F.lit(40.6) + (key % 37) / F.lit(200.0)


def _station_name(key: Column) -> Column:
    """Names whose case and spacing drift, as they do between layouts."""
    n = (key % 60).cast("string")
    return (
        F.when(key % 3 == 0, F.concat(F.lit("  Dock  St "), n))
        .when(key % 3 == 1, F.concat(F.lit("DOCK ST  "), n))
        .when(key % 11 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("Dock St "), n, F.lit(" ")))
    )


def legacy_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as legacy-layout trips."""
    o = table(spark, sf_dir, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    second = (key * 37) % 86400
    return o.select(
        F.when(key % 7 != 0, F.floor(F.col("o_totalprice") / 100).cast("bigint") + 60).alias("trip_duration"),
        F.when(key % 97 != 0, _after(F.col("o_orderdate"), second)).alias("start_time"),
        _after(F.col("o_orderdate"), second + 60 + cust % 3600).alias("stop_time"),
        cust.cast("string").alias("start_station_id"),
        _station_name(cust).alias("start_station_name"),
        _latitude(cust).alias("start_station_latitude"),
        _longitude(cust).alias("start_station_longitude"),
        (cust % 500).cast("string").alias("end_station_id"),
        _station_name(cust + 1).alias("end_station_name"),
        _latitude(key).alias("end_station_latitude"),
        _longitude(key).alias("end_station_longitude"),
        (key % 5000).cast("string").alias("bike_id"),
        F.when(F.col("o_orderstatus") == "F", "Subscriber")
        .when(F.col("o_orderstatus") == "O", "Customer")
        .otherwise("Guest")
        .alias("user_type"),
        F.when(cust % 5 != 0, 1940 + (cust % 120) / F.lit(2.0)).alias("birth_year"),
        (cust % 3).alias("gender"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "JC").otherwise("NYC").alias("region"),
        F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("source_file"),
    )


def current_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as current-layout trips."""
    t = table(spark, sf_dir, "lineitem")
    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    second = (key * 37 + line * 3671) % 86400
    seen = part % 50 != 0
    return t.select(
        F.concat_ws("-", key.cast("string"), line.cast("string")).alias("ride_id"),
        F.when(F.col("l_returnflag") == "A", "classic_bike")
        .when(F.col("l_returnflag") == "R", "electric_bike")
        .otherwise("docked_bike")
        .alias("rideable_type"),
        _after(F.col("l_shipdate"), second).alias("start_time"),
        _after(F.col("l_shipdate"), second + F.col("l_quantity").cast("bigint") * 60 + part % 60).alias("stop_time"),
        F.concat(supp.cast("string"), F.lit(".05")).alias("start_station_id"),
        _station_name(supp).alias("start_station_name"),
        F.when(seen, _latitude(part)).alias("start_station_latitude"),
        F.when(seen, _longitude(part)).alias("start_station_longitude"),
        F.concat((supp % 80).cast("string"), F.lit(".05")).alias("end_station_id"),
        _station_name(supp + 1).alias("end_station_name"),
        _latitude(key).alias("end_station_latitude"),
        _longitude(key).alias("end_station_longitude"),
        F.when(F.col("l_linestatus") == "F", "member").otherwise("casual").alias("member_casual"),
        F.when(supp % 3 == 0, "JC").otherwise("NYC").alias("region"),
        F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("source_file"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical trips over the years of the order tables."""
    return unify(
        [
            unified_branch(legacy_typed(spark, sf_dir), "legacy", F.col("region")),
            unified_branch(current_typed(spark, sf_dir), "current", F.col("region")),
        ]
    )


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trips of one month."""
    return trips_of_events(table(spark, sf_dir, "events"))


def trips_of_events(e: DataFrame) -> DataFrame:
    """Events, batch or stream, as current-layout trips; two night hours of every third day are empty."""
    ts, user = F.col("ts"), F.col("user_id")
    night = F.hour(ts).isin(2, 3) & (F.dayofmonth(ts) % 3 == 0)
    start = F.when(night, _after(ts, F.lit(7200))).otherwise(ts)
    typed = e.select(
        F.col("event_id").cast("string").alias("ride_id"),
        F.when(F.col("event_type").isin("view", "click"), "classic_bike").otherwise("electric_bike").alias("rideable_type"),
        start.alias("start_time"),
        _after(start, F.floor(F.col("value") * 60)).alias("stop_time"),
        user.cast("string").alias("start_station_id"),
        _station_name(user).alias("start_station_name"),
        _latitude(user).alias("start_station_latitude"),
        _longitude(user).alias("start_station_longitude"),
        _latitude(F.col("event_id")).alias("end_station_latitude"),
        _longitude(F.col("event_id")).alias("end_station_longitude"),
        F.when(F.col("event_id") % 3 != 0, "member").otherwise("casual").alias("member_casual"),
        F.when(user % 4 == 0, "JC").otherwise("NYC").alias("region"),
        F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("source_file"),
    )
    return unified_branch(typed, "current", F.col("region"))


# ---------------------------------------------------------------- daily weather
def long_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as long daily observations; two thirds belong to the home station."""
    t = table(spark, sf_dir, "lineitem")
    key, line, part, supp = (F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    elements = F.array(*[F.lit(e) for e in ELEMENT_ORDER])
    element = F.get(elements, ((key * 7 + line * 5 + part) % len(ELEMENT_ORDER)).cast("int"))
    noise = part % 121 - 60
    warm = 260 - 50 * F.abs(F.month("l_shipdate") - 7)
    value = (
        F.when(F.col("element") == "TMAX", warm + noise + 50)
        .when(F.col("element") == "TMIN", warm + noise - 50)
        .when(F.col("element").isin("TAVG", "AWBT"), warm + noise)
        .when(F.col("element") == "ADPT", warm + noise - 40)
        .when(F.col("element") == "PRCP", F.when(part % 3 == 0, part % 400).otherwise(0))
        .when(F.col("element").isin("SNOW", "SNWD"), F.when((warm < 60) & (part % 2 == 0), part % 150).otherwise(0))
        .when(F.col("element").isin("RHAV", "RHMN", "RHMX"), part % 70 + 30)
        .when(F.col("element").isin("ASLP", "ASTP"), part % 400 + 9900)
        .when(F.col("element").isin("AWND", "WSF2"), part % 90 + 5)
        .when(F.col("element") == "WDF2", part % 360)
        .otherwise(1)
    )
    return (
        t.withColumn("element", element)
        .select(
            _station_of(supp).alias("id"),
            F.to_date("l_shipdate").alias("date"),
            "element",
            value.cast("bigint").alias("value"),
            F.when(key % 13 == 0, "X").alias("qflag"),
        )
    )


def _station_of(supp: Column) -> Column:
    own = F.concat(F.when(supp % 10 == 9, "CA").otherwise("US"), F.lpad(supp.cast("string"), 9, "0"))
    return F.when(supp % 3 == 2, own).otherwise(F.lit(HOME_STATION))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as weather stations; the first one is the home station."""
    supp = F.col("s_suppkey")
    own = F.concat(F.when(supp % 10 == 9, "CA").otherwise("US"), F.lpad(supp.cast("string"), 9, "0"))
    return table(spark, sf_dir, "supplier").select(
        F.when(supp == 0, HOME_STATION).otherwise(own).alias("id"),
        F.col("s_name").alias("name"),
        F.lit("NY").alias("state"),
        F.when(supp % 29 != 28, _latitude(supp)).alias("latitude"),
        _longitude(supp).alias("longitude"),
    )


def _ring(points: list[tuple[float, float]]) -> list[dict]:
    return [{"lon": x, "lat": y} for x, y in points]


# Areas. Rectangles overlap by 0.0104 degrees, so some points lie in two of them.
ZIP_WEST, ZIP_SOUTH, ZIP_STEP, ZIP_OVERLAP = -74.0007, 40.5993, 0.05, 0.0104
TRIANGLE = [(-73.9507, 40.5993), (-73.8507, 40.5993), (-73.9507, 40.7493)]
COUNTIES = {
    "East": (-73.9007, -73.7007, 40.5, 40.9),
    "West": (-74.1007, -73.8907, 40.5, 40.9),
}


def zip_rectangles() -> list[tuple[str, float, float, float, float]]:
    """(zip, west, east, south, north) of the 4 x 4 rectangles."""
    return [
        (
            f"100{i}{j}",
            ZIP_WEST + i * ZIP_STEP,
            ZIP_WEST + (i + 1) * ZIP_STEP + ZIP_OVERLAP,
            ZIP_SOUTH + j * ZIP_STEP,
            ZIP_SOUTH + (j + 1) * ZIP_STEP + ZIP_OVERLAP,
        )
        for i in range(4)
        for j in range(4)
    ]


def _box(west: float, east: float, south: float, north: float) -> list[dict]:
    return _ring([(west, south), (east, south), (east, north), (west, north)])


def zip_areas(spark: SparkSession) -> DataFrame:
    rows = [(z, f"City {z[3]}", _box(w, e, s, n)) for z, w, e, s, n in zip_rectangles()]
    rows.append(("20000", "Triangle", _ring(TRIANGLE)))
    return spark.createDataFrame(rows, "zip_code string, city string, ring array<struct<lon:double,lat:double>>")


def counties(spark: SparkSession) -> DataFrame:
    rows = [(name, _box(*box)) for name, box in COUNTIES.items()]
    return spark.createDataFrame(rows, "county_name string, ring array<struct<lon:double,lat:double>>")


def located_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return station_map(stations(spark, sf_dir), zip_areas(spark), counties(spark))


def daily_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather_daily(long_observations(spark, sf_dir), located_stations(spark, sf_dir))


def home_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather_daily_home(daily_weather(spark, sf_dir), newest_first=False)


def trips_with_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily mart with the weather of the day."""
    return join_daily_weather(
        daily_trips(trips(spark, sf_dir), CUTOVER), home_weather(spark, sf_dir)
    )


# ---------------------------------------------------------------- hourly weather
def raw_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw text observations with all value markers; line order is the event id."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    hour, day, user = F.hour("ts"), F.dayofmonth("ts"), F.col("user_id")
    spell = (day * 7 + hour * 3) % 10
    degrees = (day % 25 + F.floor(hour / 2) + user % 5 - 8).cast("int")
    decimal = F.concat(degrees.cast("string"), F.lit("."), (k % 10).cast("string"))
    marked = (
        F.when(k % 11 == 0, "")
        .when(k % 11 == 1, F.concat(decimal, F.lit("s")))
        .when(k % 11 == 2, F.concat(decimal, F.lit("V")))
        .when(k % 11 == 3, "*")
        .otherwise(decimal)
    )
    return e.select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:00").alias("DATE"),
        F.when(F.col("event_type") == "view", " FM-15")
        .when(F.col("event_type") == "click", "FM-15 ")
        .when(F.col("event_type").isin("purchase", "signup"), "FM-16")
        .otherwise("SOD")
        .alias("REPORT_TYPE"),
        marked.alias("HourlyDryBulbTemperature"),
        F.concat((degrees - 3).cast("string"), F.lit(".5")).alias("HourlyDewPointTemperature"),
        F.when(k % 2 == 0, marked).alias("HourlyWetBulbTemperature"),
        (k % 70 + 30).cast("string").alias("HourlyRelativeHumidity"),
        F.when(spell < 3, F.element_at(F.array(F.lit("T"), F.lit("0.8"), F.lit("4.3")), k % 3 + 1))
        .when(spell < 7, "0.0")
        .otherwise("")
        .alias("HourlyPrecipitation"),
        F.concat((k + 980).cast("string"), F.lit(".1")).alias("HourlySeaLevelPressure"),
        F.concat((user % 15).cast("string"), F.lit("."), (k % 10).cast("string")).alias("HourlyWindSpeed"),
        F.when(k % 4 == 0, (user % 20 + 5).cast("string")).alias("HourlyWindGustSpeed"),
        F.when(k % 5 == 0, "VRB").otherwise((k % 36 * 10).cast("string")).alias("HourlyWindDirection"),
        F.when(k % 3 == 0, "4.023V").otherwise("16.093").alias("HourlyVisibility"),
        F.when(k % 2 == 0, " FEW:02 72.43 ").alias("HourlySkyConditions"),
        F.when((spell < 3) & (k % 2 == 0), "-RA:02 |RA |RA")
        .when((spell == 4) & (k % 5 == 0), "-SN:03 |SN |")
        .when((spell == 5) & (k % 5 == 1), "FG:30 |FG |TS:7")
        .when((spell == 6) & (k % 7 == 1), "HZ:7 | |HZ")
        .otherwise("  ")
        .alias("HourlyPresentWeatherType"),
        F.lit("events").alias("source_file"),
        F.col("event_id").alias("line_no"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed hourly observations."""
    return hourly_observations(raw_observations(spark, sf_dir), order=["line_no"])


def hours_of_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse_hours(weather_hourly(observations(spark, sf_dir)))


def hourly_with_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly mart with the weather of the hour."""
    return join_hourly_weather(
        hourly_trips(event_trips(spark, sf_dir)), hours_of_weather(spark, sf_dir)
    )
