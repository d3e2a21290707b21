"""Named queries: every operator and mart on the provided tables.

Each takes (spark, sf_dir) and reads whole tables. Values an engine may sum in another order are
rounded here, not in the operators.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame, SparkSession, functions as F

from velomet.fixed_values import CLIMATOLOGY_DRIVERS, PRESENT_WEATHER_CODES, SEGMENTS
from velomet.functions.calendar import hour_stamp, is_federal_holiday, is_weekend, season, year_month
from velomet.functions.geo import great_circle_meters
from velomet.functions.text import name_key, present_weather_flag
from velomet.functions.units import steady_round
from velomet.operators import climatology, profiles, quality, series, spatial, trip_marts, weather_daily, weather_hourly
from velomet.operators.lowess import lowess, lowess_at_observations, lowess_at_rows
from velomet.operators.regression import Design, cluster_sums, collect_moments, hac_sums, moment_sums, solve, stable_fit
from velomet.plans import daily_impacts, hourly_rain, standins, weather_adjusted
from velomet.session import checkpoint_dir
from velomet.sources import manifest
from velomet.sources.trip_files import align_to_era, quarantine
from velomet.sources.weather_files import keep_first
from velomet.streaming.marts import current_mart, keep_current

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: steady_round(F.col(c), digits) for c in columns})


# ---------------------------------------------------------------- canonical trips and marts
@query
def trips_unified(spark, sf):
    return rounded(standins.trips(spark, sf), ["distance_meters"], 3)


@query
def daily_trips(spark, sf):
    return trip_marts.daily_trips(standins.trips(spark, sf), standins.CUTOVER)


@query
def hourly_trips(spark, sf):
    return trip_marts.hourly_trips(standins.event_trips(spark, sf))


@query
def hourly_trips_stream(spark, sf):
    """The hourly mart brought up to date by a streaming run over the events file."""
    events = standins.table(spark, sf, "events")
    stream = (
        spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    )
    work = f"{checkpoint_dir(spark)}/hourly-{uuid.uuid4()}"
    run = keep_current(standins.trips_of_events(stream), trip_marts.hourly_trips, f"{work}/mart", f"{work}/state")
    run.awaitTermination()
    return current_mart(spark, f"{work}/mart")


@query
def hourly_trips_all_years(spark, sf):
    return trip_marts.hourly_trips(standins.trips(spark, sf), standins.CUTOVER)


@query
def station_counts_monthly(spark, sf):
    return trip_marts.station_counts_monthly(standins.trips(spark, sf), standins.CUTOVER)


@query
def station_key_comparison(spark, sf):
    return trip_marts.station_key_comparison(
        standins.trips(spark, sf), "NYC", (1995, 2001), standins.CUTOVER
    )


@query
def daily_trips_weather(spark, sf):
    return standins.trips_with_weather(spark, sf)


@query
def hourly_trips_weather(spark, sf):
    df = standins.hourly_with_weather(spark, sf)
    return rounded(df, ["temp_f", "dewpoint_f", "wetbulb_f", "rh_pct", "prcp_inches", "wind_mph", "visibility_miles"])


@query
def missing_start_times(spark, sf):
    return quality.missing_start_times(standins.trips(spark, sf))


@query
def repeated_keys(spark, sf):
    """Line items whose (order, line) key is not unique."""
    keys = ["l_orderkey", "l_linenumber"]
    return quality.repeated_keys(standins.table(spark, sf, "lineitem"), keys)


# ---------------------------------------------------------------- weather
@query
def observation_pivot(spark, sf):
    return weather_daily.pivot_observations(standins.long_observations(spark, sf))


@query
def weather_daily_derived(spark, sf):
    return weather_daily.derive_daily(
        weather_daily.pivot_observations(standins.long_observations(spark, sf))
    )


@query
def weather_daily_stations(spark, sf):
    return standins.daily_weather(spark, sf).drop("geo_coord")


@query
def weather_daily_nyc(spark, sf):
    return weather_daily.weather_daily_home(standins.daily_weather(spark, sf))


@query
def station_map(spark, sf):
    return standins.located_stations(spark, sf).drop("geo_coord")


@query
def observation_typing(spark, sf):
    """Raw text observations: markers, report filter, first of repeated reports."""
    return standins.observations(spark, sf)


@query
def weather_hourly_nyc(spark, sf):
    return weather_hourly.weather_hourly(standins.observations(spark, sf))


@query
def obs_hour_collapse(spark, sf):
    df = standins.hours_of_weather(spark, sf)
    return rounded(df, ["temp_f", "dewpoint_f", "wetbulb_f", "rh_pct", "prcp_inches", "wind_mph", "visibility_miles"])


@query
def tz_local_key(spark, sf):
    """Standard time to the local wall clock over all line items, both clock changes included."""
    minute = (F.col("l_orderkey") * 61 + F.col("l_linenumber") * 7) % 1440
    t = standins.table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_shipdate") + F.make_dt_interval(mins=minute.cast("int"))).alias("obs_time_lst"),
    )
    local = weather_hourly.local_time(F.col("obs_time_lst"))
    return t.select(
        "*",
        local.alias("obs_time_local"),
        F.to_date(local).alias("date_local"),
        F.hour(local).alias("hour_local"),
    )


@query
def text_flags(spark, sf):
    """Present-weather code flags over whole document texts, blank texts as NULL."""
    text = F.when(F.trim("text") != "", F.translate("text", ascii_lowercase, ascii_uppercase))
    return standins.table(spark, sf, "documents").select(
        "doc_id", *[present_weather_flag(text, f).alias(f) for f in PRESENT_WEATHER_CODES]
    )


# ---------------------------------------------------------------- cells, names, files
def raw_trip_cells(spark, sf):
    """Orders as raw text rows of a legacy file with every kind of untidy cell."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    price = F.floor(F.col("o_totalprice")).cast("bigint").cast("string")
    day = F.col("o_orderdate")
    return standins.table(spark, sf, "orders").select(
        F.when(key % 11 == 0, "\\N").when(key % 11 == 1, F.concat(price, F.lit(".5"))).when(
            key % 11 == 2, "1d"
        ).otherwise(F.concat(price, F.lit(".0"))).alias("trip_duration"),
        F.when(key % 4 == 0, F.date_format(day, "M/d/yyyy H:mm"))
        .when(key % 4 == 1, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(key % 4 == 2, F.concat(F.date_format(day, "yyyy-MM-dd HH:mm:ss"), F.lit(".0")))
        .otherwise(F.when(key % 5 == 0, "junk").otherwise(F.date_format(day, "yyyy-MM-dd HH:mm:ss")))
        .alias("start_time"),
        F.concat(F.lit(" "), cust.cast("string"), F.lit(".0")).alias("start_station_id"),
        F.when(key % 6 == 0, "  ").when(key % 6 == 1, "NULL").otherwise(
            F.concat(F.lit("\t"), F.col("o_orderpriority"), F.lit("  "))
        ).alias("start_station_name"),
        F.when(key % 9 == 0, "n/a").otherwise(F.concat((key % 90).cast("string"), F.lit(".25"))).alias("start_station_latitude"),
        F.when(cust % 3 == 0, "").otherwise(F.concat((1940 + cust % 60).cast("string"), F.lit(".0"))).alias("birth_year"),
        (cust % 3).cast("string").alias("gender"),
        key.alias("row_id"),
        F.lit("orders").alias("source_file"),
    )


@query
def clean_markers(spark, sf):
    raw = raw_trip_cells(spark, sf)
    return align_to_era(raw, "legacy", keep=["row_id"]).select(
        "row_id", "trip_duration", "start_time", "start_station_id", "start_station_name",
        "start_station_latitude", "birth_year", "gender", "bike_id",
    )


@query
def quarantine_counts(spark, sf):
    return (
        quarantine(raw_trip_cells(spark, sf), "legacy")
        .groupBy("source_file", "column")
        .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("example"))
    )


@query
def name_keys(spark, sf):
    """Distinct part names per brand before and after folding case and spacing."""
    n = F.col("p_partkey") % 4
    drift = (
        F.when(n == 0, F.upper("p_name"))
        .when(n == 1, F.concat(F.lit("  "), F.col("p_name")))
        .when(n == 2, F.replace("p_name", F.lit(" "), F.lit(" \t ")))
        .otherwise(F.col("p_name"))
    )
    return (
        standins.table(spark, sf, "part")
        .select("p_brand", drift.alias("name"))
        .groupBy("p_brand")
        .agg(
            F.count_distinct("name").alias("raw_names"),
            F.count_distinct(name_key(F.col("name"))).alias("stations"),
            F.min(name_key(F.col("name"))).alias("first_name"),
        )
    )


def _trip_manifest(spark, sf):
    """Orders as files of monthly archives: combined files, shards, nested copies, other files."""
    key = F.col("o_orderkey")
    month = F.date_format("o_orderdate", "yyyyMM")
    base = F.concat(
        F.when(key % 8 == 7, "JC-").otherwise(""), month, F.lit("-tripdata"),
        F.when(key % 5 == 1, F.concat(F.lit("_"), (key % 9).cast("string")))
        .when(key % 5 == 2, F.concat(F.lit("-part"), (key % 9).cast("string")))
        .otherwise(""),
    )
    folder = F.when(key % 6 == 3, "nested/").when(key % 6 == 4, "nested/deep/").when(key % 6 == 5, "__MACOSX/").otherwise("")
    suffix = F.when(key % 10 == 9, ".txt").when(key % 10 == 8, ".CSV").otherwise(".csv")
    return (
        standins.table(spark, sf, "orders")
        .select(
            F.concat(F.year("o_orderdate").cast("string"), F.lit(".zip")).alias("archive"),
            F.concat(folder, base, suffix).alias("path"),
            (key % 7 + 1).alias("size"),
        )
        .groupBy("archive", "path")
        .agg(F.max("size").alias("size"))
    )


@query
def shard_antijoin(spark, sf):
    return manifest.csv_members(_trip_manifest(spark, sf))


def _file_name(key):
    return F.concat(
        F.when(key % 4 == 0, "jc-").otherwise(""),
        (F.lit(201300) + key % 1200).cast("string"),
        F.lit("-tripdata-"),
        key.cast("string"),
        F.when(key % 9 == 0, ".html").otherwise(".zip"),
    )


def _listing(spark, sf):
    """Customers as published files."""
    key = F.col("c_custkey")
    return standins.table(spark, sf, "customer").select(
        _file_name(key).alias("path"), (key * 3 % 1000).alias("size")
    )


def _stored(spark, sf):
    """Files of the customers with a finished order, some of them at another size."""
    key = F.col("o_custkey")
    return (
        standins.table(spark, sf, "orders")
        .filter(F.col("o_orderstatus") == "F")
        .groupBy("o_custkey")
        .agg(F.min("o_orderkey").alias("o_orderkey"))
        .select(
            _file_name(key).alias("path"),
            (key * 3 % 1000 + F.when(F.col("o_orderkey") % 5 == 0, 1).otherwise(0)).alias("size"),
        )
    )


@query
def manifest_diff(spark, sf):
    return manifest.manifest_diff(_listing(spark, sf), _stored(spark, sf))


@query
def archive_selection(spark, sf):
    return manifest.select_archives(_listing(spark, sf), region="jc", first=25)


@query
def not_yet_loaded(spark, sf):
    loaded = _stored(spark, sf).select(F.concat(F.lit("s3/x/"), F.col("path")).alias("source_file"))
    return manifest.not_yet_loaded(_listing(spark, sf), loaded)


@query
def high_water_mark(spark, sf):
    """Monthly files newer than the latest month seen in the line items."""
    files = standins.table(spark, sf, "orders").select(
        F.concat(F.date_format("o_orderdate", "yyyyMM"), F.lit("-tripdata-"), F.col("o_orderkey").cast("string"), F.lit(".zip")).alias("path")
    )
    loaded = standins.table(spark, sf, "orders").filter(F.col("o_orderdate") < F.lit("1999-06-01").cast("date")).select(
        F.concat(F.lit("rides/"), F.date_format("o_orderdate", "yyyyMM"), F.lit(".parquet")).alias("path")
    )
    return manifest.newer_months(files, loaded)


@query
def keep_first_dedup(spark, sf):
    """First event per minute and type, in line order."""
    e = standins.table(spark, sf, "events").select(
        F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("minute"), "event_type", "event_id", "value"
    )
    return keep_first(e, ["minute", "event_type"], ["event_id"])


# ---------------------------------------------------------------- places
@query
def great_circle(spark, sf):
    """Distance between each order's two stand-in stations; missing coordinates give NULL."""
    t = standins.current_typed(spark, sf)
    c = F.col
    meters = great_circle_meters(
        c("start_station_longitude"), c("start_station_latitude"), c("end_station_longitude"), c("end_station_latitude")
    )
    return t.groupBy("start_station_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(meters).alias("n_located"),
        steady_round(F.max(meters), 3).alias("longest"),
        steady_round(F.avg(meters), 3).alias("mean"),
    )


@query
def point_in_polygon(spark, sf):
    """Customers as points against all areas; a point may lie in several or none."""
    key = F.col("c_custkey")
    points = standins.table(spark, sf, "customer").select(
        "c_custkey",
        (F.lit(-74.0) + (key % 100) / F.lit(500.0)).alias("longitude"),
        (F.lit(40.6) + (key % 37) / F.lit(200.0)).alias("latitude"),
    )
    return spatial.points_in_polygons(points, standins.zip_areas(spark), "c_custkey", ["zip_code", "city"])


# ---------------------------------------------------------------- daily frame
def _daily(spark, sf, **options):
    return series.daily_frame(standins.trips_with_weather(spark, sf), **options)


@query
def condition_label(spark, sf):
    return _daily(spark, sf).groupBy("segment", "condition").agg(
        F.count(F.lit(1)).alias("days"), F.sum("trips").alias("trips")
    )


@query
def daily_frame(spark, sf):
    df = _daily(spark, sf).select(
        "segment", "date", "year", "is_weekend", "condition", "trips", "member", "casual",
        "pct_casual", "ridership_index", "tavg_f",
    )
    return rounded(df, ["pct_casual", "ridership_index"])


@query
def user_slice(spark, sf):
    """Weekend days of three years; the index still refers to all days."""
    df = _daily(spark, sf, first_year=1998, last_year=2000, days="Weekends only").select(
        "segment", "date", "trips", "ridership_index"
    )
    return rounded(df, ["ridership_index"])


@query
def ridership_index(spark, sf):
    return rounded(_daily(spark, sf).select("segment", "date", "ridership_index"), ["ridership_index"])


@query
def rolling_30d_mean(spark, sf):
    df = series.rolling_day_mean(_daily(spark, sf), "trips", 30, "trips_30d")
    return rounded(df.select("segment", "date", "trips", "trips_30d"), ["trips_30d"])


@query
def band_means(spark, sf):
    return rounded(profiles.temperature_band_means(_daily(spark, sf)), ["trips", "member", "casual"])


@query
def rider_mix_unpivot(spark, sf):
    means = profiles.temperature_band_means(_daily(spark, sf))
    return rounded(profiles.rider_mix(means, ["segment", "band"]), ["trips"])


@query
def band_medians(spark, sf):
    return rounded(profiles.wind_band_medians(_daily(spark, sf)), ["ridership_index"])


@query
def comfort_medians(spark, sf):
    return rounded(profiles.comfort_band_medians(_daily(spark, sf)), ["ridership_index"])


@query
def month_year_mean(spark, sf):
    return rounded(profiles.month_year_mean(_daily(spark, sf)), ["trips"])


@query
def month_year_table(spark, sf):
    """The table of all years that occur, turned to one row per month and year."""
    d = _daily(spark, sf).filter(F.col("segment") == "NYC only")
    table = profiles.month_year_table(d)
    years = [c for c in table.columns if c != "month"]
    return rounded(table.unpivot("month", years, "year", "trips"), ["trips"])


@query
def calendar_month_mean(spark, sf):
    return rounded(profiles.calendar_month_mean(_daily(spark, sf)), ["trips"])


@query
def five_number(spark, sf):
    numbers = ["q1", "median", "q3", "low", "high", "whisker_low", "whisker_high"]
    return rounded(profiles.five_number(_daily(spark, sf).filter(F.col("tavg_f").isNotNull())), numbers)


@query
def headline_kpis(spark, sf):
    return rounded(profiles.headline(_daily(spark, sf)), ["per_day", "warm_cold_ratio"])


@query
def snow_days(spark, sf):
    """Days with snowfall, rain or snow on the ground, counted per segment."""
    d = _daily(spark, sf).filter(F.col("tavg_f").isNotNull())
    return profiles.amount_days(d, ["snow_inches", "prcp_inches", "snow_depth_inches"])


@query
def latest_rows(spark, sf):
    mart = standins.trips_with_weather(spark, sf).select("date", "num_trips", "tavg_f", "is_rainy")
    return series.latest_rows(mart.filter(F.col("date").isNotNull()), 30)


@query
def holiday_flag(spark, sf):
    """Orders per calendar day with the observed federal holiday flag."""
    date = F.to_date("o_orderdate")
    return standins.table(spark, sf, "orders").groupBy(date.alias("date")).agg(
        F.count(F.lit(1)).alias("n")
    ).select("date", "n", is_federal_holiday(F.col("date")).alias("holiday"))


@query
def calendar_keys(spark, sf):
    """Calendar keys per distinct ship date."""
    d = standins.table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("date")).distinct()
    c = F.col("date")
    return d.select(
        "date", year_month(c).alias("ym"), F.weekday(c).alias("dow"), F.dayofweek(c).alias("dow_sql"),
        F.dayofyear(c).alias("doy"), is_weekend(c).alias("is_weekend"), season(c).alias("season"),
        F.trunc(c, "MM").alias("month"), hour_stamp(c, F.lit(7)).alias("seven"),
    )


# ---------------------------------------------------------------- hourly frame
def _hourly(spark, sf):
    mart = standins.hourly_with_weather(spark, sf)
    return series.from_launch(series.by_segment(mart, ["date", "hour", "temp_f", "prcp_inches", "is_raining", "is_snowing"]))


def _filled(spark, sf):
    return series.zero_filled_hours(_hourly(spark, sf))


@query
def zero_filled_hours(spark, sf):
    return _filled(spark, sf)


@query
def zero_filled_profile(spark, sf):
    return rounded(profiles.day_type_profile(_filled(spark, sf)), ["trips"])


@query
def weekday_rider_profile(spark, sf):
    return rounded(profiles.weekday_rider_profile(_filled(spark, sf)), ["trips"])


@query
def rain_haircut(spark, sf):
    return rounded(profiles.rain_haircut(profiles.known_hours(_hourly(spark, sf), "is_raining")), ["pct"])


@query
def heat_index(spark, sf):
    return rounded(profiles.heat_index(profiles.known_hours(_hourly(spark, sf), "temp_f")), ["pct"])


@query
def complete_hours(spark, sf):
    hourly = series.with_clock(_hourly(spark, sf)).select("segment", "ts", "trips")
    return series.complete_hours(hourly)


@query
def lead_lag_grid(spark, sf):
    hourly = series.with_clock(_hourly(spark, sf)).select("segment", "ts", "trips", "is_raining")
    return series.lead_lag_hours(hourly, "is_raining", 2, 4, "rain", ["segment"])


@query
def lead_lag_all_years(spark, sf):
    """Trips two hours ahead and four behind over six years of sparse hours."""
    hourly = trip_marts.hourly_trips(standins.trips(spark, sf), standins.CUTOVER)
    rows = hourly.filter(F.col("hour_ts").isNotNull()).select(F.col("hour_ts").alias("ts"), "num_trips")
    return series.lead_lag_hours(rows, "num_trips", 2, 4, "trips")


@query
def within_day_demean(spark, sf):
    hourly = _hourly(spark, sf).select(
        "segment", "date", "hour", F.log(F.when(F.col("trips") > 0, F.col("trips"))).alias("logy"), F.col("is_raining").cast("double")
    )
    return rounded(series.within_group_demean(hourly, ["logy", "is_raining"], ["segment", "date"]), ["logy", "is_raining"])


# ---------------------------------------------------------------- climatology and periods
def _climate_days(spark, sf):
    return weather_adjusted.kpi_frame(standins.trips_with_weather(spark, sf).filter(F.col("date").isNotNull()), "num_nyc_trips")


@query
def climatology_doy(spark, sf):
    return rounded(climatology.day_of_year_means(_climate_days(spark, sf), CLIMATOLOGY_DRIVERS), ["value"])


@query
def interpolate_doy(spark, sf):
    """Gaps: normals of snow on snow days only, so most slots have to be interpolated."""
    snowy = _climate_days(spark, sf).filter("snow_cap > 0")
    means = climatology.day_of_year_means(snowy, ["snow_cap", "tavg_f"])
    return rounded(climatology.interpolate_slots(means), ["value"])


@query
def climatology_smooth(spark, sf):
    means = climatology.day_of_year_means(_climate_days(spark, sf), CLIMATOLOGY_DRIVERS)
    return rounded(climatology.circular_mean(climatology.interpolate_slots(means)), ["value"])


def _adjusted(spark, sf):
    """Daily actuals with a simple stand-in for adjusted trips, per segment."""
    d = _daily(spark, sf)
    factor = 1 + (F.col("member") % 7 - 3) / F.lit(50.0)
    return d.select("segment", "date", F.col("trips").cast("double").alias("actual"), (F.col("trips") / factor).alias("adjusted"))


@query
def yearly_rollup(spark, sf):
    years = profiles.yearly_totals(_adjusted(spark, sf), ["segment"], 200)
    return rounded(years, ["actual", "adjusted", "weather_pct"], 4)


@query
def growth_statement(spark, sf):
    years = profiles.yearly_totals(_adjusted(spark, sf), ["segment"], 200)
    df = profiles.growth_statement(years, ["segment"])
    return rounded(df, ["raw_growth", "adjusted_growth", "gap", "favored_pct", "other_pct"], 4)


@query
def period_kpi(spark, sf):
    return rounded(profiles.period_totals(_adjusted(spark, sf), ["segment"]), ["actual", "adjusted", "weather_pct"], 4)


@query
def adjusted_slice(spark, sf):
    """Adjusted days of one segment within three years of the daily mart."""
    mart = standins.trips_with_weather(spark, sf).select("date", "num_jc_trips")
    adjusted = _adjusted(spark, sf).filter(F.col("segment") == "Jersey City only").drop("segment")
    df = profiles.adjusted_slice(adjusted, mart, "num_jc_trips", 1997, 1999)
    return rounded(df, ["actual", "adjusted"])


@query
def rolling_28d_adjusted(spark, sf):
    df = profiles.rolling_adjusted(_adjusted(spark, sf), ["segment"])
    return rounded(df, ["actual", "adjusted", "actual_28", "adjusted_28"])


@query
def network_intensity(spark, sf):
    counts = trip_marts.station_counts_monthly(standins.trips(spark, sf), standins.CUTOVER)
    df = profiles.network_intensity(counts, SEGMENTS["NYC + Jersey City"][3])
    return rounded(df, ["stations", "trips_per_station"])


@query
def intensity_change(spark, sf):
    counts = trip_marts.station_counts_monthly(standins.trips(spark, sf), standins.CUTOVER)
    network = profiles.network_intensity(counts, SEGMENTS["NYC only"][3])
    return rounded(profiles.intensity_change(network), ["trips_pct", "stations_pct", "trips_per_station_pct"])


# ---------------------------------------------------------------- estimators
SLOPE_DESIGN = Design("y", ("x",), absorb=("ym",))
GRAM_DESIGN = Design("y", ("x", "z"), {"dow": list(range(7))}, absorb=("ym",))


def _model_days(spark, sf):
    """Days with trips and wind: log trips on wind and humidity, by month. The days go to the checkpoint
    folder, since a fit and its errors read them several times: trips are scanned once."""
    checkpoint_dir(spark)
    d = standins.trips_with_weather(spark, sf).filter(F.col("date").isNotNull() & (F.col("num_trips") > 0))
    return d.select(
        "date", year_month(F.col("date")).alias("ym"), F.weekday("date").alias("dow"),
        F.log("num_trips").alias("y"), F.col("wind_avg_mph").alias("x"), F.col("rh_avg").alias("z"),
    ).checkpoint()


@query
def ols_gram(spark, sf):
    """Raw and month-absorbed sums of products over intercept, outcome, wind, humidity, weekdays."""
    return rounded(moment_sums(_model_days(spark, sf), GRAM_DESIGN), ["raw", "absorbed"], 4)


@query
def within_slope(spark, sf):
    frame = _model_days(spark, sf)
    moments = collect_moments(frame, SLOPE_DESIGN)
    fit = solve(moments)
    rows = [(moments.n, float(fit.beta[0]))]
    return rounded(spark.createDataFrame(rows, "n bigint, slope double"), ["slope"])


@query
def near_collinear_slopes(spark, sf):
    """Log trips on wind and on wind with a ten-thousandth of the humidity, two regressors far from zero and all but the same."""
    frame = _model_days(spark, sf).withColumn("x", F.col("x") + 1000.0).withColumn("z", F.col("x") + F.col("z") / 10000.0)
    fit = stable_fit(frame, Design("y", ("x", "z")))
    rows = [(name, float(b)) for name, b in zip(fit.names, fit.beta)]
    return rounded(spark.createDataFrame(rows, "name string, slope double"), ["slope"], 3)


@query
def hac_variance(spark, sf):
    frame = _model_days(spark, sf)
    fit = solve(collect_moments(frame, SLOPE_DESIGN))
    df = hac_sums(frame, SLOPE_DESIGN, fit, {"wind": {"x": 1.0}, "ten": {"x": 10.0}}, "date")
    return rounded(df, ["variance"], 9)


@query
def cluster_variance(spark, sf):
    frame = _model_days(spark, sf)
    fit = solve(collect_moments(frame, SLOPE_DESIGN))
    df = cluster_sums(frame, SLOPE_DESIGN, fit, {"wind": {"x": 1.0}})
    return rounded(df.withColumnRenamed("m0", "variance"), ["variance"], 9)


@query
def model_bands(spark, sf):
    """Model temperature and rain bands of all days."""
    frame = daily_impacts.impact_frame(standins.trips_with_weather(spark, sf).filter(F.col("date").isNotNull()), "num_trips")
    return frame.groupBy("temp_band", "rain_band", "holiday").agg(
        F.count(F.lit(1)).alias("n"), steady_round(F.avg("logy"), 6).alias("mean_log")
    )


def _effects(df):
    return rounded(df, ["pct", "lo", "hi"], 4)


@query
def fit_impacts(spark, sf):
    days = standins.trips_with_weather(spark, sf).filter(F.col("date").isNotNull())
    return _effects(daily_impacts.by_size(daily_impacts.fit_impacts(days, "num_nyc_trips")[0]))


@query
def fit_impacts_meta(spark, sf):
    """How much of the days' variance calendar and weather explain."""
    days = standins.trips_with_weather(spark, sf).filter(F.col("date").isNotNull())
    meta = daily_impacts.fit_impacts(days, "num_nyc_trips")[1]
    names = ["r2_controls", "r2_full", "weather_partial_r2"]
    df = spark.createDataFrame([(meta["n"], *[meta.get(c) for c in names])], "n bigint, " + ", ".join(f"{c} double" for c in names))
    return rounded(df, names, 6)


@query
def fit_humidity(spark, sf):
    days = standins.trips_with_weather(spark, sf).filter(F.col("date").isNotNull())
    h = daily_impacts.humidity_impact(days, "num_nyc_trips")
    rows = [] if h is None else [(h.per_f, h.p10, h.lo10, h.hi10, h.n)]
    df = spark.createDataFrame(rows, "`per_F` double, p10 double, lo10 double, hi10 double, n bigint")
    return rounded(df, ["per_F", "p10", "lo10", "hi10"], 4)


@query
def rain_profile(spark, sf):
    return _effects(hourly_rain.rain_profile(standins.hourly_with_weather(spark, sf), "num_nyc_trips")[0])


@query
def rain_totals(spark, sf):
    """What an hour of rain costs up to four hours later, and what heavy rain adds for members."""
    hourly = standins.hourly_with_weather(spark, sf)
    profile = hourly_rain.rain_profile(hourly, "num_nyc_trips")[1]
    parts = hourly_rain.rain_by_daypart(hourly, "num_member_trips_nyc")[1]
    rows = [("hours 0 to 4", *[profile[f"cum_{c}"] for c in ("pct", "lo", "hi")], profile["n"], profile["n_days"])]
    rows.append(("heavy rain, members", *[parts["heavy_extra"][c] for c in ("pct", "lo", "hi")], parts["n"], parts["n_days"]))
    df = spark.createDataFrame(rows, "effect string, pct double, lo double, hi double, n bigint, n_days bigint")
    # A few hours of data can give effects of millions of percent, of which sums of doubles do not settle four decimals.
    ends = {c: F.when(F.abs(c) >= 1e6, steady_round(F.col(c), 0)).otherwise(steady_round(F.col(c), 4)) for c in ("pct", "lo", "hi")}
    return df.withColumns(ends)


@query
def empty_years(spark, sf):
    """The models over years without days: rows of each, which is none."""
    days = standins.trips_with_weather(spark, sf).filter(F.col("date").isNotNull())
    none = series.user_slice(days, 1850, 1851)
    hours = series.user_slice(standins.hourly_with_weather(spark, sf), 1850, 1851)
    frames = {
        "adjusted": weather_adjusted.weather_adjusted_daily(none, "num_nyc_trips"),
        "impacts": daily_impacts.fit_impacts(none, "num_nyc_trips")[0],
        "profile": hourly_rain.rain_profile(hours, "num_nyc_trips")[0],
        "dayparts": hourly_rain.rain_by_daypart(hours, "num_nyc_trips")[0],
    }
    return spark.createDataFrame([(k, df.count()) for k, df in frames.items()], "model string, n bigint")


@query
def rain_daypart(spark, sf):
    hourly = standins.hourly_with_weather(spark, sf)
    return _effects(hourly_rain.rain_by_rider(hourly, "num_member_trips_nyc", "num_casual_trips_nyc"))


@query
def weather_adjusted_trips(spark, sf):
    days = standins.trips_with_weather(spark, sf).filter(F.col("date").isNotNull())
    df = weather_adjusted.weather_adjusted_daily(days, "num_nyc_trips")
    return rounded(df, ["actual", "expected", "weather_effect", "adjusted"])


@query
def lowess_fit(spark, sf):
    """The trend at every day, with the default share of neighbours."""
    days = standins.trips_with_weather(spark, sf).filter(F.col("date").isNotNull())
    return rounded(lowess_at_rows(days, "tavg_f", "num_nyc_trips", 0.4, by=("season",), carry=("date",)), ["x", "y", "fit"])


@query
def lowess_grid(spark, sf):
    days = standins.trips_with_weather(spark, sf).filter(F.col("date").isNotNull())
    return rounded(lowess(days, "tavg_f", "num_nyc_trips", 0.3, by=("season",)), ["x", "fit"])


@query
def lowess_observations(spark, sf):
    """The trend at every day, each fitted to its own nearest days of the season."""
    days = standins.trips_with_weather(spark, sf).filter(F.col("date").isNotNull())
    fits = lowess_at_observations(days, "tavg_f", "num_nyc_trips", 0.3, by=("season",), carry=("date",))
    return rounded(fits, ["x", "y", "fit"])


# Queries over stored files register themselves above.
import velomet.plans.stored  # noqa: E402, F401
import velomet.plans.upkeep  # noqa: E402, F401
