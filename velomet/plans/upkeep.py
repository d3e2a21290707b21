"""Queries over marts that are kept current: hours closed by a watermark, days refreshed by loads, merged sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from velomet.operators import sketches, trip_marts
from velomet.plans import standins
from velomet.plans.queries import query
from velomet.session import new_folder
from velomet.sources import refresh
from velomet.streaming import closed_hours as closing


@query
def hourly_trips_closed(spark, sf):
    """The hourly mart after two arrivals of events, a tenth of the first half of the month coming with the second: hours closed in
    time, and the trips that came too late for theirs."""
    folder = new_folder(spark, "closed-hours")
    events = standins.table(spark, sf, "events")
    first = (F.dayofmonth("ts") <= 15) & (F.col("event_id") % 10 != 3)
    for arrival in (first, ~first):
        events.filter(arrival).write.mode("append").parquet(f"{folder}/events")
        stream = spark.readStream.schema(events.schema).parquet(f"{folder}/events")
        closing.update_closed_hours(standins.trips_of_events(stream), folder)
    late = closing.late_trips(spark, folder)
    both = closing.closed_hours(spark, folder).join(late, "hour_ts", "full")
    return both.withColumn("late", F.coalesce("late", F.lit(0)))


def _delivered(spark: SparkSession, sf: str, run: int) -> DataFrame:
    """Trips as the monthly files of three runs: early months; all months; and late trips of the first years, which come
    inside the legacy files, now larger, or in current files of their own."""
    month = F.date_format("start_time", "yyyyMM")
    late = F.coalesce((F.col("trip_duration_seconds") % 50 == 7) & (month < "199606"), F.lit(False))
    own = F.when(late & (F.col("source_era") == "current"), "-late").otherwise("")
    name = F.concat(F.coalesce(month, F.lit("undated")), F.lit("-"), "source_era", F.lit("-"), "region", own, F.lit(".csv"))
    trips = standins.trips(spark, sf).withColumn("source_file", name)
    if run == 1:
        trips = trips.filter(month < "199801")
    return trips.filter(~late) if run < 3 else trips


@query
def daily_trips_three_loads(spark, sf):
    """The daily mart brought up to date after each of three runs; ``load`` is the run that computed the day last."""
    store = refresh.TripStore(new_folder(spark, "loads"))
    for run in (1, 2, 3):
        trips = _delivered(spark, sf, run)
        listing = trips.groupBy(F.col("source_file").alias("path")).agg(F.count(F.lit(1)).alias("size"))

        def read(files: DataFrame, trips: DataFrame = trips) -> DataFrame:
            return trips.join(files, F.col("source_file") == F.col("path"), "left_semi")

        refresh.load_files(spark, store, listing, read)
        refresh.refresh(spark, store, "daily", lambda t: trip_marts.daily_trips(t, standins.CUTOVER))
    return refresh.mart(spark, store, "daily")


@query
def median_rollups(spark, sf):
    """Durations of months, years, regions and all, merged from a stored daily mart of sketches; ``within`` says that the
    median's exact rank is as near the middle as the sketch promises."""
    trips = standins.trips(spark, sf)
    folder = new_folder(spark, "durations")
    sketches.daily_durations(trips, standins.CUTOVER).write.parquet(folder)
    daily = spark.read.parquet(folder)
    nothing = F.lit(None).cast("string")
    spans = {
        "month": (lambda d: F.date_format(d, "yyyy-MM"), F.col("region")),
        "year": (lambda d: F.date_format(d, "yyyy"), nothing),
        "region": (lambda d: nothing, F.col("region")),
        "all": (lambda d: nothing, nothing),
    }
    parts = [
        sketches.duration_quantiles(daily, [F.lit(kind).alias("kind"), period(F.col("date")).alias("period"), region.alias("region")])
        for kind, (period, region) in spans.items()
    ]
    merged = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    keys = F.array(*[F.struct(F.lit(k).alias("kind"), p(F.to_date("start_time")).alias("period"), g.alias("region")) for k, (p, g) in spans.items()])
    each = trip_marts.owned_rows(trips, standins.CUTOVER).select(F.explode(keys).alias("k"), F.col("trip_duration_seconds").alias("s"))
    m, k = merged.alias("m"), each.alias("e")
    same = (F.col("m.kind") == F.col("k.kind")) & F.col("m.period").eqNullSafe(F.col("k.period")) & F.col("m.region").eqNullSafe(F.col("k.region"))
    columns = ["m.kind", "m.period", "m.region", "trips", "timed", "least", "most"]
    ranks = k.join(m, same).groupBy(*columns).agg(F.count_if(F.col("s") < F.col("q50")).alias("below"), F.count_if(F.col("s") <= F.col("q50")).alias("upto"))
    spare = 2 * sketches.rank_error()
    within = (F.col("below") <= (0.5 + spare) * F.col("timed")) & (F.col("upto") >= (0.5 - spare) * F.col("timed"))
    return ranks.select("kind", "period", "region", "trips", "timed", "least", "most", within.alias("within"))


def _station_sets(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "station-sets")
    sketches.monthly_station_sets(standins.trips(spark, sf), standins.CUTOVER).write.parquet(folder)
    return spark.read.parquet(folder)


@query
def station_totals_merged(spark, sf):
    """Distinct stations per year and region, and per year, merged from a stored monthly mart of sketches."""
    sets = _station_sets(spark, sf)
    year, nothing = F.year("month").alias("year"), F.lit(None).cast("string").alias("region")
    totals = sketches.station_totals(sets, [year, "region"]).unionByName(sketches.station_totals(sets, [year, nothing]))
    near = F.abs(F.col("stations_hll") - F.col("stations")) <= sketches.hll_error() * F.col("stations") + 1
    return totals.select("year", "region", "trips", "stations", near.alias("hll_within"))


@query
def stations_between_years(spark, sf):
    """Stations kept, opened and closed from each year to the next, per region."""
    return sketches.stations_kept(_station_sets(spark, sf), ["region"])
