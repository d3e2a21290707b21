"""Queries that write the given tables as files of the kinds the library loads, and load them again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from velomet.fixed_values import HOME_STATION
from velomet.operators import trip_marts, weather_daily
from velomet.plans import standins
from velomet.plans.queries import query, raw_trip_cells
from velomet.session import new_folder
from velomet.sources import catalog, manifest, named_views, trip_files, trip_lines, weather_files


def _as_csv(df: DataFrame):
    """A writer that leaves cells as they are."""
    keep = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "header": "true", "escape": '"'}
    return df.write.options(**keep)


@query
def trip_files_typed(spark, sf):
    """Raw legacy files with headers as people spell them, found, grouped, typed, stored by month and read back."""
    folder = new_folder(spark, "trips")
    raw = raw_trip_cells(spark, sf).drop("row_id", "source_file")
    spelled = [F.col(c).alias(c.replace("_", " ").title() + " ") for c in raw.columns]
    _as_csv(raw.select(*spelled)).csv(f"{folder}/raw")
    spark.createDataFrame([("x", "y")], "a string, b string").coalesce(1).write.option("header", "true").mode("append").csv(f"{folder}/raw")
    listed = [r["path"] for r in manifest.list_files(spark, f"{folder}/raw", ".csv").select("path").collect()]
    plan = trip_files.without_damaged_files(spark, trip_files.plan_files(spark, listed))
    trip_files.write_typed(trip_files.typed_trips(spark, plan, "legacy"), f"{folder}/typed")
    typed = spark.read.parquet(f"{folder}/typed").filter(trip_files.months_between("1993-01-01"))
    return typed.groupBy("region", F.date_format("start_time", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("start_station_name").alias("named"),
        F.sum("trip_duration").alias("seconds"),
        F.sum("birth_year").alias("birth_years"),
        F.count_distinct("start_station_id").alias("stations"),
        F.lit(len(plan.errors)).cast("bigint").alias("bad_files"),
    )


@query
def observation_years(spark, sf):
    """Raw observation files of one year each, loaded in two runs with a file that is no observation file.

    A long year has several files, whose names follow the order of their lines.
    """
    folder = new_folder(spark, "observations")
    raw = standins.raw_observations(spark, sf).withColumn("y", F.substring("DATE", 1, 4))
    ordered = raw.drop("source_file").repartitionByRange("y", "line_no").sortWithinPartitions("y", "line_no")
    _as_csv(ordered).partitionBy("y").csv(f"{folder}/raw")
    spark.createDataFrame([("x", "y")], "a string, b string").coalesce(1).write.option("header", "true").csv(f"{folder}/raw/y=none")
    paths = sorted(r["path"] for r in manifest.list_files(spark, f"{folder}/raw", ".csv").select("path").collect())
    errors: dict[str, str] = {}
    years = sorted({path.rsplit("/", 1)[0] for path in paths})  # a year has to come whole
    half = len(years) // 2
    for some in (years[:half], years[half:], years[half:]):  # the second run is made twice
        lines = weather_files.read_observation_csv(spark, [p for p in paths if p.rsplit("/", 1)[0] in some], errors)
        weather_files.write_hourly_observations(weather_files.hourly_observations(lines, HOME_STATION), f"{folder}/typed")
    return weather_files.read_hourly_observations(spark, f"{folder}/typed").drop("year", "source_file")


@query
def daily_observation_folders(spark, sf):
    """Daily observations in folders by year, read with an open end and with a bound on either side."""
    folder = new_folder(spark, "daily")
    long = standins.long_observations(spark, sf)
    long.withColumn("year", F.year("date")).repartitionByRange("year", "id", "date").write.partitionBy("year").parquet(folder)
    reads = {"all": (None, None), "from 1995": (1995, None), "to 1994": (None, 1994)}
    parts = [
        weather_files.read_daily_observations(spark, folder, *years).select(F.lit(name).alias("span"), "element", "value")
        for name, years in reads.items()
    ]
    return parts[0].union(parts[1]).union(parts[2]).groupBy("span", "element").agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")
    )


@query
def mart_snapshots(spark, sf):
    """The daily mart as a view, a snapshot and a text dump, each read back."""
    folder = new_folder(spark, "marts")
    catalog.deploy_views(
        spark,
        {
            "stored_trips": lambda: standins.trips(spark, sf),
            "daily_trips": lambda: trip_marts.daily_trips(spark.table("stored_trips"), standins.CUTOVER),
        },
    )
    rows = catalog.snapshot(spark, "daily_trips", folder=f"{folder}/m")
    columns = ["date", "num_trips", "num_nyc_trips"]
    mart = catalog.read_mart(spark, "m_daily_trips", columns, ["date"])
    mart.write.option("header", "true").csv(f"{folder}/text")
    text = catalog.read_mart_csv(spark, f"{folder}/text", "date date, num_trips bigint, num_nyc_trips bigint")
    kinds = (("snapshot", mart), ("text", text))
    both = [df.select(F.lit(kind).alias("kind"), *columns, F.lit(rows).cast("bigint").alias("rows")) for kind, df in kinds]
    return both[0].union(both[1])


def _database(spark: SparkSession) -> str:
    """A new database for the tables of one run."""
    name = f"velomet_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{new_folder(spark, 'database')}'")
    return name


@query
def catalog_views(spark, sf):
    """The daily mart as a view over the view of whichever trip folders exist, one of four being absent; deployed in
    one session and read in another."""
    folder, db = new_folder(spark, "typed"), _database(spark)
    for era, typed in (("legacy", standins.legacy_typed(spark, sf)), ("current", standins.current_typed(spark, sf).filter("region = 'NYC'"))):
        typed.drop("source_file").withColumn("source_era", F.lit(era)).write.mode("append").partitionBy("region", "source_era").parquet(folder)
    folders = {(r, e): f"{folder}/region={r}/source_era={e}" for r in ("NYC", "JC") for e in ("legacy", "current")}
    other = spark.newSession()
    tables = named_views.deploy_unified(other, f"{db}.trips_unified", folders, f"{db}.trips_")
    named_views.deploy_view(other, f"{db}.daily_trips", named_views.daily_trips_sql(f"{db}.trips_unified", standins.CUTOVER))
    return spark.table(f"{db}.daily_trips").withColumn("sources", F.lit(len(tables)).cast("bigint"))


@query
def catalog_station_view(spark, sf):
    """Monthly station counts as a deployed view over a stored table of canonical trips."""
    db = _database(spark)
    standins.trips(spark, sf).write.saveAsTable(f"{db}.trips")
    named_views.deploy_view(spark, f"{db}.station_counts", named_views.station_counts_monthly_sql(f"{db}.trips", standins.CUTOVER))
    return spark.table(f"{db}.station_counts")


@query
def catalog_hourly_views(spark, sf):
    """Hourly trips with weather as a view over the views of both, themselves over an external table of observations
    and a table of trips."""
    folder, db = new_folder(spark, "observed"), _database(spark)
    standins.observations(spark, sf).write.parquet(folder)
    standins.event_trips(spark, sf).write.saveAsTable(f"{db}.trips")
    named_views.register_external(spark, f"{db}.lcd_hourly", folder)
    views = {
        "weather_hourly": named_views.weather_hourly_sql(f"{db}.lcd_hourly"),
        "hourly_trips": named_views.hourly_trips_sql(f"{db}.trips"),
        "hourly_trips_weather": named_views.hourly_trips_weather_sql(f"{db}.hourly_trips", f"{db}.weather_hourly"),
    }
    for name, sql in views.items():
        named_views.deploy_view(spark, f"{db}.{name}", sql)
    return spark.table(f"{db}.hourly_trips_weather")


#: Buckets of the stored tables below.
BUCKETS = 16


@query
def observation_pivot_bucketed(spark, sf):
    """Long observations stored by station and day, and pivoted where they lie."""
    stored = catalog.store_bucketed(standins.long_observations(spark, sf), f"{_database(spark)}.observations", ["id", "date"], BUCKETS)
    return weather_daily.pivot_observations(stored)


@query
def daily_trips_weather_bucketed(spark, sf):
    """Daily trips and weather stored by date, and joined bucket by bucket."""
    db = _database(spark)
    daily = trip_marts.daily_trips(standins.trips(spark, sf), standins.CUTOVER)
    daily = catalog.store_bucketed(daily, f"{db}.m_daily_trips", ["date"], BUCKETS)
    weather = catalog.store_bucketed(standins.home_weather(spark, sf), f"{db}.m_weather_daily", ["date"], BUCKETS)
    return trip_marts.join_daily_weather(daily, weather)


@query
def snapshot_descriptions(spark, sf):
    """What the catalog says about each column of a snapshot of the home station's weather, and how many days have it."""
    db = _database(spark)
    standins.home_weather(spark, sf).createOrReplaceTempView("weather_of_home")
    home = catalog.with_descriptions(spark.table("weather_of_home"), "weather_daily_nyc")
    home.write.saveAsTable(f"{db}.m_weather_daily_nyc")
    told = [(c.name, c.description) for c in spark.catalog.listColumns(f"{db}.m_weather_daily_nyc")]
    stored = spark.table(f"{db}.m_weather_daily_nyc")
    filled = stored.agg(*[F.count(c).alias(c) for c in stored.columns]).unpivot([], stored.columns, "column", "filled")
    return filled.join(spark.createDataFrame(told, "column string, description string"), "column")


@query
def trip_files_one_scan(spark, sf):
    """Raw legacy files of two headers, columns in another order, and one of neither layout, typed in one scan; some records
    are cut by a line break and set aside."""
    folder = new_folder(spark, "lines")
    raw = raw_trip_cells(spark, sf).withColumn("start_station_name", F.when(F.col("row_id") % 31 == 5, F.lit("Line\nbreak")).otherwise(F.col("start_station_name")))
    cells = [c for c in raw.columns if c not in ("row_id", "source_file")]
    spelled = [F.col(c).alias(c.replace("_", " ").title() + " ") for c in cells]
    _as_csv(raw.filter("row_id % 2 = 0").select(*spelled)).csv(f"{folder}/a")
    _as_csv(raw.filter("row_id % 2 = 1").select(*[F.col(c).alias(c.upper().replace("_", "-")) for c in reversed(cells)])).csv(f"{folder}/b")
    spark.createDataFrame([("x", "y")], "a string, b string").coalesce(1).write.option("header", "true").csv(f"{folder}/c")
    planned = trip_lines.layouts(spark, folder)
    bad = planned[0].filter("error IS NOT NULL").count()
    broken = trip_lines.broken_lines(spark, folder, planned).count()
    typed = trip_lines.typed_lines(spark, folder, "legacy", planned).filter("start_time IS NOT NULL")
    return typed.groupBy("region", F.date_format("start_time", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("start_station_name").alias("named"),
        F.sum("trip_duration").alias("seconds"),
        F.sum("birth_year").alias("birth_years"),
        F.count_distinct("start_station_id").alias("stations"),
        F.lit(bad).cast("bigint").alias("bad_files"),
        F.lit(broken).cast("bigint").alias("broken_lines"),
    )
