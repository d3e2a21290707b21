"""A trip store that grows by loads, and marts that follow it day by day.

A load takes the files of a listing that are new or have another size, writes their trips beside what is there, and
commits by writing its list of files last. A file that comes again replaces its earlier version for every reader.
A mart is brought up to date by recomputing the days that files loaded since have trips on, or had in the version they
replaced: an old month's late file reopens its days and no others. What is read for that is the months of those days, and
within them the days' time range; what is written replaces the months' partitions of the mart in one job.

Everything listed here is of the size of files x days or of the calendar; trips are only ever scanned.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from velomet.sources.catalog import has_parquet
from velomet.sources.manifest import manifest_diff

_FILES = "path string, size bigint, load int"
_FILE_DAYS = "source_file string, date date, trips bigint, load int"
#: Tasks that write one month of one load at most.
MONTH_SLICES = 8


@dataclass(frozen=True)
class TripStore:
    """Folders of one store: trips by month and load, committed files, days of files, marts."""

    folder: str

    @property
    def trips(self) -> str:
        return f"{self.folder}/trips"

    @property
    def files(self) -> str:
        return f"{self.folder}/files"

    @property
    def days(self) -> str:
        return f"{self.folder}/days"

    def mart(self, name: str) -> str:
        return f"{self.folder}/marts/{name}"

    def applied(self, name: str) -> str:
        return f"{self.folder}/applied/{name}"


def _read(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    if not has_parquet(spark, folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(folder)


def versions(spark: SparkSession, store: TripStore) -> DataFrame:
    """Every committed version of every file: path, size, load, and the load that replaced it, if one did."""
    later = F.lead("load").over(Window.partitionBy("path").orderBy("load"))
    return _read(spark, store.files, _FILES).withColumn("replaced_by", later)


def pending(spark: SparkSession, store: TripStore, listing: DataFrame) -> DataFrame:
    """Files of a listing (path, size) that are not stored at that size; ``late`` marks those of months (six digits
    in the name) up to the newest one loaded."""
    month = F.nullif(F.regexp_extract("path", r"(\d{6})", 1), F.lit(""))
    current = versions(spark, store).filter("replaced_by IS NULL")
    newest = current.agg(F.max(month).alias("newest")).scalar()
    wanted = manifest_diff(listing, current).filter("action = 'mirror'")
    return wanted.select("path", "size", F.coalesce(month <= newest, F.lit(False)).alias("late"))


def load_files(
    spark: SparkSession, store: TripStore, listing: DataFrame, read: Callable[[DataFrame], DataFrame]
) -> int | None:
    """Load what is pending of a listing and return the load's number, or None when nothing is.

    ``read`` turns files (path, size) into canonical trips whose ``source_file`` is the path. A load that fails
    before its list of files is written leaves trips that no reader looks at.
    """
    files = pending(spark, store, listing).select("path", "size").persist()
    try:
        if files.isEmpty():
            return None
        number = _next_load(spark, store)
        trips = read(files).withColumn("start_month", F.date_format("start_time", "yyyy-MM")).withColumn("load", F.lit(number))
        slice_ = F.pmod(F.xxhash64("start_time"), F.lit(MONTH_SLICES))
        trips.repartition("start_month", slice_).write.mode("append").partitionBy("start_month", "load").parquet(store.trips)
        own = _stored(spark, store).filter(F.col("load") == number) if has_parquet(spark, store.trips) else trips.limit(0)
        by_day = own.groupBy("source_file", F.to_date("start_time").alias("date")).agg(F.count(F.lit(1)).alias("trips"))
        by_day.withColumn("load", F.lit(number)).write.mode("append").parquet(store.days)
        files.withColumn("load", F.lit(number)).write.mode("append").parquet(store.files)
        return number
    finally:
        files.unpersist()


def _next_load(spark: SparkSession, store: TripStore) -> int:
    """One more than any load that has left a trace, committed or not."""
    newest = _read(spark, store.days, _FILE_DAYS).agg(F.max("load")).first()[0] or 0
    if has_parquet(spark, store.trips):
        newest = max(newest, _stored(spark, store).agg(F.max("load")).first()[0] or 0)
    return max(newest, _read(spark, store.files, _FILES).agg(F.max("load")).first()[0] or 0) + 1


def _stored(spark: SparkSession, store: TripStore) -> DataFrame:
    return spark.read.parquet(store.trips)


def live_trips(spark: SparkSession, store: TripStore) -> DataFrame:
    """Trips of the newest version of every committed file.

    Loads that were not committed are pruned as partitions. Only versions that a later one replaced are joined
    against, which are few, and none of a store whose files never changed.
    """
    seen = versions(spark, store)
    loads = sorted(r["load"] for r in seen.select("load").distinct().collect())
    old = seen.filter("replaced_by IS NOT NULL").select(F.col("path").alias("source_file"), "load")
    return _stored(spark, store).filter(F.col("load").isin(loads)).join(old, ["source_file", "load"], "left_anti")


def changed_days(spark: SparkSession, store: TripStore, since: int) -> DataFrame:
    """(date): days with trips in files loaded after load ``since``, or in the versions these replaced. Null is a
    day: that of trips without a start time."""
    seen = versions(spark, store).filter(f"load > {since} OR replaced_by > {since}")
    days = _read(spark, store.days, _FILE_DAYS)
    moved = (days["source_file"] == seen["path"]) & (days["load"] == seen["load"])
    return days.join(seen, moved, "left_semi").select("date").distinct()


def within(days: DataFrame) -> tuple[list[str | None], Column]:
    """Months of some days, and a condition on trips that prunes folders by month and files by time range."""
    months = sorted((r[0] for r in days.select(F.date_format("date", "yyyy-MM")).distinct().collect()), key=str)
    low, high = days.agg(F.min("date"), F.date_add(F.max("date"), 1)).first()
    dated = F.col("start_month").isin([m for m in months if m])
    if low is not None:
        start = F.col("start_time")
        dated &= (start >= F.lit(low).cast("timestamp_ntz")) & (start < F.lit(high).cast("timestamp_ntz"))
    return months, dated | F.col("start_month").isNull() if None in months else dated


def trips_of_days(spark: SparkSession, store: TripStore, days: DataFrame) -> DataFrame:
    """Live trips of the given days, read from their months and time range only."""
    _, condition = within(days)
    trips = live_trips(spark, store).filter(condition)
    return trips.join(days, F.to_date("start_time").eqNullSafe(days["date"]), "left_semi").drop("start_month", "load")


def refresh(spark: SparkSession, store: TripStore, name: str, build: Callable[[DataFrame], DataFrame]) -> int:
    """Bring the mart ``name`` up to date with all committed loads and return the number of days recomputed.

    ``build`` makes the mart from canonical trips and gives it a ``date`` per row. The mart is stored by month, each
    row with the load it was last computed at. Running it again, also after a failure, does no harm.
    """
    folder = store.mart(name)
    newest = versions(spark, store).agg(F.max("load")).first()[0] or 0
    since = _read(spark, store.applied(name), "load int").agg(F.max("load")).first()[0] or 0
    if newest <= since:
        return 0
    days = changed_days(spark, store, since).persist()
    try:
        count = days.count()
        if count:
            months, _ = within(days)
            fresh = build(trips_of_days(spark, store, days)).withColumn("load", F.lit(newest))
            fresh = fresh.withColumn("mart_month", F.coalesce(F.date_format("date", "yyyy-MM"), F.lit("none")))
            names = [m or "none" for m in months]
            if has_parquet(spark, folder):
                kept = mart(spark, store, name, months=True).filter(F.col("mart_month").isin(names))
                fresh = fresh.unionByName(kept.join(days, kept["date"].eqNullSafe(days["date"]), "left_anti"))
            writer = fresh.repartition("mart_month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy("mart_month").parquet(folder)
            _drop_emptied(spark, store, name, days, names, newest)
        spark.createDataFrame([(newest,)], "load int").coalesce(1).write.mode("append").parquet(store.applied(name))
        return count
    finally:
        days.unpersist()


def _drop_emptied(spark: SparkSession, store: TripStore, name: str, days: DataFrame, months: list[str], load: int) -> None:
    """Remove months whose days are all gone: an overwrite leaves partitions alone that it writes nothing to, and
    these show by changed days of an earlier load."""
    stored = mart(spark, store, name, months=True).filter(F.col("mart_month").isin(months) & (F.col("load") < load))
    stale = stored.join(days, stored["date"].eqNullSafe(days["date"]), "left_semi").select("mart_month").distinct().collect()
    jvm = spark.sparkContext._jvm
    for row in stale:
        place = jvm.org.apache.hadoop.fs.Path(f"{store.mart(name)}/mart_month={row[0]}")
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def mart(spark: SparkSession, store: TripStore, name: str, months: bool = False) -> DataFrame:
    """A mart kept by ``refresh``; ``months`` keeps the text of its partitions."""
    stored = spark.read.parquet(store.mart(name))
    return stored if months else stored.drop("mart_month")
