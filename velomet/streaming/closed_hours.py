"""The hourly mart as a stream that closes hours, and a count of what came too late for them.

An hour is closed once the newest start time seen, less a delay, lies at its end or beyond. Closed hours are appended to the
mart once and for all, and their state is given up: what is held is the hours still open, however long the
stream runs and however many trips an hour has. A trip whose hour is closed when it arrives is late and leaves the mart alone.

Late trips are not lost from sight. A second, stateless query over the same files counts arrivals per hour, and what
arrived less what the mart counted is what came late. It reads one column and writes a few rows a batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from velomet.fixed_values import CURRENT_ERA_START
from velomet.functions.calendar import clock_hour
from velomet.operators.trip_marts import hour_measures
from velomet.operators.unify import owned_rows

#: How long an hour waits for late trips after the newest one seen.
DELAY = "2 hours"
_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _instant(wall_clock: str) -> Column:
    """A wall-clock time as the instant it names in UTC, whatever the session's zone; watermarks need instants."""
    return F.timestamp_micros(F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, {wall_clock})"))


def _wall_clock(instant: Column) -> Column:
    return F.expr(_EPOCH) + F.make_dt_interval(secs=F.unix_seconds(instant).cast("decimal(18,6)"))


def close_hours(
    trips: DataFrame, folder: str, checkpoint: str, delay: str = DELAY, cutover: str = CURRENT_ERA_START
) -> StreamingQuery:
    """Append the hours that the arrived trips close to the mart in ``folder``, by date, then stop.

    Every closed hour is written exactly once, with the columns of ``trip_marts.hourly_trips``. Trips without a
    start time belong to no hour.
    """
    timed = owned_rows(trips, cutover).withColumn("started", _instant("start_time")).withWatermark("started", delay)
    hours = timed.groupBy(F.window("started", "1 hour").alias("span")).agg(*hour_measures())
    start = _wall_clock(F.col("span.start"))
    keys = [start.alias("hour_ts"), F.to_date(start).alias("date"), F.hour(start).alias("hour")]
    return (
        hours.select(*keys, *[c for c in hours.columns if c != "span"])
        .writeStream.outputMode("append")
        .format("parquet")
        .partitionBy("date")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def count_arrivals(trips: DataFrame, folder: str, checkpoint: str, cutover: str = CURRENT_ERA_START) -> StreamingQuery:
    """Add the arrived trips per hour to the counts in ``folder``, then stop. A retried batch replaces its own counts."""

    def write(batch: DataFrame, number: int) -> None:
        counted = batch.groupBy("hour_ts").agg(F.count(F.lit(1)).alias("arrived"))
        counted.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return (
        owned_rows(trips, cutover)
        .select(clock_hour(F.col("start_time")).alias("hour_ts"))
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def update_closed_hours(
    trips: DataFrame, folder: str, delay: str = DELAY, cutover: str = CURRENT_ERA_START, timeout: int | None = None
) -> None:
    """Bring mart and counts up to date with everything that has arrived.

    The mart comes first: a file that arrives in between is then counted as arrived before the mart has seen it, and
    for a closed hour that is what it will be, late.
    """
    close_hours(trips, f"{folder}/hours", f"{folder}/_state/hours", delay, cutover).awaitTermination(timeout)
    count_arrivals(trips, f"{folder}/arrivals", f"{folder}/_state/arrivals", cutover).awaitTermination(timeout)


def closed_hours(spark: SparkSession, folder: str) -> DataFrame:
    """The mart so far: closed hours with a trip in time."""
    columns = ["hour_ts", "date", "hour"]
    mart = spark.read.parquet(f"{folder}/hours")
    return mart.select(*columns, *[c for c in mart.columns if c not in columns])


def late_trips(spark: SparkSession, folder: str) -> DataFrame:
    """(hour_ts, late): trips that came after their hour was closed, up to the newest closed hour. Trips without a
    start time, which no hour can take, are listed under a null hour."""
    counted = closed_hours(spark, folder).select("hour_ts", "num_trips")
    arrived = spark.read.parquet(f"{folder}/arrivals").groupBy("hour_ts").agg(F.sum("arrived").alias("arrived"))
    newest = counted.agg(F.max("hour_ts").alias("newest"))
    late = F.col("arrived") - F.coalesce("num_trips", F.lit(0))
    return (
        arrived.join(counted, "hour_ts", "left")
        .filter(F.col("hour_ts").isNull() | (F.col("hour_ts") <= newest.scalar()))
        .select("hour_ts", late.alias("late"))
        .filter("late > 0")
    )
