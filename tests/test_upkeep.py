"""Marts kept current: hours closed by a watermark, days refreshed by loads, and sketches that merge."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from velomet.fixed_values import UNIFIED_COLUMNS
from velomet.operators import sketches
from velomet.operators.trip_marts import daily_trips, hourly_trips, station_counts_monthly
from velomet.plans import standins
from velomet.sources import refresh
from velomet.sources.refresh import TripStore
from velomet.streaming import closed_hours as closing

SCHEMA = ", ".join(f"{name} {kind}" for name, kind in UNIFIED_COLUMNS)


def made(spark, *trips):
    """Canonical trips from (start, seconds, region, file); everything else the same."""
    own = []
    for start, seconds, region, file in trips:
        row = dict.fromkeys((n for n, _ in UNIFIED_COLUMNS), None)
        begin = dt.datetime.fromisoformat(start) if start else None
        row |= {"start_time": begin, "trip_duration_seconds": seconds, "region": region, "source_file": file}
        row |= {"member_casual": "member", "rideable_type": "classic_bike", "source_era": "legacy", "start_station_name": f"St {seconds}"}
        own.append(tuple(row[n] for n, _ in UNIFIED_COLUMNS))
    return spark.createDataFrame(own, SCHEMA)


def rows(df, *drop):
    return sorted(map(str, df.drop(*drop).collect()))


# ---------------------------------------------------------------- closed hours
def arrive(spark, folder, *starts):
    made(spark, *[(s, 60 + i, "NYC", "f") for i, s in enumerate(starts)]).coalesce(1).write.mode("append").parquet(folder)


def test_hours_close_once_and_late_trips_are_counted(spark, tmp_path):
    arrivals, store = str(tmp_path / "arrivals"), str(tmp_path / "store")

    def update(*starts):
        arrive(spark, arrivals, *starts)
        stream = spark.readStream.schema(SCHEMA).parquet(arrivals)
        closing.update_closed_hours(stream, store, "2 hours", timeout=120)
        mart = {r.hour_ts.hour: r.num_trips for r in closing.closed_hours(spark, store).collect()}
        late = {r.hour_ts and r.hour_ts.hour: r.late for r in closing.late_trips(spark, store).collect()}
        return mart, late

    # Newest 12:30, so all that ends by 10:30 is closed; the hour of 10 waits.
    assert update("2024-03-01 08:10", "2024-03-01 09:50", "2024-03-01 10:05", "2024-03-01 12:30") == ({8: 1, 9: 1}, {})
    # Two for closed hours, one of them an hour without a trip in time; one that still counts; one without a time.
    mart, late = update("2024-03-01 09:59", "2024-03-01 07:00", "2024-03-01 10:40", None)
    assert (mart, late) == ({8: 1, 9: 1}, {9: 1, 7: 1, None: 1})
    mart, late = update("2024-03-01 14:00")
    assert (mart, late) == ({8: 1, 9: 1, 10: 2}, {9: 1, 7: 1, None: 1})
    mart, late = update("2024-03-02 03:00", "2024-03-01 11:59:59.999")
    assert (mart, late) == ({8: 1, 9: 1, 10: 2, 12: 1, 14: 1}, {9: 1, 7: 1, None: 1, 11: 1})


def test_closed_hours_equal_the_batch_mart(spark, sf_dir, tmp_path):
    """In time order nothing is late: all hours two hours before the newest trip are as in the batch mart."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    folder, store = str(tmp_path / "arrivals"), str(tmp_path / "store")
    batch = hourly_trips(standins.trips_of_events(events))
    for first, last in ((1, 10), (11, 20), (21, 31)):
        events.filter(F.dayofmonth("ts").between(first, last)).write.mode("append").parquet(folder)
        stream = spark.readStream.schema(events.schema).parquet(folder)
        closing.update_closed_hours(standins.trips_of_events(stream), store, timeout=120)
    newest = standins.trips_of_events(events).agg(F.max("start_time")).first()[0]
    closed = batch.filter(F.col("hour_ts") + F.expr("interval 3 hours") <= F.lit(newest))
    assert closed.count() > 300
    assert rows(closing.closed_hours(spark, store)) == rows(closed)
    assert closing.late_trips(spark, store).collect() == []


def test_state_holds_open_hours_only(spark, sf_dir, tmp_path):
    folder = str(tmp_path / "store")
    stream = spark.readStream.schema(spark.read.parquet(f"{sf_dir}/events.parquet").schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    run = closing.close_hours(standins.trips_of_events(stream), folder + "/hours", folder + "/state")
    run.awaitTermination(120)
    held = run.lastProgress["stateOperators"][0]
    assert held["numRowsTotal"] <= 4 and held["numRowsDroppedByWatermark"] == 0


# ---------------------------------------------------------------- refresh
@pytest.fixture()
def store(tmp_path):
    return TripStore(str(tmp_path / "store"))


class Files:
    """Files of trips by name; what a listing shows and a reader gives."""

    def __init__(self, spark):
        self.spark, self.held = spark, {}

    def put(self, name, *trips):
        self.held[name] = [(start, seconds, region, name) for start, seconds, region in trips]

    def listing(self):
        return self.spark.createDataFrame([(n, len(t)) for n, t in self.held.items()], "path string, size bigint")

    def read(self, files):
        names = [r.path for r in files.collect()]
        return made(self.spark, *[t for n in names for t in self.held[n]])

    def all(self):
        return made(self.spark, *[t for own in self.held.values() for t in own])


def load(spark, store, files):
    number = refresh.load_files(spark, store, files.listing(), files.read)
    days = {name: refresh.refresh(spark, store, name, build) for name, build in (("daily", daily_trips), ("hourly", hourly_trips))}
    for name, build in (("daily", daily_trips), ("hourly", hourly_trips)):
        assert rows(refresh.mart(spark, store, name), "load") == rows(build(files.all()))
    return number, days["daily"]


def test_loads_reopen_the_days_they_touch(spark, store):
    files = Files(spark)
    files.put("201401-a.csv", ("2014-01-03 10:00", 60, "NYC"), ("2014-01-03 11:00", 61, "NYC"), ("2014-01-09 10:00", 62, "NYC"))
    files.put("201402-a.csv", ("2014-02-01 10:00", 63, "NYC"), (None, 64, "NYC"))
    assert load(spark, store, files) == (1, 4)
    assert load(spark, store, files) == (None, 0)
    files.put("201403-a.csv", ("2014-03-01 10:00", 65, "JC"))
    assert load(spark, store, files) == (2, 1)
    # A late file of an old month, and one that comes again with another size.
    files.put("201401-late.csv", ("2014-01-09 23:00", 66, "JC"), ("2014-01-20 01:00", 67, "JC"))
    assert [(r.path, r.late) for r in refresh.pending(spark, store, files.listing()).collect()] == [("201401-late.csv", True)]
    assert load(spark, store, files) == (3, 2)
    at = {str(r.date): r.load for r in refresh.mart(spark, store, "daily").collect()}
    assert at == {"2014-01-03": 1, "2014-01-09": 3, "2014-01-20": 3, "2014-02-01": 1, "None": 1, "2014-03-01": 2}
    files.put("201402-a.csv", ("2014-02-02 10:00", 68, "NYC"))
    assert load(spark, store, files) == (4, 3)  # the day it has now, and both of its earlier version


def test_a_month_that_empties_goes(spark, store):
    files = Files(spark)
    files.put("201401.csv", ("2014-01-03 10:00", 60, "NYC"), ("2014-02-03 10:00", 60, "NYC"))
    load(spark, store, files)
    files.put("201401.csv", ("2014-02-03 11:00", 60, "NYC"))
    assert load(spark, store, files) == (2, 2)


def test_a_failed_load_is_not_seen(spark, store, monkeypatch):
    files = Files(spark)
    files.put("201401.csv", ("2014-01-03 10:00", 60, "NYC"))
    load(spark, store, files)
    files.put("201402.csv", ("2014-02-03 10:00", 60, "NYC"))
    whole, calls = refresh._stored, []

    def once(*args):
        calls.append(args)
        if len(calls) == 2:  # the trips are written, their days are not
            raise RuntimeError("lost")
        return whole(*args)

    with monkeypatch.context() as broken:
        broken.setattr(refresh, "_stored", once)
        with pytest.raises(RuntimeError, match="lost"):
            refresh.load_files(spark, store, files.listing(), files.read)
    assert refresh.live_trips(spark, store).count() == 1
    number, days = load(spark, store, files)
    assert number == 3 and days == 1 and refresh.live_trips(spark, store).count() == 2


def test_refresh_reads_changed_months_and_days(spark, store):
    files = Files(spark)
    for month in range(1, 10):
        files.put(f"20140{month}.csv", *[(f"2014-0{month}-{day:02d} 10:00", 60, "NYC") for day in range(1, 25)])
    load(spark, store, files)
    days = spark.createDataFrame([(dt.date(2014, 3, 4),), (dt.date(2014, 3, 6),)], "date date")
    found = refresh.trips_of_days(spark, store, days)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [start_month" in plan or "(start_month" in plan.split("PartitionFilters")[1].split("]")[0]
    scan = plan.split("DataFilters: [")[1]
    assert "(start_time" in scan and ">= 2014-03-04 00:00:00" in scan and "< 2014-03" in scan
    assert refresh.within(days)[0] == ["2014-03"]
    assert found.count() == 2


# ---------------------------------------------------------------- sketches
def test_merged_medians_keep_their_bound(spark):
    n = 60_000
    t = spark.range(n).select(
        F.expr("timestamp_ntz'2019-01-01 00:00:00' + make_dt_interval(cast(id % 700 as int))").alias("start_time"),
        F.when(F.col("id") % 11 != 0, F.pmod(F.xxhash64("id"), F.lit(90_000))).alias("trip_duration_seconds"),
        F.when(F.col("id") % 3 == 0, "JC").otherwise("NYC").alias("region"),
        F.lit("legacy").alias("source_era"),
    )
    daily = sketches.daily_durations(t, size=256)
    got = sketches.duration_quantiles(daily, [F.year("date").alias("year"), "region"], (0.1, 0.5, 0.95), size=256).collect()
    assert len(got) == 4 and sum(r.trips for r in got) == n
    exact = {(r.year, r.region): sorted(r.v) for r in t.groupBy(F.year("start_time").alias("year"), "region").agg(F.collect_list("trip_duration_seconds").alias("v")).collect()}
    for r in got:
        v = exact[r.year, r.region]
        assert (r.timed, r.least, r.most) == (len(v), v[0], v[-1])
        for q, value in ((0.1, r.q10), (0.5, r.q50), (0.95, r.q95)):
            rank = sum(x <= value for x in v) / len(v)
            assert abs(rank - q) < 2 * sketches.rank_error(256)
    assert sketches.rank_error(2048) < 0.0015


def test_quantiles_of_nothing(spark):
    t = made(spark, ("2020-01-01 10:00", None, "NYC", "f"))
    (r,) = sketches.duration_quantiles(sketches.daily_durations(t), ["region"]).collect()
    assert (r.trips, r.timed, r.least, r.most, r.q50) == (1, 0, None, None, None)
    assert sketches.duration_quantiles(sketches.daily_durations(t.limit(0)), ["region"]).collect() == []


def test_station_sets_count_as_the_exact_mart(spark, sf_dir):
    trips = standins.trips(spark, sf_dir)
    sets = sketches.monthly_station_sets(trips, standins.CUTOVER)
    got = {(r.month, r.region): (r.stations, r.trips) for r in sketches.station_totals(sets, ["month", "region"]).collect()}
    exact = station_counts_monthly(trips, standins.CUTOVER).collect()
    assert got == {(r.month, r.region): (r.num_stations, r.num_trips) for r in exact}


def test_stations_kept_and_bounds(spark):
    """Sets far larger than the sketches: counts and set operations within the stated errors."""
    ids = lambda low, high, year: spark.range(low, high).select(
        F.lit(dt.datetime(year, 5, 1)).cast("timestamp_ntz").alias("start_time"),
        F.lit("NYC").alias("region"), F.lit("legacy").alias("source_era"), F.concat(F.lit(" st  "), F.col("id").cast("string")).alias("start_station_name"),
    )
    trips = ids(0, 60_000, 2020).union(ids(20_000, 100_000, 2021)).union(ids(5, 10, 2023)).union(ids(7, 12, 2024))
    sets = sketches.monthly_station_sets(trips, theta_bits=12, hll_bits=12)
    by_year = {r.year: r for r in sketches.station_totals(sets, [F.year("month").alias("year")], bits=12).collect()}
    for year, n in ((2020, 60_000), (2021, 80_000), (2023, 5), (2024, 5)):
        assert abs(by_year[year].stations - n) <= sketches.theta_error(12) * n
        assert abs(by_year[year].stations_hll - n) <= sketches.hll_error(12) * n + 0.5
    kept = {r.year: r for r in sketches.stations_kept(sets, bits=12).collect()}
    assert set(kept) == {2021, 2024}
    r = kept[2024]
    assert (r.stations, r.before, r.kept, r.opened, r.closed) == (5, 5, 3, 2, 2)
    r = kept[2021]
    union = 100_000  # set operations err in proportion to the union
    for got, want in ((r.kept, 40_000), (r.opened, 40_000), (r.closed, 20_000)):
        assert abs(got - want) <= sketches.theta_error(12) * union
