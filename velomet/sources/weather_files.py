"""Raw weather CSV files to typed Parquet, and the yearly daily-observation folders."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from velomet.fixed_values import (
    DAILY_ELEMENTS,
    DAILY_FLAGS,
    DAILY_MEAN_ELEMENT,
    HOME_STATION,
    KEPT_REPORTS,
    OBSERVATION_NUMBERS,
    OBSERVATION_TEXTS,
)
from velomet.functions.text import (
    observation_cells,
    observation_number,
    optional_text,
    strip,
    to_wall_clock,
)
from velomet.sources.trip_files import read_header

LINE_ORDER = ["source_file", "block_start", "line_in_block"]


NEEDED = {"DATE", "REPORT_TYPE"}


def read_observation_csv(
    spark: SparkSession, paths: Sequence[str], errors: dict[str, str] | None = None, threads: int = 16
) -> DataFrame:
    """Station-year files as text columns, with the order of the lines made explicit.

    Splits of one file are ordered by their block start and lines within a split by a
    running id, so "first in the file" stays well defined when a file is read in parallel.
    Files may differ in their columns. A file that cannot be opened or lacks the date or the
    report type is put into ``errors`` with the reason and skipped; without ``errors`` it
    raises. No usable file gives no rows.
    """

    def header_of(path: str) -> tuple[str, ...]:
        header = tuple(read_header(spark, path))
        if missing := NEEDED - set(header):
            raise ValueError(f"no column {sorted(missing)}")
        return header

    with ThreadPoolExecutor(max_workers=threads) as pool:
        pending = {path: pool.submit(header_of, path) for path in paths}
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path, outcome in pending.items():
        problem = outcome.exception()
        if problem is None:
            by_header.setdefault(outcome.result(), []).append(path)
        elif errors is None:
            raise problem
        else:
            errors[path] = str(problem)
    frames = []
    for header, group in by_header.items():
        schema = ", ".join(f"`{name}` string" for name in header)
        frames.append(
            spark.read.schema(schema)
            .option("header", "true")
            .option("escape", '"')
            .csv(group)
            .withColumn("source_file", F.col("_metadata.file_path"))
            .withColumn("block_start", F.col("_metadata.file_block_start"))
            .withColumn("line_in_block", F.monotonically_increasing_id())
        )
    if not frames:
        texts = ", ".join(f"{name} string" for name in sorted(NEEDED))
        return spark.createDataFrame([], f"{texts}, source_file string, block_start bigint, line_in_block bigint")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in the given order.

    ``row_number() = 1`` is planned with a group limit below the shuffle: each task passes on
    one row per key, so a key with very many repeats does not travel whole.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("nth", F.row_number().over(first)).filter("nth = 1").drop("nth")


def hourly_observations(
    raw: DataFrame, station: str | Column = HOME_STATION, order: Sequence[str] = LINE_ORDER
) -> DataFrame:
    """Typed observations: routine and special reports only, each (time, report) once.

    The first of repeated reports is picked among raw cells, so that only its keys are worked on below the shuffle and only
    what is kept gets typed. Cells and keys in one projection would also be more than one generated method may hold.
    """
    sources = [src for src, *_ in (*OBSERVATION_NUMBERS, *OBSERVATION_TEXTS) if src in raw.columns]
    report = strip(F.col("REPORT_TYPE"))
    station_id = F.lit(station) if isinstance(station, str) else station
    keyed = raw.filter(report.isin(KEPT_REPORTS)).select(
        station_id.alias("station_id"),
        to_wall_clock(F.col("DATE")).alias("obs_time_lst"),
        report.alias("report_type"),
        *sources,
        "source_file",
        *[F.col(c).alias(f"_{c}") for c in order],
    )
    keys = ["station_id", "obs_time_lst", "report_type"]
    first = observation_cells(keep_first(keyed, keys, [f"_{c}" for c in order]), sources)
    numbers = [
        (observation_number(F.col(src), trace) if src in sources else F.lit(None).cast("double")).alias(name)
        for src, name, trace in OBSERVATION_NUMBERS
    ]
    texts = [
        (optional_text(F.col(src)) if src in sources else F.lit(None).cast("string")).alias(name)
        for src, name in OBSERVATION_TEXTS
    ]
    return first.select(*keys, *numbers, *texts, "source_file")


def write_hourly_observations(observations: DataFrame, folder: str) -> None:
    """Typed Parquet by year and station, time-ordered inside each file.

    What a run brings replaces the same station-years and leaves all others as they are, so years can
    come one after another and a year can be loaded again. A station-year has to come whole.
    """
    (
        observations.withColumns({"year": F.year("obs_time_lst"), "station": F.col("station_id")})
        .repartition("year", "station")
        .sortWithinPartitions("year", "station", "obs_time_lst", "report_type")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "station")
        .option("compression", "snappy")
        .parquet(folder)
    )


def read_hourly_observations(spark: SparkSession, folder: str) -> DataFrame:
    """What write_hourly_observations has stored, with ``year`` for pruning."""
    return spark.read.parquet(folder).drop("station")


def daily_elements() -> list[str]:
    """The 19 element codes the daily mart uses."""
    return [
        DAILY_MEAN_ELEMENT,
        *[code for _, code, _ in DAILY_ELEMENTS],
        *[code for _, code in DAILY_FLAGS],
    ]


def read_daily_observations(
    spark: SparkSession, folder: str, first_year: int | None = None, last_year: int | None = None
) -> DataFrame:
    """Long daily observations of US stations from folders partitioned by ``year``.

    A year bound, where the caller gives one, prunes folders; station prefix and element list reach the
    Parquet scan.
    """
    daily = spark.read.parquet(folder)
    if first_year is not None:
        daily = daily.filter(F.col("year") >= first_year)
    if last_year is not None:
        daily = daily.filter(F.col("year") <= last_year)
    return (
        daily.filter(F.col("id").startswith("US") & F.col("element").isin(daily_elements()))
        .select("id", "date", "element", "value", "qflag")
    )
