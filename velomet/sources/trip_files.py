"""Raw trip CSV files to typed Parquet.

Files are grouped by header; each group is one ``read.csv`` with an explicit all-text schema
and one ``select`` of typed expressions. Only the header line of a file is ever looked at on
the driver.
"""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from velomet.fixed_values import COLUMN_RENAMES, CURRENT_SIGNALS, ERA_COLUMNS, LEGACY_SIGNALS
from velomet.functions.text import clean_cells, coerce_cells, to_text, typed_cell
from velomet.sources.manifest import region_of


class UnknownLayout(ValueError):
    """A header that carries the signals of neither layout."""


#: What may stand between the words of a header cell, and what is left out of them.
_BETWEEN, _LEFT_OUT = re.compile(r"[\s_-]+"), re.compile(r"[()]")


def normalize_column(name: str) -> str:
    """Canonical spelling of one raw header cell: its words in lower case, joined by underscores."""
    parts = [part for part in _BETWEEN.split(_LEFT_OUT.sub("", name).lower()) if part]
    spelled = "_".join(parts)
    return COLUMN_RENAMES.get(spelled, spelled)


def detect_era(header: Iterable[str]) -> str:
    """Layout of a file, judged by its header and never by its name.

    The layouts share most columns, so the ones only one of them has decide. A column of the newer
    layout outweighs any of the older one, which exports of the changeover still carry.
    """
    columns = sorted({normalize_column(cell) for cell in header})
    signs = dict.fromkeys(LEGACY_SIGNALS, "legacy") | dict.fromkeys(CURRENT_SIGNALS, "current")
    seen = {signs[column] for column in columns if column in signs}
    if not seen:
        raise UnknownLayout(f"no known layout has the columns {columns}")
    return min(seen)


def read_header(spark: SparkSession, path: str) -> list[str]:
    """First CSV record of one file, through the Hadoop file system the path belongs to."""
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    stream = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(location)
    reader = jvm.java.io.BufferedReader(
        jvm.java.io.InputStreamReader(stream, "UTF-8")
    )
    try:
        line = reader.readLine() or ""
    finally:
        reader.close()
    return next(csv.reader([line.lstrip("﻿")]), [])


@dataclass(frozen=True)
class HeaderGroup:
    era: str
    columns: tuple[str, ...]
    paths: tuple[str, ...]


@dataclass
class FilePlan:
    """Files grouped by header, and the ones that could not be placed with the reason."""

    groups: list[HeaderGroup] = field(default_factory=list)
    errors: dict[str, str] = field(default_factory=dict)


def plan_files(spark: SparkSession, paths: Sequence[str], threads: int = 16) -> FilePlan:
    """Group files by header. A bad file is recorded and does not stop the others."""
    plan = FilePlan()
    grouped: dict[tuple[str, tuple[str, ...]], list[str]] = defaultdict(list)

    def classify(path: str):
        header = read_header(spark, path)
        return detect_era(header), tuple(normalize_column(h) for h in header)

    with ThreadPoolExecutor(max_workers=threads) as pool:
        pending = {path: pool.submit(classify, path) for path in paths}
    for path, outcome in pending.items():
        problem = outcome.exception()
        if problem is None:
            grouped[outcome.result()].append(path)
        else:
            plan.errors[path] = str(problem)
    plan.groups = [HeaderGroup(era, cols, tuple(sorted(p))) for (era, cols), p in grouped.items()]
    return plan


def without_damaged_files(spark: SparkSession, plan: FilePlan, threads: int = 8) -> FilePlan:
    """The plan without files whose body cannot be read to the end, such as a cut-off archive.

    Each file is read through once in a small job of its own, so use it on files that have just arrived.
    """
    paths = [path for group in plan.groups for path in group.paths]

    def read_through(path: str) -> int:
        return spark.read.text(path).count()

    with ThreadPoolExecutor(max_workers=threads) as pool:
        outcomes = {path: pool.submit(read_through, path) for path in paths}
    errors = {path: str(e).splitlines()[0] for path, o in outcomes.items() if (e := o.exception())}
    groups = []
    for group in plan.groups:
        good = tuple(path for path in group.paths if path not in errors)
        if good:
            groups.append(HeaderGroup(group.era, group.columns, good))
    return FilePlan(groups, plan.errors | errors)


def read_raw(spark: SparkSession, group: HeaderGroup) -> DataFrame:
    """One header group as text columns plus ``source_file``; blank cells arrive as NULL."""
    schema = ", ".join(f"`{name}` string" for name in group.columns)
    return (
        spark.read.schema(schema)
        .option("header", "true")
        .option("enforceSchema", "true")
        .option("escape", '"')
        .csv(list(group.paths))
        .withColumn("source_file", F.col("_metadata.file_path"))
    )


def align_to_era(raw: DataFrame, era: str, keep: Sequence[str] = ()) -> DataFrame:
    """Exactly the columns of the layout, typed: absent ones NULL, extra ones dropped.

    A projection only, so the number of rows cannot change.
    """
    present = {name: kind for name, kind in ERA_COLUMNS[era] if name in raw.columns}
    typed = coerce_cells(raw, present)
    columns = [
        F.col(name) if name in present else F.lit(None).cast(kind).alias(name)
        for name, kind in ERA_COLUMNS[era]
    ]
    return typed.select(*columns, *[c for c in keep if c in raw.columns])


def quarantine(raw: DataFrame, era: str) -> DataFrame:
    """Rows with a non-blank cell that does not fit its type, one row per such cell.

    Columns: source_file, column, value. Count it by column for an error report.
    """
    typed = [(n, k) for n, k in ERA_COLUMNS[era] if k != "string" and n in raw.columns]
    kept = raw.withColumns({f"_raw_{n}": F.col(n) for n, _ in typed})
    bad: list[Column] = []
    for name, kind in typed:
        cell = F.col(name)
        lost = to_text(cell).isNotNull() & typed_cell(cell, kind).isNull()
        bad.append(F.when(lost, F.struct(F.lit(name).alias("column"), F.col(f"_raw_{name}").alias("value"))))
    source = F.col("source_file") if "source_file" in raw.columns else F.lit(None).cast("string")
    return (
        clean_cells(kept, [n for n, _ in typed])
        .select(source.alias("source_file"), F.explode(F.array_compact(F.array(*bad))).alias("cell"))
        .select("source_file", "cell.column", "cell.value")
    )


def typed_trips(spark: SparkSession, plan: FilePlan, era: str) -> DataFrame | None:
    """All files of one layout as typed trips with region and source_file; None without files."""
    parts = [
        align_to_era(read_raw(spark, group), era, keep=["source_file"])
        for group in plan.groups
        if group.era == era
    ]
    if not parts:
        return None
    trips = reduce(DataFrame.unionByName, parts)
    return trips.withColumn("region", region_of(F.col("source_file"))).withColumn(
        "source_era", F.lit(era)
    )


#: Tasks that write one month of one region and layout at most.
FOLDER_SLICES = 8


def months_between(first: str | None = None, before: str | None = None) -> Column:
    """Condition on ``start_month`` that a start time in [first, before) implies; times as ISO text."""
    month, bound = F.col("start_month").cast("string"), F.lit(True)
    if first is not None:
        bound &= month >= first[:7]
    if before is not None:
        bound &= month <= before[:7]
    return bound


def write_typed(trips: DataFrame, folder: str, mode: str = "append") -> None:
    """Typed Parquet routed by region, layout and month.

    A filter on ``start_month`` prunes folders; ``months_between`` derives one from a time range. Rows are
    dealt by folder and a few slices of its rows first, so a task opens few folders and a month gets few
    files. Rows without a start time land in the default partition and stay readable.
    """
    keys = ["region", "source_era", "start_month"]
    slice_ = F.pmod(F.xxhash64("start_time"), F.lit(FOLDER_SLICES))
    (
        trips.withColumn("start_month", F.date_format("start_time", "yyyy-MM"))
        .repartition(*keys, slice_)
        .write.mode(mode)
        .partitionBy("region", "source_era", "start_month")
        .parquet(folder)
    )
