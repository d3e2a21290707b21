"""File manifests as DataFrames: which files to take, skip or load next.

A manifest has one row per file, so every decision here is a join or an aggregate and stays
cheap for any number of files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# Fixed value: a shard is "<base>_<number>"; "-part<number>" is not one.
SHARD_PATTERN = r"^(.+)_\d+$"
MONTH_PATTERN = r"(\d{6})"

MANIFEST_SCHEMA = "path string, size bigint"


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def region_of(path: Column) -> Column:
    """``JC`` for files named ``JC-...`` in any case, ``NYC`` for all others."""
    return F.when(F.upper(basename(path)).startswith("JC-"), "JC").otherwise("NYC")


def list_files(spark: SparkSession, folder: str, suffix: str = "") -> DataFrame:
    """Paths and sizes under a folder, from the file listing alone (no content is read)."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    return reader.load(folder).select("path", F.col("length").alias("size"))


def csv_members(manifest: DataFrame, archive: str = "archive") -> DataFrame:
    """The CSV members to load of each archive, so that each month counts once.

    Members with the same name keep the shallowest path. A ``<base>_N`` shard is dropped when
    the combined ``<base>`` exists in the same archive.
    """
    members = manifest.filter(
        F.lower("path").endswith(".csv") & ~F.col("path").startswith("__MACOSX")
    ).withColumn("base", basename(F.col("path")))
    depth = F.length("path") - F.length(F.replace("path", F.lit("/"), F.lit("")))
    shallowest = Window.partitionBy(archive, "base").orderBy(depth, "path")
    members = (
        members.withColumn("nth", F.row_number().over(shallowest))
        .filter("nth = 1")
        .withColumn("stem", F.expr("left(base, length(base) - 4)"))
        .withColumn("combined", F.regexp_extract("stem", SHARD_PATTERN, 1))
    )
    stems = members.select(archive, F.col("stem").alias("combined"))
    return members.join(stems, [archive, "combined"], "left_anti").select(*manifest.columns)


def select_archives(
    manifest: DataFrame,
    region: str = "all",
    names: Sequence[str] = (),
    first: int = 0,
    suffix: str = ".zip",
) -> DataFrame:
    """Archives by suffix, then by explicit names, or by region and the first N in path order."""
    chosen = manifest.filter(F.col("path").endswith(suffix))
    if names:
        wanted = list(names)
        return chosen.filter(
            F.col("path").isin(wanted) | basename(F.col("path")).isin(wanted)
        ).orderBy("path")
    if region != "all":
        chosen = chosen.filter(region_of(F.col("path")) == region.upper())
    chosen = chosen.orderBy("path")
    return chosen.limit(first) if first else chosen


def manifest_diff(
    remote: DataFrame, stored: DataFrame, overwrite: bool = False, plan_only: bool = False
) -> DataFrame:
    """What to do with each remote file: ``skip`` when stored at the same size, else fetch it.

    ``plan_only`` reports ``plan`` instead of ``mirror``.
    """
    todo = "plan" if plan_only else "mirror"
    have = stored.select("path", F.col("size").alias("stored_size"))
    same = F.lit(False) if overwrite else F.col("size") == F.col("stored_size")
    return remote.join(have, "path", "left").withColumn(
        "action", F.when(same, "skip").otherwise(todo)
    )


def not_yet_loaded(manifest: DataFrame, loaded: DataFrame, overwrite: bool = False) -> DataFrame:
    """Files whose name is not among the already loaded ``source_file`` names."""
    if overwrite:
        return manifest
    done = loaded.select(basename(F.col("source_file")).alias("base"))
    return (
        manifest.withColumn("base", basename(F.col("path"))).join(done, "base", "left_anti").drop("base")
    )


def newer_months(
    manifest: DataFrame, loaded: DataFrame, monthly: str = r"^\d{6}-.*tripdata"
) -> DataFrame:
    """Monthly files strictly newer than the latest month already loaded.

    ``loaded`` has a ``path`` column; with nothing loaded every monthly file qualifies.
    """
    latest = loaded.select(
        F.coalesce(
            F.max(F.nullif(F.regexp_extract(basename(F.col("path")), MONTH_PATTERN, 1), F.lit(""))),
            F.lit("000000"),
        ).alias("latest")
    )
    base = basename(F.col("path"))
    return manifest.filter(
        base.rlike(monthly) & (F.substring(base, 1, 6) > latest.scalar())
    ).orderBy("path")
