"""Named views, snapshots, descriptions and mart reads."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from velomet.operators.unify import unified_branch
from velomet.sources.descriptions import COLUMN_DESCRIPTIONS

SNAPSHOT_PREFIX = "m_"


class NoSource(RuntimeError):
    """None of the expected Parquet folders holds data."""


def has_parquet(spark: SparkSession, folder: str) -> bool:
    """Whether a folder holds at least one Parquet file, found by listing only."""
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(folder)
    fs = location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(location):
        return False
    files = fs.listFiles(location, True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def external_table(spark: SparkSession, folder: str) -> DataFrame | None:
    """The Parquet dataset under a folder, or None when there is nothing yet."""
    return spark.read.parquet(folder) if has_parquet(spark, folder) else None


def unified_from_folders(
    spark: SparkSession, folders: Mapping[tuple[str, str], str]
) -> DataFrame:
    """Canonical trips from whichever (region, era) folders hold data."""
    branches = []
    for (region, era), folder in folders.items():
        typed = external_table(spark, folder)
        if typed is not None:
            typed = typed.withColumn("source_file", F.col("_metadata.file_path"))
            branches.append(unified_branch(typed, era, region))
    if not branches:
        raise NoSource("no trip folder holds Parquet; load typed trips first")
    return reduce(DataFrame.unionByName, branches)


def deploy_views(
    spark: SparkSession, builders: Mapping[str, Callable[[], DataFrame]]
) -> list[str]:
    """Register each named result as a view; later builders may read earlier views."""
    for name, build in builders.items():
        build().createOrReplaceTempView(name)
    return list(builders)


def snapshot(
    spark: SparkSession,
    name: str,
    folder: str | None = None,
    partition_by: Sequence[str] = (),
    describe: str | None = None,
) -> int:
    """Materialize view ``name`` as ``m_<name>`` and return its row count.

    The count is observed while the table is written, so the view is computed once.
    """
    seen = Observation()
    df = spark.table(name)
    if describe:
        df = with_descriptions(df, describe)
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if folder:
        writer.save(folder)
        spark.read.parquet(folder).createOrReplaceTempView(SNAPSHOT_PREFIX + name)
    else:
        writer.saveAsTable(SNAPSHOT_PREFIX + name)
    return seen.get["rows"]


def store_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Store a table in ``buckets`` files by hash of ``keys``, sorted by them, and read it back.

    Aggregations on the keys, and joins on them with a table of as many buckets, then need no shuffle. Choose keys
    that spread: a bucket of a key that holds a third of the rows is one task's work, so add a column (the date to
    a station) where one does.
    """
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


def with_descriptions(df: DataFrame, relation: str) -> DataFrame:
    """Attach column descriptions as metadata; they travel with a table write."""
    texts = COLUMN_DESCRIPTIONS[relation]
    return df.select(
        *[
            F.col(c).alias(c, metadata={"comment": texts[c]}) if c in texts else F.col(c)
            for c in df.columns
        ]
    )


def read_mart(
    spark: SparkSession,
    name: str,
    columns: Sequence[str] = (),
    order_by: Sequence[str] = (),
) -> DataFrame:
    """A mart pruned to the columns asked for and ordered for the consumer."""
    mart = spark.table(name)
    if columns:
        mart = mart.select(*columns)
    return mart.orderBy(*order_by) if order_by else mart


def read_mart_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A mart dumped to CSV, read back with a declared schema (dates parsed, no inference)."""
    return spark.read.schema(schema).option("header", "true").csv(path)
