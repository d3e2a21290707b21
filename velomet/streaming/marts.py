"""The trip marts as incremental jobs over typed trip folders.

The file source remembers which files it has seen, so a rerun takes up new files only. The mart
builders of the batch path run unchanged on the stream: their state is one row of sums and one
sketch per day or hour, bounded by the calendar, and late trips of any age still count.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from velomet.fixed_values import ERA_COLUMNS
from velomet.operators.unify import unified_branch


def typed_schema(era: str) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in ERA_COLUMNS[era])


def trip_stream(
    spark: SparkSession, folders: Mapping[tuple[str, str], str], files_per_batch: int | None = None
) -> DataFrame:
    """Canonical trips as a stream over (region, layout) folders of typed Parquet."""
    branches = []
    for (region, era), folder in folders.items():
        reader = spark.readStream.schema(typed_schema(era)).option("recursiveFileLookup", "true")
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        typed = reader.parquet(folder).withColumn("source_file", F.col("_metadata.file_path"))
        branches.append(unified_branch(typed, era, region))
    return reduce(DataFrame.unionByName, branches)


def keep_current(
    trips: DataFrame,
    build_mart: Callable[[DataFrame], DataFrame],
    folder: str,
    checkpoint: str,
) -> StreamingQuery:
    """Bring a mart up to date with everything that has arrived, then stop.

    Each batch writes the whole mart (one row per day or hour) to its own numbered folder; a
    retried batch overwrites its own number, and readers only ever see finished folders. Folders older
    than the one before, which a reader may still hold, are removed.
    """

    def write(mart: DataFrame, batch: int) -> None:
        mart.write.mode("overwrite").parquet(f"{folder}/batch={batch}")
        jvm = mart.sparkSession.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(folder)
        fs = root.getFileSystem(mart.sparkSession.sparkContext._jsc.hadoopConfiguration())
        for held in fs.listStatus(root):
            number = held.getPath().getName().removeprefix("batch=")
            if number.isdigit() and int(number) < batch - 1:
                fs.delete(held.getPath(), True)

    return (
        build_mart(trips)
        .writeStream.outputMode("complete")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_mart(spark: SparkSession, folder: str) -> DataFrame:
    """The newest finished version of a mart kept by ``keep_current``."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = [
        int(s.getPath().getName().removeprefix("batch="))
        for s in fs.listStatus(root)
        if fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))
    ]
    return spark.read.parquet(f"{folder}/batch={max(done)}")
