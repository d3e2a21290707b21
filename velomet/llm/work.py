"""Input tables and intermediate tables that all executors can see."""

from __future__ import annotations

import gc
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

#: The words of a text: runs of anything but space and the five ASCII control spaces.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: spark.checkpoint.dir, and where a session on one machine names none
    (as in a test), a folder in the warehouse. A cluster has to name one: its executors may not share the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{named or spark.conf.get('spark.sql.warehouse.dir').rstrip('/') + '/_work'}/llm"


def keep(df: DataFrame) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back: later steps start from the files,
    so a lost executor costs tasks of one step and not the whole lineage."""
    spark = df.sparkSession
    path = f"{work_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Deletes the files of a table made by keep() that no later step reads."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if path.startswith(("file:", "/")) or "://" in path:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def release(spark: SparkSession, turns: int = 1) -> None:
    """Lets Spark delete the shuffle files of finished steps now. It does so when the driver finds their frames
    unused, which between large steps may be long after. The step that ended last is held by events on their way for a moment
    more; a second turn finds it unused."""
    for turn in range(turns):
        if turn:
            time.sleep(1)
        gc.collect()
        spark.sparkContext._jvm.System.gc()
