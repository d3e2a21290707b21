"""Raw trip files of any mix of headers, read in two jobs however many files there are.

The first job reads lines and keeps the first one of every file: a table of headers, from which names, layout and
errors follow as columns. The second reads lines again, joins each to its file's header and takes a column's cell
by the place its name has there, so one projection serves every header. The driver learns one number, the most cells that a
header has.

A line is a record. A quoted cell that holds a line break leaves lines with an odd number of quotes; these are set aside, to
be read by ``trip_files``, and never parsed as if they were whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from velomet.fixed_values import COLUMN_RENAMES, CURRENT_SIGNALS, ERA_COLUMNS, LEGACY_SIGNALS
from velomet.sources.manifest import region_of
from velomet.sources.trip_files import align_to_era

_CSV = {"escape": '"', "mode": "PERMISSIVE"}


def lines(spark: SparkSession, folder: str, suffix: str = ".csv") -> DataFrame:
    """(source_file, line, block, place) of all files under a folder; places rise along a file's block."""
    text = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*{suffix}").text(folder)
    return text.select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("value").alias("line"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
    )


def column_names(cells: Column) -> Column:
    """Raw header cells in their canonical spelling: words in lower case joined by underscores, then renamed."""
    renames = F.create_map(*[F.lit(x) for pair in COLUMN_RENAMES.items() for x in pair])

    def spelled(cell: Column) -> Column:
        bare = F.lower(F.regexp_replace(F.coalesce(cell, F.lit("")), "[()]", ""))
        name = F.trim(F.regexp_replace(bare, r"(?U)[\s_-]+", "_"), F.lit("_"))
        return F.coalesce(F.try_element_at(renames, name), name)

    return F.transform(cells, spelled)


def cells_of(line: Column, width: int) -> Column:
    """The cells of one record, nulls for blank ones and beyond its end."""
    schema = ", ".join(f"c{i} string" for i in range(width))
    record = F.from_csv(line, schema, _CSV)
    return F.array(*[record[f"c{i}"] for i in range(width)])


def layouts(spark: SparkSession, folder: str, suffix: str = ".csv") -> tuple[DataFrame, int]:
    """(source_file, header, names, era, error) per file under a folder, and the most cells a header has.

    A file whose header is blank or has the signals of neither layout has an error and no era; an empty file has no
    lines, and is not listed. A column that only the newer layout has outweighs any of the older one.
    """
    found = lines(spark, folder, suffix).filter("block = 0")
    first = found.groupBy("source_file").agg(F.min_by("line", "place").alias("header"))
    files = first.withColumn("text", F.ltrim(F.col("header"), F.lit("﻿"))).persist()
    width = (files.agg(F.max(F.regexp_count("text", F.lit(",")))).first()[0] or 0) + 1
    named = files.withColumn("names", F.when(F.col("text") != "", column_names(cells_of(F.col("text"), width))))
    has = lambda signals: F.coalesce(F.arrays_overlap("names", F.array(*map(F.lit, sorted(signals)))), F.lit(False))
    era = F.when(has(CURRENT_SIGNALS), "current").when(has(LEGACY_SIGNALS), "legacy")
    named_columns = F.array_join(F.array_sort(F.array_remove("names", "")), ", ")
    unknown = F.concat(F.lit("no known layout has the columns "), named_columns)
    error = F.when(F.col("names").isNull(), "no header").when(era.isNull(), unknown)
    return named.select("source_file", "header", "names", era.alias("era"), error.alias("error")), width


def _records(spark: SparkSession, folder: str, suffix: str, files: DataFrame) -> DataFrame:
    """Lines with their file's names, without headers and blank lines; ``whole`` tells records that end on their line."""
    joined = lines(spark, folder, suffix).join(files.filter("error IS NULL"), "source_file")
    quotes = F.regexp_count("line", F.lit('"'))
    return joined.filter((F.col("line") != F.col("header")) & (F.trim("line") != "")).withColumn("whole", quotes % 2 == 0)


def typed_lines(spark: SparkSession, folder: str, era: str, planned: tuple[DataFrame, int] | None = None, suffix: str = ".csv") -> DataFrame:
    """All files of one layout as typed trips with source_file, region and source_era, the columns of ``trip_files.typed_trips``."""
    files, width = planned or layouts(spark, folder, suffix)
    whole = _records(spark, folder, suffix, files.filter(F.col("era") == era)).filter("whole")
    cells = whole.select("source_file", "names", cells_of(F.col("line"), width).alias("cells"))
    named = {name: F.get("cells", (F.array_position("names", name) - 1).cast("int")) for name, _ in ERA_COLUMNS[era]}
    raw = cells.select("source_file", *[cell.alias(name) for name, cell in named.items()])
    typed = align_to_era(raw, era, keep=["source_file"])
    return typed.withColumn("region", region_of(F.col("source_file"))).withColumn("source_era", F.lit(era))


def broken_lines(spark: SparkSession, folder: str, planned: tuple[DataFrame, int] | None = None, suffix: str = ".csv") -> DataFrame:
    """(source_file, line): parts of records that a line break cuts."""
    files, _ = planned or layouts(spark, folder, suffix)
    return _records(spark, folder, suffix, files).filter("NOT whole").select("source_file", "line")
