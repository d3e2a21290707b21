"""Mixing sources to target weights by systematic sampling.

Every source has a target, a number of words. Its documents are lined up by size, each expects
target / source size copies, and the expected copies are summed up along the line; one random offset is
added, and a document is taken once for every integer that its step crosses. Lining up by size makes the
words taken differ from the target by little more than one long document.

The line of a source can hold a third of all rows, so no task holds a line: rows are sorted by range over
all tasks, counted per task and source, and the counts before a task give its rows their places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velomet.llm.work import WORD, keep

#: Weights of the sources in code point order, repeating; the null source comes last.
WEIGHTS = (3, 1, 2)
#: Words of all targets as a share of all sizes, and the most a target may be of its source's size.
SHARE, MOST = 1.5, 2.0
SEED = 20_240


def words(text: Column) -> Column:
    """Number of words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fill(sizes: list[tuple[int, int]], share: float = SHARE, most: float = MOST) -> list[float]:
    """Targets of sources given as (size, weight): proportional to weight, none above `most` times its
    size, the excess shared again by weight among the rest until none is above."""
    total = share * sum(s for s, _ in sizes)
    targets, open_ = [0.0] * len(sizes), {i for i, (s, w) in enumerate(sizes) if s > 0 and w > 0}
    while open_:
        left = total - sum(t for i, t in enumerate(targets) if i not in open_)
        weight = sum(sizes[i][1] for i in open_)
        for i in open_:
            targets[i] = left * sizes[i][1] / weight
        full = {i for i in open_ if targets[i] > most * sizes[i][0]}
        if not full:
            break
        for i in full:
            targets[i] = most * sizes[i][0]
        open_ -= full
    return targets


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from a table of (source, source_size).

    A round of sharing fixes every source above its bound. Sources fill up in the order of weight per size,
    so the level where sharing ends is found by running sums over that order instead of rounds: with
    the sources that fill first taken out, the level is what is left of the total by what is left of the
    weight, and the sources that fill are those whose bound is below it.
    """
    n = len(weights)
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = (F.row_number().over(by_name) - 1) % n
    weighted = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("double"))
    # level at which a source is full: most * size / weight
    weighted = weighted.withColumn("full_at", F.lit(most) * F.col("source_size") / F.col("weight"))
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    line = Window.orderBy("full_at", F.col("source").isNull(), "source")
    before = line.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    run = weighted.select(
        "*",
        F.row_number().over(line).alias("no"),
        (F.lit(share) * F.sum("source_size").over(whole)).alias("total"),
        F.sum("weight").over(whole).alias("all_weight"),
        F.coalesce(F.sum(F.lit(most) * F.col("source_size")).over(before), zero).alias("filled"),
        F.coalesce(F.sum("weight").over(before), zero).alias("used"),
    ).withColumn("level", (F.col("total") - F.col("filled")) / (F.col("all_weight") - F.col("used")))
    # The first source that stays below its bound sets the level of all that follow.
    level = F.min(F.when(F.col("full_at") >= F.col("level"), F.struct("no", "level"))).over(whole)["level"]
    return run.withColumn("end", level).select(
        "source",
        "source_size",
        F.least(F.lit(most) * F.col("source_size"), F.col("weight") * F.coalesce("end", F.lit(float("inf")))).alias("target"),
    )


def plan(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = SEED,
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """Per row of docs: doc_id, source, size, source_size, target, copies, taken (copies x size).

    Size is the number of words (null or empty text: 0). Documents without words take part in the line
    and their copies add no words. The null source is a source. Ties of size go by doc_id, nulls first;
    rows equal in source, size and doc_id are interchangeable. Reruns agree, whatever the partitions.
    carried: other columns to hand through, as "c_<name>". An empty table gives an empty result.
    """
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        words(F.col("text").cast("string")).alias("size"),
        *(F.col(c).alias(f"c_{c}") for c in carried),
    )
    lined = keep(
        sized.repartitionByRange("source", "size", "doc_id")
        .sortWithinPartitions("source", "size", "doc_id")
        .withColumn("task", F.spark_partition_id())
        .withColumn("row", F.monotonically_increasing_id())
    )
    share_of_task = lined.groupBy("task", "source").agg(
        F.count(F.lit(1)).alias("n"), F.min("row").alias("first"), F.sum("size").alias("words")
    )
    # One row per task and source from here on; rows of docs are only joined again.
    earlier = Window.partitionBy("source").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    places = keep(share_of_task.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))))
    goals = targets(places.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    goals = goals.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    # One offset in [0, 1) per source, from the seed and its name.
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null")))
    offset = F.conv(F.substring(F.md5(named.cast("binary")), 1, 7), 16, 10).cast("double") / float(16**7)
    goals = goals.withColumn("offset", offset)
    places = places.alias("p").join(goals.alias("g"), F.expr("p.source <=> g.source")).select(
        "task", "p.source", "first", "before", "source_size", "target", "rate", "offset"
    )
    place = F.col("row") - F.col("first") + F.col("before")
    step = lambda i: F.floor(i * F.col("rate") + F.col("offset"))
    copies = (step(place + 1) - step(place)).cast("long")
    # The task's number comes first: a source is spread over as many tasks as it filled above.
    return (
        lined.alias("l")
        .join(places.alias("p"), F.expr("l.task = p.task AND l.source <=> p.source"))
        .select(
            "doc_id",
            "l.source",
            "size",
            "source_size",
            "target",
            copies.alias("copies"),
            (copies * F.col("size")).alias("taken"),
            *(f"c_{c}" for c in carried),
        )
    )


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The rows of docs that the mix takes, each as often as it is taken, with all their columns."""
    plain = [c for c in docs.columns if c not in ("doc_id", "source")]
    taken = plan(docs, carried=tuple(plain), **how).where("copies > 0")
    return taken.select(
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy_no"), "doc_id", "source", *(f"c_{c}" for c in plain)
    ).select(*(F.col(c) if c in ("doc_id", "source") else F.col(f"c_{c}").alias(c) for c in docs.columns))


PLAN_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT *, CAST(CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS DOUBLE) AS weight
  FROM sources
), filling AS (
  SELECT *, 2.0::DOUBLE * source_size / weight AS full_at FROM weighted
), run AS (
  SELECT *, row_number() OVER line AS no,
         1.5::DOUBLE * (SELECT sum(source_size) FROM sources) AS total, (SELECT sum(weight) FROM weighted) AS all_weight,
         coalesce(sum(2.0::DOUBLE * source_size) OVER (line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled,
         coalesce(sum(weight) OVER (line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used
  FROM filling WINDOW line AS (ORDER BY full_at, source IS NULL, source)
), levels AS (
  SELECT *, (total - filled) / (all_weight - used) AS level FROM run
), ended AS (
  SELECT arg_min(level, no) AS fin FROM levels WHERE full_at >= level
), goals AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, weight * coalesce(fin, CAST('inf' AS DOUBLE))) AS target,
         CAST('0x' || substr(md5('20240:' || coalesce('=' || source, 'null')), 1, 7) AS BIGINT) / CAST(268435456 AS DOUBLE) AS shift
  FROM levels, ended
), lined AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id NULLS FIRST) AS place FROM sized
), taken AS (
  SELECT l.doc_id, l.size, g.source_size, g.target,
         CAST(floor(place * rate + shift) - floor((place - 1) * rate + shift) AS BIGINT) AS copies
  FROM lined l JOIN (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM goals) g
    ON l.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target, copies, copies * size AS taken FROM taken
"""
