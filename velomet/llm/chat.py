"""Chat formatting with the speakers' roles rotated.

A dialogue of several parties gives one training text per participant: that participant's messages are the
assistant's, everyone else's are a user's who goes by name, and system messages stay what they are. What the
assistant says, with its closing tag, is what a model would be trained on; spans say where it stands.

Everything is DataFrame operations. Messages are numbered within their dialogue, and a rendering is cut into parts of
PART messages; the parts in order are the whole, and no group is larger than a part. Numbers come from a sort by range:
each task numbers its stretch of a dialogue, and sums over the tasks before it are added, so that a dialogue of very many
messages, of one turn or of none, is spread over tasks as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velomet.llm.work import keep

PART = 256
#: Roles that are nobody's turn to speak.
SYSTEM = ("system",)
#: Leading characters of a message that the sort by range looks at to spread messages of one turn and role.
SPREAD = 64
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def numbered(messages: DataFrame) -> DataFrame:
    """conv_id, role, said and no, a message's number within its dialogue from 0."""
    said = messages.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"),
        F.replace(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit("<|im_"), F.lit("<\\|im_")).alias("said"),
    )
    # Equal messages travel as one row with their number.
    once = said.groupBy("conv_id", "turn", "role", "said").agg(
        F.when(F.col("turn").isNull(), F.count(F.lit(1))).otherwise(F.lit(1)).cast("long").alias("copies")
    )
    dealt = keep(
        once.repartitionByRange("conv_id", "turn", "role", F.substring("said", 1, SPREAD)).withColumn("task", F.spark_partition_id())
    )
    stretch = Window.partitionBy("task", "conv_id").orderBy("turn", "role", "said")
    earlier = Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("task", "conv_id").agg(F.sum("copies").alias("n"))
    before = sums.select(
        F.col("task").alias("t"), F.col("conv_id").alias("c"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    placed = dealt.withColumn("upto", F.sum("copies").over(stretch.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    last = F.col("before") + F.col("upto") - 1
    return (
        placed.join(before, (F.col("task") == F.col("t")) & F.col("conv_id").eqNullSafe(F.col("c")))
        .select("conv_id", "role", "said", F.explode(F.sequence(last - F.col("copies") + 1, last)).alias("no"))
    )


def rotate(messages: DataFrame, part_messages: int = PART) -> DataFrame:
    """(conv_id, perspective, part, n_messages, text, spans) for every participant of every dialogue.

    messages has conv_id, turn, role, text; other columns are left out whatever their names. spans is an array of
    (start, end) in characters of the part's text, end exclusive.

    Order: by turn, null turns first; equal turns by role and then text. Equal rows of one turn are one message, those
    without a turn are messages each. A null
    text is an empty message. A message without a role is a user's named "?" and no participant's. Rows whose
    conv_id is null are the dialogue without an id. A dialogue of system messages alone has no participants
    and no rows. Tags inside a text or a name lose their meaning by a backslash after "<", and line breaks in a
    name are written as spaces, so neither can open a turn of its own. No rows: no result.
    """
    said = numbered(messages)
    people = (
        messages.select(F.col("conv_id").alias("c"), F.col("role").cast("string").alias("perspective"))
        .where(F.col("perspective").isNotNull() & ~F.lower("perspective").isin(*SYSTEM))
        .distinct()
    )
    seen = said.join(people, F.col("conv_id").eqNullSafe(F.col("c")))
    own = F.coalesce(F.col("role") == F.col("perspective"), F.lit(False))
    system = F.coalesce(F.lower("role").isin(*SYSTEM), F.lit(False))
    name = F.replace(F.translate(F.coalesce("role", F.lit("?")), "\n\r", "  "), F.lit("<|im_"), F.lit("<\\|im_"))
    speaker = (
        F.when(own, F.lit("assistant"))
        .when(system, F.lit("system"))
        .otherwise(F.concat(F.lit("user name="), name))
    )
    part = F.floor(F.col("no") / part_messages).cast("long")
    pieces = seen.select(
        "conv_id", "perspective", part.alias("part"), "no", own.alias("own"),
        F.concat(F.lit(OPEN), speaker, F.lit("\n")).alias("head"), F.concat("said", F.lit(CLOSE)).alias("body"),
    )
    line = Window.partitionBy("conv_id", "perspective", "part").orderBy("no")
    after = F.sum(F.length("head") + F.length("body") + 1).over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = pieces.select(
        "conv_id", "perspective", "part", "own", "no",
        F.concat("head", "body", F.lit("\n")).alias("piece"),
        (after - 1 - F.length("body")).cast("long").alias("start"), (after - 1).cast("long").alias("end"),
    )
    gathered = placed.groupBy("conv_id", "perspective", "part").agg(
        F.sort_array(F.collect_list(F.struct("no", "piece", "own", "start", "end"))).alias("all")
    )
    spans = F.transform(F.filter("all", lambda m: m["own"]), lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end")))
    return gathered.select(
        "conv_id", "perspective", "part", F.size("all").cast("long").alias("n_messages"),
        F.array_join("all.piece", "").alias("text"), spans.alias("spans"),
    )


def report(messages: DataFrame, part_messages: int = PART) -> DataFrame:
    """rotate() with its spans written as start:end, comma-joined."""
    written = F.array_join(
        F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    return rotate(messages, part_messages).withColumn("spans", written)


REPORT_SQL = r"""
WITH said AS (
  SELECT DISTINCT conv_id, turn, role, replace(coalesce(text, ''), '<|im_', '<\|im_') AS said FROM conversations WHERE turn IS NOT NULL
  UNION ALL
  SELECT conv_id, turn, role, replace(coalesce(text, ''), '<|im_', '<\|im_') FROM conversations WHERE turn IS NULL
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, said) - 1 AS no FROM said
), people AS (
  SELECT DISTINCT conv_id AS c, role AS perspective FROM said WHERE lower(role) <> 'system'
), pieces AS (
  SELECT conv_id, perspective, CAST(floor(no / 256.0) AS BIGINT) AS part, no, role, said,
         role IS NOT DISTINCT FROM perspective AS own,
         '<|im_start|>' || CASE WHEN role = perspective THEN 'assistant' WHEN lower(role) = 'system' THEN 'system'
           ELSE 'user name=' || replace(translate(coalesce(role, '?'), chr(10) || chr(13), '  '), '<|im_', '<\|im_') END || chr(10) AS head,
         said || '<|im_end|>' AS body
  FROM numbered JOIN people ON conv_id IS NOT DISTINCT FROM c
), placed AS (
  SELECT *,
         sum(length(head) + length(body) + 1) OVER (line ROWS UNBOUNDED PRECEDING) - 1 AS fin
  FROM pieces WINDOW line AS (PARTITION BY conv_id, perspective, part ORDER BY no)
)
SELECT conv_id, perspective, part, count(*) AS n_messages,
       string_agg(head || body || chr(10), '' ORDER BY no) AS text,
       coalesce(string_agg(CASE WHEN own THEN CAST(fin - length(body) AS VARCHAR) || ':' || CAST(fin AS VARCHAR) END, ',' ORDER BY no), '') AS spans
FROM placed GROUP BY conv_id, perspective, part
"""
