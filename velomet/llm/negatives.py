"""Hard-negative mining by a secondary-sort shuffle.

An anchor's scores are packed into keys (anchor, descending score, role, id, row) whose bytes sort in that order,
and repartitionAndSortWithinPartitions brings every anchor's scores to one task as a sorted stream. Walking down the
stream, a positive opens a window that reaches from its score down to a share of it, and every negative met goes to the
windows that are open and not yet full. The walk holds the open windows of one anchor and nothing else.

What enters the shuffle is cut down first. Candidates are dealt into blocks and anchors into groups, and a task scores one block for
one group. From a first shuffle of each block's best scores of the anchor's own label come the anchor's positives; knowing
these, a block sends of the other labels only its first few scores per window. A hot label or a vector repeated in a
third of all rows is dealt over all blocks, and no block sends more for it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomet.llm.topk import finite
from velomet.llm.work import keep

#: Candidates of a block, anchors of a group, and anchors scored at a time.
BLOCK, GROUP, AT_ONCE = 8_192, 16_384, 128
#: Positives of an anchor, negatives of a positive, and the hundredths of a positive's score that a negative must reach.
POSITIVES, NEGATIVES, LEAST = 5, 5, 80

SCORED = "anchor long, role int, vec_id long, row long, score long"
MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
KEY = struct.Struct(">QQBQQ")
HALF = 1 << 63


def whole_numbers(embeddings: DataFrame, scale: int = 256, moved: int = 7, classes: int = 10) -> DataFrame:
    """row, vec_id, label, width and cells of the rows that take part, kept in the shared folder.

    cells are the components floor(scale * x) as bytes: two a component where all of a row fit, else eight.
    Rows without an id or a label, and vectors that are null, empty or hold null or non-finite components, take no
    part. Where vec_id is divisible by `moved`, the label is the next of `classes`.
    """
    label = F.col("label").cast("long")
    moving = F.when(F.col("vec_id") % moved == 0, F.pmod(label + 1, F.lit(classes))).otherwise(label)
    vector = F.col("embedding").cast("array<double>")
    usable = embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(vector)).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        moving.alias("label"),
        F.transform(vector, lambda x: F.floor(x * float(scale)).cast("long")).alias("v"),
    )

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, flat = batch.column(2).offsets.to_numpy(), batch.column(2).values.to_numpy()
            cells = []
            for a, b in zip(ends, ends[1:]):
                v = flat[a:b]
                cells.append(v.astype("<i2" if len(v) and -32_768 <= v.min() and v.max() <= 32_767 else "<i8").tobytes())
            width = pa.array(np.diff(ends).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), width, pa.array(cells, pa.binary())], ["vec_id", "label", "width", "cells"]
            )

    packed = usable.mapInArrow(each, "vec_id long, label long, width int, cells binary").where("width > 0")
    return keep(packed.withColumn("row", F.monotonically_increasing_id()))


def matrix(cells: pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of components."""
    rows = cells.to_pylist()
    if all(len(r) == 2 * width for r in rows):
        return np.frombuffer(b"".join(rows), "<i2").reshape(-1, width).astype(np.int64)
    return np.stack([np.frombuffer(r, "<i2" if len(r) == 2 * width else "<i8").astype(np.int64) for r in rows])


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of a with those of b, exactly: in doubles where no sum can pass 2^53, else in
    whole numbers of any length. Rows of the result belong to a."""
    most = a.shape[1] * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    if most < 1 << 48:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a.astype(object) @ b.T.astype(object)


class Block:
    """Candidates of one block, in order of id and row, so that a place stands for the tie order."""

    def __init__(self, table: pa.Table, width: int):
        ids, rows = table["vec_id"].to_numpy(), table["row"].to_numpy()
        order = np.lexsort((rows, ids))
        self.ids, self.rows, self.labels = ids[order], rows[order], table["label"].to_numpy()[order]
        self.cells = matrix(table["cells"].take(pa.array(order)), width)
        self.size = len(order)

    def keys(self, scores: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Scores with their places, as numbers that sort by score and, backwards, by place. Larger is better."""
        return scores * self.size + (self.size - 1 - at)

    def rows_of(self, anchor: int, role: int, keys: np.ndarray) -> list[tuple]:
        scores, at = keys // self.size, self.size - 1 - keys % self.size
        return [(anchor, role, self.ids[p], self.rows[p], s) for s, p in zip(scores, at)]


def as_table(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    columns = zip(*rows) if rows else [[]] * 5
    return pa.table({n: pa.array([int(x) for x in c], k) for n, k, c in zip(("anchor", "role", "vec_id", "row", "score"), kinds, columns)})


def by_label(block: Block, anchors: pa.Table, width: int, same: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of an anchor in its group, places, scores) over the block's rows of its own label, or of the others."""
    labels = anchors["a_label"].to_numpy()
    for label in np.unique(labels):
        at = np.flatnonzero(block.labels == label if same else block.labels != label)
        mine = np.flatnonzero(labels == label)
        if not len(at):
            continue
        rows = block.cells[at]
        for first in range(0, len(mine), AT_ONCE):
            some = mine[first : first + AT_ONCE]
            scores = products(matrix(anchors["a_cells"].take(pa.array(some)), width), rows)
            for k, own in zip(some, scores):
                yield int(k), at, own


def best_positives(width: int, left: pa.Table, right: pa.Table, limit: int) -> pa.Table:
    """The first `limit` rows of a block that share an anchor's label, other than the anchor itself."""
    block, out = Block(left, width), []
    anchor_rows = right["a_row"].to_numpy()
    for k, at, scores in by_label(block, right, width, same=True):
        keys = block.keys(scores, at)[block.rows[at] != anchor_rows[k]]
        if len(keys) > limit and keys.dtype != object:
            keys = np.partition(keys, len(keys) - limit)[-limit:]
        out += block.rows_of(anchor_rows[k], 0, np.sort(keys)[::-1][:limit])
    return as_table(out)


def window_negatives(width: int, left: pa.Table, right: pa.Table, limit: int, least: int) -> pa.Table:
    """The first `limit` rows of a block with another label in the window of each positive of an anchor."""
    block, out = Block(left, width), []
    anchor_rows, opened = right["a_row"].to_numpy(), right["a_opened"].to_pylist()
    for k, at, scores in by_label(block, right, width, same=False):
        tops = sorted({p for p in opened[k] if p >= 0}, reverse=True)
        if not tops:
            continue  # below zero a share of a score lies above it, so no score is in the window
        near = (scores <= tops[0]) & (scores * 100 >= least * tops[-1])
        keys = np.sort(block.keys(scores[near], at[near]))
        picked = set()
        for p in tops:
            end = np.searchsorted(keys, (p + 1) * block.size)
            first = keys[max(0, end - limit) : end]
            picked.update(x for x in first.tolist() if x // block.size * 100 >= least * p)
        out += block.rows_of(anchor_rows[k], 1, np.array(sorted(picked, reverse=True), keys.dtype))
    return as_table(out)


def tiles(candidates: DataFrame, anchors: DataFrame, judge) -> DataFrame:
    """judge(width, block, group) for every block of candidates with every group of anchors of their width."""
    asked = anchors.groupBy("width").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("groups"))
    sizes = candidates.groupBy("width").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")).join(asked, "width")
    dealt = lambda parts, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.col(parts)).cast("int")
    each = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    left = candidates.join(sizes, "width").select("width", dealt("blocks", 1).alias("b"), each("groups").alias("g"), "row", "vec_id", "label", "cells")
    # Names of its own, since anchors are rows of the candidates.
    carried = [F.col(c).alias(f"a_{c}") for c in ("row", "label", "cells", "opened") if c in anchors.columns]
    right = anchors.join(sizes, "width").select(
        F.col("width").alias("a_width"), each("blocks").alias("a_b"), dealt("groups", 2).alias("a_g"), *carried
    )

    def pair(key: tuple, block: pa.Table, group: pa.Table) -> pa.Table:
        return judge(key[0].as_py(), block, group) if block.num_rows and group.num_rows else as_table([])

    return left.groupBy("width", "b", "g").cogroup(right.groupBy("a_width", "a_b", "a_g")).applyInArrow(pair, SCORED)


def pack(anchor: int, score: int, role: int, vec_id: int, row: int) -> bytes:
    """A key whose bytes sort by anchor, falling score, role (positives first), id and row."""
    return KEY.pack(anchor, HALF - 1 - score, role, vec_id + HALF, row)


def unpack(key: bytes) -> tuple[int, int, int, int, int]:
    anchor, falling, role, vec_id, row = KEY.unpack(key)
    return anchor, HALF - 1 - falling, role, vec_id - HALF, row


def sorted_scores(scored: DataFrame, parts: int) -> RDD:
    """Scores as (key, None), every anchor in one task and sorted there."""
    return scored.rdd.map(lambda r: (pack(r.anchor, r.score, r.role, r.vec_id, r.row), None)).repartitionAndSortWithinPartitions(
        parts, lambda key: zlib.crc32(key[:8])
    )


def first_positives(stream: Iterable[tuple[bytes, None]], limit: int) -> Iterator[tuple]:
    """The first `limit` scores of every anchor."""
    current, taken = None, 0
    for key, _ in stream:
        anchor, score, role, vec_id, row = unpack(key)
        if anchor != current:
            current, taken = anchor, 0
        if taken < limit:
            taken += 1
            yield anchor, role, vec_id, row, score


def mined(stream: Iterable[tuple[bytes, None]], limit: int, least: int) -> Iterator[tuple]:
    """(anchor, positive id, rank, negative id, positive score, negative score) along the sorted scores."""
    current, windows = None, []
    for key, _ in stream:
        anchor, score, role, vec_id, _ = unpack(key)
        if anchor != current:
            current, windows = anchor, []
        if role == 0:
            windows.append([score, vec_id, 0])
            continue
        for window in windows:
            if score * 100 >= least * window[0]:
                window[2] += 1
                yield anchor, window[1], window[2], vec_id, window[0], score
        # A window that is full, or that the stream has left, opens no more.
        windows = [w for w in windows if w[2] < limit and score * 100 >= least * w[0]]


def mine(
    vectors: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST
) -> DataFrame:
    """Hard negatives of every anchor and positive: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Both tables are of whole_numbers(), anchors being rows of vectors. An anchor's positives are its first `positives` other
    rows of its label by inner product, ties to the smaller id; a positive's negatives the first `negatives` rows of
    other labels that score no more than the positive and at least `least` hundredths of it. All, if fewer. An anchor
    without positives and a positive without negatives have no rows. Vectors meet vectors of their own length
    only. Rows with one id are rows of their own and partners of each other; equal ones are told apart by row. A
    score that no long holds ends the job with an error.
    """
    spark = vectors.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def kept(rows: RDD) -> DataFrame:
        return keep(spark.createDataFrame(rows, SCORED, verifySchema=False))

    scored = tiles(vectors, anchors, lambda width, a, b: best_positives(width, a, b, positives))
    chosen = kept(sorted_scores(scored, parts).mapPartitions(lambda s: first_positives(s, positives)))
    windows = chosen.groupBy(F.col("anchor").alias("row")).agg(F.collect_list("score").alias("opened"))
    scored = tiles(vectors, anchors.join(windows, "row"), lambda width, a, b: window_negatives(width, a, b, negatives, least))
    found = sorted_scores(chosen.union(scored), parts).mapPartitions(lambda s: mined(s, negatives, least))
    names = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return spark.createDataFrame(found, MINED.replace("anchor_id", "anchor"), verifySchema=False).join(names, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def report(embeddings: DataFrame, every: int = 100) -> DataFrame:
    """mine() for the rows whose vec_id is divisible by `every`, against all rows. An empty table gives an empty result."""
    vectors = whole_numbers(embeddings)
    return mine(vectors, vectors.where(F.col("vec_id") % every == 0))


REPORT_SQL = """
WITH usable AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.r AS anchor, a.vec_id AS anchor_id, c.r AS r, c.vec_id AS vec_id, a.label = c.label AS same,
         CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
  FROM usable a JOIN usable c ON a.vec_id % 100 = 0 AND a.r <> c.r AND len(a.v) = len(c.v)
), positives AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, r) AS nth FROM scored WHERE same) WHERE nth <= 5
), ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor, p.r ORDER BY n.score DESC, n.vec_id, n.r) AS INTEGER) AS rank
  FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
"""
