"""Near-duplicate vectors by a forest of random-projection trees.

Every tree splits the vectors of a label again and again along random directions, at the median of a sample
of the cell, until a cell holds few enough to compare all with all. Vectors close to a split go to both
sides, so a close pair is seldom parted, and many trees make it sure to meet somewhere. Pairs that meet are
compared in full; those at the cosine asked for are links, and links are joined to components.

Trees grow in rounds over all cells at once. A round cuts every cell that is too large by up to four levels:
thresholds come from at most SAMPLE rows of the cell, and every row of the cell is then moved. A cell that a
split hardly shrinks, such as a crowd of near copies, is left whole and compared in square tiles of bounded
size instead, so nothing is lost and no task grows.

How deep a tree goes is bounded by what it keeps, not by the rows: every cell knows the share of pairs at the
cosine asked for that all splits above it keep together, and a split that takes it below what so many trees
make up for is not made. Every label of more rows than a leaf holds grows its trees. Only where splits would have
to stop for that reason before cells are small, and would have compared more than all pairs by then, is the label one cell,
as a cell is that no split shrinks; remainder() counts the rows of such cells.

No pair is emitted. A leaf gives the number of links of each vector, counting a pair only in the first of the
cells that both share, and a spanning set of its links.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velomet.llm.components import components
from velomet.llm.topk import finite
from velomet.llm.work import keep

TREES, LEAF, TILE = 10, 400, 1_500
#: Rows of a cell that its thresholds are taken from, at most; and levels cut in a round.
SAMPLE, LEVELS = 1_024, 4
#: Half width of the overlap, in units of a unit vector's projection on a standard normal direction.
SPILL = 0.12
#: Share of the pairs at the threshold that all trees together may part.
PARTED = 1e-3
#: Directions of a tree; deeper levels use them again.
DIRECTIONS = 24
SEED = 9_301
#: Pairs at a cosine this near to the threshold are decided by summing exactly.
CLOSE = 1e-12


def directions(tree: int, width: int) -> np.ndarray:
    return np.random.default_rng([SEED, tree, width]).standard_normal((width, DIRECTIONS))


def units(vectors: Iterable) -> np.ndarray:
    x = np.array(list(vectors), dtype=np.float64)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def together(x: np.ndarray, middle: float, least: float) -> float:
    """Share of pairs at the cosine `least` that a split of a cell with projections x keeps in one side at
    least. Projections of such a pair differ by sqrt(2 - 2 least) on average, but no more than those of any
    two rows do: a pair of a crowd is parted as often as two of its rows drawn blindly."""
    spread = max(float(x.std()), 1e-9)
    like = max(0.0, 1 - (1 - least) / spread**2)
    rest = spread * math.sqrt(1 - like**2) + 1e-12
    away = np.abs(x - middle)
    away = away[away > SPILL]
    return 1 - sum(math.erfc((SPILL + like * a) / rest / math.sqrt(2)) / 2 for a in away.tolist()) / len(x)


def floor_of(trees: int) -> float:
    """The share that each of so many trees has to keep together for all to part no more than PARTED."""
    return 1 - PARTED ** (1 / trees)


def splits_reach(p: np.ndarray, n: int, trees: int, leaf: int, least: float) -> bool:
    """Whether trees over n rows, p being the projections of some, come down to leaves before their splits part
    more close pairs than so many trees make up for; or, stopped by that, still compare fewer pairs than there are.
    A level leaves two cells with a share of the rows each."""
    middle = np.median(p, axis=0)
    share = float(np.mean(p <= middle + SPILL))
    if share > 0.8:
        return False
    kept = float(np.mean([together(p[:, k], float(middle[k]), least) for k in range(DIRECTIONS)]))
    to_leaf, allowed = math.log(leaf / n) / math.log(share), math.log(floor_of(trees)) / min(math.log(kept), -1e-12)
    return to_leaf <= allowed or trees * (2 * share * share) ** allowed < 1


def cut(p: np.ndarray, level: int, depth: int, stays: float, floor: float, least: float) -> tuple[list[float], list[float], list[float]]:
    """Bounds of a subtree of the given depth over sample projections p: a row goes left at or under the
    high bound and right at or over the low one. Infinite bounds: not split, all go left. And, for its 2^depth
    leaves, the share of close pairs that are still together, `stays` being that of the cell itself."""
    low, high = [math.inf] * (2**depth - 1), [math.inf] * (2**depth - 1)
    cells = {0: np.arange(len(p))}
    shares = [stays] * (2 ** (depth + 1) - 1)
    for place in range(2**depth - 1):
        rows = cells.get(place)
        shares[2 * place + 1] = shares[2 * place + 2] = shares[place]
        if rows is None or len(rows) < 2:
            continue
        depth_here = (place + 1).bit_length() - 1
        x = p[rows, (level + depth_here) % DIRECTIONS]
        middle = float(np.median(x))
        left, right = x <= middle + SPILL, x >= middle - SPILL
        after = shares[place] * together(x, middle, least)
        if max(left.sum(), right.sum()) > 0.8 * len(rows) or after < floor:
            cells[2 * place + 1] = rows  # hardly shrinks here, or parts too much; the next direction may do better
            continue
        shares[2 * place + 1] = shares[2 * place + 2] = after
        low[place], high[place] = middle - SPILL, middle + SPILL
        cells[2 * place + 1], cells[2 * place + 2] = rows[left], rows[right]
    return low, high, shares[2**depth - 1 :]


def settle(p: np.ndarray, level: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and the leaf of the subtree each of them falls into; a row in the overlap comes several times."""
    rows, place = np.arange(len(p)), np.zeros(len(p), np.int64)
    for d in range(depth):
        x = p[rows, (level[rows] + d) % DIRECTIONS]
        left, right = x <= high[rows, place], x >= low[rows, place]
        rows = np.concatenate([rows[left], rows[right]])
        place = np.concatenate([2 * place[left] + 1, 2 * place[right] + 2])
    return rows, place


def links_in(x: np.ndarray, y: np.ndarray, same: bool, least: float) -> np.ndarray:
    """Which rows of x and y are at the cosine asked for; for the same rows, each pair once."""
    dots = x @ y.T
    hit = dots >= least
    for i, j in zip(*np.nonzero(np.abs(dots - least) < CLOSE)):
        hit[i, j] = math.fsum(x[i] * y[j]) >= least
    return np.triu(hit, 1) if same else hit


def spanning(hit: np.ndarray) -> list[tuple[int, int]]:
    """A spanning set of the links of a symmetric matrix."""
    left, found = hit.any(1), []
    while left.any():
        front = [int(np.argmax(left))]
        left[front] = False
        while front:
            at = front.pop()
            near = np.flatnonzero(hit[at] & left)
            left[near] = False
            found += [(at, int(j)) for j in near]
            front += near.tolist()
    return found


def leaf_links(rows: pd.DataFrame, least: float) -> pd.DataFrame:
    """Links of one tile: (node, other, links), other being set for links of the spanning set."""
    cell = int(rows["cell"].iloc[0])
    a, b = int(rows["a"].iloc[0]), int(rows["b"].iloc[0])
    rows = rows.sort_values(["part", "node"])
    x, part = units(rows["v"]), rows["part"].to_numpy()
    nodes, copies = rows["node"].to_numpy(), rows["copies"].to_numpy()
    n = len(rows)
    hit = np.zeros((n, n), bool)
    if a == b:
        hit = links_in(x, x, True, least)
    else:
        i, j = np.flatnonzero(part == a), np.flatnonzero(part == b)
        hit[np.ix_(i, j)] = links_in(x[i], x[j], False, least)
    hit |= hit.T
    # A pair counts in the smallest cell that both are in: here, unless an earlier cell holds both.
    owner = np.repeat(np.arange(n), [len(c) for c in rows["cells"]])
    cells = np.concatenate([np.asarray(c, dtype=np.int64) for c in rows["cells"]])
    owner, cells = owner[cells < cell], cells[cells < cell]
    _, place, times = np.unique(cells, return_inverse=True, return_counts=True)
    member = np.zeros((n, len(times)), np.float32)
    member[owner, place] = 1
    member = member[:, times > 1]
    links = (hit & (member @ member.T < 0.5)) @ copies.astype(np.float64)
    some = np.flatnonzero(links)
    tree = np.array(spanning(hit), dtype=np.int64).reshape(-1, 2)
    return pd.DataFrame(
        {
            "node": np.concatenate([nodes[some], nodes[tree[:, 0]]]),
            "other": pd.array([*[None] * len(some), *nodes[tree[:, 1]]], dtype="Int64"),
            "links": np.concatenate([links[some], np.zeros(len(tree))]).astype(np.int64),
        }
    )


def _cells(nodes: DataFrame, trees: int, leaf: int, least: float) -> DataFrame:
    """(cell, node) of every leaf that every node is in, over all trees."""
    floor = floor_of(trees)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pandas()
            for width, part in rows.groupby(rows["v"].map(len)):
                x = units(part["v"])
                for tree in range(trees):
                    p = (x @ directions(tree, width)).astype(np.float32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(part["team"].to_numpy()),
                            pa.array(np.full(len(part), tree, np.int32)),
                            pa.array(part["node"].to_numpy()),
                            pa.FixedSizeListArray.from_arrays(pa.array(p.ravel()), DIRECTIONS).cast(pa.list_(pa.float32())),
                        ],
                        ["team", "tree", "node", "p"],
                    )

    def number(*parts: str) -> Column:
        return F.xxhash64(*parts)

    def judge(rows: pd.DataFrame) -> pd.DataFrame:
        x = units(rows.sort_values("node")["v"])
        grown = splits_reach(x @ directions(0, x.shape[1]), int(rows["n"].iloc[0]), trees, leaf, least)
        return pd.DataFrame({"team": [rows["team"].iloc[0]], "grown": [grown]})

    teams = nodes.groupBy("team").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > leaf)
    asked = nodes.select("team", "node", "v").join(teams, "team").where(
        F.pmod(F.xxhash64("node", "team"), F.lit(1 << 30)) < F.lit(float(SAMPLE) * (1 << 30)) / F.col("n")
    )
    grown = keep(asked.groupBy("team").applyInPandas(judge, "team long, grown boolean").where("grown"))
    # Labels up to the size of a leaf, and those whose splits do not come down to one, are one cell.
    done = keep(nodes.join(grown, "team", "left_anti").select(number("team", F.lit(-1)).alias("cell"), "node"))
    if grown.isEmpty():
        return done
    open_ = keep(
        nodes.select("team", "node", "v").join(grown, "team", "left_semi")
        .mapInArrow(project, "team long, tree int, node long, p array<float>")
        .select(number("team", "tree").alias("cell"), "node", F.lit(0).alias("level"), F.lit(1.0).alias("stays"), "p")
    )
    while True:
        sizes = open_.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
        large = keep(sizes.where(F.col("n") > leaf))
        if large.isEmpty():
            return done.union(open_.select("cell", "node"))
        depth = F.least(F.lit(LEVELS), F.ceil(F.log2(F.col("n") / leaf)).cast("int"))

        def fit(rows: pd.DataFrame) -> pd.DataFrame:
            d, level = int(rows["depth"].iloc[0]), int(rows["level"].iloc[0])
            rows = rows.sort_values("node")
            low, high, after = cut(np.array(rows["p"].tolist()), level, d, float(rows["stays"].iloc[0]), floor, least)
            stuck = all(x == math.inf for x in low)
            columns = {"cell": [rows["cell"].iloc[0]], "depth": [d], "stuck": [stuck], "low": [low], "high": [high], "after": [after]}
            return pd.DataFrame(columns)

        drawn = open_.join(large.withColumn("depth", depth), "cell").where(
            F.pmod(F.xxhash64("node", "cell"), F.lit(1 << 30)) < F.lit(float(SAMPLE) * (1 << 30)) / F.col("n")
        )
        splits = keep(
            drawn.groupBy("cell").applyInPandas(
                fit, "cell long, depth int, stuck boolean, low array<double>, high array<double>, after array<double>"
            )
        )

        def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = batch.to_pandas()
                for d, part in rows.groupby("depth"):
                    at, place = settle(
                        np.array(part["p"].tolist()),
                        part["level"].to_numpy(),
                        np.array(part["low"].tolist()),
                        np.array(part["high"].tolist()),
                        int(d),
                    )
                    moved = part.iloc[at]
                    after = np.array(part["after"].tolist())[at, place - (2 ** int(d) - 1)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(moved["cell"].to_numpy()),
                            pa.array(place),
                            pa.array(moved["node"].to_numpy()),
                            pa.array((moved["level"] + int(d)).to_numpy(), pa.int32()),
                            pa.array(after),
                            pa.array(moved["p"].tolist(), pa.list_(pa.float32())),
                        ],
                        ["cell", "place", "node", "level", "stays", "p"],
                    )

        # Small cells and those without a split are leaves; the rest move and are looked at again.
        leaves = open_.join(splits.where("NOT stuck"), "cell", "left_anti").select("cell", "node")
        moved = (
            open_.join(splits.where("NOT stuck").drop("stuck"), "cell")
            .mapInArrow(move, "cell long, place long, node long, level int, stays double, p array<float>")
            .select(number("cell", "place").alias("cell"), "node", "level", "stays", "p")
        )
        done = keep(done.union(leaves))
        open_ = keep(moved)


def _nodes(embeddings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows, keyed by label and vector where they can link, and one node per key."""
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").alias("v")
    )
    usable = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(F.col("v").cast("array<double>"))
        & F.exists("v", lambda x: x != 0)
    )
    # 96 bits name a vector of a label.
    keyed = rows.withColumn("k1", F.when(usable, F.xxhash64("label", "v"))).withColumn("k2", F.when(usable, F.hash("v", "label")))
    nodes = keep(
        keyed.where("k1 IS NOT NULL")
        .groupBy("k1", "k2")
        .agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("v").alias("v"))
        # A tree begins with the vectors of one label and length.
        .withColumn("team", F.xxhash64("label", F.size("v")))
    )
    return keyed, nodes


def remainder(embeddings: DataFrame, least: float = 0.93, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """(label, nodes, cells, whole, largest) of every label of more distinct vectors than a leaf holds: in how many cells its
    trees ended, how many of its vectors are in a cell of more rows than a leaf, which no split shrank, and the
    rows of its largest cell."""
    _, nodes = _nodes(embeddings)
    large = nodes.groupBy("team").agg(F.count(F.lit(1)).alias("nodes")).where(F.col("nodes") > leaf)
    cells = keep(_cells(nodes, trees, leaf, least).distinct())
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    per_node = cells.join(sizes, "cell").groupBy("node").agg(F.max("n").alias("n"))
    of_team = cells.join(nodes.select("node", "team"), "node").select("team", "cell").distinct().groupBy("team").agg(F.count(F.lit(1)).alias("cells"))
    return (
        nodes.join(per_node, "node").join(large, "team").join(of_team, "team")
        .groupBy("team", "label", "nodes", "cells")
        .agg(F.count_if(F.col("n") > leaf).alias("whole"), F.max("n").alias("largest")).drop("team")
    )


def near_duplicates(embeddings: DataFrame, least: float = 0.93, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of embeddings, whatever other columns it has.

    Rows are compared when their labels are equal and not null and their vectors equally long. Vectors that
    are null, empty, zero or hold null or non-finite components link with nothing. Equal vectors of a label
    link and are one node of the search; rows with equal ids count as rows of their own. Rows without an
    id link with nothing, and are kept, with a null component. An empty table gives an empty result.
    """
    keyed, nodes = _nodes(embeddings)
    cells = keep(_cells(nodes, trees, leaf, least).distinct())
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    lists = cells.groupBy("node").agg(F.sort_array(F.collect_list("cell")).alias("cells"))
    parts = F.ceil(F.col("n") / TILE).cast("int")
    placed = (
        cells.join(sizes, "cell")
        .withColumn("parts", parts)
        .withColumn("part", F.pmod(F.xxhash64("node", F.lit(5)), F.col("parts")).cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .join(nodes.select("node", "v", "copies"), "node")
        .join(lists, "node")
        .select("cell", F.least("part", "with").alias("a"), F.greatest("part", "with").alias("b"), "part", "node", "copies", "v", "cells")
    )
    found = keep(
        placed.groupBy("cell", "a", "b").applyInPandas(lambda x: leaf_links(x, least), "node long, other long, links long")
    )
    links = found.where("links > 0").groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")))
    labelled = nodes.join(links, "node", "left").join(roots, "node", "left").select(
        "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("root", "node").alias("root")
    )
    component = F.coalesce("root", "vec_id")
    return keyed.join(labelled, ["k1", "k2"], "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )


#: All pairs of a label, and the smallest id over links; for the size of a test table.
REPORT_SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reached AS (
  SELECT vec_id AS a, vec_id AS b FROM usable UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), roots AS (
  SELECT a AS vec_id, min(b) AS root FROM reached GROUP BY a
), counted AS (
  SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, coalesce(root, e.vec_id) AS component_id,
       coalesce(e.vec_id = coalesce(root, e.vec_id), true) AS kept
FROM embeddings e LEFT JOIN roots USING (vec_id) LEFT JOIN counted USING (vec_id)
"""
