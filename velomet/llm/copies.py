"""Groups of near copies: SimHash proposes links, the Jaccard similarity of the shingle sets decides each, and rare
shingles bring together whatever it left apart.

The search of velomet.llm.simhash deals fingerprints by key. Here it returns links between rows that lie
within the radius themselves, with their distance: in a short run of one key a minimum spanning forest of
all close pairs, in a long one a link from each row to the nearest of a few centres. The links are then
judged in rounds. A group starts as one node; in each round it takes its nearest links that lead out of it and
were not judged, the texts of both ends meet, and links of the asked similarity join groups. Links within a
group need no judging, so a tight group of m texts costs about m comparisons of texts however many links were
found. The number a group takes grows with the rounds, so all links are judged or within a group in a few of them.
A few keys make the first groups, and the other keys search one row of each.

That leaves pairs out: texts of few shingles can be alike and their fingerprints far apart, a pair can share no
key, a forest or a centre can hide a pair. So an exact search ends it. Two sets at a similarity of t or more share
one of their n - ceil(t n) + 1 first shingles in any order that all texts keep; here the rarest come first. Rows
of these shingles are dealt by shingle, and every pair of different groups that meets there is judged, unless the sizes or the
histograms of the two sets tell that it cannot be similar enough. So no pair of the asked similarity stays apart.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from velomet.llm.components import components
from velomet.llm.simhash import KEYS, SHORT, close_pairs, distance, remix, sampled_masks, shingle_hashes
from velomet.llm.work import discard, keep, release

#: Share of the radius within which a row of a long run is left to the centre that met it.
NEAR = 0.64
#: A group's links judged in the first round, and how many times as many in each further one.
FIRST, FACTOR = 1, 4
#: Keys whose links make the first groups.
FEW = 4
#: Slots in which shingles are counted, dealt in parts; only the order of shingles follows from the counts.
SLOT_BITS, PARTS = 20, 64
#: Buckets of the histogram of a set.
BUCKETS = 128
#: Pairs of two groups that one shingle gives in the first exact round, and how many times as many in each further one.
PAIRS, MORE = 64, 16
#: Pairs that a task holds before it drops those beyond these.
HELD = 2_000_000


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """The different shingle hashes of a text, sorted."""
    parts = list(shingle_hashes(text or b"", size))
    return np.unique(np.concatenate(parts)) if parts else np.empty(0, np.uint64)


def histogram(shingles: np.ndarray) -> np.ndarray:
    """How many of the set fall into each bucket, 255 at most. Two sets differ in as many shingles as these do, or more."""
    return np.minimum(np.bincount((remix(shingles, 4) >> np.uint64(57)).astype(np.int64), minlength=BUCKETS), 255).astype(np.uint8)


def apart(ha: np.ndarray, hb: np.ndarray, na: np.ndarray, nb: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """In how many shingles pairs of sets differ at least, by their histograms, and whether they may be as similar as asked."""
    d = np.abs(ha.astype(np.int16) - hb).sum(1)
    # Of n shingles of two sets together, those of similarity t differ in (1 - t) / (1 + t) n at most; rounding takes no pair out.
    may = d <= (1 - least) / (1 + least) * (na.astype(np.int64) + nb) + 1e-6
    return d, may & (np.minimum(na, nb) >= least * np.maximum(na, nb) - 1e-6)


def histograms(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BUCKETS)


def sketch(text: bytes | None, size: int, words: int) -> tuple[list[int], int, int, bytes]:
    """(fingerprint words, number of different shingles, a hash of their set, their histogram); all over the set of shingles."""
    hashes = shingle_set(text, size)
    counts = np.zeros(64 * words, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = hashes[at : at + (1 << 15)]
        for k in range(words):
            bits = np.unpackbits(remix(part, k).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts[64 * k : 64 * k + 64] += bits.sum(axis=0, dtype=np.uint32)
    prints = np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8").tolist()
    return prints, len(hashes), int(remix(hashes, 3).sum(dtype=np.uint64).view(np.int64)), histogram(hashes).tobytes()


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted arrays of different values; of two empty ones 1."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    either = len(a) + len(b) - both
    return both / either if either else 1.0


def spanning(i: np.ndarray, j: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
    """Places of the links (i, j, d) that make a minimum spanning forest of n rows, ties by place."""
    rank = np.empty(len(d), np.int64)
    rank[np.argsort(d, kind="stable")] = np.arange(len(d))
    label, taken = np.arange(n), np.zeros(len(d), bool)
    while True:
        open_ = np.flatnonzero(label[i] != label[j])
        if not len(open_):
            return np.flatnonzero(taken)
        best = np.full(n, len(d))
        np.minimum.at(best, label[i[open_]], rank[open_])
        np.minimum.at(best, label[j[open_]], rank[open_])
        taken[open_[best[label[i[open_]]] == rank[open_]]] = True
        taken[open_[best[label[j[open_]]] == rank[open_]]] = True
        a, b = i[taken], j[taken]
        while (label[a] != label[b]).any():
            least = np.minimum(label[a], label[b])
            np.minimum.at(label, a, least)
            np.minimum.at(label, b, least)
            label = label[label]


def around_centres(prints: list[np.ndarray], radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (centre, row, distance) of one long run: rows become centres in the order of their distance from the
    run's majority fingerprint, unless an earlier centre lies near; each row is linked to its nearest centre."""
    n = len(prints[0])
    major = []
    for p in prints:
        bits = np.unpackbits(p.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        major.append(np.packbits(bits.sum(axis=0, dtype=np.int64) * 2 > n, bitorder="little").view("<u8")[0])
    left = np.argsort(distance(major, prints), kind="stable")
    best, to = np.full(n, radius + 1), np.arange(n)
    while len(left) > 1:
        at, left = left[0], left[1:]
        d = distance([p[at] for p in prints], [p[left] for p in prints])
        closer = d < best[left]
        best[left[closer]], to[left[closer]] = d[closer], at
        left = left[d > NEAR * radius]
    rows = np.flatnonzero(to != np.arange(n))
    return to[rows], rows, best[rows]


def direct_links(key: np.ndarray, nodes: np.ndarray, prints: list[np.ndarray], radius: int) -> pa.RecordBatch:
    """Links (a, b, d) among rows of equal keys, each between rows within the radius. Runs are whole."""
    edges = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
    sizes = np.diff(edges)
    size_of = np.repeat(sizes, sizes)
    found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))]
    for shift in range(1, min(SHORT, int(sizes.max(initial=1)))):
        i = np.flatnonzero((key[:-shift] == key[shift:]) & (size_of[:-shift] <= SHORT))
        if not len(i):
            break
        d = distance([p[i] for p in prints], [p[i + shift] for p in prints])
        close = d <= radius
        found.append((i[close], i[close] + shift, d[close]))
    i, j, d = (np.concatenate(x) for x in zip(*found, strict=True))
    tree = spanning(i, j, d, len(key))
    found = [(i[tree], j[tree], d[tree])]
    for run in np.flatnonzero(sizes > SHORT):
        i, j, d = around_centres([p[edges[run] : edges[run + 1]] for p in prints], radius)
        found.append((edges[run] + i, edges[run] + j, d))
    i, j, d = (np.concatenate(x) for x in zip(*found, strict=True))
    a, b = np.minimum(nodes[i], nodes[j]), np.maximum(nodes[i], nodes[j])
    links = np.unique(np.stack([a, b, d.astype(np.int64)])[:, a != b], axis=1)
    return pa.RecordBatch.from_arrays([*map(pa.array, links[:2]), pa.array(links[2].astype(np.int32))], ["a", "b", "d"])


def judged(links: DataFrame, texts: DataFrame, size: int, least: float) -> DataFrame:
    """(a, b, good) for every link (a, b): whether the shingle sets of both texts are as similar as asked.
    texts has node and t, the text as bytes."""

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (shingle_sets(batch.column(n)) for n in ("ta", "tb"))
            good = [similarity(x, y) >= least for x, y in zip(left, right, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(good, pa.bool_())], ["a", "b", "good"])

    def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
        before, held = None, None  # neighbours often share an end
        for text in (cell.as_py() for cell in column):
            if held is None or text != before:
                before, held = text, shingle_set(text, size)
            yield held

    one = links.join(texts.select(F.col("node").alias("a"), F.col("t").alias("ta")), "a")
    two = one.join(texts.select(F.col("node").alias("b"), F.col("t").alias("tb")), "b")
    return two.select("a", "b", "ta", "tb").mapInArrow(each, "a long, b long, good boolean")


def possible(links: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """The links (a, b, d) between sets whose sizes and histograms, in nodes, let them be as similar as asked."""

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = (batch.column(c).to_numpy() for c in ("na", "nb"))
            _, may = apart(*(histograms(batch.column(c)) for c in ("ha", "hb")), *n, least)
            yield batch.select(["a", "b", "d"]).filter(pa.array(may))

    for end in ("a", "b"):
        links = links.join(nodes.select(F.col("node").alias(end), F.col("n").alias(f"n{end}"), F.col("h").alias(f"h{end}")), end)
    return links.select("a", "b", "d", "na", "nb", "ha", "hb").mapInArrow(each, "a long, b long, d int")


def with_roots(links: DataFrame, roots: DataFrame) -> DataFrame:
    """The links between different groups, with the roots ra and rb of their ends."""
    for end in ("a", "b"):
        of = roots.select(F.col("node").alias(end), F.col("root").alias(f"r{end}"))
        links = links.join(of, end, "left").withColumn(f"r{end}", F.coalesce(f"r{end}", end))
    return links.where("ra <> rb").select("a", "b", "d", "ra", "rb")


def verified_components(
    links: DataFrame, texts: DataFrame, size: int, least: float, roots: DataFrame | None = None, first: int = FIRST
) -> DataFrame | None:
    """(node, root) of the groups that links (a, b, d) of the asked similarity make of the groups in roots; None if
    there are none. first: a group's links judged in the first round."""
    found = [] if roots is None else [roots.select(F.col("node").alias("a"), F.col("root").alias("b"))]
    now, take = keep(links if roots is None else with_roots(links, roots)), first
    while not now.isEmpty():
        ends = now if roots is not None else now.select("*", F.col("a").alias("ra"), F.col("b").alias("rb"))
        sides = ends.select("a", "b", "d", F.explode(F.array("ra", "rb")).alias("r"))
        nearest = Window.partitionBy("r").orderBy("d", "a", "b")
        picked = sides.withColumn("no", F.row_number().over(nearest)).where(F.col("no") <= take).select("a", "b").distinct()
        seen = keep(judged(picked, texts, size, least))
        found.append(seen.where("good").select("a", "b"))
        roots = keep(components(reduce(DataFrame.union, found)))
        rest = now.select("a", "b", "d").join(seen.select("a", "b"), ["a", "b"], "left_anti")
        after = keep(with_roots(rest, roots))
        discard(now)
        release(now.sparkSession)
        now, take = after, take * FACTOR
    return roots


def shingle_counts(texts: DataFrame, size: int) -> np.ndarray:
    """How many of the sets of all texts (t) have a shingle in each slot."""

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                np.add.at(counts, slots(shingle_set(text.as_py(), size)), 1)
        data = [zstandard.compress(part.tobytes(), 1) for part in np.split(counts, PARTS)]
        yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array(data, pa.binary())], ["part", "n"])

    def add_up(table: pa.Table) -> pa.Table:
        whole = sum(np.frombuffer(zstandard.decompress(x.as_py()), np.int64) for x in table.column("n"))
        return pa.table({"part": table.column("part")[:1], "n": pa.array([zstandard.compress(whole.tobytes(), 1)], pa.binary())})

    kind = "part int, n binary"
    counts = np.zeros((PARTS, (1 << SLOT_BITS) // PARTS), np.int64)
    for row in texts.select("t").mapInArrow(each, kind).groupBy("part").applyInArrow(add_up, kind).collect():
        counts[row["part"]] = np.frombuffer(zstandard.decompress(bytes(row["n"])), np.int64)
    return counts.ravel()


def slots(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def prefix(shingles: np.ndarray, counts: np.ndarray, least: float) -> np.ndarray:
    """The first shingles of a set in the order of all: sets of the asked similarity share one of these."""
    # A little below the product, since rounding must not shorten the prefix.
    length = len(shingles) - math.ceil(least * len(shingles) - 1e-6) + 1
    return shingles[np.lexsort((shingles, counts[slots(shingles)]))[:length]]


def rare_shingles(texts: DataFrame, size: int, counts: np.ndarray, least: float) -> DataFrame:
    """(key, node) for the shingles in the prefixes of texts (node, t) that more than one node has there."""
    shared = texts.sparkSession.sparkContext.broadcast(counts)

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                sets = (shingle_set(t.as_py(), size) for t in part.column("t"))
                keys = [prefix(s, shared.value, least) if len(s) else s for s in sets]
                of = pa.array(np.repeat(np.arange(len(keys)), list(map(len, keys))))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), part.column("node").take(of)], ["key", "node"])

    def repeated(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in whole_runs(batches):
            key, node = run.column("key").to_numpy(), run.column("node").to_numpy()
            new = np.concatenate(([True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])))
            key, node = key[new], node[new]
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            lengths = np.diff(np.append(starts, len(key)))
            some = np.repeat(lengths > 1, lengths)
            yield pa.RecordBatch.from_arrays([pa.array(key[some]), pa.array(node[some])], ["key", "node"])

    kind = "key long, node long"
    rows = texts.select("node", "t").mapInArrow(each, kind).repartition("key").sortWithinPartitions("key", "node")
    return rows.mapInArrow(repeated, kind)


def links_across(rows: pa.RecordBatch, least: float, take: int) -> pa.RecordBatch:
    """Links (a, b, d, more) between rows of equal keys and different roots whose sets may be as similar as asked: for a
    key and two roots the nearest by their histograms, `take` at most; more: whether that left some out. Runs are whole, in
    the order of n."""
    key, node, root, n = (rows.column(c).to_numpy() for c in ("key", "node", "root", "n"))
    h = histograms(rows.column("h"))
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    lengths = np.diff(np.append(starts, len(key)))
    mixed = np.minimum.reduceat(root, starts) != np.maximum.reduceat(root, starts)
    i, shift = np.flatnonzero(np.repeat(mixed, lengths)), 0
    parts, held, cut = [np.empty((6, 0), np.int64)], 0, np.empty((3, 0), np.int64)

    def nearest(parts: list[np.ndarray], cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        links = np.concatenate(parts, axis=1)
        links = links[:, np.lexsort(links[[5, 4, 3, 2, 1, 0]])]
        of = links[:3]
        first = np.flatnonzero(np.concatenate(([True], (of[:, 1:] != of[:, :-1]).any(0)))) if of.shape[1] else np.empty(0, np.int64)
        place = np.arange(of.shape[1]) - np.repeat(first, np.diff(np.append(first, of.shape[1])))
        return links[:, place < take], np.unique(np.concatenate([cut, of[:, place == take]], axis=1), axis=1)

    while len(i):
        shift += 1
        i = i[i + shift < len(key)]
        # Beyond the first row of another key, or too large a set, there is no other.
        i = i[(key[i] == key[i + shift]) & (n[i] >= least * n[i + shift] - 1e-6)]
        x = i[root[i] != root[i + shift]]
        y = x + shift
        d, may = apart(h[x], h[y], n[x], n[y], least)
        x, y, d = x[may], y[may], d[may]
        if len(x):
            ends = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
            parts.append(np.stack([key[x], *ends, d, np.minimum(node[x], node[y]), np.maximum(node[x], node[y])]))
            held += len(x)
            if held > HELD:
                found, cut = nearest(parts, cut)
                parts, held = [found], 0
    found, cut = nearest(parts, cut)
    short = set(map(tuple, cut.T.tolist()))
    more = pa.array([x in short for x in zip(*found[:3].tolist(), strict=True)], pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(found[4]), pa.array(found[5]), pa.array(found[3].astype(np.int32)), more], ["a", "b", "d", "more"])


def whole_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of sorted batches, all of a key in one batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        key = batch.column("key").to_numpy()
        last = int(np.searchsorted(key, key[-1]))  # the run at the end may go on in the next batch
        if held and (last or key[0] != held[-1].column("key")[-1].as_py()):
            yield pa.Table.from_batches([*held, batch.slice(0, last)]).combine_chunks().to_batches()[0]
            held = []
        elif last:
            yield batch.slice(0, last)
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def joined_by_rare_shingles(given: DataFrame, nodes: DataFrame, roots: DataFrame | None, size: int, least: float) -> DataFrame | None:
    """(node, root) of the groups that all pairs of the asked similarity make; roots are groups such pairs made before."""
    texts = given.join(nodes.select("node", F.col("first").alias("doc_id")), "doc_id")
    shared = keep(rare_shingles(texts, size, shingle_counts(given, size), least))
    release(given.sparkSession)
    take, before = PAIRS, None

    while True:
        of = nodes.select("node", "n", "h")
        if roots is None:
            of = of.withColumn("root", F.col("node"))
        else:
            of = of.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))

        def scan(batches: Iterable[pa.RecordBatch], take: int = take) -> Iterator[pa.RecordBatch]:
            return (links_across(run, least, take) for run in whole_runs(batches))

        dealt = shared.join(of, "node").repartition("key").sortWithinPartitions("key", "n", "node")
        met = dealt.mapInArrow(scan, "a long, b long, d int, more boolean")
        links = keep(met.groupBy("a", "b").agg(F.min("d").alias("d"), F.max("more").alias("more")))
        release(given.sparkSession)
        fresh = links.select("a", "b", "d")
        if before is not None:  # links of the rounds before are judged, or within a group
            fresh = fresh.join(before.select("a", "b"), ["a", "b"], "left_anti")
        roots = groups_of(fresh, given, nodes, size, least, roots, PAIRS)
        if links.where("more").isEmpty():
            discard(shared)
            return roots
        before, take = links, take * MORE


def groups_of(
    links: DataFrame, given: DataFrame, nodes: DataFrame, size: int, least: float, roots: DataFrame | None, first: int = FIRST
) -> DataFrame | None:
    """verified_components, the texts being those of the rows in links."""
    if links.isEmpty():
        return roots
    linked = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    chosen = nodes.join(linked, "node", "left_semi").select("node", F.col("first").alias("doc_id"))
    texts = keep(given.join(chosen, "doc_id").dropDuplicates(["doc_id", "node"]).select("node", "t"))
    roots = verified_components(links, texts, size, least, roots, first)
    discard(texts)
    return roots


def near_copies(docs: DataFrame, size: int, radius: int, words: int, missed: float, least: float) -> DataFrame:
    """doc_id and component_id, the smallest doc_id reachable over links of at least the asked similarity.

    docs has doc_id, a key without nulls of which equal ones mean equal texts, and text; other columns are left out. size: words to a shingle; radius,
    words, missed: see simhash.sampled_masks; least: the Jaccard similarity of the sets of shingles from which
    texts are linked. Texts without words have the empty set and are one group. Texts of equal sets are one
    node from the start, so exact copies add nothing to the search. Repeated keys each get a row. No rows: no result.
    """
    names = [f"f{k}" for k in range(words)]

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [sketch(t.as_py(), size, words) for t in batch.column(1)]
            columns = [pa.array([r[0][k] for r in rows], pa.int64()) for k in range(words)]
            counts = [pa.array([r[i] for r in rows], pa.int64()) for i in (1, 2)]
            h = pa.array([r[3] for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, *counts, h], ["doc_id", *names, "n", "same", "h"])

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("t"))
    schema = ", ".join(["doc_id long", *(f"{n} long" for n in names), "n long", "same long", "h binary"])
    prints = keep(given.mapInArrow(each, schema).withColumn("node", F.xxhash64(*names, "n", "same")))
    nodes = keep(prints.groupBy("node", *names, "n").agg(F.min("doc_id").alias("first"), F.min("h").alias("h")))
    masks, roots = sampled_masks(words, radius, nodes.count(), missed), None
    for some in (masks[:FEW], masks[FEW:]):
        shown, parts = nodes, []
        if roots is not None:  # one row of each group found
            shown = nodes.join(roots.where("node <> root"), "node", "left_anti")
        for at in range(0, len(some), KEYS):
            found = close_pairs(shown.select("node", *names), words, radius, some[at : at + KEYS], direct_links, "a long, b long, d int")
            parts.append(keep(found.distinct()))
            release(docs.sparkSession)
        if not parts:
            continue
        links = keep(possible(reduce(DataFrame.union, parts).groupBy("a", "b").agg(F.min("d").alias("d")), nodes, least))
        for part in parts:
            discard(part)
        roots = groups_of(links, given, nodes, size, least, roots)
        discard(links)
    roots = joined_by_rare_shingles(given, nodes, roots, size, least)
    first = nodes.select("node", "first")
    if roots is not None:
        # Nodes without links stay out of the grouping: they are their own component.
        first = first.join(roots, "node", "left")
        groups = first.where("root IS NOT NULL").groupBy("root").agg(F.min("first").alias("least"))
        first = first.join(groups, "root", "left").withColumn("first", F.coalesce("least", "first"))
    return prints.join(first.select("node", F.col("first").alias("component_id")), "node").select("doc_id", "component_id")
