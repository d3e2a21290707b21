"""Near-duplicate texts by SimHash: pigeonhole blocks find close fingerprints, Hamming distance decides.

Fingerprints hold 64 bits, or several times 64 for stages that look for weaker likeness. Two ways to
block them, one scan to verify them:

* pigeonhole_masks: the bits are cut into radius + 2 blocks; fingerprints within the radius agree on at
  least two of them, so every pair of blocks is a key. No link is missed.
* sampled_masks: for a wide radius no block is long enough. Keys are then drawn bits; their length grows
  with the logarithm of the rows, and their number so that a pair at the radius shares one with the
  asked probability.

Rows are dealt by key and scanned in key order. A key with few rows is compared pair by pair; one
with many is walked: what a row reaches is taken off the list before the next row looks, so a tight
group of thousands of near copies costs about as many comparisons as it has rows. What comes out links each
row to the smallest one it is connected to under the key, never all pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomet.llm.components import components
from velomet.llm.work import discard, keep, release

SEED = 42
#: Shingles hashed at a time; bounds memory for very long texts.
CHUNK = 1 << 15
#: Longest run of one key that is compared pair by pair.
SHORT = 24
#: Rows of one key above which it is cut into finer blocks.
CROWDED = 20_000
#: Keys searched at a time; bounds the rows that are dealt at once.
KEYS = 32


def shingle_hashes(text: bytes, size: int) -> Iterator[np.ndarray]:
    """Unsigned XXH64 of every shingle of the lower-cased text, in chunks; nothing for no words."""
    words = text.lower().split()
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) > size:
        starts, ends = starts[: len(words) - size + 1], ends[size - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), CHUNK):
        spans = zip(starts[at : at + CHUNK].tolist(), ends[at : at + CHUNK].tolist(), strict=True)
        yield np.array([digest(joined[a:b], SEED) for a, b in spans], dtype=np.uint64)


def remix(h: np.ndarray, times: int) -> np.ndarray:
    """The hash itself for 0 times, else another hash made of it (splitmix64 steps)."""
    for _ in range(times):
        h = h + np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h = h ^ (h >> np.uint64(31))
    return h


def fingerprint(text: bytes | None, size: int, words: int) -> list[int]:
    """The fingerprint as signed 64-bit integers; a bit is set if more than half of the hashes set it."""
    total, counts = 0, np.zeros(64 * words, dtype=np.int64)
    for hashes in shingle_hashes(text or b"", size):
        total += len(hashes)
        for k in range(words):
            bits = np.unpackbits(
                remix(hashes, k).astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
            )
            counts[64 * k : 64 * k + 64] += bits.sum(axis=0, dtype=np.uint32)
    return np.packbits(counts * 2 > total, bitorder="little").view("<i8").tolist()


def fingerprints(docs: DataFrame, size: int, words: int = 1) -> DataFrame:
    """doc_id and the fingerprint f0, f1, ...: one row per row of docs, whatever other columns it has.

    Null and empty texts and texts of white space alone have the fingerprint zero.
    """
    names = [f"f{k}" for k in range(words)]

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py(), size, words) for t in batch.column(1)]
            columns = [pa.array([f[k] for f in found], pa.int64()) for k in range(words)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *names])

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("t")
    ).mapInArrow(each, ", ".join(["doc_id long", *(f"{n} long" for n in names)]))


def as_words(bits: Iterable[int], words: int) -> tuple[int, ...]:
    """A set of bit positions as one mask per 64-bit word."""
    mask = sum(1 << b for b in bits)
    return tuple((mask >> (64 * k)) & ((1 << 64) - 1) for k in range(words))


def pigeonhole_masks(words: int, radius: int) -> list[tuple[int, ...]]:
    """Keys of two blocks out of radius + 2: within the radius at least one key is equal."""
    blocks = np.array_split(np.arange(64 * words), radius + 2)
    return [as_words([*a.tolist(), *b.tolist()], words) for a, b in combinations(blocks, 2)]


def sampled_masks(
    words: int, radius: int, rows: int, missed: float, seed: int = SEED
) -> list[tuple[int, ...]]:
    """Keys of drawn bits: one fewer than log2(rows) bits each, and as many keys as make a pair at the
    radius be missed with the given probability (a pair closer than that less often)."""
    width = 64 * words
    bits = min(max(1, math.ceil(math.log2(max(rows, 2))) - 1), width - radius)
    same = math.prod((width - radius - i) / (width - i) for i in range(bits))
    draw = np.random.default_rng(seed)
    n = math.ceil(math.log(1 / missed) / same)
    return [
        as_words(draw.choice(width, size=bits, replace=False).tolist(), words)
        for _ in range(n)
    ]


def finer_masks(mask: tuple[int, ...], radius: int) -> list[tuple[int, ...]]:
    """The bits outside a key, cut into radius + 1 blocks, one of which a close pair must share."""
    free = [b for b in range(64 * len(mask)) if not mask[b // 64] >> (b % 64) & 1]
    return [as_words(x.tolist(), len(mask)) for x in np.array_split(np.array(free), radius + 1)]


def blend(prints: list[np.ndarray], mask: tuple[int, ...], tag: int) -> np.ndarray:
    """The masked bits as one number. Equal bits give equal numbers; others seldom do, and are verified."""
    key = np.full(len(prints[0]), (tag * 0xD6E8FEB86659FD93) % 2**64, dtype=np.uint64)
    for k, m in enumerate(mask):
        key = remix(key + (prints[k] & np.uint64(m)), 1)
    return key


def distance(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    return sum(np.bitwise_count(x ^ y).astype(np.int16) for x, y in zip(a, b, strict=True))


def walk(prints: list[np.ndarray], radius: int) -> np.ndarray:
    """For each row of one key, the first row it is connected to over links within the radius."""
    label = np.arange(len(prints[0]))
    left = label
    while len(left):
        start, front, left = left[0], [left[0]], left[1:]
        while front and len(left):
            at = front.pop()
            near = distance([p[at] for p in prints], [p[left] for p in prints]) <= radius
            label[left[near]] = start
            front += left[near].tolist()
            left = left[~near]
    return label


def links_of_runs(
    key: np.ndarray, nodes: np.ndarray, prints: list[np.ndarray], radius: int
) -> pa.RecordBatch:
    """Links that connect what is connected among rows of equal keys, each row to the smallest node of its
    part. Rows come in the order of key and node, and runs are whole.

    Keys that hold the same rows name the same smallest nodes, so a group of m near copies that meets under
    many keys leaves a few times m different links, not its pairs.
    """
    edges = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
    sizes = np.diff(edges)
    size_of = np.repeat(sizes, sizes)
    left, right = [], []
    for shift in range(1, min(SHORT, int(sizes.max(initial=1)))):
        i = np.flatnonzero((key[:-shift] == key[shift:]) & (size_of[:-shift] <= SHORT))
        if not len(i):
            break
        i = i[distance([p[i] for p in prints], [p[i + shift] for p in prints]) <= radius]
        left.append(i)
        right.append(i + shift)
    label = np.arange(len(key))
    if left:
        i, j = np.concatenate(left), np.concatenate(right)
        while (label[i] != label[j]).any():
            least = np.minimum(label[i], label[j])
            np.minimum.at(label, i, least)
            np.minimum.at(label, j, least)
            label = label[label]
    for run in np.flatnonzero(sizes > SHORT):
        part = slice(edges[run], edges[run + 1])
        label[part] = edges[run] + walk([p[part] for p in prints], radius)
    moved = np.flatnonzero((label != np.arange(len(key))) & (nodes[label] != nodes))
    pairs = np.unique(np.stack([nodes[label[moved]], nodes[moved]]), axis=1)
    return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])


def close_pairs(
    nodes: DataFrame,
    words: int,
    radius: int,
    masks: list[tuple[int, ...]],
    links: Callable[..., pa.RecordBatch] = links_of_runs,
    result: str = "a long, b long",
) -> DataFrame:
    """Links (a, b), some more than once, that connect all nodes within the radius that share a key.

    nodes has one row per different fingerprint: node, f0, f1, ...; links makes them from whole runs of keys.
    """
    names = [f"f{k}" for k in range(words)]
    schema = "key long, node long, " + ", ".join(f"{n} long" for n in names)

    def unsigned(batch: pa.RecordBatch, name: str) -> np.ndarray:
        return batch.column(name).to_numpy(zero_copy_only=False).view(np.uint64)

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [unsigned(batch, n) for n in names]
            for t, mask in enumerate(masks):
                columns = [pa.array(blend(prints, mask, t).view(np.int64)), pa.array(np.full(batch.num_rows, t, np.int32))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, *(batch.column(n) for n in ["node", *names])], ["key", "t", "node", *names]
                )

    def refined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finer = [finer_masks(mask, radius) for mask in masks]
        for batch in batches:
            table = batch.column("t").to_numpy()
            for t in np.unique(table):
                part = batch.filter(pa.array(table == t))
                prints, key = [unsigned(part, n) for n in names], unsigned(part, "key")
                for j, mask in enumerate(finer[t]):
                    inner = remix(key + blend(prints, mask, j + 1), 1).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(inner), *(part.column(n) for n in ["node", *names])], ["key", "node", *names]
                    )

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            whole = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
            return links(
                unsigned(whole, "key"),
                whole.column("node").to_numpy(),
                [unsigned(whole, n) for n in names],
                radius,
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column("key").to_numpy()
            last = int(np.searchsorted(key, key[-1]))  # the run at the end may go on in the next batch
            if held and key[0] != held[-1].column("key")[-1].as_py():
                yield out(held)
                held = []
            if last:
                yield out([*held, batch.slice(0, last)])
                held = []
            held.append(batch.slice(last))
        if held:
            yield out(held)

    entries = nodes.mapInArrow(keyed, schema.replace("key long,", "key long, t int,"))
    crowded = keep(entries.groupBy("key").count().where(F.col("count") > CROWDED).select("key"))
    if not crowded.isEmpty():
        fine = entries.join(crowded, "key", "left_semi").mapInArrow(refined, schema)
        entries = entries.join(crowded, "key", "left_anti").drop("t").unionByName(fine)
    else:
        entries = entries.drop("t")
    dealt = entries.repartition("key").sortWithinPartitions("key", "node")
    return dealt.mapInArrow(scan, result)


def near_duplicates(
    docs: DataFrame, size: int, radius: int, words: int = 1, missed: float | None = None
) -> DataFrame:
    """doc_id, fingerprint (hex digits), component_id for every row of docs.

    size: words to a shingle; radius: differing bits that still link; words: 64-bit words of a
    fingerprint; missed: None for pigeonhole blocks, which miss nothing, else see sampled_masks.

    Texts without words have the fingerprint zero and are linked like others. Equal fingerprints are one
    node from the start, so a group of copies of any size adds one row to the search. component_id is the
    smallest doc_id reachable over links; rows whose doc_id is null take part, and get null if nothing
    they reach has an id. Rows with equal ids each get a row. An empty table gives an empty result.
    """
    names = [f"f{k}" for k in range(words)]
    prints = keep(fingerprints(docs, size, words))
    node = F.col("f0") if words == 1 else F.xxhash64(*names)
    nodes = keep(prints.groupBy(*names).agg(F.min("doc_id").alias("first")).withColumn("node", node))
    masks = (
        pigeonhole_masks(words, radius)
        if missed is None
        else sampled_masks(words, radius, nodes.count(), missed)
    )
    shown = nodes.select("node", *names)
    if len(masks) <= KEYS:
        roots = components(close_pairs(shown, words, radius, masks))
    else:
        parts = []
        for at in range(0, len(masks), KEYS):
            parts.append(keep(close_pairs(shown, words, radius, masks[at : at + KEYS])))
            release(docs.sparkSession)
        roots = components(reduce(DataFrame.union, parts))
        for part in parts:
            discard(part)
    # Nodes without links stay out of the second grouping: they are their own component.
    linked = nodes.join(roots, "node", "left")
    groups = linked.where("root IS NOT NULL").groupBy("root").agg(F.min("first").alias("least"))
    labelled = (
        linked.join(groups, "root", "left")
        .select(*names, F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("least")).alias("component_id"))
    )
    digits = F.concat(*(F.lpad(F.lower(F.hex(n)), 16, "0") for n in reversed(names)))
    return prints.join(labelled, names).select("doc_id", digits.alias("fingerprint"), "component_id")
