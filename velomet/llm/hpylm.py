"""A hierarchical Pitman-Yor language model, seated by Gibbs sampling over the whole corpus.

Every context, the word before, has a restaurant whose customers are the words that follow it; the tables of
all of them are the customers of one parent restaurant over words, whose base is uniform over the
vocabulary and one word more. What is known per context is kept in two ways. Contexts that hold 2^-18 or more of the
training tokens are numbered, and their totals are a bounded table that all tasks have (at most 2^18 rows). All
others stay distributed: their pairs lie by word, and their totals are dealt by context and come back as
replies to the buckets that ask (replies()).

Steps, each over all documents:

1. count words of the training texts: frequent contexts and very common words;
2. count pairs (word, context), gathered per bucket of words: one row per word for numbered contexts, one
   binary value per bucket for the others, which are told apart by their hash;
3. two rounds of seating. Given how many tables each context has and its own word's
   customers, a word can be seated by itself: new seatings are drawn customer by customer for all its
   contexts and for the parent, sweep by sweep. The first round burns in, the second gives SAMPLES samples;
4. score, in PASSES turns over shares of the texts: every text's pairs meet their word's row, or their own, in the bucket, and sums per
   text come back.

Rows travel as sorted, delta-coded runs of keys, one binary value per batch of texts and bucket: a key is 42
bits of the word's hash and 19 of the context's number, or 64 bits of a pair with another context. The words that hold
2^-10 or more of the tokens are spread over the buckets by context.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velomet.llm.work import discard, keep, release

#: Least share of the training tokens of a context whose totals all tasks have, and of a word spread over buckets.
CONTEXT_SHARE, COMMON_SHARE = 2.0**-18, 2.0**-10
CONTEXT_BITS = 19
CONTEXT_MASK = (1 << CONTEXT_BITS) - 1
#: Strengths; discounts follow from how many counts are 1 and 2.
STRENGTH = 1.0
SWEEPS, SAMPLES = 3, 2
#: Most customers of a dish that are reseated one by one; larger parties are seated anew in order.
ONE_BY_ONE = 24
#: Tokens per bucket and per binary value, at most about.
BUCKET, RUN = 2_000_000, 2_000_000
#: Buckets whose contexts answer together; messages are buckets x homes.
PER_HOME = 4
#: Turns in which texts are scored, each on its share of them.
PASSES = 2
SEED = 77

#: No word holds white space, so these two strings are no words.
START, END = b"\r", b"\n"


def word_id(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) >> 22


def mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def pack_wide(*columns: np.ndarray) -> bytes:
    """Columns of one length and any 64-bit values as compressed bytes, byte by byte; bytes that a whole column has no use for are left out."""
    parts = [len(columns[0]).to_bytes(8, "little")]
    for column in columns:
        values = np.ascontiguousarray(column, np.int64)
        used = max(1, (int(values.view(np.uint64).max(initial=0)).bit_length() + 7) // 8)
        each = values.view(np.uint8).reshape(-1, 8)
        parts += [bytes([used]), *(each[:, k].tobytes() for k in range(used))]
    return zstandard.compress(b"".join(parts), 1)


def unpack_wide(data: bytes, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    n, out, at = int.from_bytes(raw[:8].tobytes(), "little"), [], 8
    for _ in range(columns):
        used, at = int(raw[at]), at + 1
        each = np.zeros((n, 8), np.uint8)
        for k in range(used):
            each[:, k] = raw[at : at + n]
            at += n
        out.append(each.view(np.int64).ravel())
    return out


def pack(*columns: np.ndarray) -> bytes:
    """Columns of one length as compressed bytes; the first is sorted and kept as differences."""
    return pack_wide(np.diff(columns[0].astype(np.int64), prepend=0), *columns[1:])


def unpack(data: bytes, columns: int) -> list[np.ndarray]:
    first, *rest = unpack_wide(data, columns)
    return [np.cumsum(first), *rest]


@dataclass(frozen=True)
class Counts:
    """What all tasks know of the corpus: bounded tables and totals."""

    contexts: np.ndarray  # ids of frequent contexts; context k has number k + 1
    common: np.ndarray  # ids of words spread over buckets
    tokens: int
    words: int
    buckets: int


def tokens(text: bytes) -> np.ndarray:
    """Ids of the words and the end. Hashing every word anew is cheaper than looking most of them up."""
    words = [*text.lower().split(), END]
    return (np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)) >> np.uint64(22)).astype(np.int64)


def before(found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the tokens of several texts: their words, the words before them and the places of their texts."""
    words = np.concatenate(found)
    lengths = np.array(list(map(len, found)))
    context = np.empty_like(words)
    context[1:] = words[:-1]
    context[np.cumsum(lengths) - lengths] = word_id(START)
    return words, context, np.repeat(np.arange(len(found), dtype=np.int32), lengths)


def number_of(context: np.ndarray, counts: Counts) -> np.ndarray:
    """Numbers of frequent contexts, 0 for others."""
    if not len(counts.contexts):
        return np.zeros(len(context), np.int32)
    at = np.minimum(np.searchsorted(counts.contexts, context), len(counts.contexts) - 1).astype(np.int32)
    return np.where(counts.contexts[at] == context, at + np.int32(1), np.int32(0))


def pair_id(word: np.ndarray, context: np.ndarray) -> np.ndarray:
    """64 bits for a word and the id of an infrequent context."""
    return mix(mix(word) + context.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)


def bucket_of(keys: np.ndarray, counts: Counts, word: np.ndarray | None = None) -> np.ndarray:
    word = keys >> CONTEXT_BITS if word is None else word
    spread = np.isin(word, counts.common)
    return (mix(np.where(spread, keys, word)) % np.uint64(counts.buckets)).astype(np.int32)


def by_bucket(bucket: np.ndarray, buckets: int) -> list[np.ndarray]:
    """Per bucket, the places of its rows in their order."""
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    return [order[i:j] for i, j in zip(ends, ends[1:])]


def _training(docs: DataFrame) -> DataFrame:
    """doc_id, text as bytes and whether the text is held out. A null id has the text "" and is trained on."""
    held = F.crc32(F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).cast("binary")) % 7 == 2
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("t"), held.alias("held_out")
    )


def count_words(texts: DataFrame) -> Counts:
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(found: list[np.ndarray]) -> pa.RecordBatch:
            word, n = np.unique(np.concatenate(found), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(word), pa.array(n)], ["word", "n"])

        found, size = [], 0
        for batch in batches:
            for text in batch.column(0):
                found.append(tokens(text.as_py()))
                size += len(found[-1])
                if size >= RUN:
                    yield out(found)
                    found, size = [], 0
        if found:
            yield out(found)

    counted = keep(
        texts.where("NOT held_out").select("t").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    )
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    # A context is followed by as many tokens as it occurs, the start by one for every text, as is the end by none.
    often = counted.where(F.col("n") >= max(1, total["n"] * CONTEXT_SHARE)).collect()  # at most 2^18
    discard(counted)
    end, start = word_id(END), word_id(START)
    contexts = sorted({start if r["word"] == end else r["word"] for r in often})
    common = sorted(r["word"] for r in often if r["n"] >= total["n"] * COMMON_SHARE)
    everything = max(1, total["n"]) * 7 / 6
    return Counts(
        np.array(contexts, np.int64), np.array(common, np.int64), total["n"], total["v"], max(1, math.ceil(everything / BUCKET))
    )


def gathered(texts: DataFrame, counts: Counts) -> DataFrame:
    """Pairs by bucket: rows (bucket, word, contexts, n) as count_pairs gives, and a row per bucket with
    `others`, its pairs of a word and an infrequent context (pack: word, context, n), and `sizes`.

    Pairs that only held-out texts have are among the others with n = 0: what their context holds is asked for with
    the rest. sizes: pairs counted once and twice, words of one and of two pairs, training pairs among the others.
    """
    shared = texts.sparkSession.sparkContext.broadcast(counts)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value

        def out(found: list[np.ndarray], held: list[bool]) -> pa.RecordBatch:
            word, context, text = before(found)
            found.clear()
            trained, number = ~np.array(held)[text], number_of(context, own)
            keys, n = np.unique((word << CONTEXT_BITS | number)[trained & (number > 0)], return_counts=True)
            runs = by_bucket(bucket_of(keys, own), own.buckets)
            word, context, trained = word[number == 0], context[number == 0], trained[number == 0]
            pair, first, place = np.unique(pair_id(word, context), return_index=True, return_inverse=True)
            m = np.bincount(place, trained, len(pair)).astype(np.int64)
            word, context = word[first], context[first]
            # Sorted by word, its ids are small differences.
            order = np.lexsort((context, word))
            pair, word, context, m = pair[order], word[order], context[order], m[order]
            others = by_bucket(bucket_of(pair, own, word), own.buckets)
            kept = [b for b in range(own.buckets) if len(runs[b]) or len(others[b])]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(kept, pa.int32()),
                    pa.array([pack(keys[runs[b]], n[runs[b]]) for b in kept], pa.binary()),
                    pa.array([pack(word[others[b]], context[others[b]], m[others[b]]) for b in kept], pa.binary()),
                ],
                ["bucket", "run", "others"],
            )

        found, held, size = [], [], 0
        for batch in batches:
            for text, h in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                found.append(tokens(text.as_py()))
                held.append(h)
                size += len(found[-1])
                if size >= RUN:
                    yield out(found, held)
                    found, held, size = [], [], 0
        if found:
            yield out(found, held)

    def gather(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        word, context, m = (np.concatenate(x) for x in zip(*(unpack(x.as_py(), 3) for x in table.column("others"))))
        pair, first, place = np.unique(pair_id(word, context), return_index=True, return_inverse=True)
        word, context, m = word[first], context[first], np.bincount(place, m, len(pair)).astype(np.int64)
        order = np.lexsort((context, word))
        word, context, m = word[order], context[order], m[order]
        others = pack(word, context, m)
        sizes = [int((m == 1).sum()), int((m == 2).sum())]
        after, of = np.unique(word[m > 0], return_inverse=True)
        runs = [unpack(x.as_py(), 2) for x in table.column("run")]
        # Customers after infrequent contexts are counted under number 0.
        keys, place = np.unique(np.concatenate([*(k for k, _ in runs), after << CONTEXT_BITS]), return_inverse=True)
        n = np.concatenate([*(c for _, c in runs), np.bincount(of, m[m > 0], len(after))])
        n = np.bincount(place, n, len(keys)).astype(np.int64)
        numbered = n[keys & CONTEXT_MASK > 0]
        sizes[0] += int((numbered == 1).sum())
        sizes[1] += int((numbered == 2).sum())
        words = keys >> CONTEXT_BITS
        starts = np.flatnonzero(np.diff(words, prepend=-1))
        each = np.add.reduceat((keys & CONTEXT_MASK > 0).astype(np.int64), starts) if len(starts) else np.zeros(0, np.int64)
        np.add.at(each, np.searchsorted(words[starts], after), np.bincount(of, minlength=len(after)))
        sizes += [int((each == 1).sum()), int((each == 2).sum()), int((m > 0).sum())]
        ends = pa.array(np.append(starts, len(keys)).astype(np.int32))
        rows = len(starts)
        columns = {
            "bucket": pa.array(np.full(rows + 1, bucket, np.int32)),
            "word": pa.array([*words[starts].tolist(), None], pa.int64()),
            "contexts": pa.concat_arrays([pa.ListArray.from_arrays(ends, pa.array((keys & CONTEXT_MASK).astype(np.int32))), pa.nulls(1, pa.list_(pa.int32()))]),
            "n": pa.concat_arrays([pa.ListArray.from_arrays(ends, pa.array(n)), pa.nulls(1, pa.list_(pa.int64()))]),
            "others": pa.concat_arrays([pa.nulls(rows, pa.binary()), pa.array([others], pa.binary())]),
            "sizes": pa.concat_arrays([pa.nulls(rows, pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64()))]),
        }
        return pa.table(columns)

    runs = texts.select("t", "held_out").mapInArrow(count, "bucket int, run binary, others binary")
    return runs.groupBy("bucket").applyInArrow(
        gather, "bucket int, word long, contexts array<int>, n array<long>, others binary, sizes array<long>"
    )


def count_pairs(texts: DataFrame, counts: Counts, pairs: DataFrame | None = None) -> DataFrame:
    """(bucket, word, contexts, n): for every word of the training texts, its contexts' numbers and counts, from
    what gathered() gives. Infrequent contexts are one entry, 0.

    Common words have a row in every bucket that some of their contexts are in.
    """
    pairs = gathered(texts, counts) if pairs is None else pairs
    return pairs.where("word IS NOT NULL").select("bucket", "word", "contexts", "n")


def replies(others: DataFrame, counts: Counts, width: int, pick: Callable[[list[np.ndarray]], list[np.ndarray]]) -> DataFrame:
    """(bucket, reply): sums over all buckets for every infrequent context that a bucket asks for.

    others: (bucket, others), of `width` columns, from which pick takes the contexts asked for and values to sum.
    Contexts are dealt to homes by their own hash, one binary value per bucket and home each way.
    """
    homes = math.ceil(counts.buckets / PER_HOME)

    def sums(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
        context, place = np.unique(columns[0], return_inverse=True)
        return [context, *(np.bincount(place, v, len(context)).astype(np.int64) for v in columns[1:])], place

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, data in zip(batch.column(0), batch.column(1)):
                columns, _ = sums(pick(unpack(data.as_py(), width)))
                dealt = by_bucket((mix(columns[0]) % np.uint64(homes)).astype(np.int32), homes)
                kept = [b for b in range(homes) if len(dealt[b])]
                run = [pack(*(c[dealt[b]] for c in columns)) for b in kept]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kept, pa.int32()), pa.array([bucket.as_py()] * len(kept), pa.int32()), pa.array(run, pa.binary())],
                    ["home", "bucket", "run"],
                )

    def answer(table: pa.Table) -> pa.Table:
        count = len(pick([np.zeros(0, np.int64)] * width))
        runs = [unpack(x.as_py(), count) for x in table.column("run")]
        (_, *found), place = sums([np.concatenate(x) for x in zip(*runs)])
        ends = np.cumsum([len(r[0]) for r in runs])
        out = [pack(r[0], *(v[place[end - len(r[0]) : end]] for v in found)) for r, end in zip(runs, ends)]
        return pa.table({"bucket": table.column("bucket"), "reply": pa.array(out, pa.binary())})

    asked = others.select("bucket", "others").mapInArrow(ask, "home int, bucket int, run binary")
    return asked.groupBy("home").applyInArrow(answer, "bucket int, reply binary")


def replied(table: pa.Table, context: np.ndarray, values: int) -> list[np.ndarray]:
    """The sums that the replies in a bucket's rows hold for each of the contexts, 0 where there is none."""
    runs = [unpack(x.as_py(), values + 1) for x in table.column("reply").drop_null()]
    if not runs:
        return [np.zeros(len(context), np.int64)] * values
    known, *found = (np.concatenate(x) for x in zip(*runs))
    order = np.argsort(known)
    known = known[order]
    at = np.minimum(np.searchsorted(known, context), len(known) - 1)
    return [np.where(known[at] == context, v[order][at], 0) for v in found]


def others_of(table: pa.Table, width: int) -> list[np.ndarray]:
    data = table.column("others").drop_null()
    return unpack(data[0].as_py(), width) if len(data) else [np.zeros(0, np.int64)] * width


def words_of(table: pa.Table) -> pa.Table:
    """The rows of words, by word."""
    rows = table.filter(table.column("word").is_valid()).combine_chunks()
    return rows.take(np.argsort(rows.column("word").to_numpy()))


def flat(rows: pa.Table | pa.RecordBatch, column: str) -> np.ndarray:
    """Values of a list column, row after row."""
    found = rows.column(column)
    if isinstance(found, pa.ChunkedArray):
        found = found.combine_chunks()
    return found.flatten().to_numpy(zero_copy_only=False) if len(found) else np.zeros(0, np.int64)


def seat(n: np.ndarray, fresh: np.ndarray, discount: float, rng: np.random.Generator, sweeps: int = SWEEPS) -> np.ndarray:
    """Number of tables of dishes with n customers each, `fresh` being the weight of a new table.

    Parties of up to ONE_BY_ONE start at one table, and every sweep takes each customer from its table and
    seats it again: at a table by its other customers less the discount, or at a new one. Larger parties are
    seated in order: the chance of a new table falls as the party grows, and the number opened between
    customers m and 2m is drawn at once from its expectation.
    """
    tables = np.minimum(n, 1).astype(np.int64)
    for size in range(2, ONE_BY_ONE + 1):
        rows = np.flatnonzero(n == size)
        if not len(rows):
            continue
        weight = fresh[rows]
        at = np.zeros((len(rows), size), np.int16)  # the table of each customer
        each = np.arange(len(rows))
        sizes = np.zeros((len(rows), size), np.int32)
        sizes[:, 0] = size
        for _ in range(sweeps):
            for customer in range(size):
                sizes[each, at[:, customer]] -= 1
                chance = np.where(sizes > 0, sizes - discount, 0.0)
                empty = np.argmax(sizes == 0, axis=1)
                chance[each, empty] = weight
                edge = np.cumsum(chance, axis=1)
                draw = rng.random(len(rows)) * edge[:, -1]
                at[:, customer] = np.minimum((edge <= draw[:, None]).sum(1), size - 1)
                sizes[each, at[:, customer]] += 1
        tables[rows] = (sizes > 0).sum(1)
    rows = np.flatnonzero(n > ONE_BY_ONE)
    if len(rows):
        weight, left = fresh[rows], n[rows] - 1.0
        seated, open_ = np.ones(len(rows)), np.ones(len(rows))
        while (left > 0).any():
            step = np.minimum(left, np.maximum(1.0, np.floor(seated / 2)))
            chance = weight / (weight + np.maximum(seated + step / 2 - discount * open_, 1e-9))
            open_ += np.minimum(rng.binomial(step.astype(np.int64), np.clip(chance, 0, 1)), step)
            seated, left = seated + step, left - step
        tables[rows] = open_.astype(np.int64)
    return tables


@dataclass(frozen=True)
class State:
    """Totals of a seating: per context and of the parent; common words' customers at the parent."""

    customers: np.ndarray  # of context k, at k; 0 unused
    tables: np.ndarray
    parent_customers: float
    parent_tables: float
    common: dict[int, int]


def parent_probability(customers: np.ndarray, tables: np.ndarray, state: State, discount: float, words: int) -> np.ndarray:
    base = (STRENGTH + discount * state.parent_tables) / (words + 1)
    return (np.maximum(customers - discount * tables, 0.0) + base) / (STRENGTH + state.parent_customers)


def draw(
    word: np.ndarray, lengths: np.ndarray, context: np.ndarray, n: np.ndarray, counts: Counts, state: State, discounts: tuple[float, float],
    samples: int, rng: np.random.Generator, others: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None,
) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per sample: tables of every pair, the parent's customers and tables of every word, tables of the others.

    others: pairs with infrequent contexts, as the place of the word, the customers and the tables of the context. Their tables sit at
    the parent as entry 0 of their word; without others, the customers of that entry do."""
    inner, outer = discounts
    place = np.repeat(np.arange(len(word)), lengths)
    direct = context == 0
    common = np.isin(word, counts.common)
    elsewhere = np.array([state.common.get(w, 0) if c else 0 for w, c in zip(word.tolist(), common.tolist())])
    of, m, opened = others or (np.zeros(0, np.int64),) * 3
    single = np.ones(len(m), np.int64)

    def with_direct(tables: np.ndarray, of_others: np.ndarray) -> np.ndarray:
        sent = n if others is None else np.bincount(of, of_others, len(word)).astype(np.int64)[place]
        return np.where(direct, sent, tables)

    tables = with_direct(np.ones(len(n), np.int64), single)
    drawn = []
    for k in range(samples + 1):
        customers = np.bincount(place, tables, len(word)).astype(np.int64)
        # A common word's row knows only its bucket's part; the sum is the last round's.
        customers = np.where(common & (elsewhere > 0), elsewhere, customers)
        base = (STRENGTH + outer * state.parent_tables) / (counts.words + 1)
        top = seat(customers, np.full(len(word), base), outer, rng)
        if k:
            drawn.append((tables, customers, top, single))
        if k < samples:
            p = parent_probability(customers, top, state, outer, counts.words)
            fresh = (STRENGTH + inner * state.tables[context]) * p[place]
            tables = seat(np.where(direct, 0, n), fresh, inner, rng)
            single = seat(m, (STRENGTH + inner * opened) * p[of], inner, rng)
            tables = with_direct(tables, single)
    # The last sample's parents are drawn with it.
    return drawn


def seated(
    rows: DataFrame, counts: Counts, state: State, discounts: tuple[float, float], samples: int, others: DataFrame | None = None, width: int = 3
) -> DataFrame:
    """Rows of count_pairs with tables drawn: t (samples x contexts, sample after sample), and the parent's
    customers and tables of the word, one per sample.

    others: rows (bucket, others) and the rows of replies() to them. Of width 3 (word, context, n), replies hold customers and pairs of
    the context; beyond, the tables that were opened beyond one per pair. There is a row for each bucket then with `others`: word, context, n,
    customers and pairs of the context, and tables per sample. Without others, context number 0 sits at the parent.
    """
    shared = rows.sparkSession.sparkContext.broadcast((counts, state))

    def table_of(rows: pa.Table | pa.RecordBatch, lengths: np.ndarray, drawn: list) -> pa.Table:
        word = rows.column("word").to_numpy()
        place = np.repeat(np.arange(len(word)), lengths)
        lists = pa.array(np.cumsum(np.append(0, lengths * samples)).astype(np.int32))
        order = np.argsort(np.tile(place, samples), kind="stable")
        tables = np.concatenate([d[0] for d in drawn])[order]
        per_word = pa.array(np.arange(0, samples * (len(word) + 1), samples, dtype=np.int32))
        columns = {c: rows.column(c) for c in ("bucket", "word", "contexts", "n")} | {
            "t": pa.ListArray.from_arrays(lists, pa.array(tables.astype(np.int64))),
            "customers": pa.ListArray.from_arrays(per_word, pa.array(np.stack([d[1] for d in drawn], 1).ravel().astype(np.int64))),
            "top": pa.ListArray.from_arrays(per_word, pa.array(np.stack([d[2] for d in drawn], 1).ravel().astype(np.int64))),
        }
        return pa.table(columns)

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, now = shared.value
        for batch in batches:
            if batch.num_rows:
                word, n = batch.column("word").to_numpy(), flat(batch, "n")
                # Seeds follow the rows, so a task that runs again draws the same.
                rng = np.random.default_rng([SEED, samples, int(word[0]), int(n.sum()) % 2**31, len(word)])
                lengths = np.diff(batch.column("contexts").offsets.to_numpy())
                drawn = draw(word, lengths, flat(batch, "contexts"), n, own, now, discounts, samples, rng)
                yield from table_of(batch, lengths, drawn).combine_chunks().to_batches()

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        own, now = shared.value
        rows = words_of(left)
        word = rows.column("word").to_numpy()
        lengths = np.diff(rows.column("contexts").combine_chunks().offsets.to_numpy()) if len(word) else np.zeros(0, np.int64)
        mine = others_of(right, width)
        if width == 3:
            mine += replied(right, mine[1], 2)
            opened = mine[4]
        else:
            mine = mine[:5]
            opened = mine[4] + replied(right, mine[1], 1)[0]
        trained = np.flatnonzero(mine[2])
        bucket = (left if left.num_rows else right).column("bucket")[0].as_py()
        rng = np.random.default_rng([SEED, samples, bucket])
        rare = np.searchsorted(word, mine[0][trained]), mine[2][trained], opened[trained]
        drawn = draw(word, lengths, flat(rows, "contexts"), flat(rows, "n"), own, now, discounts, samples, rng, rare)
        tables = np.zeros((samples, len(opened)), np.int64)
        tables[:, trained] = [d[3] for d in drawn]
        found = table_of(rows, lengths, drawn).append_column("others", pa.nulls(rows.num_rows, pa.binary()))
        last = {"bucket": pa.array([bucket], pa.int32()), "others": pa.array([pack(*mine, *tables)], pa.binary())}
        last = pa.table({f.name: last.get(f.name, pa.nulls(1, f.type)) for f in found.schema}, schema=found.schema)
        return pa.concat_tables([found, last])

    kind = "bucket int, word long, contexts array<int>, n array<long>, t array<long>, customers array<long>, top array<long>"
    rows = rows.select("bucket", "word", "contexts", "n")
    if others is None:
        return rows.mapInArrow(each, kind)
    return rows.groupBy("bucket").cogroup(others.groupBy("bucket")).applyInArrow(meet, f"{kind}, others binary")


def states_of(rows: DataFrame, counts: Counts, samples: int) -> tuple[list[State], dict[int, int]]:
    """The states that the samples of seated rows make, and the occurrences of the common words; rows of count_pairs, with no samples,
    make the state in which every pair has a table. One reading: tasks add up what they have, and at most 2^18 rows come to the driver."""
    shared = rows.sparkSession.sparkContext.broadcast(counts)
    width = len(counts.contexts) + 1
    drawn = max(1, samples)

    def added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        # Of contexts, and of the common words and last all others: occurrences, and per sample tables. Tables at the parent.
        per_context = np.zeros((1 + drawn, width), np.int64)
        per_word = np.zeros((1 + drawn, len(own.common) + 1), np.int64)
        top = np.zeros((drawn, len(own.common) + 1), np.int64)
        for batch in batches:
            lengths = np.diff(batch.column("contexts").offsets.to_numpy())
            context, n = flat(batch, "contexts"), flat(batch, "n")
            word = batch.column("word").to_numpy()
            place = np.searchsorted(own.common, word)
            place = np.where(np.append(own.common, -1)[place] == word, place, len(own.common))
            t = flat(batch, "t") if samples else np.ones(len(n), np.int64)
            begin = np.repeat((np.cumsum(lengths) - lengths) * (drawn - 1), lengths) + np.arange(len(n))
            for k, values in enumerate([n, *(t[begin + np.repeat(lengths, lengths) * s] for s in range(drawn))]):
                np.add.at(per_context[k], context, values)
                np.add.at(per_word[k], np.repeat(place, lengths), values)
            if samples:
                sat = flat(batch, "top").reshape(-1, samples)
                for s in range(samples):
                    np.maximum.at(top[s, :-1], place[place < len(own.common)], sat[place < len(own.common), s])
                    top[s, -1] += sat[place == len(own.common), s].sum()
        some = np.flatnonzero(per_context[0])
        every = np.arange(len(own.common) + 1)
        columns = [np.concatenate([per_context[k, some], per_word[k]]) for k in range(1 + drawn)]
        columns += [np.concatenate([np.zeros(len(some), np.int64), top[s]]) for s in range(drawn)]
        # Contexts go by their numbers, words by -1, -2, ...
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([some, -1 - every])), *map(pa.array, columns)], names)

    names = ["c", "n", *(f"t{s}" for s in range(drawn)), *(f"top{s}" for s in range(drawn))]
    columns = ["word", "contexts", "n", *(["t", "top"] if samples else [])]
    # A common word's rows each have a part of its customers but all of its tables at the parent.
    rest = F.col("c") == -1 - len(counts.common)
    sums = [F.sum(c).alias(c) for c in names[1 : 2 + drawn]]
    sums += [F.when(rest, F.sum(c)).otherwise(F.max(c)).alias(c) for c in names[2 + drawn :]]
    found = rows.select(columns).mapInArrow(added, ", ".join(f"{c} long" for c in names)).groupBy("c").agg(*sums).toPandas()
    contexts, words = found[found["c"] >= 0], found[found["c"] < 0].set_index("c")
    words = words.reindex([-1 - k for k in range(len(counts.common) + 1)], fill_value=0)
    states, common = [], counts.common.tolist()
    for s in range(drawn):
        customers, tables = np.zeros(width), np.zeros(width)
        customers[contexts["c"]], tables[contexts["c"]] = contexts["n"], contexts[f"t{s}"]
        own, at_parent = words[f"t{s}"].tolist(), words[f"top{s}"].tolist()
        states.append(State(customers, tables, float(sum(own)), float(sum(at_parent)), dict(zip(common, zip(own, at_parent)))))
    return states, dict(zip(common, words["n"].tolist()))


def totals(rows: DataFrame, counts: Counts, sample: int, samples: int) -> State:
    """The state that one sample of seated rows makes."""
    return states_of(rows, counts, samples)[0][sample]


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of docs.

    Training: texts whose crc32(doc_id as text) mod 7 is not 2. Null and empty texts have one token, the end.
    Rows without an id are trained on. Repeated rows count and are scored as often as they are there; other
    columns are left out whatever their names. Scores are log10 of the probability of the text, the mean of the
    samples' probabilities being taken per token. An empty table gives an empty result; without training
    texts the vocabulary is empty and every token has the base's probability.
    """
    spark = docs.sparkSession
    texts = _training(docs)
    counts = count_words(texts)
    made = keep(gathered(texts, counts))
    release(spark, 3)
    pairs, others = count_pairs(texts, counts, made), made.where("others IS NOT NULL").select("bucket", "others")
    # Discounts from how many pairs and how many words were counted once and twice.
    once = made.select(*(F.col("sizes")[k].alias(x) for k, x in enumerate("abcde"))).agg(*(F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in "abcde")).first()
    discounts = tuple(min(0.95, max(0.1, (x + 1) / (x + 2 * y + 2))) for x, y in ((once["a"], once["b"]), (once["c"], once["d"])))
    # To begin with, every pair sits at one table.
    (opened,), _ = states_of(pairs, counts, 0)
    state = State(opened.customers, opened.tables, float(opened.tables[1:].sum() + once["e"]), float(counts.words), {})
    told = replies(others, counts, 3, lambda c: [c[1], c[2], c[2] > 0])
    burnt = keep(seated(pairs, counts, state, discounts, 1, _with(others, told)))
    discard(made)
    release(spark, 3)
    rows, others = count_pairs(texts, counts, burnt), burnt.where("others IS NOT NULL").select("bucket", "others")
    state = totals(burnt.where("word IS NOT NULL"), counts, 0, 1)
    # Pairs of one customer sit at one table whatever their context; the others ask what it opened beyond.
    told = replies(others, counts, 6, lambda c: [x[c[2] > 1] for x in (c[1], c[5] - 1)])
    last = keep(seated(rows, counts, _sums(state), discounts, SAMPLES, _with(others, told), 6))
    discard(burnt)
    release(spark, 3)
    final, others = last.where("word IS NOT NULL"), last.where("others IS NOT NULL").select("bucket", "others")
    states, own_common = states_of(final, counts, SAMPLES)
    # A context without repeated pairs has a table for each.
    wide = 5 + SAMPLES
    told = keep(replies(others, counts, wide, lambda c: [x[c[3] > c[4]] for x in (c[1], *(np.maximum(t - 1, 0) for t in c[5:]))]))
    release(spark, 3)
    shared = spark.sparkContext.broadcast((counts, states))
    inner, outer = discounts

    def runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per batch of texts and bucket: the pairs of the texts, sorted, with the text's place and the count; those with
        infrequent contexts apart."""
        own, _ = shared.value
        part, number = TaskContext.get().partitionId(), 0

        def counted(keys: np.ndarray, text: np.ndarray) -> list[np.ndarray]:
            order = np.argsort(keys, kind="stable")
            keys, text = keys[order], text[order]
            first = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])))) if len(keys) else order
            return [keys[first], text[first], np.diff(np.append(first, len(keys))), order[first]]

        def out(found: list[np.ndarray], ids: list, held: list) -> pa.RecordBatch:
            texts = len(found)
            word, context, text = before(found)
            found.clear()
            asked = number_of(context, own)
            rare = asked == 0
            *sent, _ = counted((word << CONTEXT_BITS | asked)[~rare], text[~rare])
            dealt = by_bucket(bucket_of(sent[0], own), own.buckets)
            word, context = word[rare], context[rare]
            *apart, first = counted(pair_id(word, context), text[rare])
            others = by_bucket(bucket_of(apart[0], own, word[first]), own.buckets)
            # Every bucket hears of every batch, so every text comes back at least once.
            home = [b == number % own.buckets for b in range(own.buckets)]
            kept = [b for b in range(own.buckets) if len(dealt[b]) or len(others[b]) or home[b]]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(kept, pa.int32()),
                    pa.array([part << 32 | number] * len(kept), pa.int64()),
                    pa.array([texts] * len(kept), pa.int32()),
                    pa.array([pack(*(x[dealt[b]] for x in sent)) for b in kept], pa.binary()),
                    pa.array([pack(*(x[others[b]] for x in apart)) for b in kept], pa.binary()),
                    pa.array([ids if home[b] else None for b in kept], pa.list_(pa.int64())),
                    pa.array([held if home[b] else None for b in kept], pa.list_(pa.bool_())),
                ],
                ["bucket", "batch", "texts", "run", "apart", "ids", "held"],
            )

        found, ids, held, size = [], [], [], 0
        for batch in batches:
            for doc, text, h in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                found.append(tokens(text.as_py()))
                ids.append(doc)
                held.append(h)
                size += len(found[-1])
                if size >= RUN:
                    yield out(found, ids, held)
                    found, ids, held, size = [], [], [], 0
                    number += 1
        if found:
            yield out(found, ids, held)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        """left: runs of one bucket; right: its words, other pairs and replies. Per run, sums for the texts that are in it."""
        own, seatings = shared.value
        rows = words_of(right)
        here = rows.column("word").to_numpy()
        lengths = np.diff(rows.column("contexts").combine_chunks().offsets.to_numpy()) if len(here) else np.zeros(0, np.int64)
        keys = np.repeat(here, lengths) << CONTEXT_BITS | flat(rows, "contexts")
        n, t = flat(rows, "n"), flat(rows, "t")
        # The tables of sample s of a word's pairs lie together.
        begin = np.repeat((np.cumsum(lengths) - lengths) * (SAMPLES - 1), lengths) + np.arange(len(keys))
        t = [t[begin + np.repeat(lengths, lengths) * s] for s in range(SAMPLES)]
        # Words of this bucket, and the common ones, which may have no row here and whose sums are over all buckets.
        word = np.union1d(here, own.common)
        seen, at = np.zeros(len(word), np.int64), np.searchsorted(word, here)
        np.add.at(seen, np.repeat(at, lengths), n)
        spread = np.searchsorted(word, own.common)
        seen[spread] = [own_common[w] for w in own.common.tolist()]
        parents = []
        for s, state in enumerate(seatings):
            sat = np.zeros((2, len(word) + 1))  # the last: words not known
            sat[0, at], sat[1, at] = (flat(rows, c).reshape(-1, SAMPLES)[:, s] for c in ("customers", "top"))
            if len(spread):
                sat[:, spread] = np.array([state.common[w] for w in own.common.tolist()]).T
            parents.append(parent_probability(*sat, state, outer, own.words))
        base = np.log10((np.append(seen, 0) + 1) / (own.tokens + own.words + 1))

        def place(asked: np.ndarray) -> np.ndarray:
            i = np.searchsorted(word, asked)
            return np.where(np.append(word, -1)[i] == asked, i, len(word))

        def chance(i: np.ndarray, n: np.ndarray, tables: list, customers: list, opened: list) -> np.ndarray:
            p = np.zeros(len(i))
            for parent, t, c, o in zip(parents, tables, customers, opened):
                p += (np.where(n > 0, n - inner * t, 0.0) + (STRENGTH + inner * o) * parent[i]) / (STRENGTH + c)
            return np.log10(p / SAMPLES)

        other, context, m, held_by, pairs_of, *mine = others_of(right, wide)
        extra = replied(right, context, SAMPLES)
        of_other = place(other)
        of_pair = chance(of_other, m, mine, [held_by] * SAMPLES, [pairs_of + x for x in extra])
        ids = pair_id(other, context)
        by_id = np.argsort(ids)
        out: dict[str, list] = {k: [] for k in ("batch", "text", "n_tokens", "n_known", "base_score", "score", "ids", "held")}
        for row in range(left.num_rows):
            asked, text, times = unpack(left.column("run")[row].as_py(), 3)
            i, c = place(asked >> CONTEXT_BITS), asked & CONTEXT_MASK
            j = np.searchsorted(keys, asked)
            pair = np.append(keys, -1)[j] == asked
            counted = np.where(pair, np.append(n, 0)[j], 0)
            p = chance(i, counted, [np.append(x, 0)[j] for x in t], [x.customers[c] for x in seatings], [x.tables[c] for x in seatings])
            apart, text_apart, times_apart = unpack(left.column("apart")[row].as_py(), 3)
            j = by_id[np.searchsorted(ids, apart, sorter=by_id)]
            i, p = np.concatenate([i, of_other[j]]), np.concatenate([p, of_pair[j]])
            text, times = np.concatenate([text, text_apart]), np.concatenate([times, times_apart])
            texts = left.column("texts")[row].as_py()
            sums = lambda x: np.bincount(text, x * times, texts)
            number = sums(np.ones(len(i)))
            some = np.flatnonzero(number)
            out["batch"].append(left.column("batch")[row].as_py())
            out["text"].append(some.astype(np.int32))
            out["n_tokens"].append(number[some].astype(np.int32))
            out["n_known"].append(sums(i < len(word))[some].astype(np.int32))
            out["base_score"].append(sums(base[i])[some])
            out["score"].append(sums(p)[some])
            out["ids"].append(left.column("ids")[row].as_py())
            out["held"].append(left.column("held")[row].as_py())
        return pa.table({k: pa.array(v, part_schema.field(k).type) for k, v in out.items()})

    def add_up(table: pa.Table) -> pa.Table:
        """Every text of a batch from the sums of the buckets it has tokens in."""
        home = next(i for i, x in enumerate(table.column("ids")) if x.is_valid)
        ids, held = table.column("ids")[home].as_py(), table.column("held")[home].as_py()
        place = table.column("text").combine_chunks().flatten().to_numpy()
        whole = {c: np.bincount(place, table.column(c).combine_chunks().flatten().to_numpy(), len(ids)) for c in sums_of}
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "held_out": pa.array(held, pa.bool_()),
                "n_tokens": pa.array(whole["n_tokens"].astype(np.int64)),
                "n_known": pa.array(whole["n_known"].astype(np.int64)),
                "train_tokens": pa.array(np.full(len(ids), counts.tokens, np.int64)),
                "base_score": pa.array(whole["base_score"]),
                "score": pa.array(whole["score"]),
            }
        )

    sums_of = ("n_tokens", "n_known", "base_score", "score")
    part_schema = pa.schema(
        [
            ("batch", pa.int64()), ("text", pa.list_(pa.int32())), ("n_tokens", pa.list_(pa.int32())), ("n_known", pa.list_(pa.int32())),
            ("base_score", pa.list_(pa.float64())), ("score", pa.list_(pa.float64())), ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
        ]
    )

    def scored(some: DataFrame) -> DataFrame:
        asked = some.mapInArrow(runs, "bucket int, batch long, texts int, run binary, apart binary, ids array<long>, held array<boolean>")
        # A row per batch and bucket, with the texts of the batch that have tokens in the bucket.
        parts = asked.groupBy("bucket").cogroup(_with(last, told).groupBy("bucket")).applyInArrow(
            meet,
            "batch long, text array<int>, n_tokens array<int>, n_known array<int>, base_score array<double>, score array<double>, "
            "ids array<long>, held array<boolean>",
        )
        return parts.groupBy("batch").applyInArrow(
            add_up, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
        )

    # The pairs of all texts are as large as all else together, so a share of the texts lies on disk at a time.
    turn = F.pmod(F.xxhash64("doc_id", "t"), F.lit(PASSES))
    found = [scored(texts.where(turn == k)) for k in range(PASSES)]
    for k in range(PASSES - 1):
        found[k] = keep(found[k])
        release(spark, 3)
    return reduce(DataFrame.unionByName, found)


def _with(rows: DataFrame, told: DataFrame) -> DataFrame:
    """Rows by bucket and the replies to their bucket."""
    return rows.unionByName(told, allowMissingColumns=True)


def _sums(state: State) -> State:
    """The state as seating reads it: of common words, the customers alone."""
    return State(state.customers, state.tables, state.parent_customers, state.parent_tables, {w: c for w, (c, _) in state.common.items()})
