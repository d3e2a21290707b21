"""Packing token ids into sequences by power-of-two decomposition.

A document's ids are cut into pieces whose lengths are powers of two: as many of the longest as go in, then
one for every binary digit of the rest, from the largest down. A piece is a sequence by itself, so no sequence
crosses documents, none has padding, and sequences of one length form a bucket that a trainer draws whole
batches from.

Everything happens in one pass over the documents, without a shuffle: a sequence's number is made of its bucket, its task and
its place among the sequences of that length in the task. Numbers of a bucket are one range, and consecutive in a task.
"""

from __future__ import annotations

import functools
import itertools
import json
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from velomet.llm.bpe import byte_letters

#: Most tokens of a sequence, and the id that ends a document.
LONGEST, END = 1024, 0
#: Bits of a sequence number for the place in the task and for the task.
PLACE, TASK = 35, 24
#: Texts whose ids are held at a time.
TEXTS = 200
#: How byte-level files of this kind cut a text before merging (fixed value, part of the format).
CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

SCHEMA = "doc_id long, start long, length long, ids array<int>, doc_tokens long, sequence_id long, `offset` long"


class Coder:
    """Ids of whole texts as the tokenizers library gives them for a byte-level BPE file.

    The file's merges, as ranks, go to an encoder that keeps no offsets and takes a quarter of the library's
    time; ids are the same (tests compare them over all code points). Texts whose runs of white space are beyond what
    that encoder's pattern can step back over go through the library itself.
    """

    def __init__(self, file: str):
        self.library = Tokenizer.from_str(file)
        self.library.no_truncation()
        self.library.no_padding()
        rules = json.loads(file)
        vocab, merges = rules["model"]["vocab"], rules["model"]["merges"]
        made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
        self.ranked = None
        if (
            rules["pre_tokenizer"]["type"] == "ByteLevel"
            and not rules["normalizer"]
            and not rules["pre_tokenizer"]["add_prefix_space"]
            and made == sorted(made)  # the rank of a merge is the rank of what it makes
        ):
            special = {t["content"]: t["id"] for t in rules["added_tokens"]}
            value = {letter: byte for byte, letter in enumerate(byte_letters())}
            ranks = {bytes(value[c] for c in token): i for token, i in vocab.items() if token not in special}
            self.ranked = tiktoken.Encoding("file", pat_str=CUT, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str) -> np.ndarray:
        if self.ranked is not None:
            try:
                return self.ranked.encode_to_numpy(text, allowed_special="all").astype(np.int32)
            except ValueError:
                pass  # its pattern gave up
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.int32)


@functools.lru_cache(maxsize=1)
def coder(file: str) -> Coder:
    return Coder(file)


def lengths(n: int, longest: int = LONGEST) -> list[int]:
    """Powers of two that sum to n, none above `longest` (itself one), largest first."""
    whole, rest = divmod(n, longest)
    return [longest] * whole + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, path: str, longest: int = LONGEST, end: int = END) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset (always 0).

    A row of docs is a document: its whole text's ids by the tokenizer file at `path` (null and empty texts have
    none) and then the id `end`. start counts the ids before the piece, doc_tokens all of them with the end.
    Repeated rows are documents of their own, a null doc_id stays null, other columns are ignored, an empty
    table gives an empty result. Numbers are unique; which a piece gets follows from how the input is split into tasks.
    """
    if longest & (longest - 1) or longest < 1:
        raise ValueError("the longest sequence must be a power of two")
    with open(path, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, task = coder(shared.value), TaskContext.get().partitionId()
        placed = np.zeros(longest.bit_length(), np.int64)  # sequences so far, by binary logarithm of the length
        for batch in batches:
            for first in range(0, batch.num_rows, TEXTS):
                part = batch.slice(first, TEXTS)
                found = [np.append(own.encode(text.as_py() or ""), np.int32(end)) for text in part.column(1)]
                sizes = list(map(len, found))
                cuts = [lengths(n, longest) for n in sizes]
                counts = np.fromiter(map(len, cuts), np.int64, len(cuts))
                length = np.fromiter(itertools.chain.from_iterable(cuts), np.int64)
                ends = np.concatenate([[0], np.cumsum(length)])
                size = np.array(sizes, np.int64)
                before = np.repeat(np.cumsum(size) - size, counts)
                bucket = np.log2(length).astype(np.int64)
                place = np.empty(len(length), np.int64)
                for b in np.unique(bucket):
                    mine = np.flatnonzero(bucket == b)
                    place[mine] = placed[b] + np.arange(len(mine))
                    placed[b] += len(mine)
                number = bucket << (PLACE + TASK) | task << PLACE | place
                ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.concatenate(found)))
                doc = part.column(0).take(pa.array(np.repeat(np.arange(len(cuts)), counts)))
                columns = [doc, ends[:-1] - before, length, ids, np.repeat(size, counts), number, np.zeros(len(length), np.int64)]
                names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(each, SCHEMA)


def batch_of(tokens: int) -> Column:
    """Number of the batch that a sequence of pack() belongs to: `tokens` tokens of one length and one task,
    less only in the last batch of a task's bucket."""
    place = F.col("sequence_id").bitwiseAND(F.lit((1 << PLACE) - 1))
    first = F.col("sequence_id") - place
    return first + F.floor(place / F.greatest(F.lit(1), F.floor(F.lit(tokens) / F.col("length"))))


def write_buckets(pieces: DataFrame, folder: str) -> None:
    """Writes pieces into one folder per sequence length, each task a file per length."""
    pieces.write.partitionBy("length").parquet(folder)


def report(docs: DataFrame, path: str) -> DataFrame:
    """The pieces of pack() with the CRC-32 of their ids, as little-endian unsigned 32-bit numbers, for the ids."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            flat, ends = ids.values.to_numpy().astype("<u4"), ids.offsets.to_numpy()
            sums = pa.array([zlib.crc32(flat[a:b]) for a, b in zip(ends, ends[1:])], pa.int64())
            yield pa.RecordBatch.from_arrays([sums if k == 3 else batch.column(k) for k in range(7)], names)

    return pack(docs, path).mapInArrow(each, SCHEMA.replace("ids array<int>", "ids_crc32 long"))
