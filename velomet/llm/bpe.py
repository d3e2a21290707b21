"""BPE encoding and decoding with a published vocabulary, as a pair of DataFrame steps.

encode() gives the ids of every whole text, decode() the text of ids. A text is cut at the special tokens
it spells out; what lies between is normalised and split into pieces by the file's rules, and each piece
is merged by itself. Merging holds the piece's part boundaries in one array and the ranks of adjacent
parts in another: the smallest rank is looked up by a scan, its boundary deleted, and the two ranks
beside it renewed. Pieces are short, so the scans beat a heap.

The vocabulary is read by the driver and broadcast; a file of this kind holds some tens of thousands of
entries whatever the size of the corpus.
"""

from __future__ import annotations

import functools
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: White space as the file's \s has it (the Unicode property).
SPACE = "\t-\r \x85\xa0  -     　"
#: Pieces remembered by a Python worker, in each of two generations; forgetting them costs time only.
REMEMBERED = 120_000
#: Longest piece, in bytes, that is merged by scans.
SHORT = 256
NEVER = 1 << 60


def byte_letters() -> list[str]:
    """The printable stand-in of each byte value in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Codec:
    """The vocabulary and rules of one tokenizer file (BPE with word ends over byte letters)."""

    def __init__(self, text: str):
        file = json.loads(text)
        model = file["model"]
        ids = model["vocab"]
        suffix = model["end_of_word_suffix"] or ""
        #: Ids of a byte inside a piece and at its end.
        self.inner = [ids[x] for x in byte_letters()]
        self.final = [ids[x + suffix] for x in byte_letters()]
        #: Rank of a pair of adjacent ids, and the id that a rank makes.
        self.pairs = {ids[a] << 32 | ids[b]: rank for rank, (a, b) in enumerate(model["merges"])}
        self.merged = [ids[a + b] for a, b in model["merges"]]
        self.special = {t["content"]: t["id"] for t in file["added_tokens"]}
        self.names = {i: t for t, i in (ids | self.special).items()}
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))))
        parts = file["pre_tokenizer"]["pretokenizers"]
        self.piece = regex.compile(parts[0]["pattern"]["Regex"].replace("\\s", SPACE))

    def merge(self, piece: str) -> list[int]:
        """Ids of one piece."""
        data = piece.encode()
        # parts[i] lies between boundaries i and i + 1; deleting part i + 1 deletes the boundary between.
        parts = [self.inner[b] for b in data[:-1]]
        parts.append(self.final[data[-1]])
        if len(parts) > SHORT:
            return self.merge_long(parts)
        find, merged = self.pairs.get, self.merged
        ranks = [find(a << 32 | b, NEVER) for a, b in zip(parts, parts[1:])]
        while ranks and (least := min(ranks)) != NEVER:
            i = ranks.index(least)
            parts[i] = now = merged[least]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = find(now << 32 | parts[i + 1], NEVER)
            if i:
                ranks[i - 1] = find(parts[i - 1] << 32 | now, NEVER)
        return parts

    def merge_long(self, parts: list[int]) -> list[int]:
        """The same for a piece of any length: the smallest rank comes from a heap, not from a scan."""
        n, find = len(parts), self.pairs.get
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i) for i in range(n - 1) if (r := find(parts[i] << 32 | parts[i + 1], NEVER)) != NEVER]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] < 0 or j < 0 or find(parts[i] << 32 | parts[j], NEVER) != r:
                continue  # one of the two parts has changed since
            parts[i], parts[j] = self.merged[r], -1
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
            for a, b in ((before[i], i), (i, k)):
                if a >= 0 and b >= 0 and (x := find(parts[a] << 32 | parts[b], NEVER)) != NEVER:
                    heapq.heappush(heap, (x, a))
        return [p for p in parts if p >= 0]

    def learn(self, piece: str) -> tuple[int, ...]:
        """Ids of a piece that is not among the recent ones. Kept as a tuple: the list that was merged holds a place for every byte."""
        ids = self.older.get(piece) or self.known.get(piece) or tuple(self.merge(piece))
        if len(piece) <= 64:
            if len(self.known) >= REMEMBERED:
                self.older, self.known = self.known, {}
            self.known[piece] = ids
        return ids

    def ordinary(self, text: str, out: list[int]) -> None:
        """Appends the ids of a text without special tokens."""
        # White space only parts pieces, so making each run of it one space changes nothing. The file
        # lowers letter by letter: a last sigma is no special case, unlike in str.lower.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        find = self.known.get
        for piece in self.piece.findall(text):
            out += find(piece) or self.learn(piece)

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        at = 0
        for m in self.cut.finditer(text):
            self.ordinary(text[at : m.start()], out)
            out.append(self.special[m[0]])
            at = m.end()
        self.ordinary(text[at:] if at else text, out)
        return out

    def decode(self, ids: Iterable[int], skip_special: bool = False) -> str:
        """The file names no decoder, so the tokens stand side by side with a space between; ids outside
        the vocabulary give nothing."""
        names = self.names
        if skip_special:
            dropped = set(self.special.values())
            ids = [i for i in ids if i not in dropped]
        return " ".join([names[i] for i in ids if i in names])


@functools.lru_cache(maxsize=2)
def codec(text: str) -> Codec:
    return Codec(text)


def _shared(df: DataFrame, path: str):
    with open(path, encoding="utf-8") as file:
        return df.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (array of int) for every row of docs, whatever other columns it has.

    Whole texts; null and empty texts have no ids. Repeated rows each get a row; null doc_ids stay null.
    An empty table gives an empty result.
    """
    file = _shared(docs, path)

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(file.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):  # ids of so many texts at a time
                part = batch.slice(at, 500)
                found = [array("i", own.encode(t.as_py() or "")) for t in part.column(1)]
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                flat = pa.array(np.concatenate([np.frombuffer(x, np.int32) for x in found]))
                ids = pa.ListArray.from_arrays(pa.array(ends), flat)
                yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("t")).mapInArrow(
        each, "doc_id long, ids array<int>"
    )


def decode(encoded: DataFrame, path: str, skip_special: bool = False) -> DataFrame:
    """The columns doc_id and ids of encoded, and decoded: the text of the ids (null ids: empty)."""
    file = _shared(encoded, path)

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(file.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = part.column(1)
                flat, ends = found.values.to_numpy(), found.offsets.to_pylist()
                texts = [own.decode(flat[a:b].tolist(), skip_special) for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "decoded"]
                )

    ids = F.coalesce("ids", F.array().cast("array<int>")).alias("ids")
    return encoded.select("doc_id", ids).mapInArrow(each, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Per row of docs: doc_id, n_tokens, and SHA-256 of the ids (decimal, joined by one space) and of
    the decoded text."""
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decode(encode(docs, path), path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )
