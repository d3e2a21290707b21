"""Packing: every document's ids against the library, piece by piece, and the shape of the sequences."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from edge import DOC_SCHEMA, awkward, empty, rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from velomet.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]


def whole(pieces):
    """Documents put together again: a Counter of (doc_id, ids), and checks of every piece on the way."""
    sequences = Counter(p["sequence_id"] for p in pieces)
    assert max(sequences.values(), default=1) == 1
    docs, open_ = [], defaultdict(list)
    for p in pieces:
        assert p["offset"] == 0 and p["length"] == len(p["ids"]) <= packing.LONGEST
        assert p["length"] & (p["length"] - 1) == 0
        open_[p["doc_id"], p["doc_tokens"]].append(p)
    for (doc_id, tokens), own in open_.items():
        assert sum(p["length"] for p in own) % tokens == 0
        starts = defaultdict(list)
        for p in own:
            starts[p["start"]].append(p)
        copies = len(starts[0])
        for k in range(copies):  # rows with one id and length: take any piece that fits
            at, ids = 0, []
            while at < tokens:
                p = starts[at].pop()
                ids += p["ids"]
                at += p["length"]
            assert at == tokens
            docs.append((doc_id, tuple(ids)))
    return Counter(docs)


def test_awkward_texts(spark):
    docs = awkward(spark)
    more = rows("say <|endoftext|> twice<|endoftext|>", "  a  b \n\n c   ", "it's we'll I'D", "é" * 5_000 + " end")
    docs = docs.union(spark.createDataFrame(more, DOC_SCHEMA).withColumn("doc_id", F.col("doc_id") + 100))
    given = Counter((r["doc_id"], tuple(ids_of(r["text"]))) for r in docs.collect())
    pieces = packing.pack(docs.repartition(3), PATH).collect()
    got = whole(pieces)
    # Rows that share id and number of ids may exchange pieces; their ids taken together are the same.
    assert sum(got.values()) == sum(given.values())
    assert Counter(k[0] for k in got.elements()) == Counter(k[0] for k in given.elements())
    assert Counter(i for k in got.elements() for i in k[1]) == Counter(i for k in given.elements() for i in k[1])
    assert packing.pack(empty(spark), PATH).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 1023, 1024, 1025, 2048, 3071, 100_000])
def test_lengths(n):
    cut = packing.lengths(n)
    assert sum(cut) == n and cut == sorted(cut, reverse=True)
    assert len(cut) == n // 1024 + bin(n % 1024).count("1")


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pieces = packing.pack(docs, PATH).collect()
    assert whole(pieces) == Counter((r["doc_id"], tuple(ids_of(r["text"]))) for r in docs.collect())
    report = packing.report(docs, PATH)
    assert report.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    sums = {(r["doc_id"], r["start"]): r["ids_crc32"] for r in report.collect()}
    assert sums == {(p["doc_id"], p["start"]): zlib.crc32(np.array(p["ids"], "<u4").tobytes()) for p in pieces}


def test_coder_equals_the_library():
    with open(PATH, encoding="utf-8") as file:
        own = packing.Coder(file.read())
    assert own.ranked is not None
    points = [c for c in [*range(0xD800), *range(0xE000, 0x32000), *range(0xE0000, 0xE0200), 0x10FFFF]]
    texts = [f"a{chr(c)}a 1{chr(c)}1 !{chr(c)}! {chr(c)}{chr(c)} b" for c in points]
    texts += ["x" * 50_000, "\n" * 1_000_000 + "a", " " * 1_000_000 + "a", "é" * 9_999, "<|endoftext|> <|endoftext|>x", "it's WE'LL i'd 'tis"]
    for text, want in zip(texts, LIBRARY.encode_batch(texts, add_special_tokens=False)):
        assert own.encode(text).tolist() == want.ids, text[:30]


def test_buckets_and_batches(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(3)
    pieces = packing.pack(docs, PATH)
    packing.write_buckets(pieces, str(tmp_path / "buckets"))
    back = spark.read.parquet(str(tmp_path / "buckets"))
    assert back.count() == pieces.count()
    batched = back.withColumn("batch", packing.batch_of(4096)).groupBy("batch").agg({"length": "max", "ids": "count", "sequence_id": "min"}).collect()
    assert all(r["max(length)"] * r["count(ids)"] <= 4096 for r in batched)
    short = Counter(r["max(length)"] for r in batched if r["max(length)"] * r["count(ids)"] < 4096)
    assert max(short.values()) <= 3  # the last one of each task


def test_no_shuffle(spark, sf_dir):
    plan = packing.report(spark.read.parquet(f"{sf_dir}/documents.parquet"), PATH)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
