"""BPE against the tokenizers library, text by text."""

import hashlib
import random

import public_tokenizers
import pytest
from edge import awkward, empty
from tokenizers import Tokenizer

from velomet.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(PATH)
    made.no_padding()
    made.no_truncation()
    return made


@pytest.fixture(scope="module")
def own():
    return bpe.codec(open(PATH, encoding="utf-8").read())


def test_random_texts(library, own):
    draw = random.Random(1)
    signs = "aAé ÉΣςß'st'LL<|endoftext|>\n\t 12٣😀中́eİI._-‍\x1c\xa0"
    for _ in range(3_000):
        text = "".join(draw.choice(signs) for _ in range(draw.randint(0, 14)))
        if draw.random() < 0.2:
            text += draw.choice(["<|endoftext|>", "<|startoftext|>"]) + text
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_long_pieces(library, own):
    draw = random.Random(2)
    for n in (2, 200, 256, 257, 300, 2_000):
        text = "".join(draw.choice("abcdeathingthereé") for _ in range(n))
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_forgetting_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    small = bpe.Codec(open(PATH, encoding="utf-8").read())
    text = "a few words that come again, a few words that come again and others that do not come"
    assert small.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_remembered_ids_hold_no_spare_places():
    own = bpe.Codec(open(PATH, encoding="utf-8").read())
    own.encode("some words of several lengths, internationalisation among them")
    assert own.known and all(type(ids) is tuple for ids in own.known.values())


def check(docs, library):
    given = docs.select("doc_id", "text").collect()

    def row(doc_id, text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        said = library.decode(ids, skip_special_tokens=False)
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), said)]
        return (doc_id is None, doc_id or 0, len(ids), *digest)

    got = bpe.digests(docs, PATH).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, *r[1:]) for r in got) == sorted(row(*r) for r in given)


def test_awkward_texts(spark, library):
    check(awkward(spark), library)


def test_whole_table(spark, sf_dir, library):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"), library)


def test_no_rows_and_null_ids(spark):
    assert bpe.digests(empty(spark), PATH).collect() == []
    rows = spark.createDataFrame([(1, None), (2, []), (3, [1, -5, 10**6])], "doc_id long, ids array<int>")
    assert sorted(r["decoded"] for r in bpe.decode(rows, PATH).collect()) == ["", "", '"']
