"""Fill-in-middle: cuts and outputs against a plain regular expression, the index against its own bound."""

import hashlib
import re

import numpy as np
import pytest
from edge import DOC_SCHEMA, awkward, empty, rows

from velomet.llm import fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(doc_id, text):
    """The expected row, by definition."""
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = sha(f"42:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    assert pre + mid + suf == text
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    if h4 % 100 < 80:
        form, out = "spm", f"<S>{suf}<P>{pre}<M>{mid}"
    else:
        form, out = "psm", f"<P>{pre}<S>{suf}<M>{mid}"
    return doc_id, n, form, len(pre), len(mid), sha(out), sha(text)


def check(docs):
    want = sorted((plain(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()), key=str)
    assert sorted(map(tuple, fim.report(docs).collect()), key=str) == want
    return want


def test_awkward_texts(spark):
    more = ["<P>", "a <S> b", "x<M>y", "<", "<S", "P>", " lead and tail ", "\x0b\x0c\r\n", "é     \u0085 🙂 🙂"]
    texts = more + [f"{t} {i}" for i in range(40) for t in (" <S", "é 🙂 <P", "> <M >")]
    docs = awkward(spark).union(spark.createDataFrame(rows(*texts), DOC_SCHEMA))
    forms = {w[2] for w in check(docs)}
    assert forms == {"plain", "spm", "psm"}
    assert fim.report(empty(spark)).collect() == []


def test_whole_table(spark, sf_dir):
    check(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_parts_and_outputs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in fim.transform(docs).collect():
        if r["form"] == "plain":
            assert (r["prefix"], r["middle"], r["suffix"], r["output"]) == (None, None, None, texts[r["doc_id"]])
        else:
            assert r["prefix"] + r["middle"] + r["suffix"] == texts[r["doc_id"]]


def made_texts():
    rng = np.random.default_rng(5)
    yield ""
    yield " "
    yield "one"
    yield " ".join("ab" for _ in range(50_000))
    yield " ".join("x" * int(k) for k in rng.integers(1, 12, 30_000))
    yield " ".join("x" * int(k) for k in rng.pareto(0.7, 3_000).clip(0, 3_000) + 1)
    yield "x" * 100_000 + " a b c " + "y" * 100_000
    yield "é " * 2_000 + "\n\n" + "word " * 3


@pytest.mark.parametrize("error", [1, 16, fim.ERROR, 5_000])
def test_index_is_exact_and_bounded(error):
    for text in made_texts():
        want = np.cumsum([0, *map(len, UNIT.findall(text))])
        bounds = fim.boundaries(text)
        assert bounds.tolist() == want.tolist()
        index = fim.fit(bounds, error)
        ranks = np.arange(len(want))
        assert index.units == len(want) - 1 and index.offsets(ranks).tolist() == want.tolist()
        assert np.abs(bounds - index.predict(ranks)).max() <= error + 1
        assert index.residual.dtype == (np.int8 if error < 127 else index.residual.dtype)


def test_lines_follow_irregularity_not_length():
    even = fim.fit(fim.boundaries("word " * 200_000))
    assert len(even.first) <= 2
    rng = np.random.default_rng(1)
    uneven = fim.fit(fim.boundaries(" ".join("x" * int(k) for k in rng.integers(1, 12, 200_000))))
    assert len(uneven.first) < 200_000 / 500
    assert uneven.residual.nbytes + 24 * len(uneven.first) < 200_001 * 8 / 6


def test_stored_index_cuts_without_the_text(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in fim.rank_index(docs).collect():
        first, origin, slope = (np.array([line[c] for line in r["lines"]]) for c in ("first", "origin", "slope"))
        kind = np.int8 if len(r["residuals"]) == r["units"] + 1 else np.int32
        index = fim.RankIndex(first, origin, slope, np.frombuffer(r["residuals"], kind))
        want = np.cumsum([0, *map(len, UNIT.findall(texts[r["doc_id"]]))])
        assert index.offsets(np.arange(r["units"] + 1)).tolist() == want.tolist()


def test_long_text_is_linear():
    fim.fit(fim.boundaries("ab " * 3_500_000))
