"""Language of web pages by Bayesian fusion of what the text, the markup and the address say.

Text: byte trigrams hashed into a fixed number of buckets; their counts per language over all labelled documents
give the likelihood of a page's text under each language, tempered because neighbouring trigrams are not
independent. Declaration: the language that the markup declares. Suffix: the last label of the host. How
often languages declare each value, or live under each suffix, is counted over all pages, every page
counting for the languages its text points to. Host: a prior from the other pages of the host, smoothed by
the domain's and that by the prior of all pages.

The model that tasks are sent is languages x buckets numbers. Everything per host, domain, suffix or
declaration is a grouped sum joined back on its key.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velomet.llm.work import keep

BUCKETS = 1 << 14
#: Languages a model can hold; more are an error, since the model goes to every task.
LANGUAGES = 256
#: Weight of a trigram's likelihood, pages of prior strength, and pseudo-counts of a value of the markup.
TEMPER, STRENGTH, PSEUDO = 0.2, 4.0, 1.0
CHUNK = 1 << 16

SILENT = re.compile(r"<(!--|(?:script|style|nav|template|noscript)\b)", re.I)
CLOSE = {"!--": re.compile("-->")} | {
    k: re.compile(rf"</{k}\s*>", re.I) for k in ("script", "style", "nav", "template", "noscript")
}
TAG = re.compile(r"<[^<>]*>")
DECLARED = re.compile(r"<html\b[^<>]*?\blang\s*=\s*(?:[\"']\s*)?([A-Za-z]{2,3})\b", re.I)
#: Second-level labels under which names are given out, so that the domain has one label more.
SHARED_LABELS = ("ac", "co", "com", "edu", "gov", "net", "org")


def trigrams(text: bytes) -> np.ndarray:
    """Counts of hashed byte trigrams. ASCII capitals count as small letters; digits and marks as blanks."""
    total = np.zeros(BUCKETS, np.int64)
    for at in range(0, max(0, len(text) - 2), CHUNK):
        x = _FOLD[np.frombuffer(text, np.uint8)[at : at + CHUNK + 2]].astype(np.uint32)
        h = ((x[:-2] * 251 + x[1:-1]) * 251 + x[2:]) * np.uint32(2_654_435_761)
        total += np.bincount(h >> np.uint32(18), minlength=BUCKETS)
    return total


_FOLD = np.arange(256, dtype=np.uint8)
for _i in range(128):
    _FOLD[_i] = ord(chr(_i).lower()) if chr(_i).isalpha() else 32


def visible(page: str) -> str:
    """The text of a page: without scripts, styles, navigation, comments and tags. What is never closed stays, and
    is looked for once per kind."""
    kept, at, unclosed = [], 0, set()
    found = SILENT.search(page)
    while found:
        kind, go_on = found[1].lower(), found.end()
        if kind not in unclosed:
            if end := CLOSE[kind].search(page, found.end()):
                kept += [page[at : found.start()], " "]
                at = go_on = end.end()
            else:
                unclosed.add(kind)
        found = SILENT.search(page, go_on)
    return html.unescape(TAG.sub(" ", "".join([*kept, page[at:]])))


def address(url: str | None) -> tuple[str | None, str | None, str | None]:
    """Host, domain and suffix of an address; nothing where it has none."""
    try:
        host = urlsplit(url or "").hostname
    except ValueError:
        return None, None, None
    if not host:
        return None, None, None
    labels = [x for x in host.rstrip(".").split(".") if x]
    if len(labels) < 2 or labels[-1].isdigit():
        return host, host, None
    deep = 3 if len(labels) > 2 and labels[-2] in SHARED_LABELS and len(labels[-1]) == 2 else 2
    return host, ".".join(labels[-deep:]), labels[-1]


@dataclass(frozen=True)
class Model:
    languages: list[str]
    #: Log-likelihood of a bucket per language, languages x buckets.
    likelihood: np.ndarray
    prior: list[float]


def fit(docs: DataFrame) -> Model:
    """The text model of all documents whose lang is given; null texts add nothing."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        number: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if lang not in found and len(found) > LANGUAGES:
                    raise ValueError(f"more than {LANGUAGES} languages")
                found[lang] = found.get(lang, 0) + trigrams(text.as_py())
                number[lang] = number.get(lang, 0) + 1
        for lang, counts in found.items():
            some = np.flatnonzero(counts)
            # Bucket -1 counts the documents.
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * (len(some) + 1), pa.string()),
                    pa.array([*some.tolist(), -1], pa.int32()),
                    pa.array([*counts[some].tolist(), number[lang]], pa.int64()),
                ],
                ["lang", "bucket", "n"],
            )

    texts = docs.where("lang IS NOT NULL").select(
        F.col("lang").cast("string").alias("lang"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("t")
    )
    counts = texts.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    rows = counts.collect()  # languages x buckets at most
    languages = sorted({r["lang"] for r in rows})
    if len(languages) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    table = np.zeros((len(languages), BUCKETS))
    docs_of = np.zeros(len(languages))
    at = {x: i for i, x in enumerate(languages)}
    for r in rows:
        if r["bucket"] < 0:
            docs_of[at[r["lang"]]] = r["n"]
        else:
            table[at[r["lang"]], r["bucket"]] = r["n"]
    smooth = (table + 0.5) / (table.sum(1, keepdims=True) + 0.5 * BUCKETS)
    return Model(languages, np.log(smooth), ((docs_of + 1) / (docs_of.sum() + len(languages))).tolist() if languages else [])


def evidence(pages: DataFrame, model: Model) -> DataFrame:
    """page_id, host, domain, suffix, declared, and the text's tempered log-likelihood t0, t1, ... ."""
    shared = pages.sparkSession.sparkContext.broadcast(model)
    n = len(model.languages)

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        likelihood = shared.value.likelihood
        for batch in batches:
            marks, scores = [], []
            for url, page in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                source = page.as_py() or ""
                declared = DECLARED.search(source)
                marks.append((*address(url), declared[1].lower() if declared else None))
                scores.append(TEMPER * (likelihood @ trigrams(visible(source).encode("utf-8", "replace"))))
            columns = [pa.array([m[k] for m in marks], pa.string()) for k in range(4)]
            by_language = np.array(scores).reshape(-1, n).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *columns, *(pa.array(x) for x in by_language)],
                ["page_id", "host", "domain", "suffix", "declared", *(f"t{i}" for i in range(n))],
            )

    schema = "page_id long, host string, domain string, suffix string, declared string"
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("u"), F.col("html").cast("string").alias("h")
    ).mapInArrow(each, schema + "".join(f", t{i} double" for i in range(n)))


def _total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def _posterior(logs: list[Column], prefix: str) -> list[Column]:
    """Log scores as probabilities, numerically safe."""
    top = F.greatest(*logs) if len(logs) > 1 else logs[0]
    parts = [F.exp(x - top) for x in logs]
    return [(p / _total(parts)).alias(f"{prefix}{i}") for i, p in enumerate(parts)]


def identify(pages: DataFrame, model: Model) -> DataFrame:
    """page_id, lang, probability, declared and host for every row of pages, whatever other columns it has.

    A page without text, declaration or address has the evidence it has; without any, the language most
    common among documents. Ties go to the first language by code. Repeated rows each get a row and each
    count for their host. A model without languages gives null. An empty table gives an empty result.
    """
    n = len(model.languages)
    if not n:
        return pages.select(
            F.col("page_id").cast("long").alias("page_id"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("double").alias("probability"),
            F.lit(None).cast("string").alias("declared"), F.lit(None).cast("string").alias("host"),
        )
    each = range(n)
    facts = ["page_id", "host", "domain", "suffix", "declared"]
    seen = keep(evidence(pages, model))
    # What the text alone points to weighs each page's vote for its declaration and suffix.
    by_text = seen.select("*", *_posterior([F.col(f"t{i}") + float(np.log(model.prior[i])) for i in each], "q"))

    def sums(table: DataFrame, key: str, prefix: str) -> DataFrame:
        return table.where(F.col(key).isNotNull()).groupBy(key).agg(*(F.sum(f"q{i}").alias(f"{prefix}{i}") for i in each))

    declared, suffix = sums(by_text, "declared", "d"), sums(by_text, "suffix", "s")
    # One row: how much each language declares or shows a suffix at all, and how common it is.
    totals = by_text.agg(
        *(F.coalesce(F.sum(F.when(F.col("declared").isNotNull(), F.col(f"q{i}"))), F.lit(0.0)).alias(f"D{i}_") for i in each),
        *(F.coalesce(F.sum(F.when(F.col("suffix").isNotNull(), F.col(f"q{i}"))), F.lit(0.0)).alias(f"S{i}_") for i in each),
        *(F.coalesce(F.sum(f"q{i}"), F.lit(0.0)).alias(f"A{i}_") for i in each),
    ).first()
    pages_seen = sum(totals[f"A{i}_"] for i in each)

    def likelihood(prefix: str, upper: str) -> list[Column]:
        """Log-likelihood of a value under each language, smoothed by the value's share of all; 0 without a value."""
        whole = sum(totals[f"{upper}{i}_"] for i in each) or 1.0
        share = _total([F.col(f"{prefix}{i}") for i in each]) / whole
        return [
            F.coalesce(F.log((F.col(f"{prefix}{i}") + PSEUDO * share) / (totals[f"{upper}{i}_"] + PSEUDO)), F.lit(0.0)) for i in each
        ]

    joined = seen.join(declared, "declared", "left").join(suffix, "suffix", "left")
    logs = [F.col(f"t{i}") + a + b for i, a, b in zip(each, likelihood("d", "D"), likelihood("s", "S"), strict=True)]
    fused = keep(joined.select(*facts, *(x.alias(f"e{i}") for i, x in enumerate(logs))))
    prior = [(totals[f"A{i}_"] + STRENGTH * model.prior[i]) / (pages_seen + STRENGTH) for i in each]
    own = fused.select("*", *_posterior([F.col(f"e{i}") + float(np.log(prior[i])) for i in each], "q"))
    # Host and domain: sums over the other pages, each smoothed by the level above.
    hosts, domains = sums(own, "host", "h"), sums(own, "domain", "m")
    smoothed = own.join(domains, "domain", "left").join(hosts, "host", "left")

    def level(prefix: str, above: list[Column | float]) -> list[Column]:
        others = [F.greatest(F.coalesce(F.col(f"{prefix}{i}") - F.col(f"q{i}"), F.lit(0.0)), F.lit(0.0)) for i in each]
        return [(o + STRENGTH * a) / (_total(others) + STRENGTH) for o, a in zip(others, above, strict=True)]

    of_domain = smoothed.select("*", *(x.alias(f"x{i}") for i, x in enumerate(level("m", prior))))
    of_host = of_domain.select("*", *(x.alias(f"y{i}") for i, x in enumerate(level("h", [F.col(f"x{i}") for i in each]))))
    final = of_host.select(*facts, *_posterior([F.col(f"e{i}") + F.log(f"y{i}") for i in each], "p"))
    best = F.greatest(*(F.col(f"p{i}") for i in each)) if n > 1 else F.col("p0")
    lang = F.coalesce(*(F.when(F.col(f"p{i}") == best, F.lit(x)) for i, x in enumerate(model.languages)))
    return final.select("page_id", lang.alias("lang"), best.alias("probability"), "declared", "host")
