"""Fill-in-middle examples, cut at unit boundaries through a learned rank index.

A unit is a word with the white space before it; the boundaries of a text are the code points after 0, 1, ... n
units. The index of a text is a few straight lines over boundary ranks, fitted so that none is off by more than an
error bound, and for every boundary the small number by which its line misses it. A cut after r units is
what the line of r predicts plus the number stored for r, which is exact: 1 byte for each boundary and some 20
for each line, in place of 8 for each boundary.

Lines grow as long as some slope keeps all their boundaries within the bound (a shrinking cone), so their number follows how
irregular a text is and not how long.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most code points by which a line may miss a boundary; with rounding the rest fits one byte.
ERROR = 120
#: Boundaries looked at in the first step of a line; every further step doubles.
REACH = 512
SEED = 42
#: Share of texts, in hundredths, that stay plain, and of the others that lead with the suffix.
PLAIN, SUFFIX_FIRST = 50, 80
MARKS = PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


class RankIndex(NamedTuple):
    """Lines (first rank, boundary there, slope) and what is left of every boundary."""

    first: np.ndarray
    origin: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    @property
    def units(self) -> int:
        return len(self.residual) - 1

    def predict(self, ranks: np.ndarray) -> np.ndarray:
        line = np.searchsorted(self.first, ranks, "right") - 1
        return self.origin[line] + np.floor(self.slope[line] * (ranks - self.first[line])).astype(np.int64)

    def offsets(self, ranks) -> np.ndarray:
        """Boundaries of the ranks: predicted, then corrected."""
        ranks = np.asarray(ranks, np.int64)
        return self.predict(ranks) + self.residual[ranks]


def boundaries(text: str) -> np.ndarray:
    """Code points before each unit boundary of a whole text, from 0: the ends of its words, and of the text
    where it ends in white space."""
    letters = np.frombuffer(text.encode(), np.uint8) if text.isascii() else np.frombuffer(text.encode("utf-32-le"), np.uint32)
    inside = (letters != 32) & ((letters < 9) | (letters > 13))
    ends = np.flatnonzero(inside & ~np.append(inside[1:], False)) + 1
    tail = [len(letters)] if len(letters) and not inside[-1] else []
    return np.concatenate([[0], ends, tail]).astype(np.int64)


def fit(offsets: np.ndarray, error: int = ERROR) -> RankIndex:
    """Lines over all boundaries (rising, from rank 0), each within `error` of its boundaries."""
    first, slopes = [], []
    at, n = 0, len(offsets)
    while at < n:
        first.append(at)
        low, high = -np.inf, np.inf
        end, reach = at + 1, REACH
        while end < n:
            run = np.arange(1, min(n, end + reach) - end + 1) + (end - 1 - at)
            rise = offsets[end : end + reach] - offsets[at]
            lows = np.maximum(low, np.maximum.accumulate((rise - error) / run))
            highs = np.minimum(high, np.minimum.accumulate((rise + error) / run))
            closed = np.flatnonzero(lows > highs)
            good = closed[0] if len(closed) else len(run)
            if good:
                low, high = lows[good - 1], highs[good - 1]
            end += good
            if len(closed):
                break
            reach *= 2
        slopes.append((low + high) / 2 if end > at + 1 else 0.0)
        at = end
    lines = np.array(first, np.int64)
    bare = RankIndex(lines, offsets[lines], np.array(slopes), np.zeros(n, np.int8))
    left = offsets - bare.predict(np.arange(n))
    return bare._replace(residual=left.astype(np.int8 if not n or np.abs(left).max() < 128 else np.int32))


def rank_index(docs: DataFrame, error: int = ERROR) -> DataFrame:
    """doc_id, units, lines (first, origin, slope) and residuals (one signed byte per boundary, or four where the
    bound asks for more) of every whole text: an index to store and cut by later, without the text."""

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fit(boundaries(t.as_py() or ""), error) for t in batch.column(1)]
            lines = [[{"first": a, "origin": b, "slope": c} for a, b, c in zip(*(x.tolist() for x in m[:3]))] for m in made]
            kind = pa.list_(pa.struct([("first", pa.int64()), ("origin", pa.int64()), ("slope", pa.float64())]))
            residuals = pa.array([m.residual.tobytes() for m in made], pa.binary())
            units = pa.array([m.units for m in made], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), units, pa.array(lines, kind), residuals], ["doc_id", "units", "lines", "residuals"])

    schema = "doc_id long, units long, lines array<struct<first: long, origin: long, slope: double>>, residuals binary"
    return _texts(docs).mapInArrow(each, schema)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four whole numbers below 2^32 that depend on the seed and the id alone; a null id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def cut(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """doc_id, text, h3, h4, units, and the code points before the first and the second cut of every text."""
    h = draws(F.col("doc_id"), seed)
    drawn = _texts(docs).select("doc_id", "text", *(x.alias(f"h{k}") for k, x in enumerate(h, 1)))

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.empty((batch.num_rows, 3), np.int64)
            for k, (text, h1, h2) in enumerate(zip(batch.column(1), batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                index = fit(boundaries(text.as_py()))
                n = index.units
                ranks = sorted((h1 % (n + 1), h2 % (n + 1)))
                found[k] = n, *index.offsets(ranks)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(4), batch.column(5), *map(pa.array, np.ascontiguousarray(found.T))],
                ["doc_id", "text", "h3", "h4", "units", "first", "second"],
            )

    return drawn.mapInArrow(each, "doc_id long, text string, h3 long, h4 long, units long, first long, second long")


def transform(docs: DataFrame, seed: int = SEED, plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """doc_id, n, form, prefix, middle, suffix, output of every row of docs.

    Whole texts; a null text is empty. form is plain (the text itself; prefix, middle and suffix null) where the text is empty, holds
    one of the three marks or is drawn so, else psm or spm. Cuts may fall together or at either end, so parts may be
    empty. Equal ids draw alike, a null id draws as an empty one and stays null, repeated rows give repeated
    results, other columns are ignored, an empty table gives an empty result.
    """
    text = F.col("text")
    marked = F.lit(False)
    for mark in MARKS:
        marked |= text.contains(mark)
    stays = (text == "") | marked | (F.col("h3") % 100 >= plain)
    form = F.when(stays, "plain").when(F.col("h4") % 100 < suffix_first, "spm").otherwise("psm")
    one = F.col("first").cast("int")
    two = F.col("second").cast("int")
    parts = cut(docs, seed).withColumn("form", form).select(
        "doc_id",
        F.col("units").alias("n"),
        "form",
        *(
            F.when(F.col("form") != "plain", part).alias(name)
            for name, part in (
                ("prefix", F.substring(text, F.lit(1), one)),
                ("middle", F.substring(text, one + 1, two - one)),
                ("suffix", F.substring(text, two + 1, F.length(text))),
            )
        ),
        "text",
    )
    psm = F.concat(F.lit(PREFIX), "prefix", F.lit(SUFFIX), "suffix", F.lit(MIDDLE), "middle")
    spm = F.concat(F.lit(SUFFIX), "suffix", F.lit(PREFIX), "prefix", F.lit(MIDDLE), "middle")
    output = F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm).otherwise(text)
    return parts.withColumn("output", output).drop("text")


def restored(output: Column, form: Column) -> Column:
    """The text that an output of the given form was made of."""
    part = F.split(output, "|".join(MARKS), -1)
    psm = F.concat(F.get(part, 1), F.get(part, 3), F.get(part, 2))
    spm = F.concat(F.get(part, 2), F.get(part, 3), F.get(part, 1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def report(docs: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, n, form, prefix_chars, middle_chars, and SHA-256 of the output and of the text rebuilt from it."""
    return transform(docs).select(
        "doc_id",
        "n",
        "form",
        F.length("prefix").cast("long").alias("prefix_chars"),
        F.length("middle").cast("long").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


REPORT_SQL = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d FROM documents
), numbers AS (
  SELECT doc_id, text, regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
         CAST('0x' || substr(d, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(d, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(d, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(d, 25, 8) AS BIGINT) AS h4 FROM drawn
), ranks AS (
  SELECT *, CAST(len(u) AS BIGINT) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM numbers
), parts AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:], '') AS suffix FROM ranks
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN text ELSE prefix || middle || suffix END) AS restored_sha256
FROM parts
"""
