"""Personal data by anchor expansion: an Aho-Corasick automaton finds the places that could matter, local
parsers expand each place to its boundaries and validate what they find.

Kinds, in the order that breaks ties:

* email, ip, card, phone: the base kinds. Their parsers give just what these patterns give leftmost and
  without overlap, a match that fails its test being dropped with nothing tried in its place:
  email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+, ip [0-9]+(\\.[0-9]+){3} with parts up to 255,
  card [0-9]([\\x20-]?[0-9])+ of 12 to 19 digits that pass Luhn's test,
  phone \\+[0-9][\\x20().0-9-]+[0-9] of 9 to 15 digits.
* url: a scheme, "://", and what follows up to white space, quotes or brackets, without closing punctuation,
  if it names a user: a part before "@" ahead of the host.
* account: an IBAN with right check digits after the cue "IBAN", or 6 to 18 digits after a cue such as
  "account no.".
* secret: 20 or more letters and digits of a kind, both occurring, after a cue such as "token =".

Every parser reads a text once: each is linear in the run of characters around its anchor.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "account", "secret")
SPAN = tuple[int, int]

SCHEMES = ("http://", "https://", "ftp://")
IBAN_CUES = ("iban",)
ACCOUNT_CUES = ("account no", "account number", "acct no", "kontonummer", "numéro de compte", "número de cuenta")
SECRET_CUES = ("token", "api_key", "api key", "apikey", "secret", "password")

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
LABEL = re.compile(r"[A-Za-z0-9-]+")
CHAIN = re.compile(r"[0-9](?:[ -]?[0-9])*")
DOTTED = re.compile(r"[0-9.]+")
DIALLED = re.compile(r"[\x20().0-9-]*")
URL_REST = re.compile(r"[^\s\"'<>{}|\\^`\[\]]*")
AFTER_CUE = re.compile(r"[ \t]{0,3}[.:#=]{0,2}[ \t]{0,3}[\"']?")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
NUMBER = re.compile(r"[0-9](?:[ -]?[0-9]){5,17}(?![0-9])")
SECRET = re.compile(r"[A-Za-z0-9_-]{20,}")


@functools.cache
def automaton() -> ahocorasick.Automaton:
    """Anchors over the lower-cased text: signs, schemes, cues, and the digits that cards and addresses have."""
    built = ahocorasick.Automaton()
    for digit in "0123456789":
        built.add_word(digit, ("digit", 1))
    for kind, words in (
        ("at", "@"),
        ("plus", "+"),
        ("scheme", SCHEMES),
        ("iban", IBAN_CUES),
        ("account", ACCOUNT_CUES),
        ("secret", SECRET_CUES),
    ):
        for word in words:
            built.add_word(word, (kind, len(word)))
    built.make_automaton()
    return built


#: ASCII capitals only, so that positions stay those of the text.
LOWER = {c: c + 32 for c in range(65, 91)}


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def email_at(text: str, at: int, floor: int) -> SPAN | None:
    """The address around the sign at `at`, its local part not reaching below floor."""
    start = at
    while start > floor and text[start - 1].isascii() and LOCAL.match(text[start - 1]):
        start -= 1
    label = LABEL.match(text, at + 1)
    if start == at or not label:
        return None
    end, dots = label.end(), 0
    while text.startswith(".", end) and (label := LABEL.match(text, end + 1)):
        end, dots = label.end(), dots + 1
    return (start, end) if dots else None


def addresses_in(text: str, start: int, end: int) -> Iterator[SPAN]:
    """IP addresses in a run of digits and dots: every four parts in a row with single dots between."""
    at, parts = start, []
    for part in [*text[start:end].split("."), ""]:
        if part:
            parts.append((at, at + len(part)))
        if not part:
            parts = []
        elif len(parts) == 4:
            if all(b - a <= 3 or not text[a : b - 3].strip("0") for a, b in parts) and all(
                int(text[max(a, b - 3) : b]) <= 255 for a, b in parts
            ):
                yield parts[0][0], parts[3][1]
            parts = []
        at += len(part) + 1


def phone_at(text: str, plus: int) -> tuple[SPAN | None, int]:
    """The number after a plus, and where the search goes on (a match that fails is still passed over)."""
    first = plus + 1
    if not (text[first : first + 1].isascii() and text[first : first + 1].isdigit()):
        return None, first
    end = DIALLED.match(text, first + 1).end()
    while end > first + 2 and not "0" <= text[end - 1] <= "9":
        end -= 1
    if end <= first + 2:
        return None, first
    digits = sum("0" <= c <= "9" for c in text[first:end])
    return ((plus, end) if 9 <= digits <= 15 else None), end


def iban_ok(text: str) -> bool:
    code = text.replace(" ", "")
    turned = code[4:] + code[:4]
    return 15 <= len(code) <= 34 and int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def iban_at(text: str, at: int) -> SPAN | None:
    if not (m := IBAN.match(text, at)):
        return None
    # The longest part that ends a group and has right check digits.
    ends = [e for e in range(m.end(), at + 14, -1) if e == len(text) or not text[e].isalnum()]
    return next(((at, e) for e in ends if text[e - 1] != " " and iban_ok(text[at:e])), None)


def find(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of every span, by start and then by kind in the order of KINDS."""
    found: dict[str, list[SPAN]] = {k: [] for k in KINDS}
    run_end = chain_end = email_end = phone_end = url_run = url_end = 0
    for last, (kind, length) in automaton().iter(text.translate(LOWER)):
        first = last - length + 1
        if kind == "digit":
            if first >= chain_end:
                chain = CHAIN.match(text, first)
                chain_end = chain.end()
                digits = re.sub("[ -]", "", chain[0])
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found["card"].append(chain.span())
            if first >= run_end:
                # Leading dots open no part; a run is looked at once, from its first digit.
                run_end = DOTTED.match(text, first).end()
                if run_end - first >= 7:
                    found["ip"] += addresses_in(text, first, run_end)
        elif kind == "at":
            if span := email_at(text, first, email_end):
                found["email"].append(span)
                email_end = span[1]
            else:
                email_end = max(email_end, first + 1)
        elif kind == "plus":
            if first >= phone_end:
                span, phone_end = phone_at(text, first)
                if span:
                    found["phone"].append(span)
        elif kind == "scheme":
            if first >= url_run:  # all schemes of a run end with it
                url_run = url_end = URL_REST.match(text, last + 1).end()
                while url_end > last + 1 and text[url_end - 1] in ".,;:!?)":
                    url_end -= 1
            end = max(url_end, last + 1)
            slash = text.find("/", last + 1, end)
            if LABEL.match(text, last + 1, end) and text.find("@", last + 1, end if slash < 0 else slash) >= 0:
                found["url"].append((first, end))
        else:
            if first and (text[first - 1].isalnum() or text[first - 1] == "_"):
                continue
            at = AFTER_CUE.match(text, last + 1).end()
            if at == last + 1:
                continue
            if kind == "iban":
                if span := iban_at(text, at):
                    found["account"].append(span)
            elif kind == "account":
                if m := NUMBER.match(text, at):
                    found["account"].append(m.span())
            elif (m := SECRET.match(text, at)) and any(c.isdigit() for c in m[0]) and any(c.isalpha() for c in m[0]):
                found["secret"].append(m.span())
    order = {k: i for i, k in enumerate(KINDS)}
    spans = {(a, order[k], b) for k, at in found.items() for a, b in at}
    return [(a, KINDS[k], b) for a, k, b in sorted(spans)]


SPANS = "array<struct<start:int,kind:string,end:int>>"


def detect(docs: DataFrame) -> DataFrame:
    """doc_id and spans (start, kind, end; code points, end exclusive) for every row of docs.

    Whole texts; null and empty texts have no spans. Repeated rows each get a row, null doc_ids stay null,
    other columns are left out whatever their names. An empty table gives an empty result.
    """
    kind = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.string()), ("end", pa.int32())]))

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [{"start": a, "kind": k, "end": b} for a, k, b in find(t.as_py() or "")] for t in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("t")).mapInArrow(
        each, f"doc_id long, spans {SPANS}"
    )


def written(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def report(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds, the SHA-256 of the base spans and all spans as text, per row of docs."""
    spans = F.col("spans")

    def number(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == F.lit(kind))).cast("long")

    return detect(docs).select(
        "doc_id",
        *(number(k).alias(f"n_{k}") for k in BASE),
        F.sha2(written(F.filter(spans, lambda s: s["kind"].isin(*BASE))), 256).alias("base_sha256"),
        written(spans).alias("spans"),
    )


def mask(text: str) -> str:
    """The text with every span replaced by its kind in angle brackets; overlapping spans become one, named
    by the first of them."""
    out, at = [], 0
    for start, kind, end in find(text):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join(out) + text[at:] if out else text


def masked(docs: DataFrame, column: str = "text") -> DataFrame:
    """docs, the column with its personal data masked. Null stays null; all rows and other columns stay."""

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index(column)
            texts = [None if t is None else mask(t) for t in map(lambda t: t.as_py(), batch.column(at))]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(each, docs.schema)
