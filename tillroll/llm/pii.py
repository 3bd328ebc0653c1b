"""Personal data: patterns propose spans, checksums confirm them, context adjusts the score.

Kinds and order: email, ip, card, phone (the base kinds), then iban and
national_id, which the method adds.

1. *Propose*: one regular expression per kind, leftmost and non-overlapping.
   Every expression is linear in the text: runs are only entered at their
   start, and e-mail addresses are found from their ``@``.
2. *Confirm*: parts up to 255 (ip), 13 to 19 digits and Luhn (card), 9 to 15
   digits (phone), mod-97 (iban), area and group rules (national_id).  A failing match is
   dropped, without a retry inside it.
3. *Score*: each kind has a prior; context words within ``CONTEXT`` characters
   before or after the span raise it (they name the kind) or lower it (they
   name something else, as "version" before an ip).  The base kinds are reported at any
   score, so the score of these spans only ranks; an added kind is reported
   only at ``THRESHOLD`` or above.

Defined results: a null or empty text has no spans; repeated rows are judged
alone; offsets are code points, end exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import byte_slices, texts

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "national_id")
CONTEXT = 48
THRESHOLD = 0.6
TEXT = "_pii_text"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9]+(?:[ -][0-9]+)*")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

#: kind -> prior score
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.8, "national_id": 0.4}
#: kind -> words that raise its score / lower it when they stand near a span (lower case)
RAISES = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "credit", "debit", "payment", "karte", "tarjeta", "carte"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "telefon"),
    "iban": ("iban", "account", "bank", "konto", "cuenta", "compte"),
    "national_id": ("ssn", "social", "security", "identity"),
}
LOWERS = {
    "email": ("example",),
    "ip": ("version", "release", "build", "section"),
    "card": ("order", "isbn", "tracking", "serial"),
    "phone": ("isbn", "order", "serial"),
    "iban": ("model", "part"),
    "national_id": ("part", "model", "serial"),
}
_STEP = 0.25


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 13616: the first four characters go to the end, letters count from 10, remainder 1."""
    rest = 0
    for c in iban[4:] + iban[:4]:
        v = ord(c) - 48 if c.isdigit() else ord(c) - 55
        rest = (rest * (100 if v > 9 else 10) + v) % 97
    return rest == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for m in _AT.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            done = m.end()
            yield start, done


def _digits(s: str) -> str:
    return s.translate(_KEEP_DIGITS)


_KEEP_DIGITS = {ord(c): None for c in " ().-+"}


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """The longest prefix of a proposed run that passes mod-97 and ends at a word's end."""
    for m in _IBAN.finditer(text):
        run = m[0]
        ends = [k for k in range(15, len(run) + 1) if k == len(run) or run[k] == " "]
        for k in reversed(ends):
            if 15 <= len(bare := run[:k].replace(" ", "")) <= 34 and mod97(bare):
                yield m.start(), m.start() + k
                break


def _proposed(text: str) -> Iterator[tuple[str, int, int]]:
    """Confirmed spans of all kinds, by kind, then start."""
    if "@" in text:
        for a, b in _emails(text):
            yield "email", a, b
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            yield "ip", *m.span()
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            yield "card", *m.span()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                yield "phone", *m.span()
    for a, b in _ibans(text):
        yield "iban", a, b
    for m in _NATIONAL.finditer(text):
        area, group, serial = m[0].split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            yield "national_id", *m.span()


def _score(text: str, kind: str, start: int, end: int) -> float:
    near = f"{text[max(0, start - CONTEXT):start]} {text[end:end + CONTEXT]}".lower()
    words = set(re.findall(r"[a-z]+", near))
    score = PRIOR[kind] + _STEP * bool(words & set(RAISES[kind])) - _STEP * bool(words & set(LOWERS[kind]))
    return min(1.0, max(0.0, round(score, 2)))


def find_spans(text: str | None) -> list[Span]:
    """All reported spans of a text, by kind as in ``KINDS``, then start."""
    found = [Span(k, a, b, _score(text, k, a, b)) for k, a, b in _proposed(text or "")]
    return [s for s in found if s.kind in BASE_KINDS or s.score >= THRESHOLD]


def redact(text: str | None, spans: list[Span]) -> str | None:
    """The text with each span replaced by ``<kind>``; of overlapping spans the earlier, then longer one counts."""
    if not spans:
        return text
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s.start, -s.end)):
        if s.start >= at:
            out += [text[at:s.start], f"<{s.kind}>"]
        at = max(at, s.end)
    return "".join([*out, text[at:]])


_SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                      T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())])
_ARROW_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                  ("score", pa.float64())]))


def _detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Appends ``spans`` and ``redacted`` (null where nothing was found) to the rows without their ``TEXT``."""
    for batch in byte_slices(batches, TEXT):
        found, redacted = [], []
        for text in batch.column(batch.schema.get_field_index(TEXT)).to_pylist():
            spans = find_spans(text)
            found.append([s._asdict() for s in spans])
            redacted.append(redact(text, spans) if spans else None)
        kept = [k for k, name in enumerate(batch.schema.names) if name != TEXT]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(k) for k in kept), pa.array(found, _ARROW_SPAN), pa.array(redacted, pa.string())],
            names=[*(batch.schema.names[k] for k in kept), "spans", "redacted"])


def _detected(rows: DataFrame) -> DataFrame:
    fields = [f for f in rows.schema.fields if f.name != TEXT]
    fields += [T.StructField("spans", T.ArrayType(_SPAN)), T.StructField("redacted", T.StringType())]
    return rows.mapInArrow(_detect, T.StructType(fields))


def detect(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans`` (kind, start, end, score) of each row."""
    return _detected(texts(docs).withColumnRenamed("text", TEXT)).select("doc_id", "spans")


def redact_docs(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns, all rows) with every reported span of ``text`` replaced by ``<kind>``;
    ``n_chars``, where there is such a column, becomes the new length of a changed text."""
    @F.arrow_udf("string")
    def redacted_text(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for text in parts:  # null where nothing was found: only changed texts come back
            made = [x for x in _detect(iter([pa.RecordBatch.from_arrays([text], names=[TEXT])]))]
            yield pa.concat_arrays([x.column(1) for x in made]) if made else pa.array([], pa.string())

    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    found = docs.select(row, redacted_text(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("redacted"))
    changed = {"text": F.coalesce("redacted", "_row.text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(F.col("redacted").isNotNull(), F.length("redacted")).otherwise(
            F.col("_row.n_chars")).cast(kind)
    return found.select(*(changed.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns))


def _joined(kinds: tuple[str, ...] | None = None) -> Column:
    spans = F.col("spans") if kinds is None else F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(docs: DataFrame) -> DataFrame:
    """The digest of the query."""
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return detect(docs).select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(_joined(BASE_KINDS), 256).alias("base_sha256"), _joined().alias("spans"),
        F.array_max(F.transform("spans", lambda s: s["score"])).alias("max_score"))
