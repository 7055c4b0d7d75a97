"""Personal data: expressions propose spans, checksums confirm, context adjusts.

Base kinds, leftmost and not overlapping within a kind: ``email``; ``ip`` with
parts of at most 255; ``card``, 16 to 19 digits that pass Luhn; ``phone``, a plus
and 8 to 15 digits. A match that fails is dropped and not tried again.

Added kinds: ``iban`` (mod 97), and what needs a score: ``account``, 13 to 15
digits that pass Luhn, and ``local``, a telephone number without a country code.
These begin at a low score; a word of their context among the ``NEAR`` characters
before or after raises it, and a word that speaks against it lowers it. Those that
reach ``LEAST`` are reported. Base spans are certain and stay.

Null and empty texts have no spans. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "account", "local")
NEAR, LEAST = 40, 0.5

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL_PART = re.compile(r"[A-Za-z0-9._%+-]")
# No match can begin inside a run of digits whose start gave none.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
LOCAL = re.compile(r"(?<![0-9+(])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
DIGIT = re.compile(r"[0-9]")

# Words that speak for a kind, and words that speak against one.
CONTEXT = {
    "account": re.compile(r"\b(?:card|credit|debit|visa|amex|account|konto|carte|tarjeta)\b", re.I),
    "local": re.compile(r"\b(?:phone|tel|telephone|call|mobile|cell|fax|telefon|t[eé]l[eé]fono)\b", re.I),
}
AGAINST = re.compile(r"\b(?:order|invoice|version|serial|isbn|sku|ticket|part)\b", re.I)


def luhn(digits: str) -> bool:
    values = [ord(d) - 48 for d in reversed(digits)]
    doubled = (2 * v - 9 if v > 4 else 2 * v for v in values[1::2])
    return (sum(values[::2]) + sum(doubled)) % 10 == 0


def mod97(iban: str) -> bool:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """As finditer of EMAIL, but it looks only around each @."""
    spans, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and LOCAL_PART.match(text[start - 1]):
            start -= 1
        found = EMAIL.match(text, start) if start < at else None
        if found:
            spans.append(found.span())
            free = found.end()
        else:
            free = at + 1
        at = text.find("@", free)
    return spans


def _score(kind: str, text: str, start: int, end: int) -> float:
    around = text[max(0, start - NEAR) : start] + " " + text[end : end + NEAR]
    return 0.3 + 0.4 * bool(CONTEXT[kind].search(around)) - 0.4 * bool(AGAINST.search(around))


def find(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, score) in the order of the kinds, then of the starts."""
    spans = [("email", a, b, 1.0) for a, b in emails(text)] if "@" in text else []
    if not DIGIT.search(text):
        return spans
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            spans.append(("ip", *m.span(), 1.0))
    numbers = [(*m.span(), _digits(m[0])) for m in CARD.finditer(text)]
    spans += [("card", a, b, 1.0) for a, b, d in numbers if 16 <= len(d) <= 19 and luhn(d)]
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                spans.append(("phone", *m.span(), 1.0))
    taken = [(a, b) for _, a, b, _ in spans]
    added = []
    for m in IBAN.finditer(text):
        if mod97(m[0].replace(" ", "")):
            added.append(("iban", *m.span(), 1.0))
    for a, b, d in numbers:
        if 13 <= len(d) <= 15 and luhn(d):
            added.append(("account", a, b, _score("account", text, a, b)))
    for m in LOCAL.finditer(text):
        added.append(("local", *m.span(), _score("local", text, *m.span())))
    spans += [
        s for s in added if s[3] >= LEAST and not any(a < s[2] and s[1] < b for a, b in taken)
    ]
    return spans


SPANS = "array<struct<kind:string,start:bigint,end:bigint,score:double>>"
_ARROW = pa.list_(
    pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]
    )
)


def _find_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("kind", "start", "end", "score")
    for batch in batches:
        found = (find(t.as_py() or "") for t in batch["text"])
        spans = pa.array([[dict(zip(names, s, strict=True)) for s in one] for one in found], _ARROW)
        yield pa.RecordBatch.from_arrays([batch["doc_id"], spans], names=["doc_id", "spans"])


def personal_data(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, spans (kind, start, end, score)."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(_find_all, f"doc_id bigint, spans {SPANS}")


def told(spans):
    """The spans as kind:start:end, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def base_only(spans, kinds: tuple[str, ...]):
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def count_of(spans, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
