"""Secret scans that link the parts of a credential.

Base kinds, leftmost and not overlapping within a kind: ``assign``, a telling name
with a value of six or more characters; ``access``, an access key id of 20 or more
characters; ``hex``, 24 or more hexadecimal digits. A match that fails is dropped
and not tried again.

Parts that are weak on their own are linked: ``id`` (an access identifier in an
assignment, or in capitals and digits), ``value`` (a long token of mixed
characters) and ``endpoint`` (a URL or host). A scope is a run of lines without an
empty one. Within a scope the parts are joined by interval: two parts meet if at
most ``REACH`` characters lie between them. An ``id`` or ``value`` is reported only
if it meets its complement (a value for an id, an id for a value; a base span
counts as a value, an ``access`` one as an id too), and an ``endpoint`` only if it meets both.
The join is a sweep over the sorted parts, linear in their number.

Null and empty texts have no spans. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE = ("assign", "access", "hex")
ADDED = ("id", "value", "endpoint")
REACH = 200

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.I | re.A,
)
NAMES = (b"passw", b"secret", b"token", b"api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
IDENTIFIER = re.compile(
    r"(?<![A-Za-z0-9_])(?:client|access|account|user|key)_?(?:id|name)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9._@-]{4,})"
    r"|(?<![A-Za-z0-9])[A-Z0-9]{16,}(?![A-Za-z0-9])",
    re.I | re.A,
)
CAPITALS = re.compile(r"(?=[A-Z0-9]*[0-9])[A-Z][A-Z0-9]{15,}")
VALUE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(r"https?://[A-Za-z0-9.-]+(?::[0-9]+)?[A-Za-z0-9/._~-]*", re.A)
BREAK = re.compile(r"\n[\x20\t\r]*\n")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    low = text.encode().lower()
    spans = []
    if any(name in low for name in NAMES):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], BASE.index(s[0])))


def _mixed(token: str) -> bool:
    """Letters of both cases and digits, as generated secrets have."""
    return (
        any(c.isdigit() for c in token)
        and any(c.islower() for c in token)
        and any(c.isupper() for c in token)
    )


def identifiers(text: str) -> list[tuple[str, int, int]]:
    parts = []
    for m in IDENTIFIER.finditer(text):
        if m[1]:
            parts.append(("id", *m.span(1)))
        elif CAPITALS.fullmatch(m[0]):
            parts.append(("id", *m.span()))
    return parts


def _meets(part: tuple[str, int, int], others: list[tuple[int, int]], scopes: list[int]) -> bool:
    """Whether one of ``others`` (sorted, apart) is near ``part`` in its scope.

    Of those that do not overlap it, the nearest on either side decide.
    """
    _, start, end = part
    scope = bisect_left(scopes, start)
    low = max(start - REACH, scopes[scope - 1] if scope else 0)
    high = min(end + REACH, scopes[scope]) if scope < len(scopes) else end + REACH
    before = bisect_right(others, start, key=lambda s: s[1]) - 1
    after = bisect_left(others, end, key=lambda s: s[0])
    return (before >= 0 and others[before][1] > low) or (
        after < len(others) and others[after][0] < high
    )


def linked(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The weak parts whose complements co-occur with them in their scope.

    Every link has an identifier, so a text without one is done at once.
    """
    parts = identifiers(text)
    keys = [(a, b) for k, a, b in base if k == "access"]
    if not parts and not keys:
        return []
    parts += [("value", *m.span()) for m in VALUE.finditer(text) if _mixed(m[0])]
    parts += [("endpoint", *m.span()) for m in ENDPOINT.finditer(text)]
    scopes = [m.start() for m in BREAK.finditer(text)]
    strong = _apart([(a, b) for _, a, b in base])
    weak = {kind: [(a, b) for k, a, b in parts if k == kind] for kind in ADDED}
    ids = _apart(weak["id"] + keys)
    values = _apart(weak["value"] + strong)
    found = []
    for part in parts:
        inside = bisect_left(strong, part[2], key=lambda s: s[0]) - 1
        if inside >= 0 and strong[inside][1] > part[1]:
            continue  # part of a base span
        with_id = part[0] != "id" and _meets(part, ids, scopes)
        with_value = part[0] != "value" and _meets(part, values, scopes)
        if {"id": with_value, "value": with_id, "endpoint": with_id and with_value}[part[0]]:
            found.append(part)
    return found


def _apart(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted; of overlapping ones the first."""
    out: list[tuple[int, int]] = []
    for span in sorted(spans):
        if not out or span[0] >= out[-1][1]:
            out.append(span)
    return out


def find(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then by kind as listed."""
    base = base_spans(text)
    kinds = BASE + ADDED
    return sorted(base + linked(text, base), key=lambda s: (s[1], kinds.index(s[0]), s[2]))


SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_ARROW = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
)


def _find_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("kind", "start", "end")
    for batch in batches:
        found = (find(t.as_py() or "") for t in batch["text"])
        spans = pa.array([[dict(zip(names, s, strict=True)) for s in one] for one in found], _ARROW)
        yield pa.RecordBatch.from_arrays([batch["doc_id"], spans], names=["doc_id", "spans"])


def secrets(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, spans (kind, start, end)."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(_find_all, f"doc_id bigint, spans {SPANS}")
