"""ISO-date checks for columns and for query parameters."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column

ISO_DATE = "[0-9]{4}-[0-9]{2}-[0-9]{2}"  # fixed format YYYY-MM-DD


def is_iso_date(text: Column) -> Column:
    """Shape test only: 2024-02-30 passes. The anchors reject a trailing newline."""
    return text.rlike(rf"\A{ISO_DATE}\z")


def iso_text(day: Column) -> Column:
    return day.cast("string")


def date_range(start: str, end: str) -> tuple[date, date]:
    """Both bounds as dates, or ValueError; starts no Spark job."""
    if not all(re.fullmatch(ISO_DATE, text) for text in (start, end)):
        raise ValueError(f"dates must look like YYYY-MM-DD, got {start!r} and {end!r}")
    if start > end:
        raise ValueError(f"{start} lies after {end}")
    return date.fromisoformat(start), date.fromisoformat(end)
