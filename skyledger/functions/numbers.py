"""Rounding of aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_total(total: Column, places: int = 2) -> Column:
    """Half-up rounding that does not depend on the order of summation.

    A sum or average of doubles differs in its last bits from one shuffle to the
    next; at a tie (14.925 or 14.924999999999997) that would flip the result.
    Rounding those bits off first gives the same rows on every run.
    """
    return F.round(F.round(total, 10), places)
