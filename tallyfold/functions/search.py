"""Lookups in small sorted arrays, as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rank_in(bounds: Column, value: Column, size: int) -> Column:
    """How many of the ascending ``bounds`` (an array of at most ``size``, without NULLs) are at or below ``value``:
    a binary search in log2(size) steps."""
    steps = [1 << b for b in reversed(range(max(1, size).bit_length()))]
    at = lambda acc, s: F.get(bounds, acc + s - 1)
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda acc, s: acc + F.when(at(acc, s) <= value, s).otherwise(0))
