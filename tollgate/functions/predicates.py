"""Range and domain predicates."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def in_range(col: str | Column, lo=None, hi=None) -> Column:
    """True for values in [lo, hi]; an open side is None. NaN is in no range."""
    c = F.col(col) if isinstance(col, str) else col
    if lo is None and hi is None:
        raise ValueError("a range needs at least one bound")
    if lo is not None and hi is not None:
        inside = c.between(lo, hi)
    else:
        inside = (c >= lo) if lo is not None else (c <= hi)
    if isinstance(hi if lo is None else lo, (int, float)):
        inside = inside & ~F.isnan(c)
    return inside


def in_domain(col: str | Column, values: Iterable) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.isin(list(values))
