"""Small helpers for composing Column expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times in ``body``.

    Spark does not share common sub-expressions inside lambdas, so a costly
    array that a lambda reads again and again is bound to a variable first.
    """
    return F.transform(F.array(value), body)[0]


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def slices(sizes: np.ndarray, rows: int, total: int) -> Iterator[tuple[int, int]]:
    """Starts and ends of runs of at most ``rows`` items that sum up to at most ``total``, or are one item."""
    sums, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = sums[start - 1] if start else 0
        end = max(start + 1, min(start + rows, int(np.searchsorted(sums, before + total, side="right"))))
        yield start, end
        start = end
