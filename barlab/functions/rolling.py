"""Full-window rolling aggregates: null until all ``n`` values are present.

``dense_from`` is the first bar from which a column is known to have no nulls; the
window is then full from a fixed bar on and needs no count of its values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from barlab.operators.panel import trailing


def full_window(agg: Callable[[Column], Column], column: str, n: int, dense_from: int | None = None) -> Column:
    frame = trailing(n)
    full = F.count(column).over(frame) == n if dense_from is None else F.col("bar_no") >= dense_from + n - 1
    return F.when(full, agg(F.col(column)).over(frame))


def rolling_sum(column: str, n: int, dense_from: int | None = None) -> Column:
    return full_window(F.sum, column, n, dense_from)


def rolling_mean(column: str, n: int, dense_from: int | None = None) -> Column:
    return rolling_sum(column, n, dense_from) / n


def rolling_std(column: str, n: int, dense_from: int | None = None) -> Column:
    return full_window(F.stddev_samp, column, n, dense_from)
