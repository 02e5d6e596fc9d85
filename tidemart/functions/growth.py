"""Column builders for month series: growth, differences, trailing statistics, shares."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec


def series(*keys: str, order: str = "month") -> WindowSpec:
    """One window for all metrics of a series, so they share one exchange and one sort."""
    return W.partitionBy(*keys).orderBy(order)


def pct_change(value: str, rows: int, window: WindowSpec) -> Column:
    """Percent change against ``rows`` rows earlier; null where that was zero or absent."""
    before = F.lag(value, rows).over(window)
    return F.lit(100.0) * (F.col(value) - before) / F.nullif(before, F.lit(0))


def difference(value: str, window: WindowSpec) -> Column:
    return F.col(value) - F.lag(value, 1).over(window)


def trailing(aggregate: Column, rows: int, window: WindowSpec) -> Column:
    """``aggregate`` over the current row and the ``rows - 1`` rows before it."""
    return aggregate.over(window.rowsBetween(1 - rows, 0))


def running_count(window: WindowSpec) -> Column:
    return F.count(F.lit(1)).over(window.rowsBetween(W.unboundedPreceding, 0))


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as double; null where ``whole`` is zero."""
    return part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
