"""The entity by month grid and its densification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_entities(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def distinct_months(df: DataFrame, calendar: bool = False) -> DataFrame:
    """Months that occur, or with ``calendar`` every month from the first to the last one."""
    if not calendar:
        return df.select("month").distinct()
    span = df.agg(F.min("month").alias("first"), F.max("month").alias("last"))
    return span.select(F.explode(_calendar(F.col("first"), F.col("last"))).alias("month"))


def _calendar(first: Column, last: Column) -> Column:
    return F.sequence(first, last, F.expr("interval 1 month"))


def entity_month_panel(df: DataFrame, keys: Sequence[str], calendar: bool = False) -> DataFrame:
    """Every entity in every month. The months are broadcast: a calendar bounds their number.

    Both lists come from the counted pairs, so the input is read once. A plain ``distinct`` in place
    of the count would be optimised away, and each list would read the input on its own.
    """
    seen = df.groupBy("month", *keys).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 0")
    months = distinct_months(seen, calendar)
    return distinct_entities(seen, keys).crossJoin(F.broadcast(months)).select("month", *keys)


def densify(
    monthly: DataFrame,
    months: DataFrame,
    keys: Sequence[str],
    fill: Mapping[str, object],
) -> DataFrame:
    """``monthly`` (one row per entity and month) with a filled row for every absent month.

    The grid is never shuffled: each entity's months, at most one row per calendar month, are
    gathered into one row, and the grid is unfolded in place from the list of all months. Rows
    stay partitioned by entity, so windows over ``keys`` need no further exchange. ``monthly``
    should come partitioned by ``keys``.
    """
    values = list(fill)
    history = monthly.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("month", F.struct(*values)))).alias("_history")
    )
    grid = months.agg(F.collect_set("month").alias("_months"))
    cells = F.transform(
        "_months",
        lambda month: F.struct(
            month.alias("month"), F.try_element_at("_history", month).alias("cell")
        ),
    )
    unfolded = history.crossJoin(F.broadcast(grid)).select(*keys, F.explode(cells).alias("_cell"))
    return unfolded.select(
        F.col("_cell.month").alias("month"),
        *keys,
        *[
            F.coalesce(F.col(f"_cell.cell.{name}"), F.lit(default)).alias(name)
            for name, default in fill.items()
        ],
    )
