"""Row numbers and trailing windows over series that may be too long for one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK_ROWS = 50_000


def numbered(
    df: DataFrame, series: Sequence[str], order: Sequence[str], name: str
) -> DataFrame:
    """``row_number`` per series in ``order``, from counts per order prefix.

    Each window sees one level of the order only: the months of a series, the next key within a
    month, the rows within those. No task sorts a whole series.
    """
    *prefixes, last = order
    offsets = None
    for depth in range(1, len(prefixes) + 1):
        cell, level = [*series, *prefixes[:depth]], prefixes[depth - 1]
        earlier = (
            W.partitionBy(*series, *prefixes[: depth - 1])
            .orderBy(level)
            .rowsBetween(W.unboundedPreceding, -1)
        )
        before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
        sizes = df.groupBy(*cell).agg(F.count(F.lit(1)).alias("_rows")).select(*cell, before)
        if offsets is None:
            offsets = sizes
        else:
            parent = offsets.withColumnRenamed("_before", "_parent")
            offsets = sizes.join(parent, cell[:-1]).select(
                *cell, (F.col("_before") + F.col("_parent")).alias("_before")
            )
    local = F.row_number().over(W.partitionBy(*series, *prefixes).orderBy(last)).cast("long")
    if offsets is None:
        return df.withColumn(name, local)
    return (
        df.join(offsets, [*series, *prefixes])
        .withColumn(name, F.col("_before") + local)
        .drop("_before")
    )


def trailing_by_number(
    df: DataFrame,
    series: Sequence[str],
    number: str,
    rows: int,
    metrics: Mapping[str, Column],
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Aggregates over the current and the ``rows - 1`` preceding rows of a numbered series.

    A series is cut into blocks of ``block_rows``; the last rows of a block are also given to the
    next one, which sees through them what came before and then drops them.
    """
    if block_rows < rows:
        raise ValueError("a block must hold at least one full frame")
    position = F.col(number) - 1
    block = F.floor(position / block_rows)
    reaches_next = position % block_rows > block_rows - rows
    copies = F.when(
        reaches_next,
        F.array(
            F.struct(block.alias("block"), F.lit(False).alias("lead_in")),
            F.struct((block + 1).alias("block"), F.lit(True).alias("lead_in")),
        ),
    ).otherwise(F.array(F.struct(block.alias("block"), F.lit(False).alias("lead_in"))))
    frame = W.partitionBy(*series, "_copy.block").orderBy(number).rowsBetween(1 - rows, 0)
    out = df.withColumn("_copy", F.explode(copies))
    out = out.withColumns({name: metric.over(frame) for name, metric in metrics.items()})
    return out.where(~F.col("_copy.lead_in")).drop("_copy")
