"""Exact interpolated quantiles per group, for groups of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Buckets per e-fold of the value.
RESOLUTION = 4_096

def grouped_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, float]
) -> DataFrame:
    """One row per group with each ``quantiles`` name as a column.

    Equal values are counted first. A histogram per group then finds the buckets of the wanted ranks,
    two per quantile at most, and only the values in those buckets are ranked. So no group is gathered
    anywhere, whatever its size, and the result is exact.

    Keys must not be null; rows without a value do not count.
    """
    df = df.dropna(subset=[*keys, value])
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    return _by_rank_search(counted, keys, value, quantiles)


def _bucket(value: Column) -> Column:
    """Non-decreasing in ``value``, which is all the rank search relies on.

    Values are not null here; the default says so to Catalyst, which would otherwise add a condition
    on the bucket to one of the branches.
    """
    return F.coalesce(F.floor(F.signum(value) * F.log1p(F.abs(value)) * RESOLUTION), F.lit(0))


def _by_rank_search(
    counted: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, float]
) -> DataFrame:
    counted = counted.withColumn("_bucket", _bucket(F.col(value)))
    in_order = W.partitionBy(*keys).orderBy("_bucket")
    histogram = (
        counted.groupBy(*keys, "_bucket")
        .agg(F.sum("_n").alias("_in_bucket"))
        .withColumn("_upto", F.sum("_in_bucket").over(in_order))
        .withColumn("_total", F.sum("_in_bucket").over(W.partitionBy(*keys)))
        .withColumn("_before", F.col("_upto") - F.col("_in_bucket"))
    )

    def position(p: float) -> Column:
        return F.lit(float(p)) * (F.col("_total") - 1)

    def ranks(p: float) -> tuple[Column, Column]:
        return F.floor(position(p)), F.ceil(position(p))

    def holds(rank: Column) -> Column:
        return (F.col("_before") <= rank) & (rank < F.col("_upto"))

    wanted = F.lit(False)
    for p in quantiles.values():
        for rank in ranks(p):
            wanted = wanted | holds(rank)
    picked = histogram.where(wanted).select(*keys, "_bucket", "_before", "_total")

    within = W.partitionBy(*keys, "_bucket").orderBy(value)
    ranked = (
        counted.join(picked, [*keys, "_bucket"])
        .withColumn("_upto", F.col("_before") + F.sum("_n").over(within))
        .withColumn("_before", F.col("_upto") - F.col("_n"))
    )
    found = []
    for name, p in quantiles.items():
        for side, rank in zip(("low", "high"), ranks(p)):
            found.append(F.max(F.when(holds(rank), F.col(value))).alias(f"_{name}_{side}"))
    at_ranks = ranked.groupBy(*keys).agg(F.max("_total").alias("_total"), *found)

    def interpolated(name: str, p: float) -> Column:
        low, high = F.col(f"_{name}_low"), F.col(f"_{name}_high")
        floor, ceil = ranks(p)
        between = (ceil - position(p)) * low + (position(p) - floor) * high
        return F.when(low == high, low).otherwise(between).alias(name)

    return at_ranks.select(*keys, *[interpolated(n, p) for n, p in quantiles.items()])
