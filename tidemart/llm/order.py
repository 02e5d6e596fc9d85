"""Row numbers over a whole table without gathering it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import staged


def numbered(df: DataFrame, *order: str, weight: str | None = None, name: str = "number") -> DataFrame:
    """``df`` with ``name``: how many rows (or how much ``weight``) come before each row in ``order``.

    Rows are range-partitioned and sorted; each partition's total is known once the sorted table is
    written, and a running sum over the partitions, a few per executor core, gives their first number.
    The numbers depend on the order alone if it settles all ties, not on where the ranges are cut.
    """
    placed = staged(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id()),
        "numbered",
    ).withColumn("_part", F.shiftrightunsigned("_at", 33))
    amount = F.col(weight) if weight else F.lit(1)
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    # One row per partition of the sort.
    parts = placed.groupBy("_part").agg(F.sum(amount).alias("_sum"))
    parts = parts.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    within = W.partitionBy("_part").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    return (
        placed.withColumn("_in", F.coalesce(F.sum(amount).over(within), F.lit(0)))
        .join(F.broadcast(parts), "_part")
        .withColumn(name, F.col("_base") + F.col("_in"))
        .drop("_at", "_part", "_in", "_base")
    )
