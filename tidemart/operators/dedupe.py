"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence | None = None) -> DataFrame:
    """The first row of every key in ``order``, then in all other columns, so that ties are settled.

    Spark keeps at most one row per key and task before the shuffle, so a hot key stays small.
    """
    ranked = list(order or []) + [c for c in df.columns if c not in key]
    window = W.partitionBy(*key).orderBy(*(ranked or key))
    return df.withColumn("_row", F.row_number().over(window)).where("_row = 1").drop("_row")
