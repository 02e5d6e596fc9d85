"""Samples and lookups over published marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..schemas import DISCLOSURE_COUNT, MARTS


def disclosable(df: DataFrame, count: str, threshold: int) -> DataFrame:
    """Rows whose count is large enough to be shared."""
    return df.where(F.col(count) >= threshold)


def shareable_sample(df: DataFrame, mart: str, threshold: int, rows: int) -> DataFrame:
    """The latest rows of a mart, largest counts first where the mart has a disclosure count.

    The order ends in the mart's key and then all columns, so the sample does not depend on ties.
    """
    order = [F.desc("month")]
    count = DISCLOSURE_COUNT.get(mart)
    if count:
        df = disclosable(df, count, threshold)
        order.append(F.desc(count))
    rest = [*MARTS[mart].key, *[c for c in df.columns if c not in MARTS[mart].key]]
    return df.orderBy(*order, *rest).limit(rows)


def history(df: DataFrame, tie_keys: Sequence[str], **equals: str) -> DataFrame:
    """All rows of the given entities, newest month first."""
    for name, value in equals.items():
        df = df.where(F.col(name) == value)
    return df.orderBy(F.desc("month"), *tie_keys)


def strongest_per_month(associations: DataFrame, k: int) -> DataFrame:
    """The ``k`` associations with the highest lift in every month, with their rank."""
    window = W.partitionBy("month").orderBy(F.desc_nulls_last("lift"), "role_id", "skill_id")
    return associations.withColumn("lift_rank", F.row_number().over(window)).where(
        F.col("lift_rank") <= k
    )


def latest_per_entity(df: DataFrame, entity: Sequence[str]) -> DataFrame:
    """The newest row of every entity."""
    rest = [c for c in df.columns if c not in (*entity, "month")]
    newest = df.groupBy(*entity).agg(F.max(F.struct("month", *rest)).alias("_newest"))
    return newest.select(*entity, "_newest.*").select(*df.columns)
