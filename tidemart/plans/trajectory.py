"""Trajectory features and labels, from the job demand mart.

Two grains. ``row`` keeps one row per place, industry, role and month, which the entity key (the
role) does not tell apart: its windows run over all rows of a role, here in the order month, place,
industry. ``role`` first sums demand to one row per role and month and satisfies the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.growth import ratio, running_count, series, trailing
from ..functions.scoring import confidence, momentum_score, trajectory_class
from ..operators.trailing import BLOCK_ROWS, numbered, trailing_by_number
from ..schemas import MARTS
from ..settings import RunSettings
from .demand import with_growth

GRAINS = ("row", "role")
SERIES = ("entity_type", "entity_id")
VOLATILITY_ROWS = 12


def with_run_context(df: DataFrame, settings: RunSettings) -> DataFrame:
    """Versions and time of the run as constant columns."""
    return df.withColumns(
        {
            "run_timestamp": run_timestamp(settings),
            "feature_version": F.lit(settings.feature_version),
            "label_version": F.lit(settings.label_version),
            "method_version": F.lit(settings.method_version),
            "cs_allowlist_version": F.lit(settings.allowlist_version),
        }
    )


def run_timestamp(settings: RunSettings) -> Column:
    return F.lit(settings.run_timestamp.isoformat(sep=" ")).cast("timestamp_ntz")


def role_series(demand: DataFrame) -> DataFrame:
    """Demand summed to role and month, with growth recomputed on the sums."""
    summed = demand.groupBy("role_id", "month").agg(F.sum("posting_count").alias("posting_count"))
    return with_growth(summed, ("role_id",))


def _entities(demand: DataFrame) -> DataFrame:
    return demand.withColumns({"entity_type": F.lit("role"), "entity_id": F.col("role_id")})


def volatility(demand: DataFrame, grain: str = "role", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Entity rows with 12-row volatility of growth and the number of rows observed so far."""
    deviation = F.stddev_pop("yoy_growth")
    if grain == "role":
        # At most one row per calendar month in a series.
        window = series(*SERIES)
        return _entities(role_series(demand)).withColumns(
            {
                "volatility_12m": trailing(deviation, VOLATILITY_ROWS, window),
                "observed_months": running_count(window),
            }
        )
    if grain == "row":
        order = ("month", "geo_id", "industry_id")
        rows = numbered(_entities(demand), SERIES, order, "observed_months")
        metrics = {"volatility_12m": deviation}
        return trailing_by_number(
            rows, SERIES, "observed_months", VOLATILITY_ROWS, metrics, block_rows
        )
    raise ValueError(f"grain must be one of {GRAINS}")


def with_concentration(df: DataFrame, demand: DataFrame) -> DataFrame:
    """Each row's share of all postings of its month. The totals have a row per calendar month.

    Both grains have the month totals of ``demand`` itself, which are cheaper than those of ``df``.
    """
    totals = demand.groupBy("month").agg(F.sum("posting_count").alias("_total"))
    share = ratio(F.col("posting_count"), F.col("_total"))
    return (
        df.join(F.broadcast(totals), "month")
        .withColumn("demand_concentration_index", share)
        .drop("_total")
    )


def min_history(df: DataFrame, observations: int) -> DataFrame:
    return df.where(F.col("observed_months") >= observations)


def trajectory_features(
    demand: DataFrame,
    settings: RunSettings,
    grain: str = "role",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    measured = with_concentration(volatility(demand, grain, block_rows), demand)
    return scored_features(measured, settings)


def scored_features(measured: DataFrame, settings: RunSettings) -> DataFrame:
    """Entities with enough history, their score and the context of the run."""
    scored = min_history(measured, settings.min_observations).withColumns(
        {
            "momentum_score": momentum_score(),
            "train_start_month": F.lit(settings.train_start),
            "validation_start_month": F.lit(settings.validation_start),
        }
    )
    return with_run_context(scored, settings).select(*MARTS["trajectory_features"].columns)


def trajectory_labels(features: DataFrame, settings: RunSettings) -> DataFrame:
    labelled = features.withColumns(
        {
            "trajectory_class": trajectory_class(),
            "trajectory_score": F.col("momentum_score"),
            "confidence": confidence(),
            "method": F.lit(settings.label_method),
        }
    )
    return with_run_context(labelled, settings).select(*MARTS["trajectory_labels"].columns)


def label_distribution(labels: DataFrame) -> DataFrame:
    return labels.groupBy("trajectory_class").agg(F.count(F.lit(1)).alias("label_count"))
