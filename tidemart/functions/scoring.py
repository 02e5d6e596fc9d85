"""Momentum, confidence and the rule labels of the trajectory marts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Momentum weights and the thresholds of the label rules.
YOY_WEIGHT = 0.5
THREE_MONTH_WEIGHT = 0.3
ACCELERATION_WEIGHT = 0.2
EMERGING_MIN_ACCELERATION = 5
EMERGING_BELOW_COUNT = 200
EMERGING_MIN_YOY = 10
STABLE_MIN_YOY = 5
STABLE_BELOW_VOLATILITY = 15
PLATEAU_YOY = (-2, 5)
DECLINING_BELOW_YOY = -2


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0.0))


def momentum_score() -> Column:
    return (
        F.lit(YOY_WEIGHT) * _or_zero("yoy_growth")
        + F.lit(THREE_MONTH_WEIGHT) * _or_zero("rolling_3m_growth")
        + F.lit(ACCELERATION_WEIGHT) * _or_zero("acceleration")
    )


def confidence() -> Column:
    """One minus volatility in percent, held within [0, 1]."""
    steadiness = F.lit(1.0) - _or_zero("volatility_12m") / F.lit(100.0)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), steadiness))


def trajectory_class() -> Column:
    """The first rule that holds decides; a row without year-over-year growth is uncertain."""
    yoy, acceleration = F.col("yoy_growth"), F.col("acceleration")
    rules = {
        "emerging": (acceleration >= EMERGING_MIN_ACCELERATION)
        & (F.col("posting_count") < EMERGING_BELOW_COUNT)
        & (yoy >= EMERGING_MIN_YOY),
        "stable_growth": (yoy >= STABLE_MIN_YOY)
        & (_or_zero("volatility_12m") < STABLE_BELOW_VOLATILITY),
        "plateau": yoy.between(*PLATEAU_YOY) & (acceleration < 0),
        "declining": yoy < DECLINING_BELOW_YOY,
    }
    label = F
    for name, holds in rules.items():
        label = label.when(holds, name)
    return label.otherwise("uncertain")
