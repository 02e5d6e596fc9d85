"""Salary quartiles per month, place, industry and role."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quantiles import grouped_quantiles

CELL = ("month", "geo_id", "industry_id", "role_id")
# The published quartiles.
QUARTILES = {"salary_p25": 0.25, "salary_p50": 0.5, "salary_p75": 0.75}


def valid_salary(base: DataFrame) -> DataFrame:
    """Rows with a positive salary. NaN compares greater than any number and is left out too."""
    return base.where((F.col("salary_usd") > 0) & ~F.isnan("salary_usd"))


def salary_distribution(base: DataFrame) -> DataFrame:
    return grouped_quantiles(valid_salary(base), CELL, "salary_usd", QUARTILES)


def salary_distribution_approx(base: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Opt-in approximation in one aggregation, for exploring very large inputs."""
    estimate = F.percentile_approx("salary_usd", list(QUARTILES.values()), accuracy)
    found = valid_salary(base).groupBy(*CELL).agg(estimate.alias("_q"))
    return found.select(*CELL, *[F.col("_q")[i].alias(name) for i, name in enumerate(QUARTILES)])
