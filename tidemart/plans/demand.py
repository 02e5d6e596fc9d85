"""Job demand: monthly counts on a full panel, with growth and acceleration.

All functions take the filtered base or its cube: anything with a ``posting_count`` to add up.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import UNKNOWN_NAME
from ..functions.growth import difference, pct_change, series
from ..operators.panel import densify, distinct_months
from ..schemas import MARTS

ENTITY = ("geo_id", "industry_id", "role_id")
NAMES = ("geo_name", "industry_name", "role_name")

# What an entity gets in a month without postings, names included.
FILL = {"posting_count": 0, **{name: UNKNOWN_NAME for name in NAMES}}


def _counted(base: DataFrame) -> DataFrame:
    """Counts per month, entity and names: the only pass over the input."""
    return base.groupBy("month", *ENTITY, *NAMES).agg(
        F.sum("posting_count").cast("long").alias("posting_count")
    )


def _per_entity(counted: DataFrame) -> DataFrame:
    """One row per month and entity, with the smallest of its names, partitioned by entity."""
    return (
        counted.repartition(*ENTITY)
        .groupBy("month", *ENTITY)
        .agg(
            *[F.min(name).alias(name) for name in NAMES],
            F.sum("posting_count").alias("posting_count"),
        )
    )


def monthly_demand(base: DataFrame) -> DataFrame:
    columns = [c for c in MARTS["job_demand"].columns if c in ("month", *ENTITY, *NAMES)]
    return _per_entity(_counted(base)).select(*columns, "posting_count")


def demand_filled(base: DataFrame, calendar: bool = False) -> DataFrame:
    """Every entity in every month; cells without postings count zero under unknown names.

    Growth counts rows, so by default a month absent from the whole input is absent here too;
    ``calendar`` adds such months.
    """
    counted = _counted(base)
    # The test on the count keeps this branch on the same columns as the other one, so that both
    # read one shuffle of ``counted``.
    months = distinct_months(counted.where("posting_count > 0"), calendar)
    return densify(_per_entity(counted), months, ENTITY, FILL)


def with_growth(panel: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Growth against 12 and 3 rows earlier, and the change of the former."""
    window = series(*keys)
    return panel.withColumns(
        {
            "yoy_growth": pct_change("posting_count", 12, window),
            "rolling_3m_growth": pct_change("posting_count", 3, window),
        }
    ).withColumn("acceleration", difference("yoy_growth", window))


def job_demand(base: DataFrame, calendar: bool = False) -> DataFrame:
    return with_growth(demand_filled(base, calendar), ENTITY).select(*MARTS["job_demand"].columns)
