"""Skill demand and role-skill associations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.growth import pct_change, ratio, series, trailing
from ..schemas import MARTS


SKILL_SERIES = ("geo_id", "role_id", "skill_id")


def _counted(base: DataFrame) -> DataFrame:
    """Counts per month, series and name: the only pass over the input."""
    return base.groupBy("month", *SKILL_SERIES, "skill_name").agg(
        F.sum("posting_count").cast("long").alias("skill_posting_count")
    )


def _per_skill(counted: DataFrame) -> DataFrame:
    return (
        counted.repartition(*SKILL_SERIES)
        .groupBy("month", *SKILL_SERIES)
        .agg(
            F.min("skill_name").alias("skill_name"),
            F.sum("skill_posting_count").alias("skill_posting_count"),
        )
    )


def skill_monthly(base: DataFrame) -> DataFrame:
    """Postings per month, place, role and skill, partitioned by the series of the last three."""
    return _per_skill(_counted(base))


def role_totals(base: DataFrame) -> DataFrame:
    return base.groupBy("month", "geo_id", "role_id").agg(
        F.sum("posting_count").cast("long").alias("role_posting_count")
    )


def _with_share(skills: DataFrame, counted: DataFrame) -> DataFrame:
    """Each skill's share of its role's postings.

    Role totals are the sum of the role's skills: a second, combined aggregation of the counted rows, whose
    shuffle both read. So no task holds all skills of a place and role.
    """
    role = ["month", "geo_id", "role_id"]
    totals = counted.groupBy(*role).agg(F.sum("skill_posting_count").alias("role_posting_count"))
    share = ratio(F.col("skill_posting_count"), F.col("role_posting_count"))
    return skills.join(totals, role).withColumn("share_within_role", share)


def skill_share(base: DataFrame) -> DataFrame:
    counted = _counted(base)
    return _with_share(_per_skill(counted), counted)


def skill_demand(base: DataFrame) -> DataFrame:
    """Shares with year-over-year growth over the months in which the skill was observed."""
    counted = _counted(base)
    growth = pct_change("skill_posting_count", 12, series(*SKILL_SERIES))
    grown = _per_skill(counted).withColumn("yoy_growth", growth)
    return _with_share(grown, counted).select(*MARTS["skill_demand"].columns)


def cooccurrence_monthly(base: DataFrame) -> DataFrame:
    return base.groupBy("month", "role_id", "skill_id").agg(
        F.sum("posting_count").cast("long").alias("co_occurrence_count")
    )


def cooccurrence_12m(base: DataFrame) -> DataFrame:
    """Co-occurrence over the current and the 11 previously observed months of a pair."""
    return _trailing_pairs(cooccurrence_monthly(base))


def _trailing_pairs(monthly: DataFrame) -> DataFrame:
    total = trailing(F.sum("co_occurrence_count"), 12, series("role_id", "skill_id"))
    return monthly.withColumn("co_occurrence_12m", total)


def association_marginals(base: DataFrame) -> DataFrame:
    """Role, skill and grand totals per month in one pass; ``level`` tells them apart."""
    month, role, skill = F.col("month"), F.col("role_id"), F.col("skill_id")
    by_level = cooccurrence_monthly(base).groupingSets(
        [[month, role], [month, skill], [month]], month, role, skill
    )
    totals = by_level.agg(
        F.sum("co_occurrence_count").alias("total"),
        F.grouping("role_id").alias("_no_role"),
        F.grouping("skill_id").alias("_no_skill"),
    )
    level = (
        F.when(F.col("_no_role") == 0, "role").when(F.col("_no_skill") == 0, "skill").otherwise("all")
    )
    return totals.select("month", level.alias("level"), "role_id", "skill_id", "total")


def role_skill_associations(base: DataFrame, consistent: bool = False) -> DataFrame:
    """Probability of a skill given a role, and its lift over the skill's overall share.

    The numerator spans 12 observed months and the totals one month, so the probability may exceed
    one. ``consistent`` takes the totals over the same 12-row counts instead.
    """
    pairs = _trailing_pairs(cooccurrence_monthly(base))
    return associations_of(pairs, pairs, "co_occurrence_12m" if consistent else "co_occurrence_count")


def associations_of(pairs: DataFrame, every: DataFrame, counted: str) -> DataFrame:
    """Associations of ``pairs`` (with their trailing counts), the totals of their months taken over ``every``
    pair of these months."""

    def total(name: str, *keys: str) -> DataFrame:
        return every.groupBy("month", *keys).agg(F.sum(counted).alias(name))

    probability = ratio(F.col("co_occurrence_12m"), F.col("role_total"))
    overall = ratio(F.col("skill_total"), F.col("all_total"))
    joined = (
        pairs.join(total("role_total", "role_id"), ["month", "role_id"])
        .join(total("skill_total", "skill_id"), ["month", "skill_id"])
        # One row per calendar month.
        .join(F.broadcast(total("all_total")), "month")
    )
    return joined.select(
        "month",
        "role_id",
        "skill_id",
        F.col("co_occurrence_12m").alias("co_occurrence_count"),
        probability.alias("p_skill_given_role"),
        (probability / F.nullif(overall, F.lit(0.0))).alias("lift"),
    )
