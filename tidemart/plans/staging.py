"""From raw postings to the filtered base every mart starts from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.casts import (
    id_or_unknown,
    month_of,
    name_or_unknown,
    number_or_null,
    whole_key,
)
from ..operators.enrich import join_company
from ..operators.universe import Allowlist, in_universe

# The dimensions every mart but salary is a sum over.
CUBE_KEYS = (
    "month",
    "geo_id",
    "geo_name",
    "industry_id",
    "industry_name",
    "role_id",
    "role_name",
    "skill_id",
    "skill_name",
)


def raw_postings(postings: DataFrame, company: DataFrame) -> DataFrame:
    """Source columns under their canonical names and types, with the company's industry."""
    # The place falls back from the raw columns, before any of them gets its own default.
    place = F.coalesce(*[F.col(c).cast("string") for c in ("metro_area", "state", "country")])

    def skill(name: str) -> Column:
        return F.col(name) if name in postings.columns else F.lit(None).cast("string")

    canonical = postings.select(
        whole_key(postings, "job_id").alias("job_id"),
        F.col("post_date").cast("date").alias("post_date"),
        F.col("remove_date").cast("date").alias("remove_date"),
        whole_key(postings, "rcid").alias("rcid"),
        *[id_or_unknown(F.col(c)).alias(c) for c in ("country", "state", "metro_area")],
        id_or_unknown(F.col("role_k17000_v3")).alias("role_id"),
        name_or_unknown(F.col("role_k1500_v2")).alias("role_name"),
        skill("skill_id").alias("skill_id"),
        skill("skill_name").alias("skill_name"),
        number_or_null(postings, "salary").alias("salary_usd"),
        place.alias("geo_id"),
        place.alias("geo_name"),
    )
    enriched = (
        join_company(canonical, company)
        .withColumn("industry_id", id_or_unknown(F.col("rics_k200")))
        .withColumn("industry_name", name_or_unknown(F.col("rics_k50")))
    )
    return enriched.select(*schemas.RAW_POSTINGS.names)


def base_postings(raw: DataFrame) -> DataFrame:
    """One row per dated posting: month, keys with defaults, upper-cased role and skill ids."""
    dated = raw.where("post_date is not null").select(
        month_of(F.col("post_date")).alias("month"),
        id_or_unknown(F.col("geo_id")).alias("geo_id"),
        name_or_unknown(F.col("geo_name")).alias("geo_name"),
        id_or_unknown(F.col("industry_id")).alias("industry_id"),
        name_or_unknown(F.col("industry_name")).alias("industry_name"),
        F.upper(id_or_unknown(F.col("role_id"))).alias("role_id"),
        name_or_unknown(F.col("role_name")).alias("role_name"),
        F.upper(id_or_unknown(F.col("skill_id"))).alias("skill_id"),
        name_or_unknown(F.col("skill_name")).alias("skill_name"),
        number_or_null(raw, "salary_usd").alias("salary_usd"),
        F.lit(1).alias("posting_count"),
    )
    # Restated for the month, so that joins on it derive no filter of their own and all branches of
    # a mart can read the same shuffle.
    return dated.where("month is not null")


def universe_postings(
    postings: DataFrame, company: DataFrame, roles: Allowlist, skills: Allowlist
) -> DataFrame:
    """The filtered base. The filter names posting columns only, so Catalyst runs it before the
    company join and the join sees the universe, not the whole market."""
    return in_universe(base_postings(raw_postings(postings, company)), roles, skills)


def posting_cube(base: DataFrame) -> DataFrame:
    """Posting counts by every dimension: the small common input of the count marts.

    Names are grouping keys rather than ``min`` aggregates, which keeps this, the one aggregation
    over all postings, a hash aggregation with map-side combine.
    """
    return base.groupBy(*CUBE_KEYS).agg(F.sum("posting_count").cast("long").alias("posting_count"))
