"""Dimension joins: company to industry, country to region."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.casts import whole_key
from .dedupe import first_per_key


def join_company(
    postings: DataFrame,
    company: DataFrame,
    spread_on: Sequence[str] = ("post_date", "geo_id", "role_id"),
) -> DataFrame:
    """Left join of the industry columns on ``rcid``; one company row per key.

    No broadcast hint: Spark broadcasts the mapping when its size allows and else shuffles both
    sides. That shuffle goes by the key and a hash. Postings without a company hash ``spread_on``,
    columns of many values that every mart reads anyway, and so do not meet in one partition. And as
    the deduplicated mapping is not yet partitioned by the hash, both inputs of the join are fresh
    shuffles, without which Spark could not split a hot company over several tasks at run time.
    """
    industries = first_per_key(
        company.select(whole_key(company, "rcid").alias("_company"), "rics_k200", "rics_k50").where(
            F.col("_company").isNotNull()
        ),
        ["_company"],
    ).withColumn("_company_hash", F.xxhash64("_company"))
    keyed = postings.withColumn("rcid", whole_key(postings, "rcid")).withColumn(
        "_hash",
        F.when(F.col("rcid").isNull(), F.xxhash64(*spread_on)).otherwise(F.xxhash64("rcid")),
    )
    matches = (F.col("rcid") == F.col("_company")) & (F.col("_hash") == F.col("_company_hash"))
    return keyed.join(industries, matches, "left").drop("_hash", "_company", "_company_hash")


def join_region(postings: DataFrame, regions: DataFrame) -> DataFrame:
    """Optional enrichment: the region of each posting's country, unknown where none is listed."""
    known = first_per_key(regions.select("country", "region").where("country is not null"), ["country"])
    # A country list is short but arrives as a file: its size decides the join, not a hint.
    return postings.join(known, "country", "left").withColumn(
        "region", F.coalesce("region", F.lit("Unknown"))
    )
