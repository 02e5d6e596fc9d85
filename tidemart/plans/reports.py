"""The taxonomy frequency report that feeds allowlist maintenance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT_ORDER = (F.asc, "in_allowlist"), (F.desc, "posting_count"), (F.asc, "role_k17000_v3")


def report_order() -> list:
    return [direction(name) for direction, name in REPORT_ORDER]


def role_frequency(postings: DataFrame, roles: Sequence[str]) -> DataFrame:
    """Postings with a job id per source role, the missing role included as ``NULL``.

    Unlisted roles come first, most frequent on top: the candidates for the list.
    """
    counted = postings.groupBy("role_k17000_v3").agg(F.count("job_id").alias("posting_count"))
    role = F.coalesce("role_k17000_v3", F.lit("NULL"))
    return counted.select(
        role.alias("role_k17000_v3"),
        "posting_count",
        role.isin(list(roles)).alias("in_allowlist"),
    ).orderBy(*report_order())
