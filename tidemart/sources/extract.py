"""Extracting a monthly snapshot from a posting source: windows, periods, caps, dimensions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.casts import date_or_null, numeric_key_or_null
from ..operators.cut import first_rows
from ..operators.dedupe import first_per_key

ONE_MONTH = "interval 1 month"


def scan_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def in_half_open_window(day: str, start: date, end: date) -> Column:
    """``start <= day < end + 1``: ``end`` counts whole, also for timestamps."""
    return (F.col(day) >= F.lit(start)) & (F.col(day) < F.lit(end + timedelta(days=1)))


def role_in_list(role: str, roles: Sequence[str]) -> Column:
    """Case-sensitive match against the source's own role keys."""
    return F.col(role).isin(list(roles))


def posting_columns(postings: DataFrame) -> list[str]:
    """The columns of a snapshot: all of a posting, and those of skills that the source has."""
    return [*schemas.POSTINGS.names, *[c for c in schemas.SKILL_COLUMNS.names if c in postings.columns]]


def extract_postings(
    postings: DataFrame,
    start: date,
    end: date,
    roles: Sequence[str] | None = None,
    limit: int | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Postings dated within ``[start, end]``; an empty role list means no role filter.

    Date and role predicates reach the Parquet scan, and only ``columns`` are read.
    """
    columns = posting_columns(postings) if columns is None else columns
    out = postings.where(in_half_open_window("post_date", start, end))
    if roles:
        out = out.where(role_in_list("role_k17000_v3", roles))
    out = out.select(*columns)
    return out if limit is None else cap_rows_by_month(out, limit)


def periods_between(spans: DataFrame) -> DataFrame:
    """Calendar months overlapping each (``start``, ``end``), clipped to it; none if reversed."""
    first = F.trunc("start", "month")
    months = F.when(
        F.col("start") <= F.col("end"),
        F.sequence(first, F.trunc("end", "month"), F.expr(ONE_MONTH)),
    )
    month = F.col("month")
    return spans.select("start", "end", F.explode(months).alias("month")).select(
        F.date_format(month, "yyyy-MM").alias("label"),
        F.greatest(month, F.col("start")).alias("span_start"),
        F.least(F.last_day(month), F.col("end")).alias("span_end"),
    )


def month_periods(spark: SparkSession, start: date, end: date) -> DataFrame:
    return periods_between(spark.createDataFrame([(start, end)], "start date, end date"))


def select_periods(
    periods: DataFrame, first: int | None = None, last: int | None = None
) -> DataFrame:
    """The first or the last N periods; zero selects none."""
    if first is not None and last is not None:
        raise ValueError("give either first or last, not both")
    n = first if first is not None else last
    if n is None:
        return periods
    if n < 0:
        raise ValueError("the number of months must not be negative")
    order = F.asc("label") if first is not None else F.desc("label")
    return periods.orderBy(order).limit(n)


def postings_in_periods(monthly: DataFrame, periods: DataFrame) -> DataFrame:
    """Postings of a snapshot by ``year``, ``month`` that fall into ``periods``, with the period's ``label``.

    Periods may be computed from data: the few of them are broadcast, and their months choose at run time which
    folders are read.
    """
    # The comparison holds for every period; it tells Catalyst that the periods select.
    wanted = periods.where("span_start <= span_end").select(
        F.year("span_start").alias("year"), F.month("span_start").alias("month"), "label", "span_start", "span_end"
    )
    inside = (F.col("post_date") >= F.col("span_start")) & (
        F.col("post_date") < F.date_add("span_end", 1)
    )
    joined = monthly.join(F.broadcast(wanted), ["year", "month"]).where(inside)
    return joined.select("label", *monthly.columns)


def cap_rows_by_month(df: DataFrame, n: int) -> DataFrame:
    """The ``n`` earliest postings, by date, then job id, then every other column."""
    lead = ["post_date", "job_id"]
    ties = [*lead, *[c for c in df.columns if c not in lead]]
    return first_rows(df, n, F.col("post_date").cast("date"), F.col("job_id"), ties)


def dimension_for_facts(dim: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """One row of ``dim`` per key that occurs in ``facts``; keys that are no number are left out.

    Of several rows for a key the first by all columns stays, so that a join cannot double facts.
    """
    if key not in facts.columns:
        return dim.limit(0)
    wanted = facts.select(numeric_key_or_null(facts, key).alias("_key")).distinct()
    keyed = dim.withColumn("_of", numeric_key_or_null(dim, key))
    found = keyed.join(wanted, F.col("_of") == F.col("_key"), "left_semi")
    return first_per_key(found, ["_of"]).drop("_of")


def union_frames(frames: Iterable[DataFrame]) -> DataFrame:
    """All chunks as one frame, matched by column name."""
    frames = list(frames)
    if not frames:
        raise ValueError("no frames to union")
    return reduce(lambda left, right: left.unionByName(right), frames)


def with_partition_columns(postings: DataFrame, day: str = "post_date") -> DataFrame:
    """Integer ``year`` and ``month`` of the posting date; rows without a readable date are dropped."""
    dated = postings.withColumn("_day", date_or_null(postings, day)).where("_day is not null")
    return dated.withColumns({"year": F.year("_day"), "month": F.month("_day")}).drop("_day")
