"""Writing snapshots, marts, samples and reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation

from ..sources.extract import with_partition_columns

# Different ids that a Bloom filter of a row group is laid out for.
BLOOM_VALUES = 20_000
# The column order consumers look a mart up by; files sorted by it carry narrow min/max ranges.
LOOKUP_ORDER: dict[str, tuple[str, ...]] = {
    "job_demand": ("role_id", "month", "industry_id", "geo_id"),
    "skill_demand": ("skill_id", "month", "role_id", "geo_id"),
    "role_skill_associations": ("month", "lift"),
    "salary_distribution": ("role_id", "geo_id", "month"),
    "trajectory_features": ("entity_type", "entity_id", "month"),
    "trajectory_labels": ("entity_type", "entity_id", "month"),
}


def write_monthly(postings: DataFrame, path: str) -> None:
    """Write ``year=/month=`` folders, replacing only the months that occur in ``postings``.

    Rebalancing gives every month as many files as its size asks for: small months share a task,
    a month with most of the rows is split over many.
    """
    dated = with_partition_columns(postings).hint("rebalance", "year", "month")
    (
        dated.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month")
        .parquet(path)
    )


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_mart(df: DataFrame, path: str, order: Sequence[str], measures: Sequence[Column] = ()) -> dict:
    """Parquet laid out for lookups: range-partitioned and sorted by ``order``, with Bloom filters on the id
    columns, so that a lookup of an id skips the row groups that lack it. Returns ``measures`` of the rows, taken
    while they are written.
    """
    # Above the sort: below it the sampling of the ranges would count rows twice.
    laid_out = df.repartitionByRange(*order).sortWithinPartitions(*order)
    seen = Observation()
    if measures:
        laid_out = laid_out.observe(seen, *measures)
    writer = laid_out.write.mode("overwrite")
    for column in order:
        if column.endswith("_id"):
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", True)
            writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", BLOOM_VALUES)
    writer.parquet(path)
    return seen.get if measures else {}


def _csv(df: DataFrame, path: str) -> None:
    """Standard CSV: quotes doubled, blanks at the ends of values kept, so any strict reader gets the
    values back. An empty text is written quoted, a null as nothing."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_csv(df: DataFrame, path: str) -> None:
    _csv(df, path)


def export_marts(
    marts: Mapping[str, DataFrame], folder: str, measures: Mapping[str, Sequence[Column]] | None = None
) -> dict[str, dict]:
    """Every mart as ``<name>.parquet`` and, read back from it, ``<name>.csv`` with header. Returns by mart its
    ``measures``, taken on the way."""
    measured = {}
    for name, df in marts.items():
        parquet = f"{folder}/{name}.parquet"
        order = LOOKUP_ORDER.get(name)
        if order:
            measured[name] = write_mart(df, parquet, order, (measures or {}).get(name, ()))
        else:
            write_table(df, parquet)
        write_csv(df.sparkSession.read.schema(df.schema).parquet(parquet), f"{folder}/{name}.csv")
    return measured


def write_report(df: DataFrame, path: str, order: Sequence) -> None:
    """A frequency report as one ordered CSV part: it has a row per role, not per posting."""
    _csv(df.orderBy(*order).coalesce(1), path)


def replace_unless_empty(df: DataFrame, path: str) -> bool:
    """Write a sample, but keep what is there when the new one has no rows."""
    if df.isEmpty() and _exists(df, path):
        return False
    write_csv(df, path)
    return True


def _exists(df: DataFrame, path: str) -> bool:
    try:
        return not df.sparkSession.read.text(path).isEmpty()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
