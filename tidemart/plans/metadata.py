"""Run records, source lineage, evaluation splits and the extraction manifest."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import month_of
from ..schemas import METADATA
from ..settings import RunSettings
from .trajectory import run_timestamp


def pipeline_run(postings: DataFrame, settings: RunSettings) -> DataFrame:
    """One run record with the range of months found in the source."""
    month = month_of(F.col("post_date").cast("date"))
    span = postings.agg(
        F.min(month).alias("source_start_month"), F.max(month).alias("source_end_month")
    )
    return span.select(
        F.lit(settings.run_id).alias("run_id"),
        run_timestamp(settings).alias("run_timestamp"),
        "source_start_month",
        "source_end_month",
        F.lit(settings.feature_version).alias("feature_version"),
        F.lit(settings.label_version).alias("label_version"),
        F.lit(settings.method_version).alias("method_version"),
        F.lit(settings.allowlist_version).alias("cs_allowlist_version"),
        F.lit(settings.notes).alias("notes"),
    )


def new_runs(runs: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates whose run id is not registered yet; a registered run is never changed."""
    return candidates.dropDuplicates(["run_id"]).join(runs.select("run_id"), "run_id", "left_anti")


def register_run(runs: DataFrame, candidates: DataFrame) -> DataFrame:
    return runs.unionByName(new_runs(runs, candidates))


def row_hashes(df: DataFrame) -> Column:
    """The sum of row hashes: free of order, additive over parts, and repeated rows do not cancel out."""
    return F.sum(F.xxhash64(*df.columns).cast("decimal(28,0)"))


def checksum(df: DataFrame) -> Column:
    return row_hashes(df).cast("string")


def source_lineage(df: DataFrame, run_id: str, name: str, path: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"), checksum(df).alias("checksum")).select(
        F.lit(run_id).alias("run_id"),
        F.lit(name).alias("source_name"),
        F.lit(path).alias("source_path"),
        "row_count",
        "checksum",
    )


def split_of(month: Column, validation: date, test: date | None = None) -> Column:
    """``train``, ``validation`` or ``test`` by month, so that no split sees a later one."""
    if test is None:
        return F.when(month >= F.lit(validation), "validation").otherwise("train")
    return F.when(month >= F.lit(test), "test").otherwise(split_of(month, validation))


def model_eval_splits(
    features: DataFrame,
    settings: RunSettings,
    train: date | None = None,
    validation: date | None = None,
    test: date | None = None,
) -> DataFrame:
    """Month ranges of the splits, one row per entity type that has months to train on.

    Splits start at their configured months and end at the last month observed in them.
    """
    train = train or settings.train_start
    validation = validation or settings.validation_start
    month = F.col("month")
    split = split_of(month, validation, test)

    def last(name: str) -> Column:
        return F.max(F.when(F.col("_split") == name, month)).alias(f"{name}_end_month")

    def start(day: date | None, name: str) -> Column:
        return F.lit(day).cast("date").alias(f"{name}_start_month")

    ranges = (
        features.where(month >= F.lit(train))
        .withColumn("_split", split)
        .groupBy("entity_type")
        .agg(*[last(name) for name in ("train", "validation", "test")])
        .where("train_end_month is not null")
        .select(
            "*", start(train, "train"), start(validation, "validation"), start(test, "test")
        )
    )
    return ranges.withColumns(
        {
            "split_id": F.concat_ws(":", F.lit(settings.run_id), "entity_type"),
            "run_id": F.lit(settings.run_id),
        }
    ).select(*METADATA["model_eval_splits"].columns)


def run_manifest(
    postings: DataFrame,
    company: DataFrame,
    regions: DataFrame,
    settings: RunSettings,
    postings_path: str,
    company_scope: str,
    allowlist_size: int,
    report_path: str,
    source: str = "snapshot",
) -> DataFrame:
    """What an extraction delivered, as one nested row; write it with ``write.json``."""

    def rows(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias(name))

    # Three one-row frames.
    counts = (
        rows(postings, "_postings")
        .crossJoin(rows(company, "_company"))
        .crossJoin(rows(regions, "_regions"))
    )
    tables = F.struct(
        F.struct(
            F.col("_postings").alias("rows"),
            F.lit(postings_path).alias("path"),
            F.struct(
                F.lit(settings.extract_start.isoformat()).alias("start"),
                F.lit(settings.extract_end.isoformat()).alias("end"),
            ).alias("date_range"),
        ).alias("postings"),
        F.struct(
            F.col("_company").alias("rows"), F.lit(company_scope).alias("scope")
        ).alias("company_mapping"),
        F.struct(F.col("_regions").alias("rows")).alias("regions"),
    )
    return counts.select(
        F.lit(settings.run_id).alias("run_id"),
        F.lit(settings.run_timestamp.isoformat()).alias("run_timestamp_utc"),
        F.lit(source).alias("source"),
        tables.alias("tables"),
        F.lit(allowlist_size).alias("cs_allowlist_size"),
        F.lit(report_path).alias("taxonomy_report"),
    )
