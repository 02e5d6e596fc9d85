"""The whole build: snapshot to six marts, staged where more than one mart reads."""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..operators.topk import shareable_sample
from ..operators.universe import Allowlist
from ..session import shared_folder, staged
from ..settings import RunSettings
from ..sinks.tables import export_marts, replace_unless_empty
from ..sources.snapshot import (
    exists,
    posting_file_schema,
    read_monthly_or_empty,
    read_or_empty,
    require_columns,
)
from .contracts import column_checks, require_contract
from .contracts import require_columns as require_columns_of
from .demand import job_demand
from .extraction import read_snapshot
from .metadata import model_eval_splits, pipeline_run, source_lineage
from .registry import register
from .salary import salary_distribution
from .skills import role_skill_associations, skill_demand
from .staging import posting_cube, universe_postings
from .trajectory import trajectory_features, trajectory_labels


# What the marts read of a posting.
POSTING_COLUMNS = (
    "job_id",
    "rcid",
    "post_date",
    "remove_date",
    "country",
    "state",
    "metro_area",
    "role_k17000_v3",
    "role_k1500_v2",
    "salary",
)


@dataclass(frozen=True)
class Sources:
    postings: DataFrame
    company: DataFrame
    regions: DataFrame | None = None


def read_sources(spark: SparkSession, root: str) -> Sources:
    """The complete extraction runs under ``root``, or else a plain snapshot folder there.

    Any part may be absent and is then empty. Of a part that is there, the columns the marts need must be,
    too; skills are optional.
    """
    runs = read_snapshot(spark, root)
    if runs:
        postings, company, regions = runs.postings, runs.company, runs.regions
    else:
        postings = read_monthly_or_empty(spark, f"{root}/postings", posting_file_schema())
        company = read_or_empty(spark, f"{root}/company_mapping", schemas.COMPANY)
        regions = read_or_empty(spark, f"{root}/regions", schemas.REGIONS)
    return Sources(require_columns(postings, POSTING_COLUMNS, "postings"), company, regions)


def build_marts(
    sources: Sources,
    roles: Allowlist,
    skills: Allowlist,
    settings: RunSettings,
    grain: str = "role",
    folder: str | None = None,
) -> dict[str, DataFrame]:
    """All marts by name.

    Whatever has several readers is written to the shared folder on the way: the filtered base (read
    by the cube and by salaries), the cube (read by three marts), job demand (read by the
    trajectory features) and those (read by the labels).
    """
    folder = folder or shared_folder(sources.postings.sparkSession)
    base = staged(
        universe_postings(sources.postings, sources.company, roles, skills), "base", folder
    )
    cube = staged(posting_cube(base), "cube", folder)
    demand = staged(job_demand(cube), "job_demand", folder)
    features = staged(trajectory_features(demand, settings, grain), "trajectory_features", folder)
    return {
        "job_demand": demand,
        "skill_demand": skill_demand(cube),
        "role_skill_associations": role_skill_associations(cube),
        "salary_distribution": salary_distribution(base),
        "trajectory_features": features,
        "trajectory_labels": trajectory_labels(features, settings),
    }


def run_build(
    spark: SparkSession,
    roles: Allowlist,
    skills: Allowlist,
    settings: RunSettings,
    grain: str = "role",
) -> dict[str, DataFrame]:
    """Read the snapshot under ``source_root``, build, export to ``output_root``, validate and register the run
    with its sources and splits under ``output_root/metadata``."""
    sources = read_sources(spark, settings.source_root)
    marts = build_marts(sources, roles, skills, settings, grain)
    for name, contract in schemas.MARTS.items():
        require_columns_of(marts[name], name, contract)
    counted = export_marts(
        marts, settings.output_root, {name: column_checks(c) for name, c in schemas.MARTS.items()}
    )
    exported = validate_outputs(spark, settings, counted)
    record_run(spark, sources, exported["trajectory_features"], settings)
    if exported["trajectory_features"].isEmpty() and not exported["job_demand"].isEmpty():
        warnings.warn(f"no entity has {settings.min_observations} observed months: no trajectories")
    return exported


def record_run(spark: SparkSession, sources: Sources, features: DataFrame, settings: RunSettings) -> bool:
    """Register the run of ``settings``; False if its id is registered already."""
    named = {"postings": sources.postings, "company_mapping": sources.company}
    if sources.regions is not None:
        named["regions"] = sources.regions
    lineage = [
        source_lineage(df, settings.run_id, name, f"{settings.source_root}/{name}") for name, df in named.items()
    ]
    return register(
        spark,
        f"{settings.output_root}/metadata",
        pipeline_run(sources.postings, settings),
        reduce(DataFrame.unionByName, lineage),
        model_eval_splits(features, settings),
    )


def validate_outputs(
    spark: SparkSession, settings: RunSettings, counted: Mapping[str, Mapping[str, int]] | None = None
) -> dict[str, DataFrame]:
    """All exported marts, each present and within its contract; anything else is an error. What was ``counted``
    of a mart while it was exported is not counted again."""
    missing = [n for n in schemas.MARTS if not exists(spark, f"{settings.output_root}/{n}.parquet")]
    if missing:
        raise FileNotFoundError(f"marts not exported: {', '.join(missing)}")
    found = {}
    for name, contract in schemas.MARTS.items():
        found[name] = spark.read.parquet(f"{settings.output_root}/{name}.parquet")
        require_contract(found[name], name, contract, (counted or {}).get(name))
    return found


def make_sample(spark: SparkSession, settings: RunSettings) -> list[str]:
    """Write the shareable sample of every exported mart; returns the marts written."""
    written = []
    for name in schemas.MARTS:
        if not exists(spark, f"{settings.output_root}/{name}.parquet"):
            continue
        mart = spark.read.parquet(f"{settings.output_root}/{name}.parquet")
        sample = shareable_sample(mart, name, settings.min_disclosed_count, settings.sample_rows)
        if replace_unless_empty(sample, f"{settings.sample_root}/{name}.csv"):
            written.append(name)
    return written
