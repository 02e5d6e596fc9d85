"""The extraction run: from a posting table to a snapshot folder that readers see once it is complete."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.dedupe import first_per_key
from ..settings import RunSettings
from ..sinks.tables import write_monthly, write_report, write_table
from ..sources.extract import (
    cap_rows_by_month,
    dimension_for_facts,
    extract_postings,
    month_periods,
    posting_columns,
    postings_in_periods,
    select_periods,
)
from ..sources.snapshot import (
    ABSENT,
    months_stored,
    posting_file_schema,
    read_monthly_or_empty,
    read_months,
    read_or_empty,
)
from .metadata import run_manifest
from .reports import report_order, role_frequency

MANIFEST = (
    "run_id string, run_timestamp_utc string, source string, tables struct<postings: struct<rows: long, path: string,"
    " date_range: struct<start: string, end: string>>, company_mapping: struct<rows: long, scope: string>,"
    " regions: struct<rows: long>>, cs_allowlist_size int, taxonomy_report string,"
    " months array<struct<year: int, month: int, rows: long>>"
)
# How the company mapping of a run was chosen.
FULL, FOR_POSTINGS, LEFT_OUT = "full", "postings_rcid", "none"


@dataclass(frozen=True)
class ExtractOptions:
    """What an extraction takes of its source beyond the date range of the settings."""

    first_months: int | None = None
    last_months: int | None = None
    limit_rows: int | None = None
    # One of FULL, FOR_POSTINGS, LEFT_OUT.
    company: str = FOR_POSTINGS
    regions: bool = True
    # All columns of a posting unless given.
    columns: tuple[str, ...] | None = None

    def __post_init__(self):
        if self.company not in (FULL, FOR_POSTINGS, LEFT_OUT):
            raise ValueError(f"company must be {FULL!r}, {FOR_POSTINGS!r} or {LEFT_OUT!r}")
        if self.first_months is not None and self.last_months is not None:
            raise ValueError("give either first_months or last_months, not both")


def run_folder(root: str, run_id: str) -> str:
    return f"{root}/runs/{run_id}"


def _chosen(postings: DataFrame, roles: Sequence[str], settings: RunSettings, options: ExtractOptions) -> DataFrame:
    """Postings of the date range, the listed roles and the chosen months, up to the row cap."""
    window = settings.extract_start, settings.extract_end
    columns = list(options.columns or posting_columns(postings))
    some = options.first_months is not None or options.last_months is not None
    # A source by month has its folders chosen; others are filtered by the posting date.
    by_month = some and {"year", "month"} <= set(postings.columns)
    found = extract_postings(postings, *window, roles, columns=[*columns, *(["year", "month"] if by_month else [])])
    if some:
        if not by_month:
            found = found.withColumns({"year": F.year("post_date"), "month": F.month("post_date")})
        periods = month_periods(postings.sparkSession, *window)
        found = postings_in_periods(found, select_periods(periods, options.first_months, options.last_months))
        found = found.select(*columns)
    return found if options.limit_rows is None else cap_rows_by_month(found, options.limit_rows)


def run_extract(
    postings: DataFrame,
    company: DataFrame | None,
    regions: DataFrame | None,
    settings: RunSettings,
    roles: Sequence[str] = (),
    options: ExtractOptions | None = None,
) -> str:
    """Extract into a folder of its own under ``settings.source_root``; returns the folder.

    Postings go to month folders, the company mapping is taken whole, for the companies of these postings
    with one row each, or not at all, and a report counts the source's roles. Counts are taken of what was
    written. The manifest, which names the months, is written last: it alone makes the run visible to
    :func:`read_snapshot`, so a run that stops halfway leaves the snapshot as it was, and can be run again under
    a new id. A run without postings has a manifest, too.
    """
    spark = postings.sparkSession
    options = options or ExtractOptions()
    folder = run_folder(settings.source_root, settings.run_id)
    path = f"{folder}/postings"
    if settings.run_id in {run.run_id for run in committed_runs(spark, settings.source_root)} or months_stored(spark, path):
        raise FileExistsError(f"there is a run {settings.run_id} already, complete or not")
    write_monthly(_chosen(postings, list(roles), settings, options), path)
    written = read_monthly_or_empty(spark, path, posting_file_schema())

    empty_company = spark.createDataFrame([], schemas.COMPANY)
    kept_company = empty_company
    if company is not None and options.company != LEFT_OUT:
        chosen = company if options.company == FULL else dimension_for_facts(company, written, "rcid")
        write_table(chosen, f"{folder}/company_mapping")
        kept_company = spark.read.schema(chosen.schema).parquet(f"{folder}/company_mapping")
    kept_regions = spark.createDataFrame([], schemas.REGIONS)
    if regions is not None and options.regions:
        write_table(regions, f"{folder}/regions")
        kept_regions = spark.read.schema(regions.schema).parquet(f"{folder}/regions")

    report = f"{folder}/role_frequency"
    write_report(role_frequency(written, list(roles)), report, report_order())
    manifest = run_manifest(
        written, kept_company, kept_regions, settings,
        postings_path=path,
        company_scope=options.company if company is not None else LEFT_OUT,
        allowlist_size=len(set(roles)),
        report_path=report,
        source="extract",
    )
    per_month = written.groupBy("year", "month").agg(F.count(F.lit(1)).alias("rows"))
    months = per_month.agg(F.sort_array(F.collect_list(F.struct("year", "month", "rows"))).alias("months"))
    # Two frames of one row.
    manifest.crossJoin(months).coalesce(1).write.json(f"{folder}/manifest")
    return folder


def committed_runs(spark: SparkSession, root: str) -> list:
    """The manifests of all complete runs under ``root``, newest first."""
    try:
        rows = spark.read.schema(MANIFEST).json(f"{root}/runs/*/manifest").collect()
    except AnalysisException as error:
        if error.getCondition() not in ABSENT:
            raise
        return []
    return sorted(rows, key=lambda r: (r.run_timestamp_utc, r.run_id), reverse=True)


@dataclass(frozen=True)
class Snapshot:
    postings: DataFrame
    company: DataFrame
    regions: DataFrame


def read_snapshot(spark: SparkSession, root: str) -> Snapshot | None:
    """What the complete runs under ``root`` make up together; None without any.

    Every month comes from the newest run that has it, a company from the newest run that names it, the regions
    from the newest run that brought them along. Months that change their column types are reconciled as
    :func:`tidemart.sources.snapshot.read_months` says.
    """
    runs = committed_runs(spark, root)
    if not runs:
        return None
    taken: set[tuple[int, int]] = set()
    postings, companies, regions = [], [], None
    for age, run in enumerate(runs):
        folder = run_folder(root, run.run_id)
        new = [(m.year, m.month) for m in run.months or () if (m.year, m.month) not in taken]
        if new:
            stored = months_stored(spark, f"{folder}/postings")
            postings += [(f"{folder}/postings", stored[month]) for month in new]
            taken.update(new)
        if run.tables.company_mapping.scope != LEFT_OUT:
            company = read_or_empty(spark, f"{folder}/company_mapping", schemas.COMPANY)
            companies.append(company.withColumn("_age", F.lit(age)))
        if regions is None and run.tables.regions.rows:
            regions = read_or_empty(spark, f"{folder}/regions", schemas.REGIONS)
    company = spark.createDataFrame([], schemas.COMPANY)
    if companies:
        every = companies[0]
        for older in companies[1:]:
            every = every.unionByName(older, allowMissingColumns=True)
        company = (first_per_key(every, ["rcid"], ["_age"]) if len(companies) > 1 else every).drop("_age")
    return Snapshot(
        postings=read_months(spark, postings) if postings else spark.createDataFrame([], posting_file_schema()),
        company=company,
        regions=regions if regions is not None else spark.createDataFrame([], schemas.REGIONS),
    )
