"""Every operator and mart as a named query over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.casts import month_of, number_or_null
from ..functions.growth import ratio
from ..operators.dedupe import first_per_key
from ..operators.enrich import join_company, join_region
from ..operators.panel import distinct_entities, distinct_months, entity_month_panel
from ..operators.topk import (
    disclosable,
    history,
    latest_per_entity,
    shareable_sample,
    strongest_per_month,
)
from ..operators.universe import allowlist_sizes, dimension, in_universe
from ..plans import (
    contracts,
    demand,
    extraction,
    incremental,
    lineage,
    metadata,
    registry,
    reports,
    salary,
    skills,
    staging,
    trajectory,
)
from ..plans.build import Sources, build_marts, record_run
from ..schemas import DISCLOSURE_COUNT, MARTS
from ..session import shared_folder
from ..settings import new_run_id
from ..sinks.tables import write_monthly
from ..sources import extract, snapshot
from . import standin
from .standin import NO_ROLES, NO_SKILLS, ROLES, SETTINGS, SKILLS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters of the registered queries, within the date range of the test tables.
FIRST_HALF = (date(1900, 1, 1), date(1998, 6, 30))
SECOND_HALF = (date(1998, 7, 1), date(2999, 12, 31))
WINDOW = (date(1996, 2, 15), date(2000, 2, 29))
ROW_CAP = 20_000
TOP_LIFTS = 10
SPLITS = {"train": date(1998, 1, 1), "validation": date(2000, 1, 1), "test": date(2001, 1, 1)}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def register(name: str, function: Query) -> None:
    QUERIES[name] = function


def settled(name: str) -> Column:
    """Six decimals and no negative zero: engines differ in the last bits of interpolated and
    second-moment values."""
    return (F.round(name, 6) + F.lit(0.0)).alias(name)


def settle(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[settled(c) if c in names else F.col(c) for c in df.columns])


# --- the chain of inputs -------------------------------------------------------------------------


def raw(spark: SparkSession, folder: str) -> DataFrame:
    return staging.raw_postings(
        standin.postings(spark, folder), standin.company_mapping(spark, folder)
    )


def base(spark: SparkSession, folder: str) -> DataFrame:
    return staging.base_postings(raw(spark, folder))


def filtered(spark: SparkSession, folder: str) -> DataFrame:
    return in_universe(base(spark, folder), ROLES, SKILLS)


def job_demand_mart(spark: SparkSession, folder: str) -> DataFrame:
    return demand.job_demand(filtered(spark, folder))


def features(grain: str) -> Query:
    return lambda spark, folder: trajectory.trajectory_features(
        job_demand_mart(spark, folder), SETTINGS, grain
    )


def labels(grain: str) -> Query:
    return lambda spark, folder: trajectory.trajectory_labels(
        features(grain)(spark, folder), SETTINGS
    )


def all_marts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    sources = Sources(standin.postings(spark, folder), standin.company_mapping(spark, folder))
    return build_marts(sources, ROLES, SKILLS, SETTINGS)


# --- extraction ----------------------------------------------------------------------------------


@query
def extract_window(spark, folder):
    source = standin.postings(spark, folder)
    return extract.extract_postings(
        source, *WINDOW, roles=["Economy", "Promo"], columns=source.columns
    )


def _periods_in_data(spark, folder) -> DataFrame:
    span = standin.postings(spark, folder).agg(
        F.min("post_date").alias("start"), F.max("post_date").alias("end")
    )
    return extract.periods_between(span)


def _with_posting_counts(spark, folder, periods: DataFrame) -> DataFrame:
    dated = standin.postings(spark, folder).where("post_date is not null")
    label = F.date_format("post_date", "yyyy-MM").alias("label")
    counts = dated.groupBy(label).agg(F.count(F.lit(1)).alias("posting_count"))
    return periods.join(counts, "label", "left").select(
        "label",
        "span_start",
        "span_end",
        F.coalesce("posting_count", F.lit(0)).alias("posting_count"),
    )


@query
def month_periods(spark, folder):
    return _with_posting_counts(spark, folder, _periods_in_data(spark, folder))


def _stored_by_month(spark, folder, *columns: str) -> DataFrame:
    path = f"{shared_folder(spark)}/postings-{new_run_id()}"
    write_monthly(standin.postings(spark, folder).select(*columns), path)
    return snapshot.read_monthly(spark, path)


def _postings_of_months(spark, folder, **choice) -> DataFrame:
    """Postings of the first or last months of the data, read from a snapshot by month."""
    monthly = _stored_by_month(spark, folder, "job_id", "post_date", "role_k17000_v3")
    periods = extract.select_periods(_periods_in_data(spark, folder), **choice)
    return extract.postings_in_periods(monthly, periods).drop("year", "month")


@query
def first_months(spark, folder):
    return _postings_of_months(spark, folder, first=6)


@query
def last_months(spark, folder):
    return _postings_of_months(spark, folder, last=6)


@query
def extraction_run(spark, folder):
    """An extraction of the last 30 months for two roles into a folder of its own, read back as a snapshot."""
    source = standin.postings(spark, folder)
    root = f"{shared_folder(spark)}/snapshot-{new_run_id()}"
    settings = replace(SETTINGS, source_root=root, extract_start=WINDOW[0], extract_end=WINDOW[1])
    options = extraction.ExtractOptions(last_months=30, columns=tuple(source.columns))
    extraction.run_extract(
        source, standin.company_mapping(spark, folder), standin.regions(spark, folder), settings,
        ["Economy", "Promo"], options,
    )
    stored = extraction.read_snapshot(spark, root)
    found = stored.postings.groupBy("year", "month", "rcid").agg(F.count(F.lit(1)).alias("posting_count"))
    return found.join(stored.company.select("rcid", "company"), "rcid", "left")


@query
def cap_rows_by_month(spark, folder):
    dated = standin.postings(spark, folder).where("post_date is not null")
    columns = ["job_id", "rcid", "post_date", "role_k17000_v3", "salary"]
    return extract.cap_rows_by_month(dated.select(*columns), ROW_CAP)


@query
def company_for_postings(spark, folder):
    source = extract.extract_postings(
        standin.postings(spark, folder), *WINDOW, columns=["rcid", "post_date"]
    )
    return extract.dimension_for_facts(standin.company_mapping(spark, folder), source, "rcid")


@query
def dedupe_company(spark, folder):
    """The earliest posting of every company, as a key with many rows."""
    dated = standin.postings(spark, folder).where("rcid is not null and post_date is not null")
    return first_per_key(
        dated.select("rcid", "post_date", "job_id", "country", "skill_id"), ["rcid"], ["post_date"]
    )


@query
def company_full(spark, folder):
    company = standin.company_mapping(spark, folder)
    return extract.scan_columns(company, ["rcid", "company", "rics_k50", "rics_k200"])


@query
def regions_scan(spark, folder):
    return extract.scan_columns(standin.regions(spark, folder), ["country", "region"])


@query
def partition_columns(spark, folder):
    source = standin.postings(spark, folder).select("job_id", "post_date")
    return extract.with_partition_columns(source)


@query
def monthly_roundtrip(spark, folder):
    """Write the snapshot by month, read it back, count what each folder holds."""
    return (
        _stored_by_month(spark, folder, "job_id", "post_date", "role_k17000_v3")
        .groupBy("year", "month")
        .agg(
            F.count(F.lit(1)).alias("posting_count"),
            F.sum("job_id").alias("job_id_sum"),
            F.count("role_k17000_v3").alias("role_count"),
        )
    )


@query
def drifting_months(spark, folder):
    """A snapshot whose later months spell job ids as text and salaries as numbers, and have no companies."""
    source = standin.postings(spark, folder).select("job_id", "rcid", "post_date", "salary")
    path = f"{shared_folder(spark)}/postings-{new_run_id()}"
    earlier, later = F.col("post_date") <= F.lit(FIRST_HALF[1]), F.col("post_date") > F.lit(FIRST_HALF[1])
    # Halves of a month would share its folder, so the cut lies between two months.
    write_monthly(source.where(earlier), path)
    other = source.where(later).withColumns(
        {"job_id": F.col("job_id").cast("string"), "salary": number_or_null(source, "salary")}
    )
    write_monthly(other.drop("rcid"), path)
    df = snapshot.read_monthly(spark, path)
    return df.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("posting_count"),
        F.sum("job_id").alias("job_id_sum"),
        F.count("rcid").alias("rcid_count"),
        F.count(number_or_null(df, "salary")).alias("salary_count"),
    )


@query
def union_months(spark, folder):
    source = standin.postings(spark, folder)
    columns = ["job_id", "post_date", "role_k17000_v3", "metro_area"]
    return extract.union_frames(
        extract.extract_postings(source, *window, columns=columns)
        for window in (FIRST_HALF, SECOND_HALF)
    )


def _allowlisted_counts(spark, folder, allowlist) -> DataFrame:
    key = allowlist.id_column
    counts = base(spark, folder).groupBy(key).agg(F.sum("posting_count").alias("posting_count"))
    return (
        allowlist.frame(spark)
        .join(counts, key, "left")
        .select(
            key, f"{allowlist.kind}_name", F.coalesce("posting_count", F.lit(0)).alias("posting_count")
        )
    )


@query
def allowlist_roles(spark, folder):
    return _allowlisted_counts(spark, folder, ROLES)


@query
def allowlist_skills(spark, folder):
    return _allowlisted_counts(spark, folder, SKILLS)


@query
def run_manifest(spark, folder):
    source = standin.postings(spark, folder)
    company = standin.company_mapping(spark, folder)
    manifest = metadata.run_manifest(
        source,
        extract.dimension_for_facts(company, source, "rcid"),
        standin.regions(spark, folder),
        SETTINGS,
        postings_path="postings",
        company_scope="postings_rcid",
        allowlist_size=len(ROLES.source_ids),
        report_path="role_frequency",
    )
    return manifest.select(
        "run_id",
        "source",
        F.col("tables.postings.rows").alias("postings_rows"),
        F.col("tables.postings.path").alias("postings_path"),
        F.col("tables.postings.date_range.start").alias("range_start"),
        F.col("tables.postings.date_range.end").alias("range_end"),
        F.col("tables.company_mapping.rows").alias("company_rows"),
        F.col("tables.company_mapping.scope").alias("company_scope"),
        F.col("tables.regions.rows").alias("regions_rows"),
        F.col("cs_allowlist_size").cast("long").alias("cs_allowlist_size"),
        "taxonomy_report",
    )


# --- staging and universe ------------------------------------------------------------------------


@query
def raw_postings(spark, folder):
    return raw(spark, folder)


@query
def base_postings(spark, folder):
    return base(spark, folder)


@query
def cs_postings(spark, folder):
    return filtered(spark, folder)


@query
def cs_postings_passthrough(spark, folder):
    return in_universe(base(spark, folder), NO_ROLES, NO_SKILLS)


@query
def cs_postings_skill_only(spark, folder):
    return in_universe(base(spark, folder), NO_ROLES, SKILLS)


@query
def valid_salary(spark, folder):
    return salary.valid_salary(filtered(spark, folder))


@query
def role_in_list(spark, folder):
    source = standin.postings(spark, folder)
    listed = extract.role_in_list("role_k17000_v3", ["Economy", "PROMO"])
    return source.where(listed).select("job_id", "role_k17000_v3", "post_date")


@query
def industry_enrichment(spark, folder):
    source = standin.postings(spark, folder).select("job_id", "rcid", "post_date")
    return join_company(source, standin.company_mapping(spark, folder), ["job_id"])


@query
def region_enrichment(spark, folder):
    source = standin.postings(spark, folder).select("job_id", "country", "post_date")
    return join_region(source, standin.regions(spark, folder))


def _dimension_counts(spark, folder, allowlist) -> DataFrame:
    """The dimension of a list, with the postings of each id and name."""
    keys = [allowlist.id_column, f"{allowlist.kind}_name"]
    counts = base(spark, folder).groupBy(*keys).agg(F.sum("posting_count").alias("posting_count"))
    found = dimension(allowlist, spark).join(counts, keys, "left")
    return found.select(*keys, F.coalesce("posting_count", F.lit(0)).alias("posting_count"))


@query
def dim_role(spark, folder):
    return _dimension_counts(spark, folder, ROLES)


@query
def dim_skill(spark, folder):
    return _dimension_counts(spark, folder, SKILLS)


register("allowlist_sizes", lambda s, f: allowlist_sizes(dim_role(s, f), dim_skill(s, f)))


@query
def entities(spark, folder):
    return distinct_entities(filtered(spark, folder), ["role_id", "geo_id", "industry_id"])


@query
def months(spark, folder):
    return distinct_months(filtered(spark, folder))


register(
    "entity_month_panel",
    lambda s, f: entity_month_panel(filtered(s, f), ["role_id", "geo_id", "industry_id"]),
)


@query
def scalar_normalisation(spark, folder):
    source = standin.postings(spark, folder).where("post_date is not null")
    day, number = F.col("post_date"), number_or_null(source, "salary")
    return source.select(
        "job_id",
        month_of(day).alias("month"),
        F.date_format(day, "yyyy-MM").alias("month_label"),
        F.year(day).alias("post_year"),
        F.month(day).alias("post_month"),
        F.last_day(day).alias("month_end"),
        F.date_add(day, 1).alias("next_day"),
        F.try_to_date(day.cast("string"), "yyyy-MM-dd").alias("parsed_day"),
        F.upper(F.trim(F.concat(F.lit(" "), F.coalesce("role_k17000_v3", F.lit("UNK"))))).alias(
            "role_id"
        ),
        F.coalesce("metro_area", "state", "country", F.lit("UNK")).alias("geo_id"),
        number.alias("salary_usd"),
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), number / 50000.0)).alias("clamped"),
        ratio(F.lit(1000.0), number).alias("safe_ratio"),
        F.when(number > 50000, "high").when(number > 0, "low").otherwise("none").alias("band"),
    )


# --- demand --------------------------------------------------------------------------------------

register("monthly_demand", lambda s, f: demand.monthly_demand(filtered(s, f)))
register("demand_filled", lambda s, f: demand.demand_filled(filtered(s, f)))
register("job_demand", job_demand_mart)


def _demand_metric(name: str) -> Query:
    keys = ["month", *demand.ENTITY, "posting_count"]
    return lambda spark, folder: job_demand_mart(spark, folder).select(*keys, name)


register("demand_yoy", _demand_metric("yoy_growth"))
register("demand_3m_growth", _demand_metric("rolling_3m_growth"))
register("demand_acceleration", _demand_metric("acceleration"))

# --- skills and associations ---------------------------------------------------------------------

register("skill_monthly", lambda s, f: skills.skill_monthly(filtered(s, f)))
register("role_totals", lambda s, f: skills.role_totals(filtered(s, f)))
register("skill_share", lambda s, f: skills.skill_share(filtered(s, f)))
register("skill_demand", lambda s, f: skills.skill_demand(filtered(s, f)))
register(
    "skill_yoy",
    lambda s, f: skills.skill_demand(filtered(s, f)).select(
        "month", "geo_id", "role_id", "skill_id", "yoy_growth"
    ),
)
register("cooccurrence_monthly", lambda s, f: skills.cooccurrence_monthly(filtered(s, f)))
register("cooccurrence_12m", lambda s, f: skills.cooccurrence_12m(filtered(s, f)))
register("assoc_marginals", lambda s, f: skills.association_marginals(filtered(s, f)))
register("role_skill_associations", lambda s, f: skills.role_skill_associations(filtered(s, f)))

# --- salaries ------------------------------------------------------------------------------------


@query
def salary_distribution(spark, folder):
    return settle(salary.salary_distribution(filtered(spark, folder)), *salary.QUARTILES)


# --- trajectories --------------------------------------------------------------------------------


def _measured(grain: str, *columns: str) -> Query:
    def run(spark, folder):
        rows = trajectory.volatility(job_demand_mart(spark, folder), grain)
        place = [c for c in ("geo_id", "industry_id") if c in rows.columns]
        return settle(
            rows.select("entity_type", "entity_id", "month", *place, *columns), "volatility_12m"
        )

    return run


register("volatility_12m", _measured("row", "yoy_growth", "volatility_12m"))
register("observed_months", _measured("row", "observed_months"))


@query
def demand_concentration(spark, folder):
    mart = job_demand_mart(spark, folder)
    shares = trajectory.with_concentration(mart, mart)
    return shares.select("month", *demand.ENTITY, "posting_count", "demand_concentration_index")


@query
def min_history_gate(spark, folder):
    rows = trajectory.volatility(job_demand_mart(spark, folder), "role")
    return trajectory.min_history(rows, SETTINGS.min_observations).select(
        "entity_type", "entity_id", "month", "posting_count", "observed_months"
    )


@query
def with_run_context(spark, folder):
    rows = trajectory.role_series(job_demand_mart(spark, folder))
    return trajectory.with_run_context(rows, SETTINGS)


for _grain in trajectory.GRAINS:
    register(
        f"trajectory_features_{_grain}",
        lambda s, f, g=_grain: settle(features(g)(s, f), "volatility_12m"),
    )
    register(
        f"trajectory_labels_{_grain}",
        lambda s, f, g=_grain: settle(labels(g)(s, f), "confidence"),
    )

register("label_distribution", lambda s, f: trajectory.label_distribution(labels("role")(s, f)))

# --- samples and lookups -------------------------------------------------------------------------


def _sample(df: DataFrame, mart: str) -> DataFrame:
    return shareable_sample(df, mart, SETTINGS.min_disclosed_count, SETTINGS.sample_rows)


register("snapshot_demand", lambda s, f: _sample(job_demand_mart(s, f), "job_demand"))
register("snapshot_skill", lambda s, f: _sample(QUERIES["skill_demand"](s, f), "skill_demand"))
register(
    "snapshot_assoc",
    lambda s, f: _sample(QUERIES["role_skill_associations"](s, f), "role_skill_associations"),
)
register("snapshot_salary", lambda s, f: _sample(salary_distribution(s, f), "salary_distribution"))
register(
    "snapshot_features",
    lambda s, f: _sample(QUERIES["trajectory_features_role"](s, f), "trajectory_features"),
)
register(
    "snapshot_labels",
    lambda s, f: _sample(QUERIES["trajectory_labels_role"](s, f), "trajectory_labels"),
)


@query
def snapshot_threshold(spark, folder):
    mart = job_demand_mart(spark, folder)
    return disclosable(mart, DISCLOSURE_COUNT["job_demand"], SETTINGS.min_disclosed_count)


@query
def lookup_role_demand(spark, folder):
    return history(job_demand_mart(spark, folder), ["geo_id", "industry_id"], role_id="ECONOMY")


@query
def lookup_industry_demand(spark, folder):
    return history(job_demand_mart(spark, folder), ["geo_id", "role_id"], industry_id="ASIA")


@query
def lookup_skill_demand(spark, folder):
    return history(QUERIES["skill_demand"](spark, folder), ["geo_id", "role_id"], skill_id="BRAND#12")


@query
def lookup_salary(spark, folder):
    mart = salary_distribution(spark, folder)
    return history(mart, ["industry_id"], role_id="PROMO", geo_id="BUILDING")


@query
def top_lift_per_month(spark, folder):
    return strongest_per_month(QUERIES["role_skill_associations"](spark, folder), TOP_LIFTS)


@query
def latest_label(spark, folder):
    return latest_per_entity(QUERIES["trajectory_labels_role"](spark, folder), trajectory.SERIES)


# --- reports, contracts, metadata ----------------------------------------------------------------


@query
def role_frequency(spark, folder):
    return reports.role_frequency(standin.postings(spark, folder), ROLES.source_ids)


@query
def table_row_counts(spark, folder):
    return contracts.row_counts(all_marts(spark, folder))


@query
def validate_non_negative(spark, folder):
    return contracts.negative_counts(job_demand_mart(spark, folder))


def _per_mart(marts: dict[str, DataFrame], check) -> DataFrame:
    frames = [
        check(df, MARTS[name]).withColumn("table_name", F.lit(name)) for name, df in marts.items()
    ]
    return reduce(DataFrame.unionByName, frames)


@query
def contract_not_null(spark, folder):
    return _per_mart(
        all_marts(spark, folder),
        lambda df, contract: contracts.null_violations(df, contract.required),
    )


@query
def contract_pk(spark, folder):
    return _per_mart(
        all_marts(spark, folder), lambda df, contract: contracts.key_summary(df, contract.key)
    )


@query
def contract_pk_trajectory(spark, folder):
    """At row grain the key repeats: one row per place and industry of a role."""
    return contracts.key_violations(
        features("row")(spark, folder), MARTS["trajectory_features"].key
    )


def _runs_by_role(df: DataFrame) -> DataFrame:
    """A run record per role, as if every role had been loaded by a run of its own."""
    return df.groupBy(F.concat(F.lit("run_"), "role_id").alias("run_id")).agg(
        F.min("month").alias("source_start_month"),
        F.max("month").alias("source_end_month"),
        F.count(F.lit(1)).alias("row_count"),
    )


@query
def register_run(spark, folder):
    """Runs of the filtered roles are registered; those of all roles come in."""
    known = _runs_by_role(in_universe(base(spark, folder), ROLES, NO_SKILLS))
    return metadata.register_run(known, _runs_by_role(base(spark, folder)))


@query
def contract_fk(spark, folder):
    known = _runs_by_role(in_universe(base(spark, folder), ROLES, NO_SKILLS))
    return contracts.orphans(_runs_by_role(base(spark, folder)), known, "run_id")


@query
def source_lineage(spark, folder):
    sources = {
        "postings": standin.postings(spark, folder),
        "company_mapping": standin.company_mapping(spark, folder),
        "regions": standin.regions(spark, folder),
    }
    frames = [
        metadata.source_lineage(df, SETTINGS.run_id, name, f"snapshot/{name}")
        for name, df in sources.items()
    ]
    # The hash function of the checksum is Spark's own, so it is left to the tests.
    return reduce(DataFrame.unionByName, frames).drop("checksum")


@query
def pipeline_run(spark, folder):
    return metadata.pipeline_run(standin.postings(spark, folder), SETTINGS)


@query
def model_eval_splits(spark, folder):
    return metadata.model_eval_splits(features("role")(spark, folder), SETTINGS, **SPLITS)


@query
def incremental_job_demand(spark, folder):
    """Job demand after a build without a third of one month, and one that takes up the whole month."""
    source, company = standin.postings(spark, folder), standin.company_mapping(spark, folder)
    late = (F.date_format("post_date", "yyyy-MM") == "1998-03") & (F.col("job_id") % 3 == 0)
    root = f"{shared_folder(spark)}/builds-{new_run_id()}"
    earlier = replace(SETTINGS, run_id="earlier")
    later = replace(SETTINGS, run_id="later", run_timestamp=SETTINGS.run_timestamp + timedelta(days=1))
    before = Sources(source.where(F.coalesce(~late, F.lit(True))), company)
    incremental.rebuild(spark, before, ROLES, SKILLS, earlier, root)
    after = Sources(source, company)
    built = incremental.rebuild(spark, after, ROLES, SKILLS, later, root, [date(1998, 3, 1)])
    return built.read(spark, "job_demand")


@query
def monthly_lineage(spark, folder):
    """Rows by month of a stored snapshot, of which one month was replaced after the first lineage was taken."""
    path = f"{shared_folder(spark)}/postings-{new_run_id()}"
    source = standin.postings(spark, folder).select("job_id", "post_date", "salary")
    write_monthly(source, path)
    known = lineage.month_lineage(spark, path)
    march = source.where("date_format(post_date, 'yyyy-MM') = '1998-03' and job_id % 3 > 0")
    write_monthly(march, path)
    found = lineage.month_lineage(spark, path, known)
    changed = lineage.changed_months(known, found)
    first = F.make_date("year", "month", F.lit(1))
    # The hash function is Spark's own, so hashes are left to the tests.
    return found.select("year", "month", "row_count", first.isin(changed).alias("changed"))


@query
def registered_sources(spark, folder):
    """The lineage records of a run, registered, and registered again under the same id with other records."""
    root = f"{shared_folder(spark)}/registry-{new_run_id()}"
    sources = Sources(
        standin.postings(spark, folder), standin.company_mapping(spark, folder), standin.regions(spark, folder)
    )
    settings = replace(SETTINGS, output_root=root, source_root="snapshot")
    trajectories = features("role")(spark, folder)
    record_run(spark, sources, trajectories, settings)
    record_run(spark, replace(sources, regions=None), trajectories, settings)
    kept = registry.registered(spark, f"{root}/metadata", registry.LINEAGE)
    runs = registry.registered(spark, f"{root}/metadata", registry.RUNS)
    return kept.join(runs, "run_id").select(
        "run_id", "source_name", "source_path", "row_count", "source_start_month", "source_end_month"
    )
