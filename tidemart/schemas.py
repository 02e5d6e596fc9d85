"""Column types of every table, and the key and NOT NULL contract of every published one."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _schema(**columns: str) -> T.StructType:
    """All fields nullable: files carry no NOT NULL, the contracts below check it."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


# The raw posting columns, in file order.
POSTINGS = _schema(
    job_id="long",
    rcid="long",
    company="string",
    country="string",
    state="string",
    metro_area="string",
    role_k1500_v2="string",
    role_k17000_v3="string",
    onet_code="string",
    salary="string",
    salary_min="double",
    salary_max="double",
    salary_predicted="double",
    post_date="date",
    remove_date="date",
    ultimate_parent_rcid="long",
    ultimate_parent_company_name="string",
    remote_type="string",
    expected_hires="double",
    source_company_sites="boolean",
    source_linkedin="boolean",
    source_indeed="boolean",
    source_zhaopin="boolean",
    source_51job="boolean",
    source_liepin="boolean",
    source_other_aggregators="boolean",
    source_staffingfirms="boolean",
    source_regional_aggregators="boolean",
)
# Skills may be delivered next to the postings; both columns are optional in a snapshot.
SKILL_COLUMNS = _schema(skill_id="string", skill_name="string")

COMPANY = _schema(
    rcid="long",
    company="string",
    ultimate_parent_rcid="long",
    ultimate_parent_company_name="string",
    naics_code="string",
    rics_k50="string",
    rics_k200="string",
    rics_k400="string",
)
REGIONS = _schema(country="string", region="string")

RAW_POSTINGS = _schema(
    job_id="long",
    post_date="date",
    remove_date="date",
    rcid="long",
    country="string",
    state="string",
    metro_area="string",
    role_id="string",
    role_name="string",
    skill_id="string",
    skill_name="string",
    salary_usd="double",
    industry_id="string",
    industry_name="string",
    geo_id="string",
    geo_name="string",
)
BASE_POSTINGS = _schema(
    month="date",
    geo_id="string",
    geo_name="string",
    industry_id="string",
    industry_name="string",
    role_id="string",
    role_name="string",
    skill_id="string",
    skill_name="string",
    salary_usd="double",
    posting_count="int",
)


@dataclass(frozen=True)
class Contract:
    schema: T.StructType
    key: tuple[str, ...]
    required: tuple[str, ...]

    @property
    def columns(self) -> list[str]:
        return self.schema.names


def _contract(
    schema: T.StructType, key: tuple[str, ...], nullable: tuple[str, ...] = ()
) -> Contract:
    return Contract(
        schema=schema,
        key=key,
        required=tuple(name for name in schema.names if name not in nullable),
    )


MARTS: dict[str, Contract] = {
    "job_demand": _contract(
        _schema(
            month="date",
            geo_id="string",
            geo_name="string",
            industry_id="string",
            industry_name="string",
            role_id="string",
            role_name="string",
            posting_count="long",
            yoy_growth="double",
            rolling_3m_growth="double",
            acceleration="double",
        ),
        key=("month", "geo_id", "industry_id", "role_id"),
        nullable=("yoy_growth", "rolling_3m_growth", "acceleration"),
    ),
    "skill_demand": _contract(
        _schema(
            month="date",
            geo_id="string",
            role_id="string",
            skill_id="string",
            skill_name="string",
            skill_posting_count="long",
            role_posting_count="long",
            share_within_role="double",
            yoy_growth="double",
        ),
        key=("month", "geo_id", "role_id", "skill_id"),
        nullable=("share_within_role", "yoy_growth"),
    ),
    "role_skill_associations": _contract(
        _schema(
            month="date",
            role_id="string",
            skill_id="string",
            co_occurrence_count="long",
            p_skill_given_role="double",
            lift="double",
        ),
        key=("month", "role_id", "skill_id"),
        nullable=("p_skill_given_role", "lift"),
    ),
    "salary_distribution": _contract(
        _schema(
            month="date",
            geo_id="string",
            industry_id="string",
            role_id="string",
            salary_p25="double",
            salary_p50="double",
            salary_p75="double",
        ),
        key=("month", "geo_id", "industry_id", "role_id"),
        nullable=("salary_p25", "salary_p50", "salary_p75"),
    ),
    "trajectory_features": _contract(
        _schema(
            entity_type="string",
            entity_id="string",
            month="date",
            posting_count="long",
            yoy_growth="double",
            rolling_3m_growth="double",
            acceleration="double",
            volatility_12m="double",
            demand_concentration_index="double",
            momentum_score="double",
            feature_version="string",
            run_timestamp="timestamp_ntz",
            cs_allowlist_version="string",
            train_start_month="date",
            validation_start_month="date",
        ),
        key=("entity_type", "entity_id", "month", "feature_version"),
        nullable=(
            "yoy_growth",
            "rolling_3m_growth",
            "acceleration",
            "volatility_12m",
            "demand_concentration_index",
            "momentum_score",
        ),
    ),
    "trajectory_labels": _contract(
        _schema(
            entity_type="string",
            entity_id="string",
            month="date",
            trajectory_class="string",
            trajectory_score="double",
            confidence="double",
            method="string",
            label_version="string",
            method_version="string",
            run_timestamp="timestamp_ntz",
        ),
        key=("entity_type", "entity_id", "month", "label_version", "method_version"),
        nullable=("trajectory_score", "confidence"),
    ),
}

METADATA: dict[str, Contract] = {
    "pipeline_runs": _contract(
        _schema(
            run_id="string",
            run_timestamp="timestamp_ntz",
            source_start_month="date",
            source_end_month="date",
            feature_version="string",
            label_version="string",
            method_version="string",
            cs_allowlist_version="string",
            notes="string",
        ),
        key=("run_id",),
        nullable=("source_start_month", "source_end_month", "notes"),
    ),
    "source_lineage": _contract(
        _schema(
            run_id="string",
            source_name="string",
            source_path="string",
            row_count="long",
            checksum="string",
        ),
        key=("run_id", "source_name", "source_path"),
        nullable=("row_count", "checksum"),
    ),
    "model_eval_splits": _contract(
        _schema(
            split_id="string",
            run_id="string",
            entity_type="string",
            train_start_month="date",
            train_end_month="date",
            validation_start_month="date",
            validation_end_month="date",
            test_start_month="date",
            test_end_month="date",
        ),
        key=("split_id",),
        nullable=("validation_end_month", "test_start_month", "test_end_month"),
    ),
}

# The count column each thresholded sample is cut on.
DISCLOSURE_COUNT = {
    "job_demand": "posting_count",
    "skill_demand": "skill_posting_count",
    "role_skill_associations": "co_occurrence_count",
}
