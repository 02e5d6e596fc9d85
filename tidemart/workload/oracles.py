"""An independent SQL statement for every query, for checking results in another engine.

Growth and trailing metrics are stated as self-joins on month or row numbers, not as the window
functions the Spark plans use, so that a wrong frame or order on one side shows.
"""

from __future__ import annotations

import re

# Named steps; a statement gets exactly those it refers to, in order of dependency.
STEPS: dict[str, str] = {}
ORACLES: dict[str, str] = {}

STEPS["postings"] = """
    SELECT
        l_orderkey * 8 + l_linenumber AS job_id,
        CASE WHEN l_partkey % 50 <> 0 THEN l_suppkey END AS rcid,
        CASE WHEN l_orderkey % 2 <> 0 THEN 'Country ' || r_regionkey END AS country,
        CASE WHEN l_orderkey % 3 <> 0 THEN r_name END AS state,
        CASE WHEN l_orderkey % 5 <> 0 THEN c_mktsegment END AS metro_area,
        CASE WHEN l_orderkey % 101 <> 0 THEN lower(p_type) || ' role' END AS role_k1500_v2,
        CASE WHEN l_orderkey % 101 <> 0
            THEN upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2)) END AS role_k17000_v3,
        CASE l_partkey % 40
            WHEN 1 THEN 'n/a' WHEN 2 THEN '0' WHEN 3 THEN '-5' WHEN 4 THEN NULL
            ELSE CAST(CAST(l_extendedprice AS DECIMAL(12, 2)) AS VARCHAR) END AS salary,
        CASE WHEN l_orderkey % 97 <> 0 THEN CAST(l_shipdate AS DATE) END AS post_date,
        CASE WHEN l_orderkey % 97 <> 0
            THEN CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) END AS remove_date,
        CASE WHEN l_linenumber <> 7 THEN lower(p_brand) END AS skill_id,
        CASE WHEN l_linenumber <> 7 THEN p_brand END AS skill_name
    FROM lineitem, part, orders, customer, nation, region
    WHERE l_partkey = p_partkey AND l_orderkey = o_orderkey AND o_custkey = c_custkey
      AND c_nationkey = n_nationkey AND n_regionkey = r_regionkey"""

STEPS["company_mapping"] = """
    SELECT s_suppkey AS rcid, s_name AS company, r_name AS rics_k200,
           'Group ' || r_regionkey AS rics_k50
    FROM supplier, nation, region
    WHERE s_nationkey = n_nationkey AND n_regionkey = r_regionkey AND s_suppkey % 10 <> 0"""

STEPS["regions"] = """
    SELECT 'Country ' || r_regionkey AS country, r_name AS region FROM region"""

STEPS["raw_postings"] = """
    SELECT
        job_id, post_date, remove_date, p.rcid,
        ifnull(country, 'UNK') AS country,
        ifnull(state, 'UNK') AS state,
        ifnull(metro_area, 'UNK') AS metro_area,
        ifnull(role_k17000_v3, 'UNK') AS role_id,
        ifnull(role_k1500_v2, 'Unknown') AS role_name,
        skill_id, skill_name,
        TRY_CAST(salary AS DOUBLE) AS salary_usd,
        ifnull(rics_k200, 'UNK') AS industry_id,
        ifnull(rics_k50, 'Unknown') AS industry_name,
        coalesce(metro_area, state, country) AS geo_id,
        coalesce(metro_area, state, country) AS geo_name
    FROM postings p LEFT JOIN company_mapping c ON p.rcid = c.rcid"""

STEPS["base_postings"] = """
    SELECT
        make_date(year(post_date), month(post_date), 1) AS month,
        ifnull(geo_id, 'UNK') AS geo_id,
        ifnull(geo_name, 'Unknown') AS geo_name,
        industry_id, industry_name,
        upper(role_id) AS role_id, role_name,
        upper(ifnull(skill_id, 'UNK')) AS skill_id,
        ifnull(skill_name, 'Unknown') AS skill_name,
        salary_usd,
        CAST(1 AS INTEGER) AS posting_count
    FROM raw_postings WHERE post_date IS NOT NULL"""

STEPS["cs_postings"] = """
    SELECT * FROM base_postings
    WHERE role_id IN ('ECONOMY', 'LARGE', 'PROMO') OR skill_id IN ('BRAND#12', 'BRAND#7')"""

STEPS["role_postings"] = """
    SELECT * FROM base_postings WHERE role_id IN ('ECONOMY', 'LARGE', 'PROMO')"""

STEPS["skill_postings"] = """
    SELECT * FROM base_postings WHERE skill_id IN ('BRAND#12', 'BRAND#7')"""

STEPS["entities"] = "SELECT DISTINCT role_id, geo_id, industry_id FROM cs_postings"

STEPS["month_numbers"] = """
    SELECT month, row_number() OVER (ORDER BY month) AS n
    FROM (SELECT DISTINCT month FROM cs_postings)"""

STEPS["panel"] = "SELECT month, n, role_id, geo_id, industry_id FROM entities, month_numbers"

STEPS["monthly_demand"] = """
    SELECT month, geo_id, min(geo_name) AS geo_name, industry_id,
           min(industry_name) AS industry_name, role_id, min(role_name) AS role_name,
           count(*) AS posting_count
    FROM cs_postings GROUP BY month, geo_id, industry_id, role_id"""

STEPS["demand_filled"] = """
    SELECT month, n, geo_id, ifnull(geo_name, 'Unknown') AS geo_name,
           industry_id, ifnull(industry_name, 'Unknown') AS industry_name,
           role_id, ifnull(role_name, 'Unknown') AS role_name,
           ifnull(posting_count, 0) AS posting_count
    FROM panel LEFT JOIN monthly_demand USING (month, geo_id, industry_id, role_id)"""

STEPS["demand_grown"] = """
    SELECT now.*,
           100e0 * (now.posting_count - year_ago.posting_count)
               / nullif(year_ago.posting_count, 0) AS yoy_growth,
           100e0 * (now.posting_count - quarter_ago.posting_count)
               / nullif(quarter_ago.posting_count, 0) AS rolling_3m_growth
    FROM demand_filled now
    LEFT JOIN demand_filled year_ago
           ON year_ago.geo_id = now.geo_id AND year_ago.industry_id = now.industry_id
          AND year_ago.role_id = now.role_id AND year_ago.n = now.n - 12
    LEFT JOIN demand_filled quarter_ago
           ON quarter_ago.geo_id = now.geo_id AND quarter_ago.industry_id = now.industry_id
          AND quarter_ago.role_id = now.role_id AND quarter_ago.n = now.n - 3"""

STEPS["job_demand"] = """
    SELECT now.month, now.geo_id, now.geo_name, now.industry_id, now.industry_name,
           now.role_id, now.role_name, now.posting_count, now.yoy_growth, now.rolling_3m_growth,
           now.yoy_growth - past.yoy_growth AS acceleration
    FROM demand_grown now
    LEFT JOIN demand_grown past
           ON past.geo_id = now.geo_id AND past.industry_id = now.industry_id
          AND past.role_id = now.role_id AND past.n = now.n - 1"""

STEPS["skill_monthly"] = """
    SELECT month, geo_id, role_id, skill_id, min(skill_name) AS skill_name,
           count(*) AS skill_posting_count
    FROM cs_postings GROUP BY month, geo_id, role_id, skill_id"""

STEPS["role_totals"] = """
    SELECT month, geo_id, role_id, count(*) AS role_posting_count
    FROM cs_postings GROUP BY month, geo_id, role_id"""

STEPS["skill_share"] = """
    SELECT month, geo_id, role_id, skill_id, skill_name, skill_posting_count, role_posting_count,
           CAST(skill_posting_count AS DOUBLE) / role_posting_count AS share_within_role
    FROM skill_monthly JOIN role_totals USING (month, geo_id, role_id)"""

STEPS["skill_numbered"] = """
    SELECT *, row_number() OVER (PARTITION BY geo_id, role_id, skill_id ORDER BY month) AS n
    FROM skill_share"""

STEPS["skill_demand"] = """
    SELECT now.month, now.geo_id, now.role_id, now.skill_id, now.skill_name,
           now.skill_posting_count, now.role_posting_count, now.share_within_role,
           100e0 * (now.skill_posting_count - past.skill_posting_count)
               / nullif(past.skill_posting_count, 0) AS yoy_growth
    FROM skill_numbered now
    LEFT JOIN skill_numbered past
           ON past.geo_id = now.geo_id AND past.role_id = now.role_id
          AND past.skill_id = now.skill_id AND past.n = now.n - 12"""

STEPS["pairs"] = """
    SELECT month, role_id, skill_id, count(*) AS co_occurrence_count,
           row_number() OVER (PARTITION BY role_id, skill_id ORDER BY month) AS n
    FROM cs_postings GROUP BY month, role_id, skill_id"""

STEPS["pairs_12m"] = """
    SELECT now.month, now.role_id, now.skill_id, now.co_occurrence_count,
           CAST(sum(past.co_occurrence_count) AS BIGINT) AS co_occurrence_12m
    FROM pairs now
    JOIN pairs past ON past.role_id = now.role_id AND past.skill_id = now.skill_id
         AND past.n BETWEEN now.n - 11 AND now.n
    GROUP BY now.month, now.role_id, now.skill_id, now.co_occurrence_count"""

STEPS["marginals"] = """
    SELECT month, 'role' AS level, role_id, CAST(NULL AS VARCHAR) AS skill_id, count(*) AS total
    FROM cs_postings GROUP BY month, role_id
    UNION ALL
    SELECT month, 'skill', NULL, skill_id, count(*) FROM cs_postings GROUP BY month, skill_id
    UNION ALL
    SELECT month, 'all', NULL, NULL, count(*) FROM cs_postings GROUP BY month"""

STEPS["associations"] = """
    SELECT p.month, p.role_id, p.skill_id, p.co_occurrence_12m AS co_occurrence_count,
           CAST(p.co_occurrence_12m AS DOUBLE) / r.total AS p_skill_given_role,
           (CAST(p.co_occurrence_12m AS DOUBLE) / r.total)
               / (CAST(s.total AS DOUBLE) / a.total) AS lift
    FROM pairs_12m p
    JOIN marginals r ON r.level = 'role' AND r.month = p.month AND r.role_id = p.role_id
    JOIN marginals s ON s.level = 'skill' AND s.month = p.month AND s.skill_id = p.skill_id
    JOIN marginals a ON a.level = 'all' AND a.month = p.month"""

STEPS["paid_postings"] = "SELECT * FROM cs_postings WHERE salary_usd > 0"

STEPS["salary_distribution"] = """
    SELECT month, geo_id, industry_id, role_id,
           round(quantile_cont(salary_usd, 0.25), 6) + 0e0 AS salary_p25,
           round(quantile_cont(salary_usd, 0.5), 6) + 0e0 AS salary_p50,
           round(quantile_cont(salary_usd, 0.75), 6) + 0e0 AS salary_p75
    FROM paid_postings GROUP BY month, geo_id, industry_id, role_id"""

STEPS["month_totals"] = """
    SELECT month, sum(posting_count) AS month_total FROM monthly_demand GROUP BY month"""

STEPS["rows_numbered"] = """
    SELECT 'role' AS entity_type, role_id AS entity_id, *,
           row_number() OVER (PARTITION BY role_id ORDER BY month, geo_id, industry_id)
               AS observed_months
    FROM job_demand"""

STEPS["rows_measured"] = """
    SELECT now.entity_type, now.entity_id, now.month, now.geo_id, now.industry_id,
           now.posting_count, now.yoy_growth, now.rolling_3m_growth, now.acceleration,
           now.observed_months, spread.volatility_12m
    FROM rows_numbered now
    JOIN (
        SELECT here.entity_id, here.observed_months,
               stddev_pop(past.yoy_growth) AS volatility_12m
        FROM rows_numbered here
        JOIN rows_numbered past ON past.entity_id = here.entity_id
             AND past.observed_months BETWEEN here.observed_months - 11 AND here.observed_months
        GROUP BY here.entity_id, here.observed_months
    ) spread USING (entity_id, observed_months)"""

STEPS["role_filled"] = """
    SELECT role_id, month, n, CAST(sum(posting_count) AS BIGINT) AS posting_count
    FROM demand_filled GROUP BY role_id, month, n"""

STEPS["role_grown"] = """
    SELECT now.role_id, now.month, now.n, now.posting_count,
           100e0 * (now.posting_count - year_ago.posting_count)
               / nullif(year_ago.posting_count, 0) AS yoy_growth,
           100e0 * (now.posting_count - quarter_ago.posting_count)
               / nullif(quarter_ago.posting_count, 0) AS rolling_3m_growth
    FROM role_filled now
    LEFT JOIN role_filled year_ago
           ON year_ago.role_id = now.role_id AND year_ago.n = now.n - 12
    LEFT JOIN role_filled quarter_ago
           ON quarter_ago.role_id = now.role_id AND quarter_ago.n = now.n - 3"""

STEPS["role_series"] = """
    SELECT now.*, now.yoy_growth - past.yoy_growth AS acceleration
    FROM role_grown now
    LEFT JOIN role_grown past ON past.role_id = now.role_id AND past.n = now.n - 1"""

STEPS["roles_measured"] = """
    SELECT 'role' AS entity_type, now.role_id AS entity_id, now.month, now.posting_count,
           now.yoy_growth, now.rolling_3m_growth, now.acceleration, now.n AS observed_months,
           (SELECT stddev_pop(past.yoy_growth) FROM role_series past
            WHERE past.role_id = now.role_id AND past.n BETWEEN now.n - 11 AND now.n)
               AS volatility_12m
    FROM role_series now"""


def _features(measured: str) -> str:
    return f"""
    SELECT entity_type, entity_id, month, posting_count, yoy_growth, rolling_3m_growth,
           acceleration, volatility_12m,
           CAST(posting_count AS DOUBLE) / nullif(month_total, 0) AS demand_concentration_index,
           0.5e0 * ifnull(yoy_growth, 0) + 0.3e0 * ifnull(rolling_3m_growth, 0)
               + 0.2e0 * ifnull(acceleration, 0) AS momentum_score,
           'phase1-v1' AS feature_version, TIMESTAMP '2026-04-01 00:00:00' AS run_timestamp,
           '2026.04' AS cs_allowlist_version,
           DATE '2023-01-01' AS train_start_month, DATE '2025-01-01' AS validation_start_month
    FROM {measured} JOIN month_totals USING (month)
    WHERE observed_months >= 36"""


def _labels(features: str) -> str:
    return f"""
    SELECT entity_type, entity_id, month,
           CASE
               WHEN yoy_growth IS NULL THEN 'uncertain'
               WHEN yoy_growth >= 10 AND posting_count < 200 AND acceleration >= 5 THEN 'emerging'
               WHEN yoy_growth >= 5 AND ifnull(volatility_12m, 0) < 15 THEN 'stable_growth'
               WHEN yoy_growth >= -2 AND yoy_growth <= 5 AND acceleration < 0 THEN 'plateau'
               WHEN yoy_growth < -2 THEN 'declining'
               ELSE 'uncertain'
           END AS trajectory_class,
           momentum_score AS trajectory_score,
           round(CASE
               WHEN volatility_12m IS NULL THEN 1e0
               WHEN volatility_12m >= 100 THEN 0e0
               ELSE 1e0 - volatility_12m / 100e0 END, 6) + 0e0 AS confidence,
           'phase1_rules' AS method, 'phase1-v1' AS label_version, 'rules-v1' AS method_version,
           TIMESTAMP '2026-04-01 00:00:00' AS run_timestamp
    FROM {features}"""


STEPS["features_row"] = _features("rows_measured")
STEPS["features_role"] = _features("roles_measured")
STEPS["labels_row"] = _labels("features_row")
STEPS["labels_role"] = _labels("features_role")

STEPS["runs_known"] = """
    SELECT 'run_' || role_id AS run_id, min(month) AS source_start_month,
           max(month) AS source_end_month, count(*) AS row_count
    FROM role_postings GROUP BY role_id"""
STEPS["runs_all"] = """
    SELECT 'run_' || role_id AS run_id, min(month) AS source_start_month,
           max(month) AS source_end_month, count(*) AS row_count
    FROM base_postings GROUP BY role_id"""

STEPS["month_counts"] = """
    SELECT strftime(post_date, '%Y-%m') AS label, count(*) AS posting_count
    FROM postings WHERE post_date IS NOT NULL GROUP BY ALL"""

STEPS["post_span"] = "SELECT min(post_date) AS first_day, max(post_date) AS final_day FROM postings"

STEPS["periods"] = """
    SELECT strftime(m, '%Y-%m') AS label,
           greatest(CAST(m AS DATE), first_day) AS span_start,
           least(last_day(m), final_day) AS span_end
    FROM (SELECT first_day, final_day,
                 unnest(generate_series(CAST(date_trunc('month', first_day) AS TIMESTAMP),
                                        CAST(final_day AS TIMESTAMP), INTERVAL 1 MONTH)) AS m
          FROM post_span)"""

STEPS["counted_periods"] = """
    SELECT label, span_start, span_end, ifnull(posting_count, 0) AS posting_count
    FROM periods LEFT JOIN month_counts USING (label)"""

_NAMES = "|".join(sorted(STEPS, key=len, reverse=True))


def _refers_to(sql: str) -> list[str]:
    return re.findall(rf"(?:FROM|JOIN|,)\s+({_NAMES})\b(?!\.)", sql)


def with_steps(sql: str) -> str:
    """``sql`` behind the steps it needs."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name not in ordered:
            for needed in _refers_to(STEPS[name]):
                if needed != name:
                    add(needed)
            ordered.append(name)

    for name in _refers_to(sql):
        add(name)
    if not ordered:
        return sql
    steps = ",\n".join(f"{name} AS MATERIALIZED ({STEPS[name]})" for name in ordered)
    return f"WITH {steps}\n{sql}"


def oracle(name: str, sql: str) -> None:
    ORACLES[name] = with_steps(sql)


# --- extraction ----------------------------------------------------------------------------------

oracle(
    "extract_window",
    """SELECT * FROM postings
    WHERE post_date >= DATE '1996-02-15' AND post_date < DATE '2000-03-01'
      AND role_k17000_v3 IN ('Economy', 'Promo')""",
)
oracle("month_periods", "SELECT * FROM counted_periods")
for _name, _way in (("first_months", "ASC"), ("last_months", "DESC")):
    oracle(
        _name,
        f"""SELECT label, job_id, post_date, role_k17000_v3 FROM postings
        JOIN (SELECT label FROM counted_periods ORDER BY label {_way} LIMIT 6)
          ON strftime(post_date, '%Y-%m') = label""",
    )
oracle(
    "extraction_run",
    """SELECT rcid, company, CAST(year(post_date) AS INTEGER) AS year, CAST(month(post_date) AS INTEGER) AS month,
           count(*) AS posting_count
    FROM postings LEFT JOIN company_mapping USING (rcid)
    WHERE post_date BETWEEN DATE '1997-09-01' AND DATE '2000-02-29' AND role_k17000_v3 IN ('Economy', 'Promo')
    GROUP BY ALL""",
)
oracle(
    "cap_rows_by_month",
    """SELECT job_id, rcid, post_date, role_k17000_v3, salary FROM postings
    WHERE post_date IS NOT NULL
    ORDER BY post_date, job_id, rcid NULLS FIRST, role_k17000_v3 NULLS FIRST, salary NULLS FIRST
    LIMIT 20000""",
)
oracle(
    "company_for_postings",
    """SELECT rcid, company, rics_k200, rics_k50 FROM company_mapping
    WHERE rcid IN (SELECT rcid FROM postings
                   WHERE post_date BETWEEN DATE '1996-02-15' AND DATE '2000-02-29')""",
)
oracle(
    "dedupe_company",
    """SELECT DISTINCT ON (rcid) rcid, post_date, job_id, country, skill_id FROM postings
    WHERE rcid IS NOT NULL AND post_date IS NOT NULL
    ORDER BY rcid, post_date, job_id, country NULLS FIRST, skill_id NULLS FIRST""",
)
oracle("company_full", "SELECT rcid, company, rics_k50, rics_k200 FROM company_mapping")
oracle("regions_scan", "SELECT country, region FROM regions")
oracle(
    "partition_columns",
    """SELECT job_id, post_date, CAST(year(post_date) AS INTEGER) AS year,
           CAST(month(post_date) AS INTEGER) AS month
    FROM postings WHERE post_date IS NOT NULL""",
)
oracle(
    "monthly_roundtrip",
    """SELECT CAST(year(post_date) AS INTEGER) AS year, CAST(month(post_date) AS INTEGER) AS month,
           count(*) AS posting_count, CAST(sum(job_id) AS BIGINT) AS job_id_sum,
           count(role_k17000_v3) AS role_count
    FROM postings WHERE post_date IS NOT NULL GROUP BY ALL""",
)
oracle(
    "drifting_months",
    """SELECT CAST(year(post_date) AS INTEGER) AS year, CAST(month(post_date) AS INTEGER) AS month,
           count(*) AS posting_count, CAST(sum(job_id) AS BIGINT) AS job_id_sum,
           count(rcid) FILTER (post_date <= DATE '1998-06-30') AS rcid_count,
           count(TRY_CAST(salary AS DOUBLE)) AS salary_count
    FROM postings WHERE post_date IS NOT NULL GROUP BY ALL""",
)
oracle(
    "union_months",
    """SELECT job_id, post_date, role_k17000_v3, metro_area FROM postings
    WHERE post_date IS NOT NULL""",
)
oracle(
    "allowlist_roles",
    """SELECT column0 AS role_id, column1 AS role_name, ifnull(c, 0) AS posting_count
    FROM (VALUES ('ECONOMY', 'economy role'), ('LARGE', 'large role'), ('PROMO', 'promo role')) v(column0, column1)
    LEFT JOIN (SELECT role_id, count(*) AS c FROM base_postings GROUP BY role_id)
           ON role_id = column0""",
)
oracle(
    "allowlist_skills",
    """SELECT column0 AS skill_id, column1 AS skill_name, ifnull(c, 0) AS posting_count
    FROM (VALUES ('BRAND#12', 'Brand#12'), ('BRAND#7', 'Brand#7')) v(column0, column1)
    LEFT JOIN (SELECT skill_id, count(*) AS c FROM base_postings GROUP BY skill_id)
           ON skill_id = column0""",
)
oracle(
    "run_manifest",
    """SELECT 'run_standin' AS run_id, 'snapshot' AS source,
           (SELECT count(*) FROM postings) AS postings_rows, 'postings' AS postings_path,
           '1995-01-01' AS range_start, '2001-12-31' AS range_end,
           (SELECT count(*) FROM company_mapping WHERE rcid IN (SELECT rcid FROM postings))
               AS company_rows,
           'postings_rcid' AS company_scope,
           (SELECT count(*) FROM regions) AS regions_rows,
           CAST(3 AS BIGINT) AS cs_allowlist_size, 'role_frequency' AS taxonomy_report""",
)

# --- staging and universe ------------------------------------------------------------------------

oracle("raw_postings", "SELECT * FROM raw_postings")
oracle("base_postings", "SELECT * FROM base_postings")
oracle("cs_postings", "SELECT * FROM cs_postings")
oracle("cs_postings_passthrough", "SELECT * FROM base_postings")
oracle("cs_postings_skill_only", "SELECT * FROM skill_postings")
oracle("valid_salary", "SELECT * FROM paid_postings")
oracle(
    "role_in_list",
    """SELECT job_id, role_k17000_v3, post_date FROM postings
    WHERE role_k17000_v3 = 'Economy' OR role_k17000_v3 = 'PROMO'""",
)
oracle(
    "industry_enrichment",
    """SELECT job_id, p.rcid, post_date, rics_k200, rics_k50
    FROM postings p LEFT JOIN company_mapping c ON c.rcid = p.rcid""",
)
oracle(
    "region_enrichment",
    """SELECT p.country, job_id, post_date, ifnull(region, 'Unknown') AS region
    FROM postings p LEFT JOIN regions r ON r.country = p.country""",
)
oracle(
    "dim_role",
    """SELECT role_id, role_name, count(b.month) AS posting_count
    FROM (VALUES ('ECONOMY', 'economy role'), ('LARGE', 'large role'), ('PROMO', 'promo role')) v(role_id, role_name)
    LEFT JOIN base_postings b USING (role_id, role_name) GROUP BY role_id, role_name""",
)
oracle(
    "dim_skill",
    """SELECT skill_id, skill_name, count(b.month) AS posting_count
    FROM (VALUES ('BRAND#12', 'Brand#12'), ('BRAND#7', 'Brand#7')) v(skill_id, skill_name)
    LEFT JOIN base_postings b USING (skill_id, skill_name) GROUP BY skill_id, skill_name""",
)
oracle(
    "allowlist_sizes",
    """SELECT (SELECT count(*) FROM (SELECT DISTINCT role_id, role_name FROM role_postings))
               AS role_allowlist_size,
           (SELECT count(*) FROM (SELECT DISTINCT skill_id, skill_name FROM skill_postings))
               AS skill_allowlist_size""",
)
oracle("entities", "SELECT role_id, geo_id, industry_id FROM entities")
oracle("months", "SELECT month FROM month_numbers")
oracle("entity_month_panel", "SELECT month, role_id, geo_id, industry_id FROM panel")
oracle(
    "scalar_normalisation",
    """SELECT job_id,
           make_date(year(post_date), month(post_date), 1) AS month,
           strftime(post_date, '%Y-%m') AS month_label,
           CAST(year(post_date) AS INTEGER) AS post_year,
           CAST(month(post_date) AS INTEGER) AS post_month,
           last_day(post_date) AS month_end,
           post_date + 1 AS next_day,
           post_date AS parsed_day,
           upper(ifnull(role_k17000_v3, 'UNK')) AS role_id,
           coalesce(metro_area, state, country, 'UNK') AS geo_id,
           TRY_CAST(salary AS DOUBLE) AS salary_usd,
           least(1e0, greatest(0e0, TRY_CAST(salary AS DOUBLE) / 50000e0)) AS clamped,
           1000e0 / nullif(TRY_CAST(salary AS DOUBLE), 0) AS safe_ratio,
           CASE WHEN TRY_CAST(salary AS DOUBLE) > 50000 THEN 'high'
                WHEN TRY_CAST(salary AS DOUBLE) > 0 THEN 'low' ELSE 'none' END AS band
    FROM postings WHERE post_date IS NOT NULL""",
)

# --- marts and their steps -----------------------------------------------------------------------

oracle("monthly_demand", "SELECT * FROM monthly_demand")
oracle("demand_filled", "SELECT * EXCLUDE (n) FROM demand_filled")
oracle("job_demand", "SELECT * FROM job_demand")
oracle("incremental_job_demand", "SELECT * FROM job_demand")
for _name, _metric in (
    ("demand_yoy", "yoy_growth"),
    ("demand_3m_growth", "rolling_3m_growth"),
    ("demand_acceleration", "acceleration"),
):
    oracle(
        _name,
        f"SELECT month, geo_id, industry_id, role_id, posting_count, {_metric} FROM job_demand",
    )
oracle("skill_monthly", "SELECT * FROM skill_monthly")
oracle("role_totals", "SELECT * FROM role_totals")
oracle("skill_share", "SELECT * FROM skill_share")
oracle("skill_demand", "SELECT * FROM skill_demand")
oracle("skill_yoy", "SELECT month, geo_id, role_id, skill_id, yoy_growth FROM skill_demand")
oracle("cooccurrence_monthly", "SELECT month, role_id, skill_id, co_occurrence_count FROM pairs")
oracle("cooccurrence_12m", "SELECT * FROM pairs_12m")
oracle("assoc_marginals", "SELECT * FROM marginals")
oracle("role_skill_associations", "SELECT * FROM associations")
oracle("salary_distribution", "SELECT * FROM salary_distribution")

_ROUNDED = "* REPLACE (round(volatility_12m, 6) + 0e0 AS volatility_12m)"
oracle(
    "volatility_12m",
    """SELECT entity_type, entity_id, month, geo_id, industry_id, yoy_growth,
           round(volatility_12m, 6) + 0e0 AS volatility_12m
    FROM rows_measured""",
)
oracle(
    "observed_months",
    "SELECT entity_type, entity_id, month, geo_id, industry_id, observed_months FROM rows_numbered",
)
oracle(
    "demand_concentration",
    """SELECT month, geo_id, industry_id, role_id, posting_count,
           CAST(posting_count AS DOUBLE) / month_total AS demand_concentration_index
    FROM demand_filled JOIN month_totals USING (month)""",
)
oracle(
    "min_history_gate",
    """SELECT 'role' AS entity_type, role_id AS entity_id, month, posting_count,
           n AS observed_months
    FROM role_filled WHERE n >= 36""",
)
oracle(
    "with_run_context",
    """SELECT role_id, month, posting_count, yoy_growth, rolling_3m_growth, acceleration,
           TIMESTAMP '2026-04-01 00:00:00' AS run_timestamp, 'phase1-v1' AS feature_version,
           'phase1-v1' AS label_version, 'rules-v1' AS method_version,
           '2026.04' AS cs_allowlist_version
    FROM role_series""",
)
for _grain in ("row", "role"):
    oracle(f"trajectory_features_{_grain}", f"SELECT {_ROUNDED} FROM features_{_grain}")
    oracle(f"trajectory_labels_{_grain}", f"SELECT * FROM labels_{_grain}")
oracle(
    "label_distribution",
    "SELECT trajectory_class, count(*) AS label_count FROM labels_role GROUP BY trajectory_class",
)

# --- samples and lookups -------------------------------------------------------------------------

for _name, _table, _count, _key in (
    ("snapshot_demand", "job_demand", "posting_count", "geo_id, industry_id, role_id"),
    ("snapshot_skill", "skill_demand", "skill_posting_count", "geo_id, role_id, skill_id"),
    ("snapshot_assoc", "associations", "co_occurrence_count", "role_id, skill_id"),
):
    oracle(
        _name,
        f"""SELECT * FROM {_table} WHERE {_count} >= 5
        ORDER BY month DESC, {_count} DESC, {_key} LIMIT 25000""",
    )
oracle(
    "snapshot_salary",
    """SELECT * FROM salary_distribution
    ORDER BY month DESC, geo_id, industry_id, role_id LIMIT 25000""",
)
oracle(
    "snapshot_features",
    f"SELECT {_ROUNDED} FROM features_role ORDER BY month DESC, entity_type, entity_id LIMIT 25000",
)
oracle(
    "snapshot_labels",
    "SELECT * FROM labels_role ORDER BY month DESC, entity_type, entity_id LIMIT 25000",
)
oracle("snapshot_threshold", "SELECT * FROM job_demand WHERE posting_count >= 5")
oracle("lookup_role_demand", "SELECT * FROM job_demand WHERE role_id = 'ECONOMY'")
oracle("lookup_industry_demand", "SELECT * FROM job_demand WHERE industry_id = 'ASIA'")
oracle("lookup_skill_demand", "SELECT * FROM skill_demand WHERE skill_id = 'BRAND#12'")
oracle(
    "lookup_salary",
    "SELECT * FROM salary_distribution WHERE role_id = 'PROMO' AND geo_id = 'BUILDING'",
)
oracle(
    "top_lift_per_month",
    """SELECT *, CAST(row_number() OVER (
               PARTITION BY month ORDER BY lift DESC NULLS LAST, role_id, skill_id) AS INTEGER)
               AS lift_rank
    FROM associations QUALIFY lift_rank <= 10""",
)
oracle(
    "latest_label",
    """SELECT * FROM labels_role
    WHERE (entity_id, month) IN (SELECT (entity_id, max(month)) FROM labels_role GROUP BY entity_id)""",
)

# --- reports, contracts, metadata ----------------------------------------------------------------

oracle(
    "role_frequency",
    """SELECT ifnull(role_k17000_v3, 'NULL') AS role_k17000_v3, count(job_id) AS posting_count,
           ifnull(role_k17000_v3 IN ('Economy', 'Large', 'Promo'), false) AS in_allowlist
    FROM postings GROUP BY role_k17000_v3""",
)

_MART_STEPS = {
    "job_demand": "job_demand",
    "skill_demand": "skill_demand",
    "role_skill_associations": "associations",
    "salary_distribution": "salary_distribution",
    "trajectory_features": "features_role",
    "trajectory_labels": "labels_role",
}
_REQUIRED = {
    "job_demand": (
        "month",
        "geo_id",
        "geo_name",
        "industry_id",
        "industry_name",
        "role_id",
        "role_name",
        "posting_count",
    ),
    "skill_demand": (
        "month",
        "geo_id",
        "role_id",
        "skill_id",
        "skill_name",
        "skill_posting_count",
        "role_posting_count",
    ),
    "role_skill_associations": (
        "month",
        "role_id",
        "skill_id",
        "co_occurrence_count",
    ),
    "salary_distribution": (
        "month",
        "geo_id",
        "industry_id",
        "role_id",
    ),
    "trajectory_features": (
        "entity_type",
        "entity_id",
        "month",
        "posting_count",
        "feature_version",
        "run_timestamp",
        "cs_allowlist_version",
        "train_start_month",
        "validation_start_month",
    ),
    "trajectory_labels": (
        "entity_type",
        "entity_id",
        "month",
        "trajectory_class",
        "method",
        "label_version",
        "method_version",
        "run_timestamp",
    ),
}
_KEYS = {
    "job_demand": ("month", "geo_id", "industry_id", "role_id"),
    "skill_demand": ("month", "geo_id", "role_id", "skill_id"),
    "role_skill_associations": ("month", "role_id", "skill_id"),
    "salary_distribution": ("month", "geo_id", "industry_id", "role_id"),
    "trajectory_features": ("entity_type", "entity_id", "month", "feature_version"),
    "trajectory_labels": ("entity_type", "entity_id", "month", "label_version", "method_version"),
}


def _each_mart(statement) -> str:
    return "\nUNION ALL\n".join(statement(mart, step) for mart, step in _MART_STEPS.items())


oracle(
    "table_row_counts",
    _each_mart(lambda m, t: f"SELECT '{m}' AS table_name, count(*) AS row_count FROM {t}"),
)
oracle(
    "validate_non_negative",
    "SELECT count(*) AS negative_rows FROM job_demand WHERE posting_count < 0",
)
oracle(
    "contract_not_null",
    _each_mart(
        lambda m, t: "\nUNION ALL\n".join(
            f"SELECT '{m}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS null_rows"
            f" FROM {t}"
            for c in _REQUIRED[m]
        )
    ),
)
oracle(
    "contract_pk",
    _each_mart(
        lambda m, t: f"""SELECT '{m}' AS table_name, count(*) AS repeated_keys,
           CAST(ifnull(sum(r - 1), 0) AS BIGINT) AS surplus_rows
    FROM (SELECT count(*) AS r FROM {t} GROUP BY {", ".join(_KEYS[m])} HAVING count(*) > 1)"""
    ),
)
oracle(
    "contract_pk_trajectory",
    """SELECT entity_type, entity_id, month, feature_version, count(*) AS key_rows
    FROM features_row GROUP BY entity_type, entity_id, month, feature_version
    HAVING count(*) > 1""",
)
oracle(
    "register_run",
    """SELECT * FROM runs_known
    UNION ALL
    SELECT * FROM runs_all WHERE run_id NOT IN (SELECT run_id FROM runs_known)""",
)
oracle(
    "contract_fk", "SELECT * FROM runs_all WHERE run_id NOT IN (SELECT run_id FROM runs_known)"
)
oracle(
    "source_lineage",
    """SELECT 'run_standin' AS run_id, source_name, 'snapshot/' || source_name AS source_path,
           row_count
    FROM (SELECT 'postings' AS source_name, count(*) AS row_count FROM postings
          UNION ALL SELECT 'company_mapping', count(*) FROM company_mapping
          UNION ALL SELECT 'regions', count(*) FROM regions)""",
)
oracle(
    "pipeline_run",
    """SELECT 'run_standin' AS run_id, TIMESTAMP '2026-04-01 00:00:00' AS run_timestamp,
           CAST(date_trunc('month', first_day) AS DATE) AS source_start_month,
           CAST(date_trunc('month', final_day) AS DATE) AS source_end_month,
           'phase1-v1' AS feature_version, 'phase1-v1' AS label_version,
           'rules-v1' AS method_version, '2026.04' AS cs_allowlist_version, 'local load' AS notes
    FROM post_span""",
)
oracle(
    "model_eval_splits",
    """SELECT 'run_standin:' || entity_type AS split_id, 'run_standin' AS run_id, entity_type,
           DATE '1998-01-01' AS train_start_month,
           max(month) FILTER (month < DATE '2000-01-01') AS train_end_month,
           DATE '2000-01-01' AS validation_start_month,
           max(month) FILTER (month BETWEEN DATE '2000-01-01' AND DATE '2000-12-31')
               AS validation_end_month,
           DATE '2001-01-01' AS test_start_month,
           max(month) FILTER (month >= DATE '2001-01-01') AS test_end_month
    FROM features_role WHERE month >= DATE '1998-01-01' GROUP BY entity_type""",
)
oracle(
    "monthly_lineage",
    """SELECT CAST(year(post_date) AS INTEGER) AS year, CAST(month(post_date) AS INTEGER) AS month,
           count(*) AS row_count, strftime(min(post_date), '%Y-%m') = '1998-03' AS changed
    FROM postings
    WHERE post_date IS NOT NULL AND (strftime(post_date, '%Y-%m') <> '1998-03' OR job_id % 3 > 0)
    GROUP BY 1, 2""",
)
oracle(
    "registered_sources",
    """SELECT 'run_standin' AS run_id, source_name, 'snapshot/' || source_name AS source_path, row_count,
           (SELECT CAST(date_trunc('month', min(post_date)) AS DATE) FROM postings) AS source_start_month,
           (SELECT CAST(date_trunc('month', max(post_date)) AS DATE) FROM postings) AS source_end_month
    FROM (SELECT 'postings' AS source_name, count(*) AS row_count FROM postings
          UNION ALL SELECT 'company_mapping', count(*) FROM company_mapping
          UNION ALL SELECT 'regions', count(*) FROM regions)""",
)
