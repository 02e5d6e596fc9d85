"""Properties of the executed plans that matter at scale."""

import re

import pytest

import __spark_entry__ as spark_entry

FOLDER = "/root/testdata/sf0.001"


def executed(spark, name):
    df = spark_entry.queries()[name](spark, FOLDER)
    df.toArrow()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


@pytest.mark.parametrize(
    "name",
    [
        "job_demand",
        "skill_demand",
        "assoc_marginals",
        "role_skill_associations",
        "salary_distribution",
        "trajectory_labels_role",
        "trajectory_labels_row",
        "entity_month_panel",
    ],
)
def test_marts_read_the_postings_once(spark, name):
    # The static plan: an adaptive one no longer shows branches that ran and turned out empty.
    spark.conf.set("spark.sql.adaptive.enabled", False)
    plan = spark_entry.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(re.findall(r"FileScan parquet \[l_", plan)) == 1
    assert "CartesianProduct" not in plan


def test_scan_is_pruned_and_filtered(spark):
    plan = executed(spark, "job_demand")
    scan = re.search(r"FileScan parquet \[(l_[^\]]*)\]", plan).group(1)
    assert "l_extendedprice" not in scan and "l_quantity" not in scan
    assert "l_linenumber" in scan and "l_shipdate" in scan


def test_extraction_pushes_the_window_down(spark, tmp_path):
    from datetime import date

    from tidemart.sources.extract import extract_postings
    from tidemart.workload import standin

    path = str(tmp_path)
    standin.postings(spark, FOLDER).write.parquet(path, mode="overwrite")
    df = extract_postings(
        spark.read.parquet(path),
        date(1996, 1, 1),
        date(1996, 12, 31),
        roles=["Economy"],
        columns=["job_id"],
    )
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    plan = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)
    assert "GreaterThanOrEqual(post_date,1996-01-01)" in pushed
    assert "LessThan(post_date,1997-01-01)" in pushed and "EqualTo(role_k17000_v3,Economy)" in pushed
    read = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert {field.split(":")[0] for field in read.split(",")} == {"job_id", "post_date", "role_k17000_v3"}


def test_growth_shares_one_shuffle(spark):
    """After the entity exchange, filling the panel and all windows stay in place."""
    plan = executed(spark, "job_demand")
    above = plan[: plan.index("REPARTITION_BY_COL")]
    hashed = [line for line in above.splitlines() if "Exchange hashpartitioning" in line]
    assert len(hashed) == 1
