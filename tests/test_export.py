"""What the export measures on the way, and how lookups read the exported marts."""

from dataclasses import replace
from datetime import date

import pytest

from tidemart import schemas
from tidemart.operators.universe import Allowlist
from tidemart.plans import build, contracts
from tidemart.settings import RunSettings
from tidemart.sinks import tables

DEMAND = schemas.MARTS["job_demand"]


def demand(spark, n, role="id % 50"):
    return spark.range(n).selectExpr(
        "date'2024-01-01' as month", "cast(id as string) as geo_id", "'g' as geo_name", "'I' as industry_id",
        "'i' as industry_name", f"concat('R', {role}) as role_id", "'r' as role_name", "id as posting_count",
        "cast(null as double) as yoy_growth", "cast(null as double) as rolling_3m_growth", "cast(null as double) as acceleration",
    )


def test_measures_of_the_export_equal_those_of_the_table(spark, tmp_path):
    df = demand(spark, 5000).repartition(7).selectExpr(
        *[c for c in DEMAND.columns if c not in ("posting_count", "role_name")],
        "if(posting_count % 10 = 3, null, role_name) as role_name", "if(posting_count % 7 = 0, -1, posting_count) as posting_count",
    )
    checks = {"job_demand": contracts.column_checks(DEMAND)}
    counted = tables.export_marts({"job_demand": df}, str(tmp_path), checks)["job_demand"]
    stored = spark.read.parquet(f"{tmp_path}/job_demand.parquet")
    assert counted == stored.agg(*contracts.column_checks(DEMAND)).first().asDict()
    assert counted["null role_name"] == 500 and counted["negative posting_count"] == 715
    with pytest.raises(contracts.ContractError, match="null role_name"):
        contracts.require_contract(stored, "job_demand", DEMAND, counted)


def test_a_build_does_not_count_columns_again(spark, raw_source, frame, tmp_path, monkeypatch):
    rows = [{"job_id": i, "post_date": date(2024, 1 + i % 3, 2), "role_k17000_v3": "D", "rcid": 1, "salary": "5"} for i in range(30)]
    settings = RunSettings(source_root=str(tmp_path / "s"), output_root=str(tmp_path / "o"), min_observations=1)
    tables.write_monthly(raw_source(rows), f"{settings.source_root}/postings")
    tables.write_table(frame(schemas.COMPANY, [{"rcid": 1}]), f"{settings.source_root}/company_mapping")
    given = []
    real = build.require_contract
    monkeypatch.setattr(build, "require_contract", lambda df, name, contract, counted: given.append((name, counted)) or real(df, name, contract, counted))
    roles = Allowlist("role", (("D", "d"),))
    build.run_build(spark, roles, Allowlist("skill"), settings)
    assert [name for name, _ in given] == list(schemas.MARTS)
    assert all(counted and not any(counted.values()) for _, counted in given)
    with pytest.raises(contracts.ContractError, match="lacks columns"):
        monkeypatch.setattr(build, "build_marts", lambda *a: {n: frame(c.schema, []).drop("month") for n, c in schemas.MARTS.items()})
        build.run_build(spark, roles, Allowlist("skill"), replace(settings, run_id="other"))


def scanned_rows(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_lookups_skip_what_lacks_the_id(spark, tmp_path):
    # Every file holds ids from one end of the alphabet to the other, so only the filters tell that one is absent.
    df = demand(spark, 40_000, role="lpad(id * 7919 % 40000, 6, '0')")
    order = tables.LOOKUP_ORDER["job_demand"]
    tables.write_mart(df, str(tmp_path / "sorted"), order)
    stored = spark.read.parquet(str(tmp_path / "sorted"))
    assert scanned_rows(stored.where("role_id = 'R000123'")) < 40_000
    assert scanned_rows(stored.where("geo_id = '12345x'")) == 0
    assert stored.where("geo_id = '12345'").count() == 1
