"""Extraction runs, snapshots put together from them, and months that differ in schema."""

import re
from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemart import schemas
from tidemart.operators.universe import Allowlist
from tidemart.plans import extraction
from tidemart.plans.build import read_sources, run_build
from tidemart.settings import RunSettings
from tidemart.sinks import tables
from tidemart.sources import extract, snapshot

SETTINGS = RunSettings(
    run_id="one", run_timestamp=datetime(2026, 4, 1), extract_start=date(2024, 1, 1), extract_end=date(2024, 6, 30),
    min_observations=1,
)


def posting(i, day, rcid=1, role="Data", salary="50000"):
    return {
        "job_id": i, "post_date": day, "rcid": rcid, "role_k17000_v3": role, "role_k1500_v2": role, "salary": salary,
        "country": "C",
    }


@pytest.fixture
def source(raw_source):
    rows = [posting(i, date(2024, 1 + i % 6, 1 + i % 28), rcid=i % 4 or None) for i in range(60)]
    rows += [posting(100, date(2023, 12, 31)), posting(101, date(2024, 7, 1)), posting(102, None), posting(103, date(2024, 2, 2), role="Nurse")]
    return raw_source(rows)


@pytest.fixture
def company(frame):
    rows = [{"rcid": r, "company": c, "rics_k200": "I", "rics_k50": "i"} for r, c in ((1, "b"), (1, "a"), (2, "x"), (9, "z"))]
    return frame(schemas.COMPANY, rows)


@pytest.fixture
def regions(frame):
    return frame(schemas.REGIONS, [{"country": "C", "region": "R"}])


def ids(df):
    return sorted(r.job_id for r in df.select("job_id").collect())


def test_a_posting_table_becomes_a_snapshot_that_builds(spark, source, company, regions, tmp_path):
    settings = replace(SETTINGS, source_root=str(tmp_path / "s"), output_root=str(tmp_path / "out"))
    folder = extraction.run_extract(source, company, regions, settings, ["Data"])
    (run,) = extraction.committed_runs(spark, settings.source_root)
    assert run.tables.postings.rows == 60 and run.tables.postings.path == f"{folder}/postings"
    assert (run.tables.company_mapping.rows, run.tables.company_mapping.scope) == (2, "postings_rcid")
    assert run.tables.regions.rows == 1 and run.cs_allowlist_size == 1
    assert [(m.year, m.month, m.rows) for m in run.months] == [(2024, m, 10) for m in range(1, 7)]
    found = read_sources(spark, settings.source_root)
    assert ids(found.postings) == list(range(60))
    assert sorted((r.rcid, r.company) for r in found.company.collect()) == [(1, "a"), (2, "x")]
    report = spark.read.option("header", True).csv(run.taxonomy_report).collect()
    assert [(r.role_k17000_v3, r.posting_count) for r in report] == [("Data", "60")]
    marts = run_build(spark, Allowlist("role", (("Data", "data"),)), Allowlist("skill"), settings)
    assert marts["job_demand"].agg(F.sum("posting_count")).first()[0] == 60


def test_a_run_without_manifest_is_invisible(spark, source, company, regions, tmp_path, monkeypatch):
    settings = replace(SETTINGS, source_root=str(tmp_path))
    extraction.run_extract(source, company, regions, settings, ["Data"])

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    monkeypatch.setattr(extraction, "run_manifest", broken)
    later = replace(settings, run_id="two", run_timestamp=datetime(2026, 5, 1))
    with pytest.raises(RuntimeError, match="lost"):
        extraction.run_extract(source.limit(3), company, regions, later, [])
    assert snapshot.months_stored(spark, f"{tmp_path}/runs/two/postings")
    assert ids(read_sources(spark, str(tmp_path)).postings) == list(range(60))
    for taken in ("one", "two"):
        with pytest.raises(FileExistsError, match=taken):
            extraction.run_extract(source, company, regions, replace(settings, run_id=taken), [])


def test_later_runs_replace_their_months(spark, raw_source, source, company, frame, tmp_path):
    settings = replace(SETTINGS, source_root=str(tmp_path))
    extraction.run_extract(source, company, None, settings, ["Data"])
    newer = raw_source([posting(500, date(2024, 6, 3), rcid=2), posting(501, date(2024, 6, 4), rcid=7)])
    renamed = frame(schemas.COMPANY, [{"rcid": 2, "company": "new"}, {"rcid": 7, "company": "seven"}])
    later = replace(settings, run_id="two", run_timestamp=datetime(2026, 5, 1))
    extraction.run_extract(newer, renamed, None, later, [], extraction.ExtractOptions(last_months=1))
    found = extraction.read_snapshot(spark, str(tmp_path))
    assert ids(found.postings) == sorted([*[i for i in range(60) if i % 6 != 5], 500, 501])
    assert sorted((r.rcid, r.company) for r in found.company.collect()) == [(1, "a"), (2, "new"), (7, "seven")]
    assert found.regions.count() == 0


@pytest.mark.parametrize(
    "choice, months",
    [({"first_months": 2}, {1, 2}), ({"last_months": 2}, {5, 6}), ({"last_months": 0}, set()), ({"first_months": 99}, set(range(1, 7)))],
)
def test_chosen_months(spark, source, tmp_path, choice, months):
    options = extraction.ExtractOptions(company=extraction.LEFT_OUT, regions=False, **choice)
    by_month = str(tmp_path / "source")
    tables.write_monthly(source, by_month)
    for name, df in (("flat", source), ("stored", snapshot.read_monthly(spark, by_month))):
        settings = replace(SETTINGS, source_root=str(tmp_path / name))
        extraction.run_extract(df, None, None, settings, ["Data"], options)
        found = extraction.read_snapshot(spark, settings.source_root)
        assert ids(found.postings) == [i for i in range(60) if 1 + i % 6 in months]
        assert found.company.count() == 0 and found.company.columns == schemas.COMPANY.names


def test_options(spark, source, company, tmp_path):
    for bad in ({"company": "some"}, {"first_months": 1, "last_months": 1}):
        with pytest.raises(ValueError):
            extraction.ExtractOptions(**bad)
    settings = replace(SETTINGS, source_root=str(tmp_path))
    options = extraction.ExtractOptions(limit_rows=7, company=extraction.FULL)
    extraction.run_extract(source, company, None, settings, ["Data"], options)
    found = extraction.read_snapshot(spark, str(tmp_path))
    assert found.postings.count() == 7 and found.company.count() == 4


def test_periods_choose_folders_at_run_time(spark, source, tmp_path):
    path = str(tmp_path)
    tables.write_monthly(source, path)
    span = source.agg(F.min("post_date").alias("start"), F.max("post_date").alias("end"))
    periods = extract.select_periods(extract.periods_between(span), last=2)
    df = extract.postings_in_periods(snapshot.read_monthly(spark, path), periods)
    assert {r.label for r in df.collect()} == {"2024-06", "2024-07"}
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", plan)


def test_months_whose_types_differ(spark, tmp_path):
    path = str(tmp_path / "postings")
    first = spark.sql("select 1 as job_id, '50' as salary, 5.0D as rcid, date'2024-01-05' as post_date, 'x' as skill_id")
    second = spark.sql("select 2L as job_id, 60.5D as salary, 6L as rcid, '2024-02-05' as post_date")
    third = spark.sql("select '3' as job_id, cast(null as string) as salary, cast('nan' as double) as rcid, date'2024-03-05' as post_date, true as odd")
    fourth = spark.sql("select 4L as job_id, 'n/a' as salary, 7L as rcid, date'2024-04-05' as post_date, 5 as odd")
    for month, df in enumerate((first, second, third, fourth), 1):
        df.write.parquet(f"{path}/year=2024/month={month}")
    df = snapshot.read_monthly_or_empty(spark, path, snapshot.posting_file_schema())
    assert {f.name: f.dataType.simpleString() for f in df.schema if f.name in ("job_id", "salary", "rcid", "post_date", "odd")} == {
        "job_id": "bigint", "salary": "string", "rcid": "bigint", "post_date": "date", "odd": "string",
    }
    got = sorted((r.job_id, r.salary, r.rcid, r.post_date, r.skill_id, r.odd) for r in df.collect())
    assert got == [
        (1, "50", 5, date(2024, 1, 5), "x", None), (2, "60.5", 6, date(2024, 2, 5), None, None),
        (3, None, None, date(2024, 3, 5), None, "true"), (4, "n/a", 7, date(2024, 4, 5), None, "5"),
    ]
    with pytest.raises(ValueError, match="role_k17000_v3"):
        read_sources(spark, str(tmp_path))


def test_pruned_months_are_not_opened(spark, raw_source, tmp_path):
    path = tmp_path / "m s"
    tables.write_monthly(raw_source([posting(i, date(2024, i, 3)) for i in (1, 2, 3)]), str(path))
    for file in (path / "year=2024/month=3").glob("*.parquet"):
        file.write_bytes(b"no parquet file")
    some = snapshot.read_monthly(spark, str(path), start=date(2024, 1, 2), end=date(2024, 2, 28))
    assert ids(some) == [1, 2]
    assert snapshot.read_monthly(spark, str(path), end=date(2023, 1, 1)).count() == 0
    with pytest.raises(Exception, match="month=3"):
        snapshot.read_monthly(spark, str(path))


def test_same_months_share_one_scan(spark, raw_source, tmp_path):
    path = str(tmp_path)
    tables.write_monthly(raw_source([posting(i, date(2024, i, 3)) for i in (1, 2, 3)]), path)
    plan = snapshot.read_monthly(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
