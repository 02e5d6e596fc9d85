import csv
import json
from dataclasses import replace
from datetime import date
from glob import glob

import pytest
from pyspark.sql import functions as F

from tidemart import schemas
from tidemart.operators.topk import history, latest_per_entity, shareable_sample, strongest_per_month
from tidemart.plans import contracts, metadata, reports
from tidemart.plans.build import build_marts, make_sample, read_sources, run_build, validate_outputs
from tidemart.session import staged
from tidemart.settings import RunSettings, new_extract_id, new_run_id
from tidemart.sinks import jdbc, tables
from tidemart.sources import snapshot
from tidemart.workload import standin

SETTINGS = RunSettings(run_id="test")
JAN, FEB, MAR = (date(2024, m, 1) for m in (1, 2, 3))


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


# --- snapshots -----------------------------------------------------------------------------------


def test_rewriting_one_month_keeps_the_others(spark, folder):
    schema = "job_id long, post_date date"
    days = [(1, JAN), (2, FEB), (3, FEB), (4, MAR), (5, None)]
    tables.write_monthly(spark.createDataFrame(days, schema), folder)
    assert rows(snapshot.read_monthly(spark, folder).select("job_id")) == [(1,), (2,), (3,), (4,)]
    for _ in range(2):
        tables.write_monthly(spark.createDataFrame([(9, FEB)], schema), folder)
        assert rows(snapshot.read_monthly(spark, folder).select("job_id")) == [(1,), (4,), (9,)]


def test_date_range_prunes_folders(spark, folder):
    days = [(i, date(2023 + i // 12, i % 12 + 1, 15)) for i in range(24)]
    tables.write_monthly(spark.createDataFrame(days, "job_id long, post_date date"), folder)
    some = snapshot.read_monthly(spark, folder, start=date(2023, 12, 1), end=date(2024, 1, 31))
    assert rows(some.select("job_id")) == [(11,), (12,)]
    assert len(some.inputFiles()) == 2
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "PushedFilters: [IsNotNull(post_date)" in plan


def test_absent_sources_are_empty(spark, folder):
    sources = read_sources(spark, folder)
    assert sources.company.schema == schemas.COMPANY and sources.company.isEmpty()
    assert sources.regions.isEmpty() and sources.postings.isEmpty()
    marts = build_marts(sources, standin.ROLES, standin.SKILLS, SETTINGS)
    assert {name: df.count() for name, df in marts.items()} == dict.fromkeys(schemas.MARTS, 0)


def test_a_broken_source_is_not_taken_for_an_absent_one(spark, tmp_path):
    (tmp_path / "x.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        snapshot.read_or_empty(spark, str(tmp_path), schemas.REGIONS).count()


def test_staged_tables_are_read_back(spark, folder):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    out = staged(df, "t", folder)
    assert rows(out) == [(1, "a")] and out.schema == df.schema
    assert folder in out.inputFiles()[0]


# --- samples and lookups -------------------------------------------------------------------------


def test_sample_threshold_order_and_ties(frame):
    contract = schemas.MARTS["role_skill_associations"]
    data = [
        {"month": m, "role_id": r, "skill_id": s, "co_occurrence_count": n}
        for m, r, s, n in [
            (JAN, "A", "X", 99),
            (FEB, "B", "X", 7),
            (FEB, "A", "Y", 7),
            (FEB, "A", "X", 7),
            (FEB, "A", "Z", 4),
            (FEB, "C", "X", 8),
        ]
    ]
    df = frame(contract.schema, data)
    sample = shareable_sample(df, "role_skill_associations", 5, 3)
    assert [(r.role_id, r.skill_id) for r in sample.collect()] == [("C", "X"), ("A", "X"), ("A", "Y")]
    assert shareable_sample(df.repartition(4), "role_skill_associations", 5, 99).count() == 5


def test_lookups(frame):
    contract = schemas.MARTS["role_skill_associations"]
    data = [
        {"month": m, "role_id": r, "skill_id": "X", "lift": v}
        for m, r, v in [(JAN, "A", 1.0), (JAN, "B", 2.0), (JAN, "C", None), (FEB, "A", 3.0)]
    ]
    df = frame(contract.schema, data)
    top = strongest_per_month(df, 2)
    assert rows(top.select("month", "role_id", "lift_rank")) == [(JAN, "A", 2), (JAN, "B", 1), (FEB, "A", 1)]
    assert [r.month for r in history(df, ["skill_id"], role_id="A").collect()] == [FEB, JAN]
    assert rows(latest_per_entity(df, ["role_id"]).select("role_id", "month")) == [
        ("A", FEB),
        ("B", JAN),
        ("C", JAN),
    ]


# --- sinks ---------------------------------------------------------------------------------------


def test_export_and_sample(spark, folder):
    postings = standin.postings(spark, "/root/testdata/sf0.001")
    company = standin.company_mapping(spark, "/root/testdata/sf0.001")
    root = f"{folder}/raw"
    tables.write_monthly(postings, f"{root}/postings")
    tables.write_table(company, f"{root}/company_mapping")
    settings = RunSettings(
        run_id="test", source_root=root, output_root=f"{folder}/out", sample_root=f"{folder}/dev"
    )
    marts = run_build(spark, standin.ROLES, standin.SKILLS, settings)
    for name, contract in schemas.MARTS.items():
        assert marts[name].columns == contract.columns
        assert contracts.contract_report(marts[name], contract) == {}
        csv = spark.read.option("header", True).csv(f"{folder}/out/{name}.csv")
        assert csv.columns == contract.columns and csv.count() == marts[name].count()
    assert marts["job_demand"].count() == 26_975
    labels = marts["trajectory_labels"].groupBy("trajectory_class").count()
    assert dict(rows(labels)) == {"emerging": 50, "plateau": 9, "declining": 104, "uncertain": 125}

    assert set(make_sample(spark, settings)) == set(schemas.MARTS)
    sample = spark.read.option("header", True).csv(f"{folder}/dev/job_demand.csv")
    assert sample.where("cast(posting_count as long) < 5").count() == 0
    count = spark.read.option("header", True).csv(f"{folder}/dev/role_skill_associations.csv").first()
    assert count.co_occurrence_count.isdigit(), "counts are written as integers"


def test_lookup_layout_is_sorted(spark, folder):
    df = spark.range(1000).selectExpr("id", "cast(id % 7 as string) as role_id")
    tables.write_mart(df, folder, ["role_id", "id"])
    for path in glob(f"{folder}/*.parquet"):
        keys = [(r.role_id, r.id) for r in spark.read.parquet(path).collect()]
        assert keys == sorted(keys)


def test_empty_sample_keeps_the_old_one(spark, folder):
    df = spark.createDataFrame([(1,)], "n int")
    path = f"{folder}/s.csv"
    assert tables.replace_unless_empty(df.limit(0), path), "nothing there yet"
    assert tables.replace_unless_empty(df, path)
    assert not tables.replace_unless_empty(df.limit(0), path)
    assert spark.read.option("header", True).csv(path).count() == 1


class Writer:
    """Records what a JDBC write is asked to do; no database runs in the tests."""

    def __init__(self):
        self.calls = {}

    def format(self, name):
        self.calls["format"] = name
        return self

    def mode(self, name):
        self.calls["mode"] = name
        return self

    def option(self, name, value):
        self.calls[name] = value
        return self

    def save(self):
        self.calls["saved"] = True


class Frame:
    def __init__(self):
        self.write = Writer()


def test_jdbc_load_truncates_in_batches():
    frame = Frame()
    jdbc.load_mart(frame, "jdbc:x", "analytics.job_demand", properties={"user": "u"})
    calls = frame.write.calls
    assert (calls["mode"], calls["truncate"], calls["dbtable"]) == ("overwrite", True, "analytics.job_demand")
    assert calls["numPartitions"] == 16 and calls["user"] == "u" and calls["saved"]
    frame = Frame()
    jdbc.append_runs(frame, "jdbc:x")
    assert frame.write.calls["mode"] == "append"


def test_broken_mart_stops_publication(frame, monkeypatch):
    loaded = []
    monkeypatch.setattr(jdbc, "load_mart", lambda df, url, table, **_: loaded.append(table))
    marts = {name: frame(c.schema, []) for name, c in schemas.MARTS.items()}
    with pytest.raises(FileNotFoundError):
        jdbc.publish({"job_demand": marts["job_demand"]}, "jdbc:x")
    jdbc.publish(marts, "jdbc:x")
    assert loaded == [f"analytics.{name}" for name in schemas.MARTS]
    loaded.clear()
    marts["trajectory_labels"] = frame(schemas.MARTS["trajectory_labels"].schema, [{"month": JAN}])
    with pytest.raises(contracts.ContractError):
        jdbc.publish(marts, "jdbc:x")
    assert loaded == []


# --- contracts and metadata ----------------------------------------------------------------------


def test_contract_violations_are_named(frame):
    contract = schemas.MARTS["role_skill_associations"]
    good = {"month": JAN, "role_id": "A", "skill_id": "X", "co_occurrence_count": 1}
    assert contracts.contract_report(frame(contract.schema, [good]), contract) == {}
    bad = [good, good, {**good, "role_id": None, "co_occurrence_count": -1}]
    df = frame(contract.schema, bad)
    assert contracts.contract_report(df, contract) == {
        "null role_id": 1,
        "repeated key": 1,
        "negative co_occurrence_count": 1,
    }
    with pytest.raises(contracts.ContractError):
        contracts.require_contract(df, "role_skill_associations")
    with pytest.raises(contracts.ContractError):
        contracts.require_contract(df.drop("lift"), "role_skill_associations")


def test_register_run_never_changes_a_known_run(spark):
    schema = "run_id string, notes string"
    known = spark.createDataFrame([("a", "old")], schema)
    new = spark.createDataFrame([("a", "new"), ("b", "new"), ("b", "new")], schema)
    assert rows(metadata.register_run(known, new)) == [("a", "old"), ("b", "new")]
    assert contracts.orphans(new, known, "run_id").count() == 2


def test_checksum_ignores_order_but_not_repeats(spark):
    def lineage(data):
        df = spark.createDataFrame(data, "n int, s string").repartition(3)
        return tuple(metadata.source_lineage(df, "r", "s", "p").first())

    assert lineage([(1, "a"), (2, "b")]) == lineage([(2, "b"), (1, "a")])
    assert lineage([(1, "a"), (1, "a")])[4] != lineage([(2, "b"), (2, "b")])[4]
    assert lineage([(1, None)])[4] != lineage([(1, "")])[4]


def test_pipeline_run_and_splits(spark, frame):
    df = spark.createDataFrame([(date(2024, 1, 17),), (date(2024, 3, 2),), (None,)], "post_date date")
    run = metadata.pipeline_run(df, SETTINGS)
    assert run.columns == schemas.METADATA["pipeline_runs"].columns
    assert (run.first().source_start_month, run.first().source_end_month) == (JAN, MAR)

    contract = schemas.MARTS["trajectory_features"]
    features = frame(
        contract.schema,
        [{"entity_type": "role", "month": date(y, 6, 1)} for y in (2022, 2023, 2024, 2025, 2026)],
    )
    (split,) = metadata.model_eval_splits(features, SETTINGS, test=date(2026, 1, 1)).collect()
    assert split.train_start_month == date(2023, 1, 1) and split.train_end_month == date(2024, 6, 1)
    assert split.validation_start_month == date(2025, 1, 1)
    assert split.validation_end_month == date(2025, 6, 1)
    assert split.test_start_month == date(2026, 1, 1) and split.test_end_month == date(2026, 6, 1)
    (split,) = metadata.model_eval_splits(features, SETTINGS).collect()
    assert split.validation_end_month == date(2026, 6, 1) and split.test_start_month is None
    only_train = features.where("month < date'2025-01-01'")
    splits = metadata.model_eval_splits(only_train, SETTINGS)
    contracts.require_contract(splits.withColumn("entity_type", F.lit("role")), "splits", schemas.METADATA["model_eval_splits"])
    assert splits.first().validation_start_month == date(2025, 1, 1)
    assert metadata.model_eval_splits(features.where("month >= date'2025-01-01'"), SETTINGS).count() == 0


def test_csv_is_read_back_by_a_strict_reader(spark, tmp_path):
    values = [' Bob "X", Inc ', "", None, "a\nb", '"', "\\", "\\\"", "é,", "plain"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k int, v string").coalesce(1)
    tables.write_csv(df, str(tmp_path / "c"))
    (path,) = glob(f"{tmp_path}/c/part-*")
    rows = list(csv.reader(open(path, newline="", encoding="utf-8"), strict=True))
    assert rows == [["k", "v"], *[[str(i), v or ""] for i, v in enumerate(values)]]


def test_range_keeps_the_end_day_of_timestamps(spark, tmp_path):
    df = spark.sql("select timestamp'2024-01-31 10:00:00' as post_date, 1 as job_id union all "
                   "select timestamp'2024-01-01 00:00:00', 2 union all select timestamp'2024-02-01 00:00:00', 3")
    tables.write_monthly(df, str(tmp_path / "m"))
    got = snapshot.read_monthly(spark, str(tmp_path / "m"), start=date(2024, 1, 1), end=date(2024, 1, 31))
    assert sorted(r.job_id for r in got.collect()) == [1, 2]


def test_months_with_other_columns(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "postings/year=2024/month=1"))
    spark.range(3).selectExpr("id", "'s' as skill_id").write.parquet(str(tmp_path / "postings/year=2024/month=2"))
    got = snapshot.read_or_empty(spark, str(tmp_path / "postings"), schemas.REGIONS)
    assert got.where("skill_id = 's'").count() == 3 and got.count() == 5
    with pytest.raises(ValueError, match="rcid"):
        read_sources(spark, str(tmp_path))


def test_no_sample_of_absent_marts(spark, tmp_path):
    settings = replace(SETTINGS, output_root=str(tmp_path / "none"), sample_root=str(tmp_path / "dev"))
    assert make_sample(spark, settings) == []
    with pytest.raises(FileNotFoundError, match="job_demand"):
        validate_outputs(spark, settings)


def test_manifest_is_nested(spark, folder):
    one, none = spark.range(1), spark.range(0)
    manifest = metadata.run_manifest(one, none, one, SETTINGS, "p", "full", 5, "r")
    manifest.write.json(folder, mode="overwrite")
    (path,) = [p for p in glob(f"{folder}/part-*") if open(p).read().strip()]
    written = json.loads(open(path).read())
    assert written["tables"]["postings"] == {
        "rows": 1,
        "path": "p",
        "date_range": {"start": "2024-01-01", "end": "2026-03-31"},
    }
    assert written["tables"]["company_mapping"] == {"rows": 0, "scope": "full"}


def test_role_frequency_report(raw_source, spark, folder):
    names = ["A", "A", "B", "B", "B", None, None, "NULL"]
    source = raw_source([{"job_id": i, "role_k17000_v3": n} for i, n in enumerate(names)])
    source = source.unionByName(raw_source([{"job_id": None, "role_k17000_v3": "A"}]))
    report = reports.role_frequency(source, ["A"])
    expected = [("B", 3, False), ("NULL", 2, False), ("NULL", 1, False), ("A", 2, True)]
    assert [tuple(r) for r in report.collect()] == expected
    tables.write_report(report, folder, reports.report_order())
    (path,) = glob(f"{folder}/part-*.csv")
    assert open(path).read().splitlines() == [
        "role_k17000_v3,posting_count,in_allowlist",
        "B,3,false",
        "NULL,2,false",
        "NULL,1,false",
        "A,2,true",
    ]


def test_settings():
    assert new_run_id() != new_run_id() and new_run_id().startswith("run_")
    assert new_extract_id().startswith("extract_")
    for bad in ({"min_observations": 0}, {"extract_start": date(2030, 1, 1)}):
        with pytest.raises(ValueError):
            RunSettings(**bad)


def test_row_counts(spark):
    counts = contracts.row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert rows(counts.select("table_name", F.col("row_count"))) == [("a", 3), ("b", 0)]
