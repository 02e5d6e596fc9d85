from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemart import schemas
from tidemart.functions.casts import date_or_null, number_or_null, numeric_key_or_null, whole_key
from tidemart.operators.enrich import join_company, join_region
from tidemart.operators.universe import Allowlist, allowlist_sizes, dimension, in_universe
from tidemart.plans import staging
from tidemart.session import removed, scratch, staged

DAY = date(2024, 2, 29)


def values(df, column):
    return [row[column] for row in df.collect()]


def test_salary_text(spark):
    texts = ["", "abc", "1,000", "1_000", "5d", " 1e5 ", "NaN", "0", "-5", None, "12.50"]
    df = spark.createDataFrame([(t,) for t in texts], "salary string")
    got = values(df.select(number_or_null(df, "salary").alias("v")), "v")
    assert got == [None, None, None, None, None, 1e5, None, 0.0, -5.0, None, 12.5]


def test_float_keys_round_half_even(spark):
    df = spark.createDataFrame([(2.0,), (2.5,), (2.7,), (3.5,), (None,)], "rcid double")
    assert values(df.select(whole_key(df, "rcid").alias("k")), "k") == [2, 2, 3, 4, None]


def test_text_keys(spark):
    df = spark.createDataFrame([("7",), ("x",), (None,)], "rcid string")
    assert values(df.select(numeric_key_or_null(df, "rcid").alias("k")), "k") == [7, None, None]


def test_partial_dates_are_null(spark):
    df = spark.createDataFrame([("2024-05-06",), ("2024-05",), ("x",)], "d string")
    assert values(df.select(date_or_null(df, "d").alias("d")), "d") == [date(2024, 5, 6), None, None]


def test_geo_falls_back_on_raw_columns(raw_source, frame):
    rows, expected = [], {}
    for i in range(8):
        place = {
            name: name.upper() for bit, name in enumerate(("metro_area", "state", "country")) if i >> bit & 1
        }
        rows.append({"job_id": i, "post_date": DAY, **place})
        expected[i] = place.get("metro_area") or place.get("state") or place.get("country")
    raw = staging.raw_postings(raw_source(rows), frame(schemas.COMPANY, []))
    assert raw.schema == schemas.RAW_POSTINGS or raw.columns == schemas.RAW_POSTINGS.names
    assert {r.job_id: r.geo_id for r in raw.collect()} == expected
    assert {r.job_id: r.country for r in raw.collect()}[0] == "UNK"
    base = staging.base_postings(raw)
    assert base.where("geo_id = 'UNK' and geo_name = 'Unknown'").count() == 1


def test_base_defaults_and_types(raw_source, frame):
    raw = staging.raw_postings(
        raw_source(
            [
                {"job_id": 1, "post_date": DAY, "role_k17000_v3": "data Engineer", "skill_id": "sql"},
                {"job_id": 2},
            ]
        ),
        frame(schemas.COMPANY, []),
    )
    base = staging.base_postings(raw)
    assert [(f.name, f.dataType) for f in base.schema] == [
        (f.name, f.dataType) for f in schemas.BASE_POSTINGS
    ]
    (row,) = base.collect()
    assert (row.month, row.role_id, row.skill_id) == (date(2024, 2, 1), "DATA ENGINEER", "SQL")
    assert (row.role_name, row.industry_id, row.posting_count) == ("Unknown", "UNK", 1)


def test_source_without_skill_columns(frame):
    raw = staging.raw_postings(
        frame(schemas.POSTINGS, [{"job_id": 1, "post_date": DAY}]), frame(schemas.COMPANY, [])
    )
    assert values(staging.base_postings(raw), "skill_id") == ["UNK"]


def test_company_join_keeps_every_posting_once(spark, frame):
    postings = spark.createDataFrame(
        [(1, 10), (2, 10), (3, None), (4, None), (5, 99), (6, -3)], "job_id long, rcid long"
    )
    company = frame(
        schemas.COMPANY,
        [
            {"rcid": 10, "rics_k200": "b"},
            {"rcid": 10, "rics_k200": "a"},
            {"rcid": -3, "rics_k200": "neg"},
            {"rcid": None, "rics_k200": "nobody"},
        ],
    )
    got = {r.job_id: r.rics_k200 for r in join_company(postings, company, ["job_id"]).collect()}
    assert got == {1: "a", 2: "a", 3: None, 4: None, 5: None, 6: "neg"}
    assert join_company(postings, company, ["job_id"]).count() == 6


def test_hot_company_is_split_at_run_time(spark):
    """Half the postings belong to one company, a quarter to none."""
    rows = spark.range(0, 40_000, 1, 8).selectExpr(
        "id as job_id", "case when id % 2 = 0 then 7 when id % 4 = 1 then id % 500 end as rcid"
    )
    company = spark.range(500).selectExpr(
        "id as rcid", "concat('k', id) as rics_k200", "concat('g', id) as rics_k50"
    )
    options = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    for name, value in options.items():
        spark.conf.set(name, value)
    joined = join_company(rows, company, ["job_id"])
    counts = joined.groupBy("rics_k200").count()
    got = {r.rics_k200: r["count"] for r in counts.collect()}
    for name in options:
        spark.conf.unset(name)
    assert sum(got.values()) == 40_000 and got["k7"] == 20_000 and got[None] == 10_000
    assert "SortMergeJoin(skew=true)" in counts._jdf.queryExecution().executedPlan().toString()


def test_region_join(spark, frame):
    postings = spark.createDataFrame([(1, "DE"), (2, "XX"), (3, None)], "job_id long, country string")
    regions = frame(schemas.REGIONS, [{"country": "DE", "region": "Europe"}] * 2)
    got = {r.job_id: r.region for r in join_region(postings, regions).collect()}
    assert got == {1: "Europe", 2: "Unknown", 3: "Unknown"}


ROLE = Allowlist("role", (("a", "name one"), ("A", "name two")))
SKILL = Allowlist("skill", (("s", "skill"),))
NO_ROLE, NO_SKILL = Allowlist("role"), Allowlist("skill")


@pytest.mark.parametrize(
    "roles, skills, kept",
    [
        (NO_ROLE, NO_SKILL, {1, 2, 3, 4}),
        (ROLE, NO_SKILL, {1, 2}),
        (NO_ROLE, SKILL, {2, 3}),
        (ROLE, SKILL, {1, 2, 3}),
    ],
)
def test_universe_modes(base, roles, skills, kept):
    rows = [("A", "UNK"), ("A", "S"), ("B", "S"), ("B", "UNK")]
    df = base(
        [
            {"month": DAY.replace(day=1), "role_id": r, "skill_id": s, "salary_usd": float(i + 1)}
            for i, (r, s) in enumerate(rows)
        ]
    )
    got = values(in_universe(df, roles, skills), "salary_usd")
    assert sorted(got) == sorted(kept), "one row per posting, whatever names an id is listed under"


def test_allowlist_from_config(spark):
    listed = Allowlist.from_config(
        "role", [{"role_id": " Data ", "role_name": "d"}, {"role_id": "", "role_name": "x"}]
    )
    assert listed.source_ids == ["Data"] and listed.ids == ["DATA"]
    assert Allowlist.from_config("skill", None).entries == ()
    with pytest.raises(ValueError):
        Allowlist.from_config("role", [{"role_id": "x"}])
    sizes = allowlist_sizes(dimension(ROLE, spark), dimension(SKILL, spark)).first()
    assert tuple(sizes) == (2, 1)


def test_filter_runs_before_company_join(raw_source, frame, spark):
    df = staging.universe_postings(raw_source([]), frame(schemas.COMPANY, []), ROLE, SKILL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    join = next(i for i, line in enumerate(lines) if "Join LeftOuter" in line)
    assert not any("Filter" in line and " IN " in line for line in lines[:join])


def test_cube_adds_up(base):
    rows = [{"month": DAY.replace(day=1), "skill_id": s} for s in ("A", "A", "B")]
    cube = staging.posting_cube(base(rows))
    assert sorted(values(cube, "posting_count")) == [1, 2]
    assert cube.agg(F.sum("posting_count")).first()[0] == 3


def test_keys_that_are_no_numbers(spark):
    from tidemart.functions.casts import numeric_key_or_null, whole_key

    nan, inf = float("nan"), float("inf")
    floats = spark.createDataFrame([(nan,), (inf,), (1e300,), (2.7,), (None,)], "k double")
    assert [r.v for r in floats.select(whole_key(floats, "k").alias("v")).collect()] == [None, None, None, 3, None]
    texts = spark.createDataFrame([("1e300",), ("7",), ("x",)], "k string")
    assert [r.v for r in texts.select(numeric_key_or_null(texts, "k").alias("v")).collect()] == [None, 7, None]


def test_long_lists_filter_below_the_company_join(spark, frame, raw_source):
    many = Allowlist("role", tuple((f"role {i}", "name") for i in range(5000)))
    df = staging.universe_postings(raw_source([]), frame(schemas.COMPANY, []), many, SKILL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("INSET") > plan.index("Join")


def test_removed_tables(spark, tmp_path):
    folder = str(tmp_path)
    one, other = (staged(spark.range(3), name, folder) for name in ("one", "other"))
    kept = staged(one.join(other, "id"), "kept", folder)
    removed(one, other, kept.where("id > 0"))
    assert [path.name.split("-")[0] for path in tmp_path.iterdir()] == ["kept"]
    assert kept.count() == 3
    removed(one)


def test_scratch_tables(spark, tmp_path):
    folder = str(tmp_path)
    outer = staged(spark.range(3), "outer", folder)
    with scratch() as tables:
        inner = staged(outer, "inner", folder)
        with scratch():
            staged(inner, "deep", folder)
        result = staged(inner.where("id > 0"), "result", folder)
        tables.remove(result)
    assert sorted(path.name.split("-")[0] for path in tmp_path.iterdir()) == ["outer", "result"]
    assert result.count() == 2
    with pytest.raises(ValueError), scratch():
        staged(outer, "broken", folder)
        raise ValueError
    assert len(list(tmp_path.iterdir())) == 2
