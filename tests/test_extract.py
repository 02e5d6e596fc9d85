import random
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemart.operators import cut
from tidemart.operators.dedupe import first_per_key
from tidemart.sources import extract


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize(
    "start, end, expected",
    [
        (date(2024, 3, 1), date(2024, 2, 1), []),
        (date(2024, 2, 29), date(2024, 2, 29), [("2024-02", date(2024, 2, 29), date(2024, 2, 29))]),
        (
            date(2023, 12, 15),
            date(2024, 2, 10),
            [
                ("2023-12", date(2023, 12, 15), date(2023, 12, 31)),
                ("2024-01", date(2024, 1, 1), date(2024, 1, 31)),
                ("2024-02", date(2024, 2, 1), date(2024, 2, 10)),
            ],
        ),
    ],
)
def test_month_periods(spark, start, end, expected):
    assert sorted(rows(extract.month_periods(spark, start, end))) == expected


def test_select_periods(spark):
    periods = extract.month_periods(spark, date(2024, 1, 5), date(2024, 6, 5))

    def labels(**choice):
        return sorted(r.label for r in extract.select_periods(periods, **choice).collect())

    assert labels(first=2) == ["2024-01", "2024-02"]
    assert labels(last=2) == ["2024-05", "2024-06"]
    assert labels(last=0) == [] and labels(first=0) == []
    assert len(labels()) == 6 and len(labels(first=99)) == 6
    for bad in ({"first": 1, "last": 1}, {"first": -1}):
        with pytest.raises(ValueError):
            extract.select_periods(periods, **bad)


def test_window_is_half_open_for_timestamps(spark):
    stamps = [datetime(2024, 1, 31, 23, 59), datetime(2024, 2, 1), datetime(2024, 1, 1)]
    df = spark.createDataFrame([(s,) for s in stamps], "post_date timestamp_ntz")
    kept = df.where(extract.in_half_open_window("post_date", date(2024, 1, 1), date(2024, 1, 31)))
    assert sorted(r.post_date for r in kept.collect()) == [stamps[2], stamps[0]]


def test_extract_filters_columns_and_case(raw_source):
    source = raw_source(
        [
            {"job_id": 1, "post_date": date(2024, 1, 2), "role_k17000_v3": "Data"},
            {"job_id": 2, "post_date": date(2024, 1, 2), "role_k17000_v3": "DATA"},
            {"job_id": 3, "post_date": date(2023, 1, 2), "role_k17000_v3": "Data"},
            {"job_id": 4, "role_k17000_v3": "Data"},
        ]
    )
    span = (date(2024, 1, 1), date(2024, 12, 31))
    assert [r.job_id for r in extract.extract_postings(source, *span, roles=["Data"]).collect()] == [1]
    assert extract.extract_postings(source, *span, roles=[]).count() == 2
    assert extract.extract_postings(source, *span, columns=["job_id"]).columns == ["job_id"]
    assert len(extract.extract_postings(source, *span).columns) == 30


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows on one day, repeated ids, ids far apart."""
    random.seed(7)
    data = []
    for i in range(3000):
        day = date(2024, 1, 15) if i % 3 else date(2024, 1, 1 + i % 28)
        job = random.choice([i % 50, random.randrange(1 << 21), random.randrange(1 << 45)])
        data.append((job, day, random.choice(["x", "y", None])))
    return spark.createDataFrame(data, "job_id long, post_date date, note string").repartition(5)


@pytest.mark.parametrize("n", [0, 1, 37, 500, 501, 1999, 2999, 3000, 9999])
def test_row_cap_matches_a_full_sort(skewed, n):
    def key(row):
        return (row[1], row[0], row[2] is not None, row[2] or "")

    expected = sorted(rows(skewed), key=key)[:n]
    assert sorted(rows(extract.cap_rows_by_month(skewed, n)), key=key) == expected


@pytest.mark.parametrize("kind", ["one day", "random ids", "one id", "no ids or days"])
def test_row_cap_on_odd_ids_and_days(spark, monkeypatch, kind):
    draw = random.Random(3)
    data = []
    for i in range(4000):
        day = date(2024, 1, 15) if kind != "random ids" else date(2024, 1, 1 + draw.randrange(3))
        job = 7 if kind == "one id" else draw.randrange(-(1 << 62), 1 << 63)
        if kind == "no ids or days":
            job, day = draw.choice([None, job]), draw.choice([None, day])
        data.append((job, day, draw.choice(["x", "y", None])))
    df = spark.createDataFrame(data, "job_id long, post_date date, note string").repartition(5)
    first = date(1, 1, 1)
    key = lambda r: (r[1] or first, r[0] is not None, r[0] or 0, r[2] is not None, r[2] or "")
    # A coarse sketch misses the cap's place now and then; the counts must make up for it.
    for sketch in (cut.SKETCH, 8):
        monkeypatch.setattr(cut, "SKETCH", sketch)
        for n in (1, 700, 2000, 3999, 4000):
            got = rows(extract.cap_rows_by_month(df, n))
            assert sorted(got, key=key) == sorted(data, key=key)[:n]


def test_row_cap_reads_all_columns_once(spark, skewed, tmp_path):
    skewed.write.parquet(str(tmp_path / "p"))
    df = extract.cap_rows_by_month(spark.read.parquet(str(tmp_path / "p")), 500)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert sum("note" in scan for scan in scans) == 1


def test_row_cap_rejects_negative(skewed):
    with pytest.raises(ValueError):
        extract.cap_rows_by_month(skewed, -1)


def test_dimension_for_facts(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "rcid long, company string")
    facts = spark.createDataFrame([("1",), ("3.0",), ("oops",), (None,), ("1",)], "rcid string")
    assert sorted(rows(extract.dimension_for_facts(dim, facts, "rcid"))) == [(1, "a"), (3, "c")]
    nothing = extract.dimension_for_facts(dim, facts.where("false"), "rcid")
    assert nothing.schema == dim.schema and nothing.count() == 0
    assert extract.dimension_for_facts(dim, facts.select(F.lit(1).alias("z")), "rcid").count() == 0


def test_first_per_key_settles_ties(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 5, "a"), (1, 6, "0"), (2, 1, "z")], "k int, o int, v string")
    assert sorted(rows(first_per_key(df, ["k"], ["o"]))) == [(1, 5, "a"), (2, 1, "z")]


def test_union_frames_by_name(spark):
    left = spark.createDataFrame([(1, "a")], "n int, s string")
    right = spark.createDataFrame([("b", 2)], "s string, n int")
    assert sorted(rows(extract.union_frames([left, right]))) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        extract.union_frames([])


def test_partition_columns_drop_unreadable_dates(spark):
    df = spark.createDataFrame([("2024-03-09",), ("soon",), (None,)], "post_date string")
    assert rows(extract.with_partition_columns(df)) == [("2024-03-09", 2024, 3)]
