import random
import statistics
from datetime import date

import numpy as np
import pytest
from mart_helpers import months
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart import schemas
from tidemart.functions.growth import series, trailing
from tidemart.functions.scoring import confidence, trajectory_class
from tidemart.operators.panel import entity_month_panel
from tidemart.operators.quantiles import grouped_quantiles
from tidemart.operators.trailing import numbered, trailing_by_number
from tidemart.plans import demand, salary, skills, trajectory
from tidemart.settings import RunSettings

SETTINGS = RunSettings(run_id="test")


def postings(base, counts, **fields):
    """``counts`` maps month to a number of postings."""
    return base([{"month": m, **fields} for m, n in counts.items() for _ in range(n)])


# --- demand --------------------------------------------------------------------------------------


def test_growth_and_zero_base(base):
    span = months(14)
    counts = dict(zip(span, [1, 0, 4, 2, 1, 1, 1, 1, 1, 1, 1, 1, 3, 5]))
    other = {m: 1 for m in span}
    df = postings(base, counts).unionByName(postings(base, other, role_id="S"))
    got = {r.month: r for r in demand.job_demand(df).where("role_id = 'R'").collect()}
    assert got[span[12]].yoy_growth == 200.0 and got[span[12]].acceleration is None
    assert got[span[13]].yoy_growth is None, "no growth on a zero base"
    assert got[span[4]].rolling_3m_growth is None and got[span[3]].rolling_3m_growth == 100.0
    empty = got[span[1]]
    assert (empty.posting_count, empty.geo_name, empty.role_name) == (0, "Unknown", "Unknown")


def test_panel_is_complete(base):
    span = months(5)
    df = base(
        [{"month": span[0], "role_id": "A"}, {"month": span[4], "role_id": "B", "geo_id": "H"}]
    )
    mart = demand.job_demand(df)
    assert [(f.name, f.dataType) for f in mart.schema] == [
        (f.name, f.dataType) for f in schemas.MARTS["job_demand"].schema
    ]
    keys = ["role_id", "geo_id", "industry_id"]
    panel = entity_month_panel(df, keys)
    assert mart.count() == panel.count() == 4
    assert mart.select("month", *keys).exceptAll(panel).count() == 0
    assert mart.agg(F.sum("posting_count")).first()[0] == 2
    assert entity_month_panel(df, keys, calendar=True).count() == 10


def test_absent_month_shifts_growth_unless_calendar(base):
    span = [m for i, m in enumerate(months(15)) if i != 6]
    df = postings(base, {m: i + 1 for i, m in enumerate(span)})
    last = date(2021, 3, 1)

    def growth(calendar):
        return demand.job_demand(df, calendar).where(F.col("month") == F.lit(last)).first().yoy_growth

    assert growth(False) == 100.0 * (14 - 2) / 2
    assert growth(True) == 100.0 * (14 - 3) / 3
    filled = demand.demand_filled(df, calendar=True)
    assert filled.count() == 15 and filled.where("posting_count = 0").count() == 1


def test_one_entity_with_several_names(base):
    month = months(1)[0]
    df = base([{"month": month, "role_name": n} for n in ("b", "a", "b")])
    (row,) = demand.monthly_demand(df).collect()
    assert (row.role_name, row.posting_count) == ("a", 3)


def test_empty_input(base):
    assert demand.job_demand(base([])).count() == 0
    assert skills.skill_demand(base([])).count() == 0
    assert skills.role_skill_associations(base([])).count() == 0
    assert salary.salary_distribution(base([])).count() == 0


# --- skills --------------------------------------------------------------------------------------


def test_skill_growth_counts_observed_months(base):
    observed = [m for i, m in enumerate(months(30)) if i % 2 == 0][:14]
    df = postings(base, {m: i + 1 for i, m in enumerate(observed)}, skill_id="X")
    got = {r.month: r.yoy_growth for r in skills.skill_demand(df).collect()}
    assert got[observed[11]] is None
    assert got[observed[12]] == 100.0 * (13 - 1) / 1


def test_shares_sum_to_one(base):
    month = months(1)[0]
    df = base([{"month": month, "skill_id": s, "role_id": r} for r, s in zip("AAAAB", "XXYZX")])
    got = skills.skill_share(df)
    sums = got.groupBy("month", "geo_id", "role_id").agg(F.sum("share_within_role").alias("s"))
    assert [r.s for r in sums.collect()] == [1.0, 1.0]
    by_pair = {(r.role_id, r.skill_id): r for r in got.collect()}
    assert by_pair["A", "X"].share_within_role == 0.5 and by_pair["A", "X"].role_posting_count == 4


# Published association counts of one month, all without a skill.
GOLDEN = {
    "SOFTWARE ENGINEERING": 64058,
    "DATA ENGINEERING PROFESSIONAL": 49577,
    "DATA SCIENCE PROFESSIONAL": 21070,
    "MACHINE LEARNING ENGINEERING": 9345,
    "CYBER ENGINEER": 4761,
}


def test_association_golden(base):
    month = date(2026, 3, 1)
    df = base([{"month": month, "role_id": r, "posting_count": n} for r, n in GOLDEN.items()])
    got = skills.role_skill_associations(df).collect()
    assert {r.role_id: r.co_occurrence_count for r in got} == GOLDEN
    assert {(r.p_skill_given_role, r.lift) for r in got} == {(1.0, 1.0)}


def test_association_numerator_spans_twelve_rows(base):
    span = months(14)
    df = postings(base, {m: 1 for m in span}, skill_id="X").unionByName(
        postings(base, {m: 1 for m in span}, skill_id="Y")
    )
    last = F.col("month") == F.lit(span[-1])
    got = skills.role_skill_associations(df).where(last & (F.col("skill_id") == "X")).first()
    assert (got.co_occurrence_count, got.p_skill_given_role) == (12, 6.0)
    got = skills.role_skill_associations(df, consistent=True).where(last).first()
    assert (got.p_skill_given_role, got.lift) == (0.5, 1.0)


def test_marginals_agree(base):
    span = months(3)
    random.seed(1)
    df = base(
        [
            {"month": random.choice(span), "role_id": random.choice("AB"), "skill_id": random.choice("XYZ")}
            for _ in range(60)
        ]
    )
    totals = skills.association_marginals(df)
    sums = {r.level: r.s for r in totals.groupBy("level").agg(F.sum("total").alias("s")).collect()}
    assert sums == {"role": 60, "skill": 60, "all": 60}
    assert totals.where("level = 'all' and (role_id is not null or skill_id is not null)").count() == 0


# --- salaries ------------------------------------------------------------------------------------


def test_quantiles_match_numpy(spark):
    random.seed(3)
    groups = {
        "one": [5.0],
        "two": [1.0, 2.0],
        "ties": [7.0] * 50 + [9.0] * 3,
        "many": [round(random.lognormvariate(11, 0.6), 2) for _ in range(997)],
        "signs": [random.uniform(-3, 3) for _ in range(101)],
        "close": [1.0 + i * 2**-40 for i in range(64)],
    }
    data = [(k, v) for k, vs in groups.items() for v in vs] + [("one", None)]
    df = spark.createDataFrame(data, "k string, v double")
    probabilities = {"q0": 0.0, "q25": 0.25, "q50": 0.5, "q75": 0.75, "q100": 1.0}
    got = {r.k: r for r in grouped_quantiles(df, ["k"], "v", probabilities).collect()}
    assert set(got) == set(groups)
    for key, vs in groups.items():
        for name, p in probabilities.items():
            assert got[key][name] == pytest.approx(np.quantile(vs, p), rel=1e-12, abs=1e-12)


def test_salary_ignores_nan_zero_and_null(base):
    month = months(1)[0]
    df = base([{"month": month, "salary_usd": s} for s in (float("nan"), 0.0, -1.0, None, 10.0, 20.0)])
    (row,) = salary.salary_distribution(df).collect()
    assert (row.salary_p25, row.salary_p50, row.salary_p75) == (12.5, 15.0, 17.5)
    assert salary.salary_distribution_approx(df).first().salary_p50 in (10.0, 20.0)


# --- trajectories --------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def uneven(spark):
    random.seed(5)
    data = []
    for role, geos in (("A", 13), ("B", 1), ("C", 4)):
        for m in months(17):
            for g in range(geos):
                for i in range(random.randrange(1, 4)):
                    growth = None if random.random() < 0.2 else random.uniform(-50, 50)
                    data.append((role, m, f"g{g:02d}", f"i{i}", growth))
    schema = "role_id string, month date, geo_id string, industry_id string, yoy_growth double"
    return spark.createDataFrame(data, schema).repartition(7)


@pytest.mark.parametrize("block_rows", [12, 13, 50, 100_000])
def test_blocked_windows_equal_one_window(uneven, block_rows):
    order = ["month", "geo_id", "industry_id"]
    rows = numbered(uneven, ["role_id"], order, "n")
    deviation = F.stddev_pop("yoy_growth")
    blocked = trailing_by_number(rows, ["role_id"], "n", 12, {"v": deviation}, block_rows)
    window = series("role_id", order="month").orderBy(*order)
    plain = uneven.withColumns(
        {"n": F.row_number().over(window).cast("long"), "v": trailing(deviation, 12, window)}
    )
    columns = [*uneven.columns, "n", "v"]
    assert sorted(map(str, blocked.select(*columns).collect())) == sorted(
        map(str, plain.select(*columns).collect())
    )


def test_numbering_without_prefix_levels(uneven):
    one = uneven.where("role_id = 'B' and industry_id = 'i0'")
    assert sorted(r.n for r in numbered(one, ["role_id"], ["month"], "n").collect()) == list(range(1, 18))


def test_block_must_hold_a_frame(uneven):
    with pytest.raises(ValueError):
        trailing_by_number(uneven, ["role_id"], "n", 12, {}, block_rows=11)


@pytest.fixture(scope="module")
def demand_mart(spark, base):
    random.seed(11)
    rows = [
        {"month": m, "role_id": r, "geo_id": g}
        for m in months(40)
        for r in "AB"
        for g in "XY"
        for _ in range(random.randrange(0, 6))
    ]
    return demand.job_demand(base(rows)).cache()


def test_role_grain(demand_mart):
    features = trajectory.trajectory_features(demand_mart, SETTINGS, "role")
    assert features.count() == 2 * (40 - 36 + 1)
    assert features.groupBy("entity_type", "entity_id", "month").count().where("count > 1").count() == 0
    shares = features.groupBy("month").agg(F.sum("demand_concentration_index").alias("s")).collect()
    assert all(r.s == pytest.approx(1.0) for r in shares)
    series_a = trajectory.role_series(demand_mart).where("role_id = 'A'").orderBy("month").collect()
    last = features.where("entity_id = 'A'").orderBy(F.desc("month")).first()
    expected = statistics.pstdev([r.yoy_growth for r in series_a[-12:]])
    assert last.volatility_12m == pytest.approx(expected)
    assert last.posting_count == series_a[-1].posting_count


def test_row_grain_counts_rows(demand_mart):
    rows = trajectory.volatility(demand_mart, "row", block_rows=20)
    per_role = demand_mart.where("role_id = 'A'").count()
    assert rows.where("entity_id = 'A'").agg(F.max("observed_months")).first()[0] == per_role
    features = trajectory.trajectory_features(demand_mart, SETTINGS, "row", block_rows=20)
    assert features.count() == demand_mart.count() - 2 * 35
    with pytest.raises(ValueError):
        trajectory.volatility(demand_mart, "geo")


def test_labels_keep_one_row_per_feature(demand_mart):
    for grain in trajectory.GRAINS:
        features = trajectory.trajectory_features(demand_mart, SETTINGS, grain)
        labels = trajectory.trajectory_labels(features, SETTINGS)
        assert labels.count() == features.count()
        assert [(f.name, f.dataType) for f in labels.schema] == [
            (f.name, f.dataType) for f in schemas.MARTS["trajectory_labels"].schema
        ]
        spread = labels.agg(F.min("confidence"), F.max("confidence")).first()
        assert 0.0 <= spread[0] <= spread[1] <= 1.0
        total = trajectory.label_distribution(labels).agg(F.sum("label_count")).first()[0]
        assert total == features.count()


FEATURES = T.StructType(
    [
        T.StructField("posting_count", T.LongType()),
        T.StructField("yoy_growth", T.DoubleType()),
        T.StructField("acceleration", T.DoubleType()),
        T.StructField("volatility_12m", T.DoubleType()),
    ]
)


@pytest.mark.parametrize(
    "count, yoy, acceleration, volatility, label",
    [
        (199, 10.0, 5.0, None, "emerging"),
        (200, 10.0, 5.0, None, "stable_growth"),
        (200, 10.0, 5.0, 15.0, "uncertain"),
        (1, 9.99, 5.0, 14.9, "stable_growth"),
        (1, 5.0, -0.1, 15.0, "plateau"),
        (1, 5.0, -0.1, 14.9, "stable_growth"),
        (1, -2.0, -0.1, None, "plateau"),
        (1, -2.0, 0.0, None, "uncertain"),
        (1, -2.01, -0.1, None, "declining"),
        (1, None, 5.0, None, "uncertain"),
        (1, 10.0, None, 20.0, "uncertain"),
    ],
)
def test_label_rules(spark, count, yoy, acceleration, volatility, label):
    df = spark.createDataFrame([(count, yoy, acceleration, volatility)], FEATURES)
    assert df.select(trajectory_class()).first()[0] == label


def test_confidence_is_clamped(spark):
    df = spark.createDataFrame([(None,), (0.0,), (100.0,), (250.0,), (25.0,)], "volatility_12m double")
    assert [r[0] for r in df.select(confidence()).collect()] == [1.0, 1.0, 0.0, 0.0, 0.75]


def test_run_context_is_the_same_everywhere(demand_mart):
    features = trajectory.trajectory_features(demand_mart, SETTINGS)
    labels = trajectory.trajectory_labels(features, SETTINGS)
    stamps = {r[0] for df in (features, labels) for r in df.select("run_timestamp").distinct().collect()}
    assert stamps == {SETTINGS.run_timestamp}
