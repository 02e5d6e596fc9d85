"""Rebuilding marts after some months of the source changed.

A build lies in a folder of its own, one folder per month and table, and its manifest, written last, says for
every table and month which builds hold the rows. A later build writes the months it recomputes and takes the
others over by name, so that what it did not touch is neither read nor written.

Postings are read for the changed months only. They give the changed months of two tables that no other month
enters, the posting cube and the salaries. The other marts come from the cube, for the months whose rows depend on
a changed one: growth looks back over rows of a series, so a change reaches the rows after it.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..operators.universe import Allowlist
from ..session import shuffles_removed, staged
from ..settings import RunSettings
from ..sources.snapshot import ABSENT
from .build import Sources
from .demand import ENTITY, FILL, _counted, _per_entity, job_demand, with_growth
from .salary import salary_distribution
from .skills import (
    _trailing_pairs,
    associations_of,
    cooccurrence_monthly,
    role_skill_associations,
    skill_demand,
)
from .staging import CUBE_KEYS, posting_cube, universe_postings
from .trajectory import (
    scored_features,
    trajectory_features,
    trajectory_labels,
    volatility,
    with_concentration,
)

CUBE = "cube"
TABLES: dict[str, T.StructType] = {
    CUBE: T.StructType(
        [*[f for f in schemas.BASE_POSTINGS if f.name in CUBE_KEYS], T.StructField("posting_count", T.LongType())]
    ),
    **{name: contract.schema for name, contract in schemas.MARTS.items()},
}
MANIFEST = "run_id string, run_timestamp string, tables array<struct<name: string, month: date, builds: array<string>>>"
MONTH_FOLDER = re.compile(r"/month=(\d{4}-\d{2}-\d{2})/[^/]+$")

# How many rows of a series back a value looks: growth over 12 and its change by one more, the trailing
# deviation of growth over 12 rows, trailing sums of 12.
GROWTH_ROWS = 13
FEATURE_ROWS = 23
SKILL_ROWS = 12
TRAILING_ROWS = 11

Places = dict[date, list[str]]


@dataclass(frozen=True)
class Build:
    """A complete build: for every table the builds that hold each of its months."""

    root: str
    run_id: str
    tables: Mapping[str, Places]

    def read(self, spark: SparkSession, name: str, months: Iterable[date] | None = None) -> DataFrame:
        """A table, or some months of it: only their folders are listed."""
        wanted = set(self.tables[name] if months is None else months)
        return read_places(spark, self.root, name, {m: b for m, b in self.tables[name].items() if m in wanted})

    def marts(self, spark: SparkSession) -> dict[str, DataFrame]:
        return {name: self.read(spark, name) for name in schemas.MARTS}


def _folder(root: str, run_id: str, name: str) -> str:
    return f"{root}/builds/{run_id}/{name}"


def read_places(spark: SparkSession, root: str, name: str, places: Places) -> DataFrame:
    schema = TABLES[name]
    by_build: dict[str, list[date]] = {}
    for month, builds in places.items():
        for build in builds:
            by_build.setdefault(build, []).append(month)
    frames = []
    for build, months in sorted(by_build.items()):
        folder = _folder(root, build, name)
        paths = [f"{folder}/month={month}" for month in sorted(months)]
        frames.append(spark.read.schema(schema).option("basePath", folder).parquet(*paths).select(*schema.names))
    if not frames:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, frames)


def latest_build(spark: SparkSession, root: str) -> Build | None:
    """The newest complete build under ``root``."""
    try:
        rows = spark.read.schema(MANIFEST).json(f"{root}/builds/*/manifest").collect()
    except AnalysisException as error:
        if error.getCondition() not in ABSENT:
            raise
        return None
    if not rows:
        return None
    newest = max(rows, key=lambda r: (r.run_timestamp, r.run_id))
    tables: dict[str, Places] = {name: {} for name in TABLES}
    for place in newest.tables:
        tables[place.name][place.month] = list(place.builds)
    return Build(root, newest.run_id, tables)


class _Writer:
    """The tables of one build while it runs."""

    def __init__(self, spark: SparkSession, root: str, run_id: str, before: Build | None):
        self.spark, self.root, self.run_id = spark, root, run_id
        self.tables: dict[str, Places] = {n: dict(before.tables[n]) if before else {} for n in TABLES}

    def write(self, name: str, df: DataFrame, replaced: Iterable[date] | None) -> None:
        """Write rows of a table. They replace what there is of the ``replaced`` months (of all, if None) and
        are added to that of other months."""
        folder = _folder(self.root, self.run_id, name)
        with shuffles_removed(self.spark):
            df.select(*TABLES[name].names).hint("rebalance", "month").write.partitionBy("month").parquet(folder)
        files = self.spark.read.schema("month date").parquet(folder).inputFiles()
        written = {date.fromisoformat(found[1]) for f in files if (found := MONTH_FOLDER.search(f))}
        places = self.tables[name]
        for month in list(places) if replaced is None else replaced:
            places.pop(month, None)
        for month in written:
            places[month] = [*places.get(month, []), self.run_id]

    def read(self, name: str, months: Iterable[date] | None = None) -> DataFrame:
        return Build(self.root, self.run_id, self.tables).read(self.spark, name, months)

    def months(self) -> list[date]:
        return sorted(self.tables[CUBE])

    def commit(self, settings: RunSettings) -> Build:
        rows = [(n, m, b) for n, places in self.tables.items() for m, b in sorted(places.items())]
        manifest = self.spark.createDataFrame(
            [(self.run_id, settings.run_timestamp.isoformat(), rows)], MANIFEST
        )
        manifest.coalesce(1).write.json(f"{self.root}/builds/{self.run_id}/manifest")
        return Build(self.root, self.run_id, self.tables)


def _in(months: Iterable[date]) -> Column:
    return F.col("month").isin(sorted(months))


def _reached(changed: Iterable[date], months: Sequence[date], back: int, ahead: int) -> set[date]:
    """Months up to ``back`` rows before or ``ahead`` rows after a changed one."""
    at = {month: i for i, month in enumerate(months)}
    places = [at[c] for c in changed if c in at]
    return {months[j] for i in places for j in range(max(0, i - back), min(len(months), i + ahead + 1))}


def rebuild(
    spark: SparkSession,
    sources: Sources,
    roles: Allowlist,
    skills: Allowlist,
    settings: RunSettings,
    root: str,
    changed: Iterable[date] | None = None,
    grain: str = "role",
) -> Build:
    """A new build under ``root`` after the postings of the ``changed`` months (first days) changed; without an
    earlier build or with None, after all did.

    The result equals a full build over ``sources`` with the same settings, but for rows that are taken over and
    keep the time and versions of the run that computed them. Where months appear before the last one or vanish,
    or an entity vanishes, rows of all months move: then all marts but the salaries are computed anew, from the
    cube. The allowlists and thresholds must be those of the earlier build.
    """
    before = latest_build(spark, root)
    out = _Writer(spark, root, settings.run_id, before)
    changed = None if before is None or changed is None else sorted({m.replace(day=1) for m in changed})
    postings = sources.postings
    if changed is not None:
        month = F.trunc(F.col("post_date").cast("date"), "month")
        postings = postings.where(month.isin(changed))
        if {"year", "month"} <= set(postings.columns):
            number = F.col("year") * 12 + F.col("month")
            postings = postings.where(number.isin([m.year * 12 + m.month for m in changed]))
    base = staged(universe_postings(postings, sources.company, roles, skills), "changed-base")
    out.write(CUBE, posting_cube(base), changed)
    out.write("salary_distribution", salary_distribution(base), changed)
    if changed is None or not _appended(before, out.months()) or _vanished(spark, before, out, changed):
        _all_marts(out, settings, grain)
    else:
        _job_demand(spark, before, out, changed)
        _skill_demand(spark, before, out, changed)
        _associations(spark, before, out, changed)
        _trajectories(spark, before, out, changed, settings, grain)
    return out.commit(settings)


def _appended(before: Build, months: Sequence[date]) -> bool:
    known = sorted(before.tables[CUBE])
    return list(months[: len(known)]) == known


def _vanished(spark: SparkSession, before: Build, out: _Writer, changed: Sequence[date]) -> bool:
    """Whether an entity, named in a changed month before, is left in no month."""
    was = before.read(spark, CUBE, changed).select(*ENTITY).distinct()
    gone = staged(was.join(out.read(CUBE, changed), list(ENTITY), "left_anti"), "left-out")
    if gone.isEmpty():
        return False
    others = out.read(CUBE, set(out.months()) - set(changed))
    return not gone.join(others, list(ENTITY), "left_anti").isEmpty()


def _all_marts(out: _Writer, settings: RunSettings, grain: str) -> None:
    cube = out.read(CUBE)
    out.write("job_demand", job_demand(cube), None)
    out.write("skill_demand", skill_demand(cube), None)
    out.write("role_skill_associations", role_skill_associations(cube), None)
    _all_trajectories(out, settings, grain)


def _all_trajectories(out: _Writer, settings: RunSettings, grain: str) -> None:
    out.write("trajectory_features", trajectory_features(out.read("job_demand"), settings, grain), None)
    out.write("trajectory_labels", trajectory_labels(out.read("trajectory_features"), settings), None)


def _filled(spark: SparkSession, entities: DataFrame, months: Iterable[date], counted: DataFrame) -> DataFrame:
    """Counts of all entities in all given months, zero where there are none. The months are a short list."""
    listed = spark.createDataFrame([(m,) for m in sorted(months)], "month date")
    grid = entities.crossJoin(F.broadcast(listed))
    cells = grid.join(_per_entity(counted), ["month", *ENTITY], "left")
    return cells.select("month", *ENTITY, *[F.coalesce(n, F.lit(v)).alias(n) for n, v in FILL.items()])


def _job_demand(spark: SparkSession, before: Build, out: _Writer, changed: Sequence[date]) -> None:
    months = out.months()
    affected = _reached(changed, months, 0, GROWTH_ROWS)
    looked_at = _reached(affected, months, GROWTH_ROWS, 0)
    # Every month of the panel names every entity.
    known = before.read(spark, "job_demand", months[:1]).select(*ENTITY)
    here = out.read(CUBE, changed)
    new = staged(here.select(*ENTITY).distinct().join(known, list(ENTITY), "left_anti"), "new-entities")
    every = staged(known.union(new), "entities")
    panel = _filled(spark, every, looked_at, _counted(out.read(CUBE, looked_at)))
    rows = with_growth(panel, ENTITY).where(_in(affected))
    # Elsewhere a new entity has the cells that it lacked: it occurs in changed months alone.
    added = _filled(spark, new, months, _counted(here))
    rows = rows.unionByName(with_growth(added, ENTITY).where(~_in(affected)))
    out.write("job_demand", rows, affected)


def _later_rows(series: DataFrame, keys: Sequence[str], changed: Sequence[date], rows: int) -> DataFrame:
    """Rows of the series at or within ``rows`` rows after a changed month."""
    whole, ordered = W.partitionBy(*keys), W.partitionBy(*keys).orderBy("month")
    number = F.row_number().over(ordered)
    found = series.withColumn("_number", number)
    upto = {f"_upto{i}": F.count_if(F.col("month") <= F.lit(c)).over(whole) for i, c in enumerate(changed)}
    found = found.withColumns(upto)
    near = [(F.col("month") >= F.lit(c)) & (F.col("_number") - F.col(f"_upto{i}") <= rows) for i, c in enumerate(changed)]
    return found.where(reduce(lambda a, b: a | b, near)).drop("_number", *upto)


def _touched(spark, before: Build, out: _Writer, changed, keys: Sequence[str]) -> DataFrame:
    """Series that had or have postings in a changed month."""
    was, now = before.read(spark, CUBE, changed), out.read(CUBE, changed)
    return staged(was.select(*keys).union(now.select(*keys)).distinct(), "touched")


def _months_of(df: DataFrame) -> set[date]:
    """The months that occur, a short list."""
    return {row.month for row in df.select("month").distinct().collect()}


def _skill_demand(spark: SparkSession, before: Build, out: _Writer, changed: Sequence[date]) -> None:
    keys = ["geo_id", "role_id", "skill_id"]
    touched = _touched(spark, before, out, changed, keys)
    # Growth counts the observed months of a series, however far back: whole series, but the touched ones only.
    series = staged(skill_demand(out.read(CUBE).join(touched, keys, "left_semi")), "touched-skills")
    later = _months_of(_later_rows(series, keys, changed, SKILL_ROWS)) - set(changed)
    # All series of a changed month are touched, so totals and shares are those of the month.
    rows = series.where(_in(changed))
    if later:
        grown = series.where(_in(later)).select("month", *keys, F.struct("yoy_growth").alias("_new"))
        old = before.read(spark, "skill_demand", later).join(grown, ["month", *keys], "left")
        growth = F.when(F.col("_new").isNotNull(), F.col("_new.yoy_growth")).otherwise(F.col("yoy_growth"))
        rows = rows.unionByName(old.withColumn("yoy_growth", growth).drop("_new"))
    out.write("skill_demand", rows, {*changed, *later})


def _associations(spark: SparkSession, before: Build, out: _Writer, changed: Sequence[date]) -> None:
    keys = ["role_id", "skill_id"]
    touched = _touched(spark, before, out, changed, keys)
    pairs = _trailing_pairs(cooccurrence_monthly(out.read(CUBE).join(touched, keys, "left_semi")))
    pairs = staged(pairs, "touched-pairs")
    months = _months_of(_later_rows(pairs, keys, changed, TRAILING_ROWS)) | set(changed)
    totals = cooccurrence_monthly(out.read(CUBE, months))
    rows = associations_of(pairs.where(_in(months)), totals, "co_occurrence_count")
    others = before.read(spark, "role_skill_associations", months - set(changed))
    rows = rows.unionByName(others.join(touched, keys, "left_anti"))
    out.write("role_skill_associations", rows, months)


def _trajectories(spark, before: Build, out: _Writer, changed, settings: RunSettings, grain: str) -> None:
    months = out.months()
    roles = out.read("job_demand", months[:1]).select("role_id").distinct()
    known = before.read(spark, "job_demand", months[:1]).select("role_id")
    if grain != "role" or not roles.join(known, "role_id", "left_anti").isEmpty():
        # A new series has rows in every month, and the finer grain numbers its rows over all places.
        return _all_trajectories(out, settings, grain)
    affected = _reached(changed, months, 0, FEATURE_ROWS)
    demand = out.read("job_demand", _reached(affected, months, FEATURE_ROWS, 0))
    # A series has a row in every month, so its rows up to a month are the months up to it.
    listed = spark.createDataFrame([(m, i + 1) for i, m in enumerate(months)], "month date, observed_months long")
    measured = volatility(demand).drop("observed_months").join(F.broadcast(listed), "month")
    measured = with_concentration(measured, demand).where(_in(affected))
    out.write("trajectory_features", scored_features(measured, settings), affected)
    features = out.read("trajectory_features", affected)
    out.write("trajectory_labels", trajectory_labels(features, settings), affected)
