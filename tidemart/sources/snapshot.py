"""Reading snapshots and dimensions back, with typed-empty fallbacks."""

from __future__ import annotations

import re
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.casts import typed
from .extract import in_half_open_window

PARTITIONS = T.StructType(
    [T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())]
)


MONTH_FOLDER = re.compile(r"/year=(?P<year>\d+)/month=(?P<month>\d+)(?=/[^/]+$)")
# Folders whose schema is read at the same time.
FOOTERS_AT_ONCE = 8
LAST_DAY = date(9999, 12, 30)
# A path that does not exist, and a folder without a data file.
ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def posting_file_schema(with_skills: bool = True) -> T.StructType:
    skills = list(schemas.SKILL_COLUMNS) if with_skills else []
    return T.StructType([*schemas.POSTINGS, *skills, *PARTITIONS])


def months_stored(spark: SparkSession, path: str) -> dict[tuple[int, int], str]:
    """The month folders of a snapshot, (year, month) by folder; none if there is no snapshot.

    Only names are listed: no file is opened.
    """
    try:
        files = spark.read.schema(PARTITIONS).parquet(path).inputFiles()
    except AnalysisException as error:
        if error.getCondition() not in ABSENT:
            raise
        return {}
    found = {}
    for file in files:
        if folder := MONTH_FOLDER.search(file):
            found[int(folder["year"]), int(folder["month"])] = f"{path}/{folder[0].strip('/')}"
    return found


def read_monthly(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """A snapshot laid out as ``year=/month=``, with the stored types unless ``schema`` is given.

    Folders outside the date range are not looked at: a predicate on ``post_date`` alone would open every
    month. Months may differ in their columns and types, see :func:`read_months`.
    """
    if schema:
        df = spark.read.schema(schema).parquet(path)
    else:
        first = (start.year, start.month) if start else (0, 0)
        last = (end.year, end.month) if end else (9999, 12)
        folders = [f for month, f in months_stored(spark, path).items() if first <= month <= last]
        if not folders:
            return _empty(spark, posting_file_schema())
        df = read_months(spark, [(path, folder) for folder in folders])
    index = F.col("year") * 12 + F.col("month")
    if start:
        df = df.where(index >= start.year * 12 + start.month)
    if end:
        df = df.where(index <= end.year * 12 + end.month)
    if start or end:
        df = df.where(in_half_open_window("post_date", start or date.min, end or LAST_DAY))
    return df


def month_groups(spark: SparkSession, folders: Iterable[tuple[str, str]]) -> list[DataFrame]:
    """Month folders, each with the snapshot it lies in, as a frame per stored schema.

    The schema of a folder is that of its files, as one extraction wrote them: one footer each is read.
    """
    folders = sorted(folders)
    with ThreadPoolExecutor(FOOTERS_AT_ONCE) as pool:
        found = list(pool.map(lambda place: spark.read.parquet(place[1]).schema, folders))
    groups: dict[tuple[str, str], tuple[T.StructType, list[str]]] = {}
    for (base, folder), schema in zip(folders, found):
        plain = T.StructType([T.StructField(f.name, f.dataType) for f in schema if f.name not in PARTITIONS.names])
        groups.setdefault((base, plain.json()), (plain, []))[1].append(folder)
    return [
        spark.read.schema(T.StructType([*schema, *PARTITIONS])).option("basePath", base).parquet(*members)
        for (base, _), (schema, members) in groups.items()
    ]


def read_months(
    spark: SparkSession, folders: Iterable[tuple[str, str]], canonical: T.StructType | None = None
) -> DataFrame:
    """Month folders, each with the snapshot it lies in, as one frame, although their files may differ in schema.

    Folders of one schema are read together. A column that has the same type wherever it occurs keeps it; one
    whose type changes comes in its type of ``canonical`` (the posting columns unless given), and one that is
    not named there as text. A column that some folders lack is null in them.
    """
    canonical = posting_file_schema() if canonical is None else canonical
    known = {f.name: f.dataType for f in canonical}
    groups = month_groups(spark, folders)
    kinds: dict[str, set[str]] = {}
    for df in groups:
        for field in df.schema:
            kinds.setdefault(field.name, set()).add(field.dataType.json())
    drifting = {name for name, types in kinds.items() if len(types) > 1}
    frames = []
    for df in groups:
        same = {n: typed(df, n, known.get(n, T.StringType())) for n in drifting if n in df.columns}
        frames.append(df.withColumns(same) if same else df)
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), frames)


def _empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_monthly_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A snapshot by month that may be absent, and is then an empty frame of ``schema``."""
    folders = months_stored(spark, path)
    if not folders:
        return _empty(spark, schema)
    return read_months(spark, [(path, folder) for folder in folders.values()], schema)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet source that may be absent: as stored, or else an empty frame of ``schema``.

    The columns of all its files are read, so one that only some months have is null in the others.
    """
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ABSENT:
            raise
        return _empty(spark, schema)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a Parquet table is there."""
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ABSENT:
            raise
        return False
    return True


def require_columns(df: DataFrame, names: Iterable[str], source: str) -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"{source} lacks columns {missing}")
    return df
