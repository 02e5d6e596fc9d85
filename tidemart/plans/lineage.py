"""Source lineage by month: fingerprints that add up, and are taken again only for months whose files changed."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import METADATA
from ..sources.snapshot import PARTITIONS, month_groups, months_stored
from .metadata import row_hashes

MONTHLY = "year int, month int, files long, files_hash decimal(38,0), row_count long, row_hash decimal(38,0)"


def stored_files(spark: SparkSession, path: str) -> DataFrame:
    """Per month of a snapshot the number of its files, a hash of their names, sizes and times, and of its rows.

    No column is read: the footers tell the rows.
    """
    file = [f"_metadata.{c}" for c in ("file_name", "file_size", "file_modification_time")]
    rows = spark.read.schema(PARTITIONS).parquet(path).select("year", "month", *file)
    files = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("rows"))
    name = F.xxhash64("file_name", "file_size", "file_modification_time").cast("decimal(38,0)")
    return files.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("files"), F.sum(name).alias("files_hash"), F.sum("rows").alias("row_count")
    )


def month_lineage(spark: SparkSession, path: str, known: DataFrame | None = None) -> DataFrame:
    """A row per month of the snapshot ``path``: files, files_hash, row_count and row_hash, the sum of its row
    hashes.

    ``known`` is an earlier result: a month whose files are the same takes its hash over, and only the others
    are read. Rows are hashed in the types their files have, so the hash of a month depends on no other month.
    The table has a row per calendar month and is put together on the driver.
    """
    folders = months_stored(spark, path)
    if not folders:
        return spark.createDataFrame([], MONTHLY)
    now = {(r.year, r.month): r for r in stored_files(spark, path).collect()}
    before = {(r.year, r.month): r for r in known.collect()} if known is not None else {}
    same = lambda m: m in before and (before[m].files, before[m].files_hash) == (now[m].files, now[m].files_hash)
    changed = [m for m in now if not same(m)]
    hashes = {m: before[m].row_hash for m in now if same(m)}
    if changed:
        found = [
            df.groupBy("year", "month").agg(row_hashes(df).alias("row_hash"))
            for df in month_groups(spark, [(path, folders[m]) for m in changed])
        ]
        hashes |= {(r.year, r.month): r.row_hash for r in reduce(DataFrame.unionByName, found).collect()}
    rows = [(*m, r.files, r.files_hash, r.row_count, hashes[m]) for m, r in sorted(now.items())]
    return spark.createDataFrame(rows, MONTHLY)


def changed_months(known: DataFrame, current: DataFrame) -> list[date]:
    """Months that came, went or have other rows: what an incremental rebuild starts from."""

    def content(df: DataFrame) -> dict:
        return {date(r.year, r.month, 1): (r.row_count, r.row_hash) for r in df.collect()}

    one, other = content(known), content(current)
    return sorted(m for m in one.keys() | other.keys() if one.get(m) != other.get(m))


def lineage_record(monthly: DataFrame, run_id: str, name: str, path: str) -> DataFrame:
    """The lineage record of a whole source: its months added up."""
    total = monthly.agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
        F.sum("row_hash").cast("decimal(38,0)").cast("string").alias("checksum"),
    )
    source = {"run_id": run_id, "source_name": name, "source_path": path}
    return total.select(
        *[F.lit(value).alias(column) for column, value in source.items()], "row_count", "checksum"
    ).select(*METADATA["source_lineage"].columns)

