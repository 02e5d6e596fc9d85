"""Session set-up and the shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Folder of a local session that names none, by application.
_OWN_FOLDERS: dict[str, str] = {}
_MADE: ContextVar[list[DataFrame] | None] = ContextVar("made", default=None)


def local_session(app: str = "tidemart", cores: int | str = "*", **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Small test data: keep all cores busy instead of merging into one megabyte-sized task.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read: ``spark.checkpoint.dir`` as the cluster sets it.

    Only a local master may fall back to a folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    # The setting cannot be changed in a running session.
    application = spark.sparkContext.applicationId
    if application not in _OWN_FOLDERS:
        _OWN_FOLDERS[application] = tempfile.mkdtemp(prefix="tidemart-")
    return _OWN_FOLDERS[application]


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Executions in here remove their shuffle files when they end, instead of when the driver's memory
    happens to be collected: many steps in a row would fill the executors' disks."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, True)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def staged(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet and go on from the written table.

    Several consumers then share one computation, and a lost executor costs a re-read of files
    rather than a recomputation from the raw snapshot. Nothing reads the shuffles of the step again, so they go.
    """
    spark = df.sparkSession
    path = f"{folder or shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    with shuffles_removed(spark):
        df.write.mode("error").option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._staged_path = path
    if (made := _MADE.get()) is not None:
        made.append(table)
    return table


def removed(*tables: DataFrame) -> None:
    """Delete tables that :func:`staged` wrote, once everything that reads them has itself been written.

    A step in rounds would else leave the tables of every round on the shared disk. Other frames are left alone.
    """
    for table in tables:
        written = getattr(table, "_staged_path", None)
        if written:
            spark = table.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(written)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextmanager
def scratch() -> Iterator[list[DataFrame]]:
    """Tables that are staged in here are removed at its end, but for those taken out of the list that it gives."""
    made: list[DataFrame] = []
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)
        removed(*made)
