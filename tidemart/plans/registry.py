"""Run records kept on files: registered once, never changed, and whole or not at all."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import METADATA
from ..session import scratch, staged
from ..sources.snapshot import ABSENT
from .contracts import ContractError, orphans, require_columns, require_contract

RUNS, LINEAGE, SPLITS = "pipeline_runs", "source_lineage", "model_eval_splits"


def registered(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The ``name`` records of all registered runs; those of a run whose registration broke off are left out."""
    found = _stored(spark, root, name)
    return found if name == RUNS else found.join(_stored(spark, root, RUNS).select("run_id"), "run_id", "left_semi")


def _stored(spark: SparkSession, root: str, name: str) -> DataFrame:
    schema = METADATA[name].schema
    try:
        return spark.read.schema(schema).parquet(f"{root}/runs/*/{name}")
    except AnalysisException as error:
        if error.getCondition() not in ABSENT:
            raise
        return spark.createDataFrame([], schema)


def register(
    spark: SparkSession, root: str, run: DataFrame, lineage: DataFrame, splits: DataFrame
) -> bool:
    """Keep the one record of ``run`` with its lineage and splits; False, and nothing changes, if its id is known.

    Every run has a folder of its own, and its own record is written last and never over another one: it is what
    makes the run known. Records are held to their contracts first, and must refer to this run. They are computed
    once, whatever reads them here: they are few, and made from whole sources.
    """
    with scratch():
        tables = {LINEAGE: lineage, SPLITS: splits, RUNS: run}
        for name, df in tables.items():
            require_columns(df, name, METADATA[name])
        made = {name: staged(df.select(*METADATA[name].columns), f"record-{name}") for name, df in tables.items()}
        return _registered_now(spark, root, made)


def _registered_now(spark: SparkSession, root: str, tables: dict[str, DataFrame]) -> bool:
    for name, df in tables.items():
        require_contract(df, name, METADATA[name])
    run = tables[RUNS]
    ids = [row.run_id for row in run.select("run_id").collect()]
    if len(ids) != 1:
        raise ContractError(f"one run is registered at a time, not {len(ids)}")
    for name in (LINEAGE, SPLITS):
        if not orphans(tables[name], run, "run_id").isEmpty():
            raise ContractError(f"{name} refers to another run than {ids[0]}")
    folder = f"{root}/runs/{ids[0]}"
    if not _stored(spark, root, RUNS).where(F.col("run_id") == ids[0]).isEmpty():
        return False
    for name, df in tables.items():
        # What an attempt before left behind is replaced; a record of the run itself never is.
        mode = "error" if name == RUNS else "overwrite"
        df.coalesce(1).write.mode(mode).parquet(f"{folder}/{name}")
    return True

