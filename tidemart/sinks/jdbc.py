"""Publishing marts to a serving database over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..plans.contracts import require_contract
from ..schemas import MARTS


def load_mart(
    df: DataFrame,
    url: str,
    table: str,
    connections: int = 16,
    batch_rows: int = 10_000,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Full refresh of one table: truncate, then parallel batched inserts.

    Keeping the table (``truncate``) keeps its keys, indexes and grants.
    """
    writer = (
        df.write.format("jdbc")
        .mode("overwrite")
        .option("url", url)
        .option("dbtable", table)
        .option("truncate", True)
        .option("numPartitions", connections)
        .option("batchsize", batch_rows)
    )
    for name, value in (properties or {}).items():
        writer = writer.option(name, value)
    writer.save()


def publish(
    marts: Mapping[str, DataFrame],
    url: str,
    schema: str = "analytics",
    properties: Mapping[str, str] | None = None,
) -> None:
    """Load all six marts after every one has passed its contract.

    Executors write on their own connections, so there is no transaction across tables: a broken
    mart stops the publication before the first write, a failure later is cured by running again.
    """
    missing = [name for name in MARTS if name not in marts]
    if missing:
        raise FileNotFoundError(f"marts not built: {', '.join(missing)}")
    for name, contract in MARTS.items():
        require_contract(marts[name], name, contract)
    for name, contract in MARTS.items():
        load_mart(marts[name].select(*contract.columns), url, f"{schema}.{name}", properties=properties)


def append_runs(runs: DataFrame, url: str, table: str = "metadata.pipeline_runs", **options: str) -> None:
    """Append run records that :func:`tidemart.plans.metadata.new_runs` found to be new."""
    writer = runs.write.format("jdbc").mode("append").option("url", url).option("dbtable", table)
    for name, value in options.items():
        writer = writer.option(name, value)
    writer.save()
