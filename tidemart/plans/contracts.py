"""Checks that stand in for database constraints: presence, counts, NOT NULL, keys, references."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import MARTS, Contract


class ContractError(ValueError):
    """A mart breaks its published contract."""


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda left, right: left.unionByName(right), frames)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _stack(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in tables.items()
        ]
    )


def negative_counts(df: DataFrame, column: str = "posting_count") -> DataFrame:
    """How many rows have a negative count."""
    return df.agg(F.count_if(F.col(column) < 0).alias("negative_rows"))


def null_violations(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Nulls per required column, all columns in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counted.unpivot([], list(required), "column_name", "null_rows")


def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return (
        df.groupBy(*key).agg(F.count(F.lit(1)).alias("key_rows")).where(F.col("key_rows") > 1)
    )


def key_summary(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """How many key values repeat, and by how many rows too many."""
    return key_violations(df, key).agg(
        F.count(F.lit(1)).alias("repeated_keys"),
        F.coalesce(F.sum(F.col("key_rows") - 1), F.lit(0)).alias("surplus_rows"),
    )


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose key has no parent."""
    return child.join(parent.select(key).distinct(), key, "left_anti")


def column_checks(contract: Contract) -> list[Column]:
    """Counts of what no column may hold: nulls where a value is required, and negative counts."""
    checks = {f"null {c}": F.col(c).isNull() for c in contract.required}
    checks |= {f"negative {c}": F.col(c) < 0 for c in contract.columns if c.endswith("_count")}
    return [F.count_if(broken).alias(name) for name, broken in checks.items()]


def contract_report(
    df: DataFrame, contract: Contract, counted: Mapping[str, int] | None = None
) -> dict[str, int]:
    """Violations by name; empty when the contract holds. One pass for the columns, unless they were ``counted``
    while the table was written, and one for the key."""
    found = dict(counted) if counted is not None else df.agg(*column_checks(contract)).first().asDict()
    found["repeated key"] = key_summary(df, contract.key).first().repeated_keys
    return {name: n for name, n in found.items() if n}


def require_columns(df: DataFrame, name: str, contract: Contract) -> None:
    missing = [c for c in contract.columns if c not in df.columns]
    if missing:
        raise ContractError(f"{name} lacks columns {missing}")


def require_contract(
    df: DataFrame, name: str, contract: Contract | None = None, counted: Mapping[str, int] | None = None
) -> None:
    contract = contract or MARTS[name]
    require_columns(df, name, contract)
    violations = contract_report(df, contract, counted)
    if violations:
        raise ContractError(f"{name} breaks its contract: {violations}")
