"""Filtering postings to an allowlisted universe of roles and skills."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Allowlist:
    """Configured ids with their names. ``kind`` is ``role`` or ``skill``."""

    kind: str
    entries: tuple[tuple[str, str], ...] = ()

    @classmethod
    def from_config(cls, kind: str, rows: Iterable[Mapping[str, str]] | None) -> Allowlist:
        entries = []
        for row in rows or ():
            key = (row.get(f"{kind}_id") or "").strip()
            name = (row.get(f"{kind}_name") or "").strip()
            if key and not name:
                raise ValueError(f"{kind} {key!r} has no name")
            if key:
                entries.append((key, name))
        return cls(kind, tuple(entries))

    @property
    def id_column(self) -> str:
        return f"{self.kind}_id"

    @property
    def source_ids(self) -> list[str]:
        """Ids as configured, for the case-sensitive match against the source."""
        return sorted({key for key, _ in self.entries})

    @property
    def ids(self) -> list[str]:
        """Ids in upper case, as the staged postings carry them."""
        return sorted({key.upper() for key, _ in self.entries})

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(key.upper(), name) for key, name in self.entries]
        return spark.createDataFrame(rows, f"{self.kind}_id string, {self.kind}_name string")


def dimension(allowlist: Allowlist, spark: SparkSession) -> DataFrame:
    """Distinct (id, name) pairs of a list."""
    return allowlist.frame(spark).distinct()


def in_universe(postings: DataFrame, roles: Allowlist, skills: Allowlist) -> DataFrame:
    """Postings whose role or skill is listed. Only if both lists are empty does everything pass.

    The lists are configuration, so they are literal sets whatever their length: one predicate on
    posting columns, which Catalyst runs next to the scan, below every join.
    """
    if not roles.ids and not skills.ids:
        return postings
    listed = [F.col(a.id_column).isin(a.ids) for a in (roles, skills) if a.ids]
    return postings.where(reduce(lambda one, other: one | other, listed))


def allowlist_sizes(roles: DataFrame, skills: DataFrame) -> DataFrame:
    """Both list sizes as one row."""
    return roles.agg(F.count(F.lit(1)).alias("role_allowlist_size")).crossJoin(
        skills.agg(F.count(F.lit(1)).alias("skill_allowlist_size"))
    )
