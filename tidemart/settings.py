"""One settings object for a run: versions, thresholds, dates and folders."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import date, datetime, timezone


def new_run_id(prefix: str = "run") -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


def new_extract_id(now: datetime | None = None) -> str:
    now = now or datetime.now(timezone.utc)
    return f"extract_{now:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:6]}"


def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class RunSettings:
    # Published versions, gates and split dates of the data contract.
    feature_version: str = "phase1-v1"
    label_version: str = "phase1-v1"
    method_version: str = "rules-v1"
    label_method: str = "phase1_rules"
    allowlist_version: str = "2026.04"
    min_observations: int = 36
    min_disclosed_count: int = 5
    sample_rows: int = 25_000
    train_start: date = date(2023, 1, 1)
    validation_start: date = date(2025, 1, 1)
    extract_start: date = date(2024, 1, 1)
    extract_end: date = date(2026, 3, 31)

    # Values of this run. Taken once on the driver so that every table carries the same ones.
    run_id: str = field(default_factory=new_run_id)
    run_timestamp: datetime = field(default_factory=_utc_now)
    notes: str = "local load"

    source_root: str = "data/raw_snapshot"
    output_root: str = "data/processed"
    sample_root: str = "data/dev_processed"

    def __post_init__(self):
        if self.min_observations < 1:
            raise ValueError("min_observations must be at least 1")
        if self.extract_start > self.extract_end:
            raise ValueError("extract_start lies after extract_end")
