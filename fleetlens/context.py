"""Run context: the one reference time and the provenance of a run."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RunContext:
    """Everything an export needs besides its tables.

    ``as_of`` replaces the database clock: every export of a run compares
    against the same instant, so a run is reproducible and its exports agree.
    ``run_id`` is the ``YYYYmmdd_HHMMSS`` snapshot key written into every row.
    """

    as_of: datetime = datetime(2024, 1, 30, 23, 58, 0)
    server_name: str = "lns-demo"
    server_url: str = "https://lns.example.org"
    environment: str = "Production"
    api_port: int = 8750
    run_id: str = field(default="")
    # Type of the source timestamps: parquet test data is timestamp_ntz,
    # a JDBC source with zoned timestamps would use "timestamp".
    timestamp_type: str = "timestamp_ntz"

    def __post_init__(self):
        if not self.run_id:
            object.__setattr__(self, "run_id", self.as_of.strftime("%Y%m%d_%H%M%S"))

    def now(self) -> Column:
        """The reference time as a literal of the source timestamp type."""
        return F.lit(self.as_of.strftime("%Y-%m-%d %H:%M:%S")).cast(self.timestamp_type)

    def ago(self, seconds: int) -> Column:
        """``as_of - seconds`` as a constant-folded literal."""
        return self.now() - F.expr(f"INTERVAL {int(seconds)} SECONDS")

    @property
    def export_date(self) -> str:
        return self.as_of.strftime("%Y-%m-%dT%H:%M:%S+00:00")


DEFAULT_CONTEXT = RunContext()
