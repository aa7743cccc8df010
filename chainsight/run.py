"""One run's identity and clock, shared by all of its tables."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from chainsight import PIPELINE_VERSION


@dataclass(frozen=True)
class RunContext:
    """Taken once where a run begins and handed to every job, so that all tables, reports and
    log rows of the run carry the same time and can be joined by it; given explicitly, a
    run can be repeated with the same lineage."""

    instant: datetime = field(default_factory=lambda: datetime.now(timezone.utc))
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    version: str = PIPELINE_VERSION

    def __post_init__(self):
        if self.instant.tzinfo is None:
            raise ValueError("a run's instant needs a time zone")

    def stamp(self) -> Column:
        """The run's time, the same whatever the session's time zone."""
        micros = int(self.instant.timestamp()) * 1_000_000 + self.instant.microsecond
        return F.timestamp_micros(F.lit(micros).cast("long"))

    def day(self) -> Column:
        """Its date in UTC."""
        return F.lit(self.instant.astimezone(timezone.utc).date())
