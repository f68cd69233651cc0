"""One instant per batch, shared by every column that records time."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the end of a version that is still valid.
OPEN_END = "9999-12-31 00:00:00"


@dataclass(frozen=True)
class BatchClock:
    """The batch instant as text plus the timestamp type to publish it as."""

    instant: str
    kind: str = "timestamp"

    @classmethod
    def at(cls, moment: datetime | str, kind: str = "timestamp") -> BatchClock:
        text = moment.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(moment, datetime) else moment
        return cls(text, kind)

    @property
    def now(self) -> Column:
        return F.lit(self.instant).cast(self.kind)

    @property
    def open_end(self) -> Column:
        return F.lit(OPEN_END).cast(self.kind)
