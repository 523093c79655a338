"""Which columns of a telemetry frame play which role."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Series:
    """A meter series: readings of ``value`` at ``ts``, one series per ``keys``.

    A reading is identified by its keys and ``order``, the finest time the source keeps.
    ``tie`` names a column that decides between readings of one instant where the source
    allows several; without it first and last readings stay hash aggregates.
    """

    keys: tuple[str, ...] = ("entity_id", "key_id")
    ts: str = "ts"
    value: str = "value"
    order: str = "ts"
    tie: str | None = None

    def renamed(self, **changes) -> "Series":
        return replace(self, **changes)

    @property
    def ordering(self) -> list[str]:
        return [self.order] if self.tie is None else [self.order, self.tie]

    def _rank(self) -> Column:
        return F.col(self.order) if self.tie is None else F.struct(self.order, self.tie)

    def first(self, column: str | None = None) -> Column:
        return F.min_by(column or self.value, self._rank())

    def last(self, column: str | None = None) -> Column:
        return F.max_by(column or self.value, self._rank())


# Telemetry as delivered: ordered by its epoch millisecond.
TELEMETRY = Series(order="ts_ms")
