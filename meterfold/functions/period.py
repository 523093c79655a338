"""Time-of-use period, day type and season of an instant, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PEAK, HALF_PEAK, SATURDAY_HALF_PEAK, OFF_PEAK = "PE", "PP", "SPP", "OP"

# Summer runs from 16 May to 15 October, written as month * 100 + day.
SUMMER = (516, 1015)


# Hour spans of each kind of day, half-open; all other hours are off-peak.
SUMMER_WORKDAY = {(9, 16): HALF_PEAK, (16, 22): PEAK, (22, 24): HALF_PEAK}
OTHER_WORKDAY = {(6, 11): HALF_PEAK, (14, 24): HALF_PEAK}
SUMMER_SATURDAY = {(9, 24): SATURDAY_HALF_PEAK}
OTHER_SATURDAY = {(6, 11): SATURDAY_HALF_PEAK, (14, 24): SATURDAY_HALF_PEAK}

_DEARER_FIRST = (PEAK, HALF_PEAK, SATURDAY_HALF_PEAK, OFF_PEAK)


def _by_hour(spans: dict[tuple[int, int], str]) -> list[str]:
    labels = [OFF_PEAK] * 24
    for (first, last), label in spans.items():
        labels[first:last] = [label] * (last - first)
    return labels


def _with_last_instant(labels: list[str]) -> list[str]:
    """Labels on the hour, where the span that ends there may still hold."""
    return labels[:1] + [min(pair, key=_DEARER_FIRST.index) for pair in zip(labels, labels[1:])]


def _table(labels: list[str]) -> Column:
    return F.expr("array(" + ", ".join(f"'{label}'" for label in labels) + ")")


def is_summer(ts: Column) -> Column:
    return (F.month(ts) * 100 + F.dayofmonth(ts)).between(*SUMMER)


def day_type(ts: Column) -> Column:
    """``O`` Monday to Friday, ``T`` Saturday, ``S`` Sunday."""
    weekday = F.dayofweek(ts)
    return F.when(weekday == 1, "S").when(weekday == 7, "T").otherwise("O")


def season_type(ts: Column) -> Column:
    """``S`` summer, ``N`` other months; Sunday has one all-year season ``A``."""
    return F.when(F.dayofweek(ts) == 1, "A").when(is_summer(ts), "S").otherwise("N")


def period_type(ts: Column, closed: bool = False) -> Column:
    """Peak, half-peak, Saturday half-peak or off-peak, looked up by the hour.

    Spans are half-open. ``closed=True`` counts a span's last instant into it and resolves
    the overlap in favour of the dearer period, as the price lookup does.
    """

    def label(refine) -> Column:
        summer = is_summer(ts)
        saturday, workday = (
            F.when(summer, _table(refine(_by_hour(in_summer)))).otherwise(_table(refine(_by_hour(otherwise))))
            for in_summer, otherwise in ((SUMMER_SATURDAY, OTHER_SATURDAY), (SUMMER_WORKDAY, OTHER_WORKDAY))
        )
        return F.element_at(F.when(F.dayofweek(ts) == 7, saturday).otherwise(workday), F.hour(ts) + 1)

    by_hour = label(list)
    if closed:
        on_the_hour = F.date_trunc("hour", ts).cast("timestamp_ntz") == ts
        by_hour = F.when(on_the_hour, label(_with_last_instant)).otherwise(by_hour)
    return F.when(F.dayofweek(ts) == 1, F.when(ts.isNotNull(), OFF_PEAK)).otherwise(by_hour)


def rate_period_closed(ts: Column) -> Column:
    return period_type(ts, closed=True)
