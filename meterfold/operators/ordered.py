"""Order-dependent computations over a series that one task could not hold.

``lag`` and running sums over ``partitionBy(series)`` would send a whole series to one
task. Here a series is cut into time slices: the window runs inside a slice, and what one
slice hands to the next travels through one row per slice.

Neither step can grow out of hand. A series has at most one slice per hour of its life,
however many readings it has. A slice has at most 3.6 million readings, since a reading is
identified by its series and millisecond; ``slice_grain="minute"`` brings that to 60,000.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterfold.functions.timebucket import calendar_bucket
from meterfold.operators.series import Series

SLICE = "_slice"


def with_previous(readings: DataFrame, s: Series, slice_grain: str = "hour") -> DataFrame:
    """Add ``prev_value`` and ``has_prev``: the reading before, in the order of the series."""
    sliced = readings.withColumn(SLICE, calendar_bucket(F.col(s.ts), slice_grain))
    across = Window.partitionBy(*s.keys).orderBy(SLICE)
    handover = (
        sliced.groupBy(*s.keys, SLICE)
        .agg(s.last().alias("_tail"))
        .select(
            *s.keys,
            SLICE,
            F.lag("_tail").over(across).alias("_carry"),
            (F.row_number().over(across) > 1).alias("_follows"),
        )
    )
    within = Window.partitionBy(*s.keys, SLICE).orderBy(*s.ordering)
    return (
        sliced.withColumn("_pos", F.row_number().over(within))
        .withColumn("_lag", F.lag(s.value).over(within))
        .join(handover, [*s.keys, SLICE])
        .withColumn("prev_value", F.when(F.col("_pos") > 1, F.col("_lag")).otherwise(F.col("_carry")))
        .withColumn("has_prev", (F.col("_pos") > 1) | F.col("_follows"))
        .drop("_pos", "_lag", "_carry", "_follows", SLICE)
    )


def running_total(readings: DataFrame, s: Series, output: str, slice_grain: str = "hour") -> DataFrame:
    """Add the running sum of the value up to and including each reading."""
    sliced = readings.withColumn(SLICE, calendar_bucket(F.col(s.ts), slice_grain))
    before = Window.partitionBy(*s.keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    handover = (
        sliced.groupBy(*s.keys, SLICE)
        .agg(F.sum(s.value).alias("_total"))
        .select(*s.keys, SLICE, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_carry"))
    )
    within = (
        Window.partitionBy(*s.keys, SLICE)
        .orderBy(*s.ordering)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        sliced.withColumn("_sum", F.sum(s.value).over(within))
        .join(handover, [*s.keys, SLICE])
        .withColumn(output, F.coalesce("_sum", F.lit(0)) + F.col("_carry"))
        .drop("_sum", "_carry", SLICE)
    )
