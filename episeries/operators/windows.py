"""Windows over dated series.

A series is what shares the key columns; it holds one row per day, so its size
is bounded by the calendar however large the raw input is: aggregate to
(key, day) first. Days are counted in a numeric column, which gives calendar
ranges (a gap shrinks the window) and one common sort order, so all windows of
an analysis run after a single exchange and sort.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from episeries.functions.measures import percent_change

DAY = "_day"


def with_day(df: DataFrame, date: str = "date") -> DataFrame:
    """Add the day number that series windows are ordered by."""
    return df.withColumn(DAY, F.unix_date(date))


def series(*keys: str) -> WindowSpec:
    """The series of each key, in day order."""
    return Window.partitionBy(*keys).orderBy(DAY)


def last_days(window: WindowSpec, days: int) -> WindowSpec:
    """The calendar days t-days+1 … t."""
    return window.rangeBetween(-(days - 1), 0)


def so_far(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, 0)


def running_total(value: Column, window: WindowSpec) -> Column:
    return F.sum(value).over(so_far(window))


def running_mean(value: Column, window: WindowSpec) -> Column:
    return F.avg(value).over(so_far(window))


def rolling_sum(value: Column, window: WindowSpec, days: int) -> Column:
    return F.sum(value).over(last_days(window, days))


def rolling_mean(value: Column, window: WindowSpec, days: int) -> Column:
    return F.avg(value).over(last_days(window, days))


def day_delta(value: Column, window: WindowSpec) -> Column:
    """Difference from the previous row of the series."""
    return value - F.lag(value, 1).over(window)


def range_change(value: Column, window: WindowSpec, days: int) -> Column:
    """Change in percent against the first value of the last ``days`` days."""
    return percent_change(F.first(value).over(last_days(window, days)), value)


def smoothed_changes(
    df: DataFrame, value: str, window: WindowSpec, outputs: Mapping[str, tuple[int, int]]
) -> DataFrame:
    """Change of a rolling mean against the mean some rows back.

    ``outputs`` maps a new column to (days smoothed, rows back). Two window
    steps on the same partitioning and order: one exchange.
    """
    smooth = df.withColumns({
        f"_smooth_{out}": rolling_mean(F.col(value), window, days)
        for out, (days, _) in outputs.items()
    })
    return smooth.withColumns({
        out: percent_change(
            F.lag(f"_smooth_{out}", back).over(window), F.col(f"_smooth_{out}")
        )
        for out, (_, back) in outputs.items()
    }).drop(*[f"_smooth_{out}" for out in outputs])


def top_rows(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group; ``order`` must break ties.

    The rank filter becomes a per-task group limit before the exchange, so a
    dominant group sends at most ``n`` rows from each task.
    """
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.filter(F.col("_rank") <= n).drop("_rank")
