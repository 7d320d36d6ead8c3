"""Rates, ratios and the other arithmetic of the analyses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def per_population(count: Column, population: Column, per: float = 1e5) -> Column:
    """Count per ``per`` inhabitants; NULL for an empty population."""
    return F.try_divide(F.lit(per) * count, population)


def inverted_rate(rate: Column, threshold: float = 10.0) -> Column:
    """100000/rate above the threshold, the flat 10000 at or below it."""
    return F.when(rate > threshold, F.lit(1e5) / rate).otherwise(F.lit(1e4))


def percentage(part: Column, whole: Column) -> Column:
    """100·part/whole; NULL when the whole is zero."""
    return F.lit(100.0) * F.try_divide(part.cast("double"), whole)


def safe_percentage(part: Column, whole: Column) -> Column:
    """Percentage where an undefined ratio is 0 but x/0 stays NULL."""
    return F.when((whole == 0) & (part != 0), F.lit(None).cast("double")).otherwise(
        F.coalesce(percentage(part, whole), F.lit(0.0))
    )


def share_of_sum(part: Column, rest: Column) -> Column:
    """Percentage of ``part`` in part + rest."""
    return percentage(part, part + rest)


def complement(value: Column) -> Column:
    """What is missing to one hundred."""
    return F.lit(100.0) - value


def annualise(value: Column, start: Column, as_of: Column, days: int = 365) -> Column:
    """Scale a count gathered between two dates to a year."""
    return value * F.try_divide(F.lit(float(days)), F.datediff(as_of, start))


def percent_change(first: Column, last: Column) -> Column:
    """Change in percent of ``first``; a zero base counts as no change."""
    return F.when(first == 0, F.lit(0.0)).otherwise(
        F.lit(100.0) * F.try_divide((last - first).cast("double"), first)
    )


def sample_size(percent: Column, count: Column) -> Column:
    """Size of the sample in which ``count`` makes up ``percent``."""
    return F.when(
        percent > 0, F.floor(F.try_divide(count.cast("double"), percent / F.lit(100.0)))
    )


def round_to_long(value: Column) -> Column:
    """Nearest integer, halves to even."""
    return F.bround(value).cast("long")
