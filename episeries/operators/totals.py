"""Sums, totals over combinations of dimensions, national rows.

All of these are hash aggregates with a map-side step, so a dominant key costs
one partial row per task instead of a hot shuffle partition.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are all present: a NULL key belongs to no group."""
    return df.filter(reduce(Column.__and__, [F.col(k).isNotNull() for k in keys]))


def total_of(measure: str) -> Column:
    """Sum in which a group of NULLs counts as 0."""
    return F.coalesce(F.sum(measure), F.lit(0))


def group_sum(df: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """One row per key with the measures summed."""
    return with_keys(df, keys).groupBy(*keys).agg(*[total_of(m).alias(m) for m in measures])


def cube_totals(
    df: DataFrame, fixed: list[str], members: Mapping[str, str], measures: list[str]
) -> DataFrame:
    """Add the total of every combination of the dimensions in ``members``.

    ``members`` maps each dimension to the name its total goes by. The rows are
    first reduced to the finest grain, so that the expansion into 2^d grouping
    sets multiplies panel rows and not raw rows.
    """
    dimensions = list(members)
    panel = group_sum(df, fixed + dimensions, measures)
    sets = [
        fixed + list(kept)
        for size in range(len(dimensions), -1, -1)
        for kept in combinations(dimensions, size)
    ]
    named = [
        F.when(F.grouping(d) == 1, F.lit(member)).otherwise(F.col(d)).alias(f"_{d}")
        for d, member in members.items()
    ]
    totals = panel.groupingSets(sets, *fixed, *dimensions).agg(
        *named, *[total_of(m).alias(f"_{m}") for m in measures]
    )
    return totals.select(
        *fixed,
        *[F.col(f"_{d}").alias(d) for d in dimensions],
        *[F.col(f"_{m}").alias(m) for m in measures],
    )


def append_national(
    df: DataFrame,
    by: list[str],
    label: str,
    member: str,
    sums: list[str] = (),
    means: list[str] = (),
) -> DataFrame:
    """Detail rows plus one labelled row per ``by`` with sums and plain means."""
    national = with_keys(df, by).groupBy(*by).agg(
        *[total_of(c).alias(c) for c in sums], *[F.avg(c).alias(c) for c in means]
    )
    return df.unionByName(
        national.withColumn(label, F.lit(member)), allowMissingColumns=True
    )


def expand_national(
    df: DataFrame,
    by: list[str],
    label: str,
    member: str,
    sums: list[str] = (),
    means: list[str] = (),
) -> DataFrame:
    """:func:`append_national` for a panel with one row per (by, label).

    Uniqueness lets both levels come out of one grouping-sets aggregate, so a
    costly input is evaluated once.
    """
    rest = [c for c in df.columns if c not in {*by, label, *sums, *means}]
    top = F.grouping(label) == 1
    level = with_keys(df, by + [label]).groupingSets([by + [label], by], *by, label).agg(
        F.when(top, F.lit(member)).otherwise(F.col(label)).alias("_label"),
        *[F.when(top, total_of(c)).otherwise(F.max(c)).alias(f"_{c}") for c in sums],
        *[F.when(top, F.avg(c)).otherwise(F.max(c)).alias(f"_{c}") for c in means],
        *[F.when(~top, F.max(c)).alias(f"_{c}") for c in rest],
    )
    return level.select(
        *[F.col("_label" if c == label else c if c in by else f"_{c}").alias(c)
          for c in df.columns]
    )
