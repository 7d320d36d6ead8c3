"""Pivot and unpivot."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_unique(
    df: DataFrame, keys: list[str], names: str, members: list[str], value: str
) -> DataFrame:
    """One column per member; a second row for a cell is an error."""
    def cell(member: str):
        here = F.when(F.col(names) == member, F.col(value))
        return (
            F.when(F.count_if(F.col(names) == member) > 1,
                   F.raise_error(F.lit(f"more than one row in a cell of {member}")))
            .otherwise(F.max(here))
            .alias(member)
        )

    return df.groupBy(*keys).agg(*[cell(m) for m in members])


def unpivot(
    df: DataFrame, keys: list[str], columns: list[str], name: str, value: str
) -> DataFrame:
    """One (name, value) row per listed column."""
    return df.unpivot(keys, columns, name, value)
