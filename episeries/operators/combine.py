"""Joins and unions.

No broadcast hint is forced anywhere. Lookups read from files are broadcast
when their file size is under ``spark.sql.autoBroadcastJoinThreshold``; derived
sides are broadcast by adaptive execution once their shuffled size is known;
everything larger is a sort-merge join, whose hot keys adaptive execution
splits.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(fact: DataFrame, lookup: DataFrame, keys: str | list[str]) -> DataFrame:
    """Inner equi-join; rows without a match are dropped."""
    return fact.join(lookup, keys, "inner")


def new_inputs(inputs: DataFrame, done: DataFrame, keys: str | list[str]) -> DataFrame:
    """Inputs that the list of processed ones does not hold."""
    return inputs.join(done, keys, "left_anti")


def snapshot_difference(
    df: DataFrame,
    keys: list[str],
    date: str,
    value: str,
    as_of: str,
    days_back: int = 365,
) -> DataFrame:
    """Value at ``as_of`` minus value ``days_back`` days earlier, per key.

    Both snapshots are picked in one scan and met in one aggregation: a date
    filter reaches the files, and no self-join is needed.
    """
    now = F.to_date(F.lit(as_of))
    then = F.date_sub(now, days_back)
    return (
        df.filter(F.col(date).isin(now, then))
        .groupBy(*keys)
        .agg(
            F.max(F.when(F.col(date) == now, F.col(value))).alias("_now"),
            F.max(F.when(F.col(date) == then, F.col(value))).alias("_then"),
            F.max(F.col(date) == now).alias("_present"),
        )
        .filter("_present")
        .select(*keys, (F.col("_now") - F.col("_then")).alias(value))
    )


def union_rows(*frames: DataFrame) -> DataFrame:
    """Bag union by name; absent columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
