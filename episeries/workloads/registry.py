"""Where queries and their SQL are kept side by side."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Workload:
    run: Run
    sql: str | None


WORKLOADS: dict[str, Workload] = {}


def workload(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query under ``name`` with the SQL that must agree with it."""
    def register(run: Run) -> Run:
        if name in WORKLOADS:
            raise ValueError(f"two queries named {name}")
        WORKLOADS[name] = Workload(run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of digits, for comparison across engines."""
    return df.select(*[
        F.round(f.name, digits).alias(f.name) if isinstance(f.dataType, DoubleType)
        else F.col(f.name)
        for f in df.schema.fields
    ])


def last_days(days: int) -> str:
    """SQL frame of the last ``days`` calendar days."""
    return f"RANGE BETWEEN INTERVAL {days - 1} DAYS PRECEDING AND CURRENT ROW"
