"""Projections, filters and value recodes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episeries.functions.textnum import replace_patterns


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by map; names the frame lacks are ignored."""
    return df.withColumnsRenamed(dict(names))


def drop_positions(df: DataFrame, positions: Iterable[int]) -> DataFrame:
    """Drop columns by 0-based position."""
    gone = set(positions)
    return df.select(*[F.col(f"`{c}`") for i, c in enumerate(df.columns) if i not in gone])


def constant(df: DataFrame, **members: object) -> DataFrame:
    """Add constant columns."""
    return df.withColumns({name: F.lit(value) for name, value in members.items()})


def flatten(df: DataFrame, paths: Mapping[str, str]) -> DataFrame:
    """Lift nested fields: ``{"percentage": "patients.total.percentage"}``."""
    roots = {path.split(".")[0] for path in paths.values()}
    kept = [F.col(c) for c in df.columns if c not in roots]
    return df.select(*kept, *[F.col(path).alias(name) for name, path in paths.items()])


def nest_dotted(df: DataFrame) -> DataFrame:
    """Collect flat columns ``a.b`` into structs ``a``."""
    order: dict[str, list[str]] = {}
    for column in df.columns:
        order.setdefault(column.split(".")[0], []).append(column)
    return df.select(*[
        F.struct(*[F.col(f"`{c}`").alias(c.split(".", 1)[1]) for c in group]).alias(root)
        if "." in group[0] else F.col(f"`{root}`")
        for root, group in order.items()
    ])


def scale(df: DataFrame, columns: Iterable[str], factor: float = 100.0) -> DataFrame:
    """Multiply columns in place."""
    return df.withColumns({c: F.lit(factor) * F.col(c) for c in columns})


def equal_to(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Rows where every named column equals its value."""
    if not values:
        return df
    return df.filter(reduce(Column.__and__, [F.col(c) == v for c, v in values.items()]))


def different_from(df: DataFrame, column: str, value: object) -> DataFrame:
    """Rows whose column differs from the value; NULL differs."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(value)))


def complete_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows without a NULL."""
    return df.dropna("any", subset=columns)


def recoded(value: Column, codes: Mapping[str, str]) -> Column:
    """Exact recode; unmapped values pass through."""
    pairs = [F.lit(x) for pair in codes.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), value)


def recode(df: DataFrame, column: str, codes: Mapping[str, str]) -> DataFrame:
    return df.withColumn(column, recoded(F.col(column), codes))


def recode_patterns(df: DataFrame, column: str, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    """Regex recodes in order, then trim."""
    return df.withColumn(column, F.trim(replace_patterns(F.col(column), pairs)))


def strip_prefix(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Remove a code prefix wherever the pattern finds it."""
    return df.withColumn(column, F.regexp_replace(column, pattern, ""))
