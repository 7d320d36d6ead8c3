"""Filtered, projected and paged reads of the analysed tables."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, MapType, StructType

from episeries.plans import paging
from episeries.sources.storage import current_version, folder_exists

# The queryable tables and the filters each one allows.
TABLES: dict[str, list[str]] = {
    "cases": ["autonomous_region", "age_range", "gender", "date"],
    "deaths": ["autonomous_region", "age_range", "gender", "date"],
    "hospitalizations": ["autonomous_region", "age_range", "gender", "date"],
    "hospitals_pressure": ["autonomous_region", "date"],
    "diagnostic_tests": ["autonomous_region", "date"],
    "covid_vs_all_deaths": ["gender", "age_range"],
    "outbreaks_description": ["scope", "date"],
    "top_death_causes": ["gender", "age_range", "death_cause"],
    "transmission_indicators": ["date", "autonomous_region"],
    "vaccination_general": ["date", "autonomous_region"],
    "vaccination_ages_single": ["date", "autonomous_region", "age_range"],
    "vaccination_ages_complete": ["date", "autonomous_region", "age_range"],
    "population_pyramid_variation": ["gender", "age_range"],
    "symptoms": [],
}

#: Beside the tables: how many rows of each have the same values to filter by.
PAGE_COUNTS = "page_counts"


def available_tables(spark: SparkSession) -> DataFrame:
    """The queryable tables with their filters."""
    return spark.createDataFrame(
        list(TABLES.items()), "table_name string, filters array<string>"
    )


def _day(value: str) -> Column:
    """An ISO date or timestamp as a date; NULL, which no row equals, for anything else."""
    return F.coalesce(F.try_to_date(F.lit(value), "yyyy-MM-dd"),
                      F.try_to_timestamp(F.lit(value)).cast("date"))


def filtered(df: DataFrame, allowed: list[str], values: Mapping[str, str]) -> DataFrame:
    """Equality on the allowed columns that were given a non-empty value."""
    for name in allowed:
        value = values.get(name)
        if not value:
            continue
        is_date = isinstance(df.schema[name].dataType, DateType)
        df = df.filter(
            F.col(name) == (_day(str(value)) if is_date
                            else F.lit(value))
        )
    return df


def _subset(column: Column, kind: StructType | MapType, paths: list[list[str]]) -> Column:
    """The part of a nested column that the paths name, nesting kept."""
    if isinstance(kind, MapType):
        keys = [path[0] for path in paths]
        return F.map_filter(column, lambda k, _: k.isin(keys))
    fields = []
    for field in kind.fields:
        deeper = [path[1:] for path in paths if path[0] == field.name]
        if not deeper:
            continue
        inner = column.getField(field.name)
        nested = isinstance(field.dataType, (StructType, MapType)) and all(deeper)
        fields.append((_subset(inner, field.dataType, deeper) if nested else inner)
                      .alias(field.name))
    return F.when(column.isNotNull(), F.struct(*fields)) if fields else F.lit(None)


def projected(df: DataFrame, fields: str | list[str] | None) -> DataFrame:
    """Only the named fields, in table order; dotted paths keep their nesting.

    Names the table lacks are ignored.
    """
    if not fields:
        return df
    paths = [f.split(".") for f in ([fields] if isinstance(fields, str) else fields)]
    chosen = []
    for field in df.schema.fields:
        deeper = [path[1:] for path in paths if path[0] == field.name]
        if not deeper:
            continue
        column = F.col(f"`{field.name}`")
        nested = isinstance(field.dataType, (StructType, MapType)) and all(deeper)
        chosen.append((_subset(column, field.dataType, deeper) if nested else column)
                      .alias(field.name))
    return df.select(*chosen)


def leading_integer(value: object) -> int:
    """``"10"`` and ``"10 rows"`` as 10; anything else as 0."""
    found = re.match(r"\s*(\d+)", str(value))
    return int(found.group(1)) if found else 0


def paged(
    df: DataFrame,
    order: list[str],
    limit: object = 0,
    page: object = 0,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Page ``page`` of ``limit`` rows in a total order; limit 0 returns all rows.

    ``counts`` are stored counts of the same rows, which spare counting them.
    """
    limit, page = leading_integer(limit), leading_integer(page)
    return paging.page(df, order, limit, page * limit, counts) if limit else df


def answer(
    df: DataFrame,
    table: str,
    filters: Mapping[str, str] | None = None,
    fields: str | list[str] | None = None,
    limit: object = 0,
    page: object = 0,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Answer a request on an analysed table.

    The symptoms list and the pyramid ignore paging and projection.
    """
    if table not in TABLES:
        raise KeyError(f"no such table: {table}")
    found = filtered(df, TABLES[table], filters or {})
    if table in ("symptoms", "population_pyramid_variation"):
        return found
    if counts is not None:
        counts = filtered(counts, TABLES[table], filters or {})
    return projected(paged(found, page_order(table), limit, page, counts), fields)


def page_order(table: str) -> list[str]:
    """The newest rows first, then by what the table can be filtered by."""
    return sorted((f"-{c}" if c == "date" else c for c in TABLES[table]), key=lambda c: c != "-date")


def query_table(
    spark: SparkSession,
    root: str,
    table: str,
    filters: Mapping[str, str] | None = None,
    fields: str | list[str] | None = None,
    limit: object = 0,
    page: object = 0,
) -> DataFrame:
    """:func:`answer` on the table stored under ``root``, with its stored counts if it has any."""
    if table not in TABLES:
        raise KeyError(f"no such table: {table}")
    root = current_version(spark, root)
    path = f"{root}/{PAGE_COUNTS}/{table}"
    counts = spark.read.parquet(path) if folder_exists(spark, path) else None
    return answer(spark.read.parquet(f"{root}/{table}"), table, filters, fields, limit, page,
                  counts)


def store_counts(spark: SparkSession, root: str, table: str) -> None:
    """Count a stored table for its pages; a table that is not paged has no counts."""
    if TABLES.get(table):
        paging.page_counts(spark.read.parquet(f"{root}/{table}"), TABLES[table]).write.mode(
            "overwrite").parquet(f"{root}/{PAGE_COUNTS}/{table}")
