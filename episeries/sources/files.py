"""Readers: delimited files, lookups, tables, report pages, sheet rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from episeries.functions.textnum import compact_date, locale_double, locale_long, whole_number
from episeries.operators.recode import equal_to

# One row of a workbook sheet. Header names travel with each row, so sheets
# whose columns drift are read by one scan and one plan.
SHEET_ROWS = (
    "file_name string, sheet_no int, sheets int, header array<string>, cells array<string>"
)


def read_delimited(
    spark: SparkSession,
    path: str,
    separator: str = ",",
    decimal: str = ".",
    thousands: str | None = None,
    encoding: str = "UTF-8",
    numbers: Mapping[str, str] | None = None,
    columns: str | None = None,
) -> DataFrame:
    """Delimited text with a header.

    Values stay text (so the code ``NA`` is a code) except for ``numbers``,
    which maps columns to ``long`` or ``double`` and is parsed with the given
    decimal and thousands marks; the thousands mark is by default a comma, or a dot where
    the comma is the decimal mark. ``columns`` is a DDL schema for files whose
    header must not be sampled.
    """
    reader = spark.read.option("header", True).option("sep", separator)
    reader = reader.option("encoding", encoding)
    if columns:
        reader = reader.schema(columns)
    df = reader.csv(path)
    thousands = thousands or ("." if decimal == "," else ",")
    parsed = {}
    for name, kind in (numbers or {}).items():
        text = F.trim(F.col(f"`{name}`"))
        parsed[name] = (
            locale_long(text, thousands) if kind == "long"
            else locale_double(text, decimal, thousands)
        )
    return df.withColumns(parsed)


def read_lookup(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """A small code table; its file size decides whether it is broadcast."""
    return read_delimited(spark, path, separator)


def read_table(
    spark: SparkSession,
    path: str,
    filters: Mapping[str, object] | None = None,
    projection: list[str] | None = None,
) -> DataFrame:
    """A stored table, optionally filtered by equality and projected."""
    df = equal_to(spark.read.parquet(path), filters or {})
    return df.select(*projection) if projection else df


def read_report_pages(spark: SparkSession, path: str) -> DataFrame:
    """Page texts from files named ``<report>-<page>.txt``."""
    return named_pages(spark.read.text(path, wholetext=True)).drop("file_date")


def named_pages(texts: DataFrame) -> DataFrame:
    """Pages from whole text files, read at once or as a stream.

    Report, page and, where it is given, date are in the name: ``<report>-<page>.txt`` or
    ``<report>-<page>_<yyyymmdd>.txt``.
    """
    name = F.col("_metadata.file_name")
    pattern = r"^(\d+)-(\d+)[._]"
    return texts.select(
        whole_number(F.regexp_extract(name, pattern, 1)).alias("report_id"),
        whole_number(F.regexp_extract(name, pattern, 2), "int").alias("page_no"),
        F.col("value").alias("text"),
        date_in_name(name).alias("file_date"),
    )


def read_sheet_rows(spark: SparkSession, path: str) -> DataFrame:
    """Workbook rows as JSON lines in the :data:`SHEET_ROWS` schema."""
    return spark.read.schema(SHEET_ROWS).json(path)


def number_in_name(file_name: Column) -> Column:
    """Report number of ``59.pdf``."""
    return whole_number(F.regexp_extract(file_name, r"^(\d+)\.[^.]+$", 1))


def date_in_name(file_name: Column) -> Column:
    """Report date of ``…_20210210.ods``."""
    return compact_date(F.regexp_extract(file_name, r"(\d{8})\.[^.]+$", 1))


def above_high_water(df: DataFrame, number: str, last: int) -> DataFrame:
    """Rows numbered above the last one processed."""
    return df.filter(F.col(number) > F.lit(last))


def high_water(df: DataFrame, number: str, last: int) -> DataFrame:
    """The new mark: largest number seen, never below the old one."""
    return df.agg(F.greatest(F.max(number), F.lit(last)).alias("high_water"))
