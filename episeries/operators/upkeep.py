"""Stored totals and series, kept up to date from what changed.

Tables lie in month partitions. A change reads and rewrites the months it reaches and no
others; Spark's dynamic overwrite replaces each of them whole. Every update may be run again
after a failure: a cube's months bear the number of the last batch merged into them, and a
series' corrections replace rows by key and date. Lists of months reach the driver, which the
calendar bounds; rows never do. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from episeries.operators import windows as w
from episeries.operators.totals import cube_totals, with_keys
from episeries.sources.storage import arranged, remove_folder, stored

MONTH, ROWS, BATCH, DELETED = "_month", "_rows", "_batch", "_deleted"
SHORTEST_MONTH = 28


def by_month(df: DataFrame, date: str) -> DataFrame:
    """Add the month, counted from year 0, that partitions are named by."""
    return df.withColumn(MONTH, F.year(date) * 12 + F.month(date) - 1)


def overwrite_months(df: DataFrame, path: str) -> None:
    """Replace the months that ``df`` has rows of; all others stay."""
    arranged(df, [MONTH]).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)


def months_of(df: DataFrame) -> list[int]:
    return sorted(r[0] for r in df.select(MONTH).distinct().collect())


def read_months(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table in months; the given schema also fits one without any row left."""
    plain = [f for f in schema.fields if f.name != MONTH]
    return spark.read.schema(StructType([*plain, StructField(MONTH, IntegerType())])).parquet(path)


def drop_months(spark: SparkSession, path: str, months: set[int]) -> None:
    """Remove months that no row is left of."""
    for month in months:
        remove_folder(spark, f"{path}/{MONTH}={month}")


# Cubes: what a batch adds and removes, expanded by itself and summed into the stored cells.

def store_cube(
    df: DataFrame, path: str, date: str, members: Mapping[str, str], measures: list[str]
) -> None:
    """Store :func:`cube_totals` per date; a cell also knows how many rows it sums."""
    rows = df.withColumn(ROWS, F.lit(1).cast("long"))
    cube = cube_totals(rows, [date], members, [*measures, ROWS])
    overwrite_months(by_month(cube, date).withColumn(BATCH, F.lit(-1).cast("long")), path)


def merge_cube(
    added: DataFrame, removed: DataFrame, batch: int, path: str, date: str,
    members: Mapping[str, str], measures: list[str],
) -> None:
    """Merge a batch into the stored cube; a corrected row is removed as it was and added anew.

    Batches are numbered upwards from 0. The measures are whole numbers or decimals, whose sums
    do not depend on their order. A cell whose last row is removed goes. Rows with a NULL date
    or dimension are in no cell; a NULL measure counts as 0.
    """
    spark, keys, sums = added.sparkSession, [date, *members], [*measures, ROWS]

    def signed(df: DataFrame, minus: bool) -> DataFrame:
        rows = df.select(*keys, *measures, F.lit(1).cast("long").alias(ROWS))
        return rows.select(*keys, *[F.negative(c).alias(c) if minus else F.col(c) for c in sums])

    delta = signed(added, False).unionByName(signed(removed, True))
    delta = stored(by_month(cube_totals(delta, [date], members, sums), date).withColumn(
        BATCH, F.lit(batch).cast("long")))
    months = months_of(delta)
    old = read_months(spark, path, delta.schema).filter(F.col(MONTH).isin(months))
    done = months_of(old.filter(F.col(BATCH) >= batch))  # by an attempt that was lost later on
    todo = F.col(MONTH).isin(sorted({*months} - {*done}))
    kinds = {f.name: f.dataType for f in delta.schema.fields}
    merged = stored(
        old.filter(todo).unionByName(delta.filter(todo)).groupBy(*keys, MONTH)
        .agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in sums], F.max(BATCH).alias(BATCH))
        .filter(F.col(ROWS) > 0))
    overwrite_months(merged, path)
    drop_months(spark, path, {*months} - {*done} - {*months_of(merged)})


def stored_cube(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(MONTH, BATCH, ROWS)


# Series: facts, sums per month of each series, and the rows derived from both.

@dataclass(frozen=True)
class Series:
    """How rows are derived from a panel with one row per key and date.

    ``derive`` may look back ``days`` calendar days and, from there, ``rows_back`` rows; what
    goes back to the start takes :func:`running_total` and :func:`running_mean`.
    """

    keys: list[str]
    measures: list[str]
    derive: Callable[[DataFrame], DataFrame]
    days: int
    rows_back: int = 0
    date: str = "date"

    @property
    def columns(self) -> list[str]:
        return [*self.keys, self.date, *self.measures]


def _carried(measure: str) -> tuple[str, str]:
    return f"_sum_{measure}", f"_n_{measure}"


def _so_far(measure: str, window: WindowSpec) -> tuple[Column, Column]:
    total, n = (F.col(c) for c in _carried(measure))
    value = F.col(measure)
    return (total + F.coalesce(w.running_total(value, window), F.lit(0)),
            n + F.count(value).over(w.so_far(window)))


def running_total(measure: str, window: WindowSpec) -> Column:
    """The total since the start of the series, whichever row is the first one read."""
    total, n = _so_far(measure, window)
    return F.when(n > 0, total)


def running_mean(measure: str, window: WindowSpec) -> Column:
    """The mean since the start of the series, whichever row is the first one read."""
    total, n = _so_far(measure, window)
    return F.when(n > 0, total / n)


def month_sums(facts: DataFrame, series: Series) -> DataFrame:
    """Per series and month what later months carry on."""
    return facts.groupBy(*series.keys, MONTH).agg(
        F.count("*").alias(ROWS),
        *[column for m in series.measures for column in (
            F.coalesce(F.sum(m), F.lit(0)).alias(_carried(m)[0]),
            F.count(m).alias(_carried(m)[1]))])


def _derived(facts: DataFrame, sums: DataFrame, series: Series, start: int) -> DataFrame:
    """Rows of the months from ``start`` on; what came before is carried in sums."""
    names = [c for m in series.measures for c in _carried(m)]
    before = sums.filter(F.col(MONTH) < start).groupBy(*series.keys).agg(
        *[F.sum(c).alias(c) for c in names])
    panel = facts.filter(F.col(MONTH) >= start).drop(MONTH).join(before, series.keys, "left")
    rows = series.derive(panel.fillna(0, names))
    return by_month(rows.drop(*names), series.date)


def first_needed(sums: DataFrame, series: Series, first: int) -> int:
    """The month from which rows must be read to derive those of month ``first`` and later."""
    needed = None
    if series.rows_back:
        later = Window.partitionBy(*series.keys).orderBy(F.desc(MONTH)).rowsBetween(
            Window.unboundedPreceding, -1)
        going_on = sums.filter(F.col(MONTH) >= first).select(*series.keys).distinct()
        needed = (
            sums.filter(F.col(MONTH) < first).join(going_on, series.keys, "left_semi")
            .withColumn("_later", F.coalesce(F.sum(ROWS).over(later), F.lit(0)))
            .filter(F.col("_later") < series.rows_back).agg(F.min(MONTH)).first()[0])
    start = first if needed is None else needed
    return start - -(-max(series.days - 1, 0) // SHORTEST_MONTH)


def store_series(panel: DataFrame, path: str, series: Series) -> None:
    """Store a panel, its sums per month and the rows derived from it."""
    spark = panel.sparkSession
    facts = by_month(with_keys(panel.select(*series.columns), [*series.keys, series.date]),
                     series.date)
    overwrite_months(facts, f"{path}/facts")
    facts = read_months(spark, f"{path}/facts", facts.schema)
    sums = month_sums(facts, series)
    overwrite_months(sums, f"{path}/sums")
    # no month lies before this one: nothing is carried
    overwrite_months(_derived(facts, sums, series, -1 << 31), f"{path}/rows")


def correct_series(changes: DataFrame, path: str, series: Series) -> None:
    """Take new, corrected and deleted rows in; derived rows change from the first month on.

    ``changes`` has the panel's columns, one row per key and date, and may have ``_deleted``.
    Read are the changed months, the sums per month, and the rows from the first changed month
    on with what their windows reach back to. Rows with a NULL key or date are left out.
    """
    spark = changes.sparkSession
    deleted = F.col(DELETED) if DELETED in changes.columns else F.lit(False)
    changes = stored(by_month(with_keys(
        changes.select(*series.columns, F.coalesce(deleted, F.lit(False)).alias(DELETED)),
        [*series.keys, series.date]), series.date))
    touched = months_of(changes)
    if not touched:
        return
    kind = changes.drop(DELETED).schema
    at = F.col(MONTH).isin(touched)

    def facts() -> DataFrame:
        return read_months(spark, f"{path}/facts", kind)

    kept = facts().filter(at).join(
        changes.select(*series.keys, series.date), [*series.keys, series.date], "left_anti")
    mended = stored(kept.unionByName(changes.filter(~F.col(DELETED)).drop(DELETED)))
    emptied = {*touched} - {*months_of(mended)}
    sums = month_sums(mended, series)
    for part, df in {"facts": mended, "sums": sums}.items():
        overwrite_months(df, f"{path}/{part}")
        drop_months(spark, f"{path}/{part}", emptied)

    sums = read_months(spark, f"{path}/sums", sums.schema)
    start = first_needed(sums, series, touched[0])
    rows = _derived(facts(), sums, series, start).filter(F.col(MONTH) >= touched[0])
    overwrite_months(rows, f"{path}/rows")
    drop_months(spark, f"{path}/rows", emptied)


def stored_series(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/rows").drop(MONTH)
