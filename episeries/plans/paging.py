"""Pages of a total order, found by order statistics.

A page is located before it is read: counts per key of the leading order column tell which key
the page starts in, counts of the next column inside that key where in it, and so on, until what
lies between the place found and the page's first row is no more than a page. Then only the rows
from there on, up to the key the page ends in, are read. Counts come from a stored table of
counts (:func:`page_counts`) as far as its columns go, else from the one column concerned.

A column with many keys is searched by pivots: a bounded sample of its keys cuts it into ranges
whose counts are exact, and the range that holds the place is cut again. The driver sees at most
``PIVOTS`` keys and one count per range; nothing is written, and the way is the same for any size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

#: Keys that cut a column into ranges at a time.
PIVOTS = 255
ROWS = "_rows"


@dataclass(frozen=True)
class Key:
    """A column of the order: ascending with NULL first, or descending with NULL last."""

    name: str
    descending: bool = False

    @property
    def column(self) -> Column:
        return F.col(f"`{self.name}`")

    def sorted(self) -> Column:
        return self.column.desc() if self.descending else self.column.asc()

    def beyond(self, value: object) -> Column:
        """Rows that come after the value."""
        if value is None:
            return F.lit(False) if self.descending else self.column.isNotNull()
        if self.descending:
            return (self.column < F.lit(value)) | self.column.isNull()
        return self.column > F.lit(value)

    def since(self, value: object) -> Column:
        """Rows of the value and all that come after it."""
        if value is None:
            return self.column.isNull() if self.descending else F.lit(True)
        if self.descending:
            return (self.column <= F.lit(value)) | self.column.isNull()
        return self.column >= F.lit(value)

    def at(self, value: object) -> Column:
        return self.column.isNull() if value is None else self.column == F.lit(value)

    def within(self, first: object, last: object) -> Column:
        """Rows from the first value to the last, both included."""
        if self.descending:
            first, last = last, first
        if first is None and last is None:
            return self.column.isNull()
        if first is not None and last is not None:
            return self.column.between(F.lit(first), F.lit(last))
        return (self.column <= F.lit(last)) | self.column.isNull()

    def ranges(self, counts: DataFrame) -> DataFrame:
        """(place, first, last, keys, rows) of the ranges between pivots, in order."""
        keyed = counts.groupBy(self.column.alias(self.name)).agg(F.sum(ROWS).alias(ROWS))
        drawn = keyed.select(self.column).filter(self.column.isNotNull()).orderBy(
            F.xxhash64(self.column), self.column).limit(PIVOTS)
        pivots = [F.lit(r[0]) for r in drawn.collect()]
        passed = F.size(F.filter(F.array(*pivots), lambda p: self.column <= p if self.descending
                                 else p <= self.column)) if pivots else F.lit(0)
        place = F.when(self.column.isNull(), PIVOTS + 1 if self.descending else -1).otherwise(
            passed)
        ends = (F.max(self.column), F.min(self.column))
        first, last = ends if self.descending else ends[::-1]
        return keyed.groupBy(place.alias("place")).agg(
            first.alias("first"), last.alias("last"), F.count("*").alias("keys"),
            F.sum(ROWS).alias("rows")).orderBy("place")


def plain(kind: object) -> bool:
    return not isinstance(kind, (ArrayType, MapType, StructType))


def total_order(df: DataFrame, order: Sequence[str]) -> list[Key]:
    """The wanted order, then all other columns that can be ordered."""
    keys = [Key(c.lstrip("-"), c.startswith("-")) for c in order]
    named = {k.name for k in keys}
    return keys + [Key(f.name) for f in df.schema.fields
                   if f.name not in named and not isinstance(f.dataType, MapType)]


def page_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per combination of the columns, to be stored beside the table."""
    return df.groupBy(*columns).agg(F.count("*").alias(ROWS))


def page(df: DataFrame, order: Sequence[str], limit: int, offset: int,
         counts: DataFrame | None = None) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of the total order.

    ``counts`` are the :func:`page_counts` of these rows. A page beyond the end is empty. Rows
    that are equal in every plain column are not told apart before they are read.
    """
    keys = total_order(df, order)
    wanted, skip = F.lit(True), offset
    path: list[tuple[Key, object]] = []
    last_key: Column | None = None
    for key in keys:
        if not plain(df.schema[key.name].dataType):
            break
        source = counts if counts is not None and key.name in counts.columns else (
            df.select(*[k.column for k, _ in path], key.column, F.lit(1).alias(ROWS)))
        source = source.filter(wanted)
        while True:
            found = key.ranges(source).collect()
            before = 0
            start = None
            for span in found:
                if start is None and before + span["rows"] > skip:
                    start, passed = span, before
                before += span["rows"]
                if not path and before >= skip + limit and last_key is None:
                    last_key = key.within(found[0]["first"], span["last"])
            if start is None:
                return df.limit(0)  # beyond the last row
            skip -= passed
            if start["rows"] <= limit or start["keys"] == 1:
                break
            source = source.filter(key.within(start["first"], start["last"]))
        path.append((key, start["first"]))
        if start["rows"] <= limit:
            break
        wanted = wanted & key.at(start["first"])
    if path:
        *fixed, (key, value) = path
        rows = key.since(value)
        for key, value in reversed(fixed):
            rows = key.beyond(value) | (key.at(value) & rows)
        lead, value = path[0]
        # the leading column once more by itself, so that files can be skipped by it
        df = df.filter(lead.since(value)).filter(rows)
        if last_key is not None:
            df = df.filter(last_key)
    return df.orderBy(*[k.sorted() for k in keys]).offset(skip).limit(limit)
