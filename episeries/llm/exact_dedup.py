"""Exact duplicates through content-defined chunk recipes.

A normalised text (A-Z lower-cased) is cut where its content says so: after a sentence or
line end that a word in a-h follows. A stretch without such a place is cut every 65,536
characters. Chunks are deduplicated over the corpus to identifiers that are verified: no two different chunks may
share one, else the run starts anew with a wider identifier. From then on a document is its
ordered list of identifiers; only chunks move, once, and never a whole document.

Defined cases: NULL text is the empty text, which has the empty recipe and is a group like any
other. A NULL ``doc_id`` sorts below all ids. Rows that repeat both id and text are one group
of which one row is kept. An empty table gives no rows. Other columns are not read, whatever
their names; ``keep`` passes them through.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episeries.llm.common import keep_rows, lower_ascii
from episeries.sources.storage import cut_lineage

CUT = r"(?<=[.!?\n][ \n])(?=[a-h])"
LONGEST = 65_536

#: Identifiers from short to long; the first that proves free of clashes is used.
IDENTIFIERS: Sequence[Callable[[Column], Column]] = (
    lambda chunk: F.xxhash64(chunk),
    lambda chunk: F.sha2(chunk, 256),
)


def normalised(text: Column) -> Column:
    return lower_ascii(F.coalesce(text, F.lit("")))


def chunks_of(text: Column) -> Column:
    """The chunks of a text; joined they are the text again."""
    def bounded(chunk: Column) -> Column:
        starts = F.sequence(F.lit(1), F.length(chunk), F.lit(LONGEST))
        return F.when(
            F.length(chunk) > LONGEST,
            F.transform(starts, lambda s: F.substring(chunk, s, F.lit(LONGEST))),
        ).otherwise(F.array(chunk))

    return F.flatten(F.transform(F.split(text, CUT), bounded))


def has_clash(docs: DataFrame, identify: Callable[[Column], Column]) -> bool:
    """Whether two different chunks of the corpus share an identifier."""
    chunk = docs.select(F.explode(chunks_of(normalised(F.col("text")))).alias("chunk"))
    distinct = chunk.groupBy(identify(F.col("chunk")).alias("id"), "chunk").agg(F.lit(1))
    return not distinct.groupBy("id").count().filter("count > 1").isEmpty()


def recipes(docs: DataFrame, identifiers: Sequence = IDENTIFIERS) -> DataFrame:
    """doc_id, row_id, text_sha256 and the recipe: the ordered list of verified identifiers."""
    for identify in identifiers:
        if not has_clash(docs, identify):
            break
    else:
        raise ValueError("different chunks share the widest identifier")
    text = docs.select("doc_id", normalised(F.col("text")).alias("text"))
    return cut_lineage(text.select(
        "doc_id", F.monotonically_increasing_id().alias("row_id"),
        F.sha2("text", 256).alias("text_sha256"),
        F.transform(chunks_of(F.col("text")), lambda c: identify(c)).alias("recipe"),
    ))


def exact_groups(docs: DataFrame, identifiers: Sequence = IDENTIFIERS) -> DataFrame:
    """One row per document: the one its group keeps, the group's size, and whether it stays.

    Groups are reduced map-side first, so a group with a third of all rows arrives as one row
    per task. Its members get their answer through a join of many rows with one, which
    adaptive execution splits where one group dominates.
    """
    rows = recipes(docs, identifiers)
    groups = cut_lineage(rows.groupBy("recipe").agg(
        F.max(F.struct("doc_id", "row_id")).alias("keep"), F.count("*").alias("group_size")
    ))
    return rows.join(groups, "recipe").select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row_id") == F.col("keep.row_id")).alias("kept"), "text_sha256",
    )


def keep(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns."""
    winners = exact_groups(docs).filter("kept").select("doc_id", F.col("text_sha256").alias("sha"))
    return keep_rows(docs, winners, F.sha2(normalised(F.col("text")), 256))
