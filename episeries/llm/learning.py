"""Which labelled rows a classifier learns from: a bounded, seeded sample, never held-out rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episeries.llm.common import held_out
from episeries.sources.storage import cut_lineage

SPACE = 1 << 28


def digest(salt: str) -> Column:
    """A number below ``SPACE`` for each id."""
    text = F.concat(F.lit(salt), F.col("doc_id").cast("string")).cast("binary")
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long")


def labelled(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """About ``most`` rows to learn from, or all if there are fewer: doc_id, text, the label
    and ``fold`` from 0 to 99. Labels that are NULL or neither 0 nor 1 are left out; of
    repeated ones the larger counts."""
    known = labels.select("doc_id", F.col(label).cast("int").alias(label)).filter(
        F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"))
    ).groupBy("doc_id").agg(F.max(label).alias(label))
    share = min(1.0, most / max(1, known.count()))
    chosen = cut_lineage(known.filter(digest("sample") < int(share * SPACE)))
    # about ``most`` ids and labels
    return cut_lineage(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        "doc_id", "text", label, (digest("fold") % 100).alias("fold")))
