"""Benchmark decontamination by winnowing.

Words are lower-cased (A-Z) and a window is ten consecutive words of a benchmark item, or all
words of a shorter item. Every span of ``length`` words holds ``length - k + 1`` k-grams, and
winnowing keeps the least k-gram hash of each such span: equal spans keep equal hashes, so
the join of kept hashes misses no shared span. A hit is then extended: the spans around it
are compared word by word with the benchmark's windows.

Fingerprints are made inside each row with array functions. What moves is one narrow row per
run of spans that keep the same hash; texts are read again only for documents with a hit.

Defined cases: NULL text has no words; an item without words has no window; a NULL
``item_id`` is left out of the item lists but its windows hit. Rows that share a ``doc_id``, or have
none, are documents of their own: a document is known by its id and 128 bits of its text, so
only repeated rows, whose results are equal, go together.
Empty tables give no rows, or rows without hits. Other columns are not read; ``keep`` passes
them through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episeries.llm.common import ALNUM_GAP, lower_ascii, small, words_of
from episeries.sources.storage import cut_lineage

WINDOW = 10
#: What a document is known by while its text is elsewhere.
KEY = ["doc_id", "__text_a", "__text_b"]


def keyed(docs: DataFrame, *more: Column) -> DataFrame:
    """The documents by key, with what else is asked for."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias(KEY[1]),
                       F.xxhash64(F.lit(1), text).alias(KEY[2]), *more)


def meet(rows: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """Join rows by key with ``found``, whose key columns go again."""
    other = found.withColumnsRenamed({k: f"{k}__found" for k in KEY})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"{k}__found")) for k in KEY])
    return rows.join(other, same, how).drop(*[f"{k}__found" for k in KEY])


def words(text: Column) -> Column:
    return words_of(lower_ascii(text), ALNUM_GAP)


def hashes(array: Column) -> Column:
    return F.transform(array, lambda w: F.xxhash64(w))


def gram_words(length: int) -> int:
    """Words per k-gram for spans of ``length`` words."""
    return min(3, (length + 1) // 2)


def shifted(array: str, by: int, last: int) -> str:
    """The array without its first ``by`` elements, ending with the last ``last`` left out."""
    return f"slice({array}, {by + 1}, greatest(size({array}) - {by + last}, 0))"


def with_least_hashes(df: DataFrame, length: int) -> DataFrame:
    """Turn ``hashed`` words into ``least``: per span of ``length`` words the least k-gram hash.

    Both the k-grams and the minima over spans grow by zipping an array with itself, shifted,
    so an element costs a few cheap steps. Each step is a column of its own, so no array is
    built twice; the words themselves are not carried along.
    """
    k = gram_words(length)
    df = df.withColumn("step", F.col("hashed"))
    for j in range(1, k):
        df = df.withColumn("step", F.expr(
            f"zip_with(slice(step, 1, greatest(size(step) - 1, 0)), {shifted('hashed', j, 0)}, "
            "(a, b) -> xxhash64(a, b))"))
    span, done = length - k + 1, 1
    while done < span:
        more = min(done, span - done)
        df = df.withColumn("step", F.expr(
            f"zip_with({shifted('step', 0, more)}, {shifted('step', more, 0)}, "
            "(a, b) -> least(a, b))"))
        done += more
    return df.withColumnRenamed("step", "least").drop("hashed")


def runs(df: DataFrame, length: int, *keep: str) -> DataFrame:
    """One row per run of spans with the same least hash: its first and last span, 0-based."""
    marked = with_least_hashes(df, length).withColumn("starts", F.expr(
        "array_compact(transform(least, (h, i) -> IF(h <=> get(least, i - 1), NULL, i)))"))
    return marked.select(
        *keep, F.expr("inline(transform(starts, (s, i) -> struct("
                      "s AS first, coalesce(get(starts, i + 1), size(least)) - 1 AS last, "
                      "get(least, s) AS anchor)))"))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows with their items: length, span (the words joined by a space), items."""
    items = benchmark.select("item_id", words(F.col("text")).alias("words")).filter(
        "size(words) > 0").withColumn("length", F.expr(f"least(size(words), {window})"))
    return items.select("item_id", "length", F.explode(F.expr(
        "transform(sequence(1, size(words) - length + 1), "
        "s -> array_join(slice(words, s, length), ' '))")).alias("span")).distinct()


def anchored(windows: DataFrame, length: int) -> DataFrame:
    """The anchors that windows of one length keep."""
    return with_least_hashes(
        windows.filter(F.col("length") == length).select(
            hashes(F.split("span", " ")).alias("hashed")), length).select(F.col("least")[0].alias("anchor")).distinct()


def document_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The key, first (0-based word), length, item_id of every window that occurs."""
    windows = cut_lineage(benchmark_windows(benchmark, window))
    # at most `window` different lengths
    lengths = sorted(r.length for r in windows.select("length").distinct().collect())
    found = None
    for length in lengths:
        tokens = keyed(docs, hashes(words(F.col("text"))).alias("hashed"))
        seeds = runs(tokens, length, *KEY).join(
            small(cut_lineage(anchored(windows, length))), "anchor"
        ).select(*KEY, F.lit(length).alias("length"), "first", "last")
        found = seeds if found is None else found.unionAll(seeds)
    if found is None:
        found = keyed(docs, F.lit(0).alias("length"), F.lit(0).alias("first"),
                      F.lit(0).alias("last")).limit(0)
    seeds = found.groupBy(*KEY).agg(
        F.collect_set(F.struct("length", "first", "last")).alias("seeds"))
    # the seeds grow with the documents: shuffled
    spans = (
        meet(keyed(docs, "text"), seeds, "inner")
        .select(*KEY, words(F.col("text")).alias("words"), F.explode("seeds").alias("seed"))
        .select(*KEY, F.col("seed.length").alias("length"), F.expr(
            "inline(transform(sequence(seed.first, seed.last), s -> struct(s AS first, "
            "array_join(slice(words, s + 1, seed.length), ' ') AS span)))"))
        .distinct()
    )
    return spans.join(small(windows), ["length", "span"]).select(
        *KEY, "first", "length", "item_id")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: its words, hit words, items with occurring windows."""
    hits = cut_lineage(document_hits(docs, benchmark, window))
    covered = (
        hits.groupBy(*KEY).agg(F.expr(
            "array_sort(collect_set(struct(first, first + length AS end)))").alias("spans"),
            F.expr("array_sort(collect_set(CAST(item_id AS STRING)))").alias("items"))
        .select(*KEY, "items", F.expr("""
            aggregate(spans, struct(0L AS n, 0 AS upto), (a, s) -> struct(
                a.n + greatest(0, s.end - greatest(s.first, a.upto)) AS n,
                greatest(a.upto, s.end) AS upto), a -> a.n)""").alias("n_hit"))
    )
    counted = keyed(docs, F.size(words_of(F.col("text"), ALNUM_GAP)).cast("long").alias("n_words"))
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return meet(counted, covered, "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def keep(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any hit, with all their columns."""
    bad = document_hits(docs, benchmark).select(*KEY).distinct()
    text = F.coalesce("text", F.lit(""))
    rows = docs.withColumns({KEY[1]: F.xxhash64(text), KEY[2]: F.xxhash64(F.lit(1), text)})
    return meet(rows, bad, "left_anti").drop(*KEY[1:])
