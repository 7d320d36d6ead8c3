"""Repeated passages: winnowed anchors as seeds, extended both ways to maximal repeats.

A window is ``length`` consecutive words (split at ASCII white space, unchanged); a word goes
if a window over it also starts earlier in the corpus. Winnowing gives each window the least
k-gram in it as its anchor, so equal windows have equal anchors. Neighbouring windows that
share an anchor are one seed: the anchor with its left and right context. What moves is one
narrow row per seed, about one for eight words.

Seeds meet by anchor. If all seeds of an anchor have the same context, the repeat extends over
the whole context, and every seed but the first is removed as a whole. Where contexts differ,
a repeat begins or ends inside them; only those seeds are extended window by window. Removed
windows that touch merge to maximal repeats, which are at least ``length`` words long.

Contents are compared by two independent 64-bit digests, of the anchor and of the context, of
the 128-bit word hashes. Counts and least ids are pre-aggregated before they move; no group is
collected, so a passage that a third of all documents share costs its rows once.

Defined cases: NULL or short texts have no window. Rows that repeat a ``doc_id`` are one
document: no copy is earlier than the other, each loses what it repeats from before. A NULL
``doc_id`` counts as later than all others. An empty table gives no rows. Other columns are not
read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from episeries.sources.storage import stored

LENGTH = 20
GRAM = 5
LAST_ID = 2**63 - 1
BASE = 0x9E3779B97F4A7C15 | 1


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that their order is as good as random."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the base and of its inverse modulo 2**64, as far as asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 4096)
            for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))


def prefix_sums(words: list[bytes], powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """The words' first hashes and the running polynomial of their second ones."""
    hashed = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), "<u8").reshape(-1, 2)
    powers.upto(len(words) + 1)
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(hashed[:, 1] * powers.up[: len(words)], out=sums[1:])
    return hashed[:, 0], sums


def context(sums: np.ndarray, powers: Powers, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A digest of the words from ``start`` to ``stop``, wherever they stand."""
    raw = (sums[stop] - sums[start]) * powers.down[start]
    return mixed(raw + mixed((stop - start).astype(np.uint64)))


def seeds_of(words: list[bytes], powers: Powers, length: int, gram: int) -> tuple | None:
    """First window, number of windows, anchor and context digest of each seed."""
    if len(words) < length:
        return None
    first, sums = prefix_sums(words, powers)
    grams = np.zeros(len(words) - gram + 1, np.uint64)
    for j in range(gram):
        grams = grams * np.uint64(BASE) + first[j: j + len(grams)]
    grams = mixed(grams)
    spans = np.lib.stride_tricks.sliding_window_view(grams, length - gram + 1)
    anchor = np.arange(len(spans)) + spans.argmin(axis=1)
    start = np.flatnonzero(np.diff(anchor, prepend=-1))
    stop = np.append(start[1:], len(spans))
    return (start, stop - start, grams[anchor[start]],
            context(sums, powers, start, stop + length - 1))


#: Rows that a task hands over at a time, unless one document has more.
ROWS = 1 << 16


def narrow_rows(batch: pd.DataFrame, found: Iterator[tuple | None],
                names: list[str]) -> Iterator[pd.DataFrame]:
    """Frames of the columns found for each document, with its keys; ``again`` marks rows that
    repeat the last two of them within their document."""
    def frame() -> pd.DataFrame:
        row = np.repeat(owners, [len(p[0]) for p in parts])
        columns = (np.concatenate(c) for c in zip(*parts, strict=True))
        out = pd.DataFrame(
            {"doc": batch["doc"].to_numpy()[row], "copy": batch["copy"].to_numpy()[row]}
            | {n: c.view(np.int64) if c.dtype == np.uint64 else c.astype(np.int32)
               for n, c in zip(names, columns, strict=True)} | {"row": row})
        out["again"] = out.duplicated(["row", *names[-2:]])
        return out.drop(columns="row")

    parts, owners, size = [], [], 0
    for row, columns in enumerate(found):
        if columns:
            parts.append(columns)
            owners.append(row)
            size += len(columns[0])
        if size >= ROWS:
            yield frame()
            parts, owners, size = [], [], 0
    if parts:
        yield frame()


SEED = "doc long, copy int, first int, n int, anchor long, context long, again boolean"


def seeds(length: int, gram: int):
    """A mapInPandas function: documents to seeds; ``again`` marks repeats in the document."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = Powers()
        for batch in batches:
            yield from narrow_rows(batch, (
                seeds_of((t or "").encode().split(), powers, length, gram)
                for t in batch["text"]), ["first", "n", "anchor", "context"])

    return run


WINDOW = "doc long, copy int, first int, anchor long, digest long, again boolean"


def windows(length: int):
    """A mapInPandas function: packed texts with seeds to extend, to windows one by one."""
    def windows_of(packed: bytes, spans: np.ndarray, anchor: np.ndarray,
                   powers: Powers) -> tuple:
        _, sums = prefix_sums(zlib.decompress(packed).split(), powers)
        starts, counts = spans >> 32, spans & 0xFFFFFFFF
        # the windows of a seed are its first and those right behind it
        first = np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        first, kept = np.unique(first, return_index=True)
        return (first, np.repeat(anchor, counts)[kept].view(np.uint64),
                context(sums, powers, first, first + length))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = Powers()
        for batch in batches:
            yield from narrow_rows(batch, (
                windows_of(*row, powers)
                for row in zip(batch["packed"], batch["spans"], batch["anchors"], strict=True)),
                ["first", "anchor", "digest"])

    return run


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def without(length: int, with_text: bool):
    """A mapInPandas function: packed texts and their repeated windows to what is left."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, packed, gone in zip(
                    batch["doc"], batch["packed"], batch["gone"], strict=True):
                words = zlib.decompress(packed).split()
                edge = np.zeros(len(words) + 1, np.int64)
                if gone is not None:
                    np.add.at(edge, gone >> 32, 1)
                    np.add.at(edge, (gone >> 32) + (gone & 0xFFFFFFFF) + length - 1, -1)
                stay = np.cumsum(edge[:-1]) == 0
                kept = b" ".join([w for w, s in zip(words, stay.tolist(), strict=True) if s])
                rows.append((None if doc == LAST_ID else doc, len(words),
                             len(words) - int(stay.sum()), hashlib.sha256(kept).hexdigest(),
                             kept.decode() if with_text else None))
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")])
            yield out.astype({"doc_id": "Int64"})

    return run


@F.pandas_udf(BinaryType())
def packed(texts: pd.Series) -> pd.Series:
    """Texts as UTF-8, compressed, for they move twice."""
    return pd.Series([zlib.compress((t or "").encode(), 1) for t in texts])


def repeats_removed(docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                    with_text: bool = True) -> DataFrame:
    """One row per document: its words, how many go, and what is left with its digest."""
    # ``copy`` tells rows apart that share an id but not a text
    base = docs.select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("doc"), F.crc32(
        F.coalesce("text", F.lit("")).cast("binary")).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("copy"), "text")
    seed = base.mapInPandas(seeds(length, gram), SEED)
    # anchors seen more than once; one context: all but the first seed go as a whole
    anchors = seed.groupBy("anchor").agg(
        F.min("doc").alias("first_doc"), F.count("*").alias("seen"),
        F.min("context").alias("low"), F.max("context").alias("high")).filter("seen > 1")
    met = stored(seed.join(anchors, "anchor").filter(
        "low <> high OR again OR doc <> first_doc").select(
        "doc", "copy", "first", "n", "anchor", (F.col("low") != F.col("high")).alias("open")))
    # a span of windows is one number, its first one and how many follow
    span = "(CAST(first AS bigint) << 32) + n AS span"
    whole = met.filter("NOT open").selectExpr("doc", "copy", span)
    text = base.select("doc", "copy", packed("text").alias("packed"))
    open_seeds = met.filter("open").groupBy("doc", "copy").agg(
        F.collect_list(F.struct(F.expr(span), "anchor")).alias("open")).select(
        "doc", "copy", F.col("open.span").alias("spans"), F.col("open.anchor").alias("anchors"))
    window = text.join(open_seeds, ["doc", "copy"]).mapInPandas(windows(length), WINDOW)
    earliest = window.groupBy("anchor", "digest").agg(F.min("doc").alias("first_doc"),
                                                      F.count("*").alias("seen"))
    extended = window.join(earliest.filter("seen > 1"), ["anchor", "digest"]).filter(
        "again OR doc <> first_doc").withColumn("n", F.lit(1)).selectExpr("doc", "copy", span)
    gone = whole.unionAll(extended).groupBy("doc", "copy").agg(F.collect_list("span").alias("gone"))
    out = text.join(gone, ["doc", "copy"], "left").mapInPandas(without(length, with_text), RESULT)
    return out if with_text else out.drop("kept")
