"""Near-duplicates by SimHash: pigeonhole blocks, then Hamming distance, then components.

A fingerprint has 64 bits from the XXH64 hashes (seed 42) of a text's word shingles, repeats
included. Fingerprints link if they differ in at most ``distance`` bits. They are cut into
``blocks`` blocks; linked ones agree on at least ``blocks - distance`` of them, so they meet in
the join on some choice of that many blocks. Pairs that meet are verified bit by bit.

Equal fingerprints are one class from the start, so copies are never paired. Where many
different fingerprints meet in one bucket, the bucket is not expanded into pairs. It is cut
again: linked fingerprints have a value in between that differs from each in at most half the
distance, so the members meet, each with the least member, at such values; that is exact too,
and linear in the bucket.

Defined cases: NULL and empty texts have the fingerprint zero and link like any other. A text
with fewer words than a shingle is one shingle. Repeated rows get the same answer. A NULL
``doc_id`` is ignored for ``component_id`` unless nothing else is in the component. An empty
table gives no rows. Other columns are not read; ``keep`` passes them through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from episeries.llm.common import keep_rows, small
from episeries.sources.storage import cut_lineage

SHINGLE = 4
DISTANCE = 4
BLOCKS = 7
SEED = 42
STEP = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint of one text as an unsigned number."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    size = min(shingle, len(words))
    starts, stops = (ends - lengths)[: len(words) - size + 1], ends[size - 1:]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), STEP):
        pairs = zip(starts[at:at + STEP].tolist(), stops[at:at + STEP].tolist(), strict=True)
        hashed = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in pairs],
                          "<u8")
        bits = np.unpackbits(hashed.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << j for j in np.flatnonzero(2 * ones > len(starts)).tolist())


@F.pandas_udf(LongType())
def fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([np.uint64(fingerprint(t)).astype(np.int64) for t in batch], dtype="int64")


def masks(blocks: int, distance: int) -> list[int]:
    """For each choice of ``blocks - distance`` blocks the signed mask of their bits."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    block = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(blocks)]
    chosen = (sum(c) for c in combinations(block, blocks - distance))
    return [m - (1 << 64) if m >> 63 else m for m in chosen]


def hashed_links(classes: DataFrame, distance: int, blocks: int, most: int) -> DataFrame:
    """Links (u, v) that connect exactly the fingerprints ``fp`` within ``distance`` bits."""
    mask = masks(blocks, distance)
    keys = classes.select("fp", F.posexplode(F.array(*[F.lit(m) for m in mask]))).select(
        "fp", F.col("pos").alias("choice"), F.expr("fp & col").alias("key"))
    hot = small(cut_lineage(
        keys.groupBy("choice", "key").count().filter(F.col("count") > most)
        .select("choice", "key")))
    cold = keys.join(hot, ["choice", "key"], "left_anti")
    # the first choice on which two agree is where their pair is taken, once
    agree = F.expr(" ".join(
        ["CASE", *[f"WHEN (a.fp ^ b.fp) & {m}L = 0 THEN {i}" for i, m in enumerate(mask)], "END"]
    ).replace("-9223372036854775808L", "(-9223372036854775807L - 1L)"))
    pairs = cold.alias("a").join(
        cold.alias("b"),
        (F.col("a.choice") == F.col("b.choice")) & (F.col("a.key") == F.col("b.key"))
        & (F.col("a.fp") < F.col("b.fp"))
        & (F.bit_count(F.expr("a.fp ^ b.fp")) <= distance) & (agree == F.col("a.choice")),
    ).select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))
    return pairs.unionAll(between(keys.join(hot, ["choice", "key"], "left_semi"), distance))


def between(members: DataFrame, distance: int) -> DataFrame:
    """Links of crowded buckets through the values that lie between two members."""
    flips = [sum(1 << b for b in bits) for n in range(distance // 2 + 1)
             for bits in combinations(range(64), n)]
    if distance % 2:
        raise ValueError("an even distance has its middle on a bit")
    signed = [f - (1 << 64) if f >> 63 else f for f in flips]
    near = members.select("fp").distinct().select(
        "fp", F.explode(F.array(*[F.lit(f) for f in signed])).alias("flip")
    ).select("fp", F.expr("fp ^ flip").alias("middle"))
    least = near.groupBy("middle").agg(F.min("fp").alias("u"), F.count("*").alias("n")).filter("n > 1")
    return near.join(least, "middle").filter("fp > u").select("u", F.col("fp").alias("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node and root (its least node) by alternating large and small stars.

    Each round joins links with one row per node; rounds grow with the logarithm of the
    largest component. Every round is written to the shared folder.
    """
    links = cut_lineage(links.distinct())
    before = None
    while True:
        both = links.unionAll(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small_star = large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                              F.struct("u", F.col("m").alias("v")))).alias("e")
        ).select("e.*").filter("u <> v").distinct()
        links = cut_lineage(small_star)
        state = links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state


def near_groups(docs: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS,
                most: int = 1_000) -> DataFrame:
    """One row per document: its fingerprint and the least doc_id it is connected with.

    ``most`` is the bucket size up to which pairs are the cheaper form; larger buckets are
    linked through values in between. The result does not depend on it.
    """
    rows = cut_lineage(docs.select(
        "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
        fingerprints("text").alias("fp")))
    classes = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(hashed_links(classes, distance, blocks, most))
    rooted = classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    groups = cut_lineage(rooted.join(ids, "root").select("fp", "component_id"))
    return rows.join(groups, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
        "text_sha256")


def keep(docs: DataFrame) -> DataFrame:
    """One document of each component, with all its columns: the one with the least id."""
    winners = near_groups(docs).filter("doc_id <=> component_id").groupBy(
        "component_id").agg(F.min("text_sha256").alias("sha")).withColumnRenamed(
        "component_id", "doc_id")
    return keep_rows(docs, winners, F.sha2(F.coalesce("text", F.lit("")), 256))
