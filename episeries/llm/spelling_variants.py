"""Spelling variants: words one edit apart, by dense prefix-suffix tiling.

Words come from whole texts and are counted over all documents. Two words are near if exactly
one code point is inserted, deleted or replaced between them. Tiles of words become padded
matrices of code points, forwards and backwards, and are compared block against block: where the
common prefix and the common suffix together reach the longer length minus one, a single edit
parts the two words.

Which blocks meet: of a single edit's two sides one is untouched, so with ``L`` the longer
length the words share their first or their last ``L // 2`` code points. Words with such a part
in common are one group; a group of more than ``BLOCK`` words is cut into blocks by the word's
hash and every pair of its blocks is one tile, so no tile grows with the data. A pair is taken
from exactly one group: the prefix group if the prefix is long enough, else the suffix group.

Defined cases: NULL and empty texts have no words; a NULL ``doc_id`` counts as empty text in
the noise digest. Repeated rows count again. An empty table gives no rows. Ties between forms go
to the smallest word in code-point order. Columns other than ``doc_id`` and ``text`` are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from episeries.llm.common import lower_ascii, small, words_of
from episeries.llm.tiles import starts_of, whole_groups
from episeries.sources.storage import cut_lineage, stored

# What is not a letter of a word, and the share of runs that lose a letter.
LETTER_GAP = r"[^A-Za-zÀ-ÿ]+"
NOISE_EVERY = 199

LEAST_LETTERS = 6
LEAST_COUNT = 5
FORM_FACTOR = 5

#: Words in a block of a crowded group, and in a tile of pooled small groups.
BLOCK, TILE = 512, 128
#: Cells (code points compared) that a tile holds at a time.
CELLS = 1 << 22

NEAR = "word string, near string, near_n long"


def noisy(run: Column, doc_id: Column) -> Column:
    """The run, without one letter where its digest says so."""
    digest = F.crc32(F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("")), run)
                     .cast("binary"))
    place = (digest % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), place),
                   F.substring(run, place + 2, F.length(run)))
    return F.when(digest % NOISE_EVERY == 0, cut).otherwise(run)


def vocabulary(docs: DataFrame, least_letters: int = LEAST_LETTERS,
               least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n): counted over all documents, summed in each task before the exchange."""
    runs = docs.select("doc_id", F.explode(
        words_of(lower_ascii(F.col("text")), LETTER_GAP)).alias("run"))
    words = runs.filter(F.length("run") >= least_letters).select(
        noisy(F.col("run"), F.col("doc_id")).alias("word"))
    return words.filter(F.length("word") >= least_letters).groupBy("word").agg(
        F.count("*").alias("n")).filter(F.col("n") >= least_count)


def block_rows(length: int | Column) -> Column:
    """Words in a block: fewer where words are very long."""
    return F.greatest(F.lit(2), F.least(F.lit(BLOCK), F.floor(F.lit(CELLS // 2) / length)))


def tiled(vocab: DataFrame) -> DataFrame:
    """(tile, size, side, block, word, n): each word in every tile that compares it."""
    half = F.floor(F.col("size") / 2).cast("int")
    entries = vocab.select("word", "n", F.explode(
        F.array(F.length("word"), F.length("word") + 1)).alias("size"))
    entries = entries.select("word", "n", "size", F.posexplode(F.array(
        F.substring("word", F.lit(1), half), F.substring(F.col("word"), -half, half),
    )).alias("side", "part"))
    group = ["size", "side", "part"]
    blocks = F.ceil(F.col("count") / block_rows(F.col("size"))).cast("int")
    crowded = small(cut_lineage(
        entries.groupBy(*group).count().select(*group, blocks.alias("blocks"))
        .filter("blocks > 1")))
    placed = entries.join(crowded, group, "left").select(
        *group, "word", "n", F.coalesce("blocks", F.lit(1)).alias("blocks"))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
    met = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return placed.select(*group, "word", "n", "block", met).select(
        F.xxhash64(*group, F.least("block", "other"), F.greatest("block", "other")).alias("tile"),
        "size", "side", "block", (F.least("block", "other") != F.greatest("block", "other"))
        .alias("two"), "word", "n")


def matrix(words: list[str]) -> np.ndarray:
    """Code points of the words, padded with zeros."""
    width = max(map(len, words))
    codes = np.array(words, f"<U{width}").view(np.uint32).reshape(len(words), width)
    return codes.astype(np.uint16) if codes.max() < 1 << 16 else codes


def common(rows: np.ndarray, all_rows: np.ndarray) -> np.ndarray:
    """Length of the common prefix of every row of one matrix with every row of the other."""
    same = np.zeros((len(rows), len(all_rows), rows.shape[1] + 1), bool)
    np.equal(rows[:, None, :], all_rows[None, :, :], out=same[:, :, :-1])
    return same.argmin(axis=2)


def single_edits(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, common prefix) of the words that one edit parts, ``i < j``."""
    forth, back = matrix(words), matrix([w[::-1] for w in words])
    lengths = np.array([len(w) for w in words])
    step = max(1, CELLS // (len(words) * (forth.shape[1] + 1)))
    found = []
    for at in range(0, len(words), step):
        prefix = common(forth[at:at + step], forth[at:])
        suffix = common(back[at:at + step], back[at:])
        longer = np.maximum(lengths[at:at + step, None], lengths[None, at:])
        # one word in two pooled groups is no pair
        i, j = np.nonzero((prefix + suffix >= longer - 1) & (prefix < forth.shape[1]))
        ahead = i < j
        i, j = i[ahead], j[ahead]
        found.append((i + at, j + at, prefix[i, j]))
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))


def packs(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Consecutive groups packed into tiles; a large group is a tile of its own."""
    begin = 0
    for at in range(1, len(starts)):
        rows = starts[at] - begin
        if rows >= TILE or rows * int(sizes[begin:starts[at]].max()) >= CELLS // 4 or (
                at == len(starts) - 1):
            if rows > 1:
                yield begin, int(starts[at])
            begin = int(starts[at])


def near_in_tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words, both ways, from rows sorted by tile."""
    for table in whole_groups(batches):
        tile, size, side, block, two, n = (
            table[c].to_numpy() for c in ("tile", "size", "side", "block", "two", "n"))
        starts = starts_of(tile)
        alone = np.diff(starts) == 1  # most groups have one word and meet nobody
        keep = np.repeat(~alone, np.diff(starts))
        words = np.array(table["word"].to_pylist(), object)[keep]
        tile, size, side, block, two, n = (x[keep] for x in (tile, size, side, block, two, n))
        left, right = [], []
        for begin, end in packs(starts_of(tile), size):
            i, j, prefix = single_edits(words[begin:end].tolist())
            i, j = i + begin, j + begin
            longer = np.array([max(len(words[x]), len(words[y])) for x, y in
                               zip(i.tolist(), j.tolist(), strict=True)], np.int64)
            own = (tile[i] == tile[j]) & (size[i] == longer) & (size[j] == longer) & (
                side[i] == side[j]) & (side[i] == (prefix < longer // 2)) & (
                ~two[i] | (block[i] != block[j]))
            left.append(i[own])
            right.append(j[own])
        if left:
            i, j = np.concatenate(left), np.concatenate(right)
            a, b = np.concatenate([i, j]), np.concatenate([j, i])
            yield pa.RecordBatch.from_arrays(
                [pa.array(words[a], pa.string()), pa.array(words[b], pa.string()),
                 pa.array(n[b], pa.int64())], ["word", "near", "near_n"])


def near_words(vocab: DataFrame) -> DataFrame:
    """(word, near, near_n): every near pair of the vocabulary, both ways, once."""
    return tiled(vocab).repartition("tile").sortWithinPartitions("tile").mapInArrow(
        near_in_tiles, NEAR)


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form), each chain followed to its end by doubling.

    A form occurs several times as often as its word, so chains are short and have no loops.
    """
    paths = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = paths.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = cut_lineage(paths.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"),
            F.col("further").isNotNull().alias("moved")))
        if moved.filter("moved").isEmpty():
            return paths
        paths = moved.drop("moved")


def variants(docs: DataFrame, factor: int = FORM_FACTOR) -> DataFrame:
    """One row per word: its form (the most frequent near word, if ``factor`` times as
    frequent), the root its forms lead to, counts."""
    vocab = stored(vocabulary(docs))
    # the most frequent near word first, of equal ones the smallest
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("form")))
    near = near_words(vocab).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    formed = vocab.join(near, "word", "left").withColumn(
        "taken", -F.col("best.minus") >= factor * F.col("n"))
    words = stored(formed.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("taken"), F.col("best.form")).alias("form"),
        F.when(F.col("taken"), -F.col("best.minus")).alias("form_n")))
    ends = roots(words.filter("form IS NOT NULL"))
    return words.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
