"""What several operators of this package share: word patterns, broadcasts, the registry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The word patterns of the result contracts.
SPACED = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# And what lies between such words.
SPACE_GAP = r"[\x20\x09-\x0D]+"
ALNUM_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A side is broadcast only if it was counted and has at most so many rows.
BROADCAST_ROWS = 20_000

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Workload:
    run: Run
    sql: str | None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else; on pure ASCII the faster ``lower`` is the same."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def words_of(text: Column, gap: str = SPACE_GAP) -> Column:
    """All words in order; NULL text has none.

    Splitting at the gaps is linear in the text; extracting matches is not, since the JVM
    copies the text for each match.
    """
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), gap), "")


def small(df: DataFrame) -> DataFrame:
    """A materialised ``df``, broadcast if it proves small; else joins shuffle it."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def perhaps_in(df: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``df`` whose keys are in the materialised ``wanted``, and about one in 16 of
    the others.

    Comes before a join that shuffles wide rows of which few are wanted. Two bytes a wanted row
    are broadcast: a bitmap of the keys' hashes.
    """
    bits = 16 * max(wanted.count(), 1)

    def spot(rows: DataFrame) -> Column:
        return F.pmod(F.xxhash64(*[rows[k] for k in keys]), F.lit(bits)) + 1

    maps = wanted.groupBy(F.bitmap_bucket_number(spot(wanted)).alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(spot(wanted))).alias("__bits"))
    place = F.bitmap_bit_position(spot(df)).cast("int")
    byte = F.conv(F.hex(F.substr("__bits", F.shiftright(place, 3) + 1, F.lit(1))), 16, 10)
    is_set = F.getbit(byte.cast("long"), place % 8) == 1
    return df.join(F.broadcast(maps), (F.bitmap_bucket_number(spot(df)) == F.col("__bucket"))
                   & is_set, "left_semi")


def held_out(doc_id: Column) -> Column:
    """Rows that no classifier may learn from: crc32 of the id's text divides by 5."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def keep_rows(docs: DataFrame, winners: DataFrame, sha: Column) -> DataFrame:
    """The rows of ``docs`` whose id and text digest are in ``winners`` (doc_id, sha), each once.

    Only the digests meet the texts' own row; repeated rows lie side by side after the join.
    """
    def key(digest: Column) -> Column:
        return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), digest)

    won = winners.select(key(F.col("sha")).alias("__key")).distinct()
    repeats = Window.partitionBy("__key").orderBy("__key")
    return (
        docs.withColumn("__key", key(sha)).join(won, "__key", "left_semi")
        .withColumn("__repeat", F.row_number().over(repeats)).filter("__repeat = 1")
        .drop("__key", "__repeat")
    )
