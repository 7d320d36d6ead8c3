"""Toxicity scores: gradient-boosted trees over dense features, calibrated isotonically.

A text becomes sixteen numbers: densities of words and word beginnings from a lexicon, how
near they stand to words that address the reader, capitals, punctuation and obfuscation
rates. The lexicon is learned: words and word beginnings that labelled toxic documents hold
far more often than others. Trees learn from other labelled rows than the lexicon, and the
calibration from other rows than the trees, so no step is judged on what it has memorised.

Learning takes about ``TRAIN_ROWS`` labelled rows, chosen by a digest of their id, never held-out ones;
features, scores and decisions are computed for every row and whole text, each in its own
row, so nothing but the labelled rows' ids and features is moved.

Defined cases: NULL and empty texts have all features zero and get the score that goes with
them. NULL labels and labels without a document teach nothing. With fewer than ``FEW`` labels of a
kind all steps learn from all of them, as parts would be too small to tell. Without labels of both
kinds the score is the share of toxic labels, 0 if there are none. Repeated rows get equal scores. Other columns are
not read; ``keep`` passes them through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from episeries.llm.common import held_out
from episeries.llm.learning import labelled
from episeries.sources.storage import cut_lineage

#: Labelled rows to learn from at most; lexicon entries at most; trees.
TRAIN_ROWS = 12_000
LEXICON_SIZE = 4_000
TREES = 16
#: Labels of each kind from which on lexicon, trees and calibration learn from rows of their own.
FEW = 40
THRESHOLD = 0.5
BEGINNING = 5

# Words that address the reader, in the corpus's languages.
SECOND_PERSON = set(
    "you your yours yourself u du dich dir dein deine ihr euch euer tu te toi ton ta tes vous "
    "votre vos tú ti usted ustedes vosotros tuyo vuestro".split())
LETTERS = str.maketrans("013457@$!", "oieastasi")
OBFUSCATED = re.compile(r"(?:[^\W\d_][@$*!0-9]+[^\W\d_])|(.)\1{3,}")
N_FEATURES = 16


def plain(word: str) -> str:
    """Lower case without punctuation around it."""
    return word.lower().strip(".,;:!?\"'()[]{}<>|*#$%&-_+=~`/\\")


def features(text: str | None, words: set[str], starts: set[str]) -> list[float]:
    """The dense features of one text, the first ten from the lexicon."""
    tokens = (text or "").split()
    if not tokens:
        return [0.0] * N_FEATURES
    bare = [plain(t) for t in tokens]
    hits = [i for i, w in enumerate(bare) if w in words]
    begun = [i for i, w in enumerate(bare) if w[:BEGINNING] in starts]
    hidden = [i for i, w in enumerate(bare)
              if w and not w.isalpha() and w.translate(LETTERS) in words]
    you = [i for i, w in enumerate(bare) if w in SECOND_PERSON]
    marked = sorted({*hits, *begun, *hidden})
    near = 0.0
    if you and marked:
        place = np.searchsorted(you, marked)
        ahead = np.append(you, 10**9)[place] - np.array(marked)
        behind = np.array(marked) - np.append(-10**9, you)[place]
        near = float(np.mean(1.0 / (1.0 + np.minimum(ahead, behind))))
    n, chars = len(tokens), len(text)
    capitals = sum(t.isupper() and len(t) > 1 for t in tokens)
    letters = sum(map(str.isupper, text)) if chars < 1 << 16 else sum(
        sum(map(str.isupper, t)) for t in tokens)
    return [
        1000 * len(hits) / n, 1000 * len(begun) / n, 1000 * len(hidden) / n,
        float(min(len(hits), 20)), float(min(len(begun), 20)), float(min(len(hidden), 20)),
        float(min(len({bare[i] for i in hits}), 10)),
        float(min(len({bare[i][:BEGINNING] for i in begun}), 10)),
        near, 1000 * len(you) / n,
        capitals / n, letters / chars, text.count("!") / n, text.count("?") / n,
        sum(map(text.count, "*#$%&@")) / n,
        sum(bool(OBFUSCATED.search(w)) for w in bare if not w.isalpha()) / n,
    ]


def featurizer(words: set[str], starts: set[str]):
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([features(t, words, starts) for t in batch], dtype=object)

    return F.pandas_udf(run, ArrayType(DoubleType()))


def parts(label: str):
    """A mapInPandas function: labelled texts to the distinct words and beginnings in them."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen = []
            for text, y in zip(batch["text"], batch[label], strict=True):
                bare = {plain(t) for t in (text or "").split()}
                seen += [(w, False, y) for w in bare if w]
                seen += [(b, True, y) for b in {w[:BEGINNING] for w in bare}
                         if len(b) == BEGINNING]
            yield pd.DataFrame(seen, columns=["part", "start", "y"])

    return run


def lexicon(rows: DataFrame, label: str) -> tuple[set[str], set[str]]:
    """Words and beginnings that three positive rows hold, or all, far above their share."""
    n = rows.agg(F.sum(label).alias("pos"), F.count("*").alias("all")).first()
    odds = F.expr(f"((pos + 0.2) / {(n.pos or 0) + 1}) / ((seen - pos + 0.2) / "
                  f"{n.all - (n.pos or 0) + 1})")
    best = (
        rows.select("text", label).mapInPandas(parts(label), "part string, start boolean, y int")
        .groupBy("part", "start").agg(F.sum("y").alias("pos"), F.count("*").alias("seen"))
        .filter(f"pos >= {max(1, min(3, n.pos or 0))}").withColumn("odds", odds).filter("odds >= 12")
        .orderBy(F.desc("pos"), F.desc("odds"), "part", "start").limit(LEXICON_SIZE).collect()
    )
    return ({r.part for r in best if not r.start}, {r.part for r in best if r.start})


class Model:
    """What was learned: lexicon, trees, calibration; ``score`` adds a column."""

    def __init__(self, docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> None:
        rows = labelled(docs, labels, "toxic", most)
        self.words, self.starts = set(), set()
        self.trees = self.calibration = None
        kinds = {(r.part, r.toxic): r.n for r in rows.groupBy(
            F.expr("CASE WHEN fold < 50 THEN 0 WHEN fold < 85 THEN 1 ELSE 2 END").alias("part"),
            "toxic").agg(F.count("*").alias("n")).collect()}
        toxic = sum(n for (_, y), n in kinds.items() if y)
        clean = sum(kinds.values()) - toxic
        self.prior = toxic / max(1, toxic + clean)
        if not toxic or not clean:
            return
        few = len(kinds) < 6 or min(toxic, clean) < FEW
        first, second, third = ("true",) * 3 if few else ("fold < 50", "fold < 85", "fold >= 85")
        self.words, self.starts = lexicon(rows.filter(first), "toxic")
        made = cut_lineage(self.vectors(rows if few else rows.filter("fold >= 50")).select(
            "toxic", "fold", "__vector"))
        self.trees = GBTClassifier(
            labelCol="toxic", featuresCol="__vector", predictionCol="__class", maxIter=TREES,
            maxDepth=3, stepSize=0.3, minInstancesPerNode=min(3, toxic, clean), seed=7,
        ).setProbabilityCol("__chance").setRawPredictionCol("__raw").fit(made.filter(second))
        self.calibration = IsotonicRegression(
            labelCol="toxic", featuresCol="__margin", predictionCol="__score").fit(
            self.margins(made.filter(third)))

    def vectors(self, df: DataFrame) -> DataFrame:
        return df.withColumn(
            "__vector", array_to_vector(featurizer(self.words, self.starts)("text")))

    def margins(self, df: DataFrame) -> DataFrame:
        """Add the trees' margin to rows with vectors."""
        return self.trees.transform(df).withColumn(
            "__margin", vector_to_array("__raw")[1]).drop("__raw", "__chance", "__class")

    def score(self, df: DataFrame, name: str = "score") -> DataFrame:
        """Add the calibrated probability of a toxic label."""
        if self.trees is None:
            return df.withColumn(name, F.lit(float(self.prior)))
        found = self.calibration.transform(self.margins(self.vectors(df)))
        return found.withColumn(name, F.greatest(F.lit(0.0), F.least(F.lit(1.0), "__score"))).drop(
            "__vector", "__margin", "__score")


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    rows = Model(docs, labels).score(docs.select("doc_id", "text"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    rows = Model(docs, labels).score(docs, "__toxicity")
    return rows.filter(F.col("__toxicity") < THRESHOLD).drop("__toxicity")
