"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is labelled good or bad. A line is described by what stands in it
(capitals, symbols, repeated words and lines, lengths) and by what stands in the lines around
it; neighbouring labels influence each other. Forward and backward sums give each line's
probability of being good, and a document's score is their mean, weighted by line length.

The field learns from about ``TRAIN_ROWS`` labelled documents, never held-out ones, of each at
most ``FIT_LINES`` lines in a row. Lines have no labels of their own: first each takes its
document's, and a field without moves is fitted. Then, in ``ROUNDS`` rounds, lines that the fitted
field is sure stand against their document's label change sides, the surest first, as long as lines of the
document's label keep more than ``SHARE`` of its length; and the whole field is fitted to
the lines so labelled. The moves between labels are so learned from documents that hold both.
Fitting is a few hundred gradient steps on the driver over that bounded sample. Scoring handles
every line of every whole text, each row by itself.

Defined cases: NULL and empty texts are one empty line. Without labels of both kinds every
score is the share of good labels, 0.5 if there are none. Repeated rows get equal scores. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from episeries.llm.common import held_out
from episeries.llm.learning import labelled

TRAIN_ROWS = 6_000
THRESHOLD = 0.3
STEPS = 250
#: Lines of a text that fitting sees; scoring sees all.
FIT_LINES = 256
#: Rounds of labelling lines anew, how sure a change must be, and the share of a document's
#: length that lines of its own label keep.
ROUNDS, SURE, SHARE = 2, 0.8, 0.6
#: Penalties of weights and of moves; few documents hold both labels, so moves stay moderate.
PENALTY, MOVE_PENALTY = 1e-4, 2e-2
KINDS = 7
OWN = 13
N_FEATURES = OWN + 2 * 5 + 2


def byte_kinds() -> np.ndarray:
    """For each byte one row: capital, small letter, digit, space, stop, symbol, not ASCII."""
    kinds = np.zeros((256, KINDS), np.int64)
    for b in range(256):
        c = chr(b)
        kind = (6 if b > 127 else 0 if c.isupper() else 1 if c.islower() else 2 if c.isdigit()
                else 3 if c.isspace() else 4 if c in ".,;:'\"-()?" else 5)
        kinds[b, kind] = 1
    return kinds


def line_features(text: str | None, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A row of features and a length for each line."""
    lines = (text or "").encode().split(b"\n")
    n = len(lines)
    lengths = np.fromiter(map(len, lines), np.int64, n)
    raw = np.frombuffer(b"".join(lines), np.uint8)
    counts = np.zeros((n, KINDS))
    if len(raw):
        stops = np.cumsum(lengths)
        for at in range(KINDS):
            sums = np.concatenate([[0], np.cumsum(kinds[:, at][raw])])
            counts[:, at] = sums[stops] - sums[stops - lengths]
    words = np.zeros((n, 4))
    seen: dict[bytes, int] = {}
    for line in lines:
        seen[line] = seen.get(line, 0) + 1
    for i, line in enumerate(lines):
        w = line.split()
        if w:
            same = sum(map(bytes.__eq__, w, w[1:]))
            words[i] = len(w), len(set(w)) / len(w), same / len(w), seen[line] > 1
    size = np.maximum(lengths, 1)[:, None]
    share = counts / size
    own = np.column_stack([
        np.ones(n), np.log1p(lengths) / 5, np.log1p(words[:, 0]) / 4, words[:, 1],
        4 * words[:, 2], words[:, 3], share[:, 0], share[:, 1] + share[:, 6], 4 * share[:, 2],
        4 * share[:, 3], 4 * share[:, 4], 8 * share[:, 5],
        np.minimum(lengths / np.maximum(words[:, 0], 1), 20) / 10,
    ])
    around = own[:, [1, 4, 5, 6, 11]]
    before = np.vstack([np.zeros((1, 5)), around[:-1]])
    after = np.vstack([around[1:], np.zeros((1, 5))])
    place = np.zeros((n, 2))
    place[0, 0] = place[-1, 1] = 1
    return np.hstack([own, before, after, place]), lengths


def chains(features: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pad feature rows of several texts to one block; the mask tells lines from padding."""
    longest = max(map(len, features))
    block = np.zeros((len(features), longest, N_FEATURES))
    mask = np.zeros((len(features), longest), bool)
    for i, f in enumerate(features):
        block[i, : len(f)], mask[i, : len(f)] = f, True
    return block, mask


def sums(state: np.ndarray, mask: np.ndarray, move: np.ndarray) -> tuple:
    """Forward and backward log sums of a block of chains with states bad and good."""
    docs, n, _ = state.shape
    ahead, back = np.zeros((docs, n, 2)), np.zeros((docs, n, 2))
    ahead[:, 0] = state[:, 0]
    for t in range(1, n):
        step = ahead[:, t - 1, :, None] + move
        new = np.logaddexp(step[:, 0], step[:, 1]) + state[:, t]
        ahead[:, t] = np.where(mask[:, t, None], new, ahead[:, t - 1])
    for t in range(n - 2, -1, -1):
        step = move + (state[:, t + 1] + back[:, t + 1])[:, None, :]
        new = np.logaddexp(step[:, :, 0], step[:, :, 1])
        back[:, t] = np.where(mask[:, t + 1, None], new, 0)
    return ahead, back, np.logaddexp(ahead[:, -1, 0], ahead[:, -1, 1])


def states(block: np.ndarray, weights: np.ndarray) -> np.ndarray:
    good = block @ weights
    return np.stack([np.zeros_like(good), good], axis=2)


def marginals(block: np.ndarray, mask: np.ndarray, weights: np.ndarray,
              move: np.ndarray) -> np.ndarray:
    """Each line's probability of being good."""
    ahead, back, total = sums(states(block, weights), mask, move)
    return np.exp(np.minimum(ahead[:, :, 1] + back[:, :, 1] - total[:, None], 0))


def fit(texts: list[np.ndarray], labels: list, steps: int = STEPS, chain: bool = True) -> tuple:
    """Weights and moves that maximise the penalised likelihood of the line labels.

    ``labels`` holds a label for each text or for each of its lines.
    """
    cut = sorted(((f, np.broadcast_to(y, len(f))) for f, y in zip(texts, labels, strict=True)),
                 key=lambda c: len(c[0]))
    blocks = []
    for at in range(0, len(cut), 1024):
        block, mask = chains([f for f, _ in cut[at: at + 1024]])
        wanted = np.zeros(mask.shape, np.int64)
        wanted[mask] = np.concatenate([y for _, y in cut[at: at + 1024]])
        blocks.append((block, mask, wanted))
    lines = sum(int(mask.sum()) for _, mask, _ in blocks)
    theta = np.zeros(N_FEATURES + 4)
    penalty = np.r_[np.full(N_FEATURES, PENALTY), np.full(4, MOVE_PENALTY)]
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        weights, move = theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2)
        slope = np.zeros_like(theta)
        for block, mask, wanted in blocks:
            state = states(block, weights)
            ahead, back, total = sums(state, mask, move)
            good = np.exp(ahead[:, :, 1] + back[:, :, 1] - total[:, None])
            miss = np.where(mask, wanted - good, 0)
            slope[:N_FEATURES] += np.einsum("dl,dlf->f", miss, block)
            if chain:
                inner = mask[:, 1:]
                pair = np.exp(np.minimum(
                    ahead[:, :-1, :, None] + move + (state + back)[:, 1:, None, :]
                    - total[:, None, None, None], 0)) * inner[:, :, None, None]
                seen = np.bincount((2 * wanted[:, :-1] + wanted[:, 1:])[inner], minlength=4)
                slope[N_FEATURES:] += seen - pair.sum(axis=(0, 1)).ravel()
        slope = slope / lines - penalty * theta
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        theta = theta + 0.1 * (mean / (1 - 0.9**step)) / (
            np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2)


def line_labels(good: np.ndarray, length: np.ndarray, label: int) -> np.ndarray:
    """Labels of a document's lines from their probabilities of being good."""
    own = good if label else 1 - good
    order = np.argsort(own, kind="stable")
    sure = own[order] <= 1 - SURE
    room = np.cumsum(length[order]) < (1 - SHARE) * length.sum()
    labels = np.full(len(good), label)
    labels[order[sure & room]] = 1 - label
    return labels


def fit_lines(texts: list[np.ndarray], labels: list[int], rounds: int = ROUNDS) -> tuple:
    """The field for texts that have a label, whose lines have none."""
    weights, move = fit(texts, labels, chain=False)
    for _ in range(rounds):
        lined = []
        for f, y in zip(texts, labels, strict=True):
            good = marginals(f[None], np.ones((1, len(f)), bool), weights, move)[0]
            lined.append(line_labels(good, np.expm1(5 * f[:, 1]) + 1, y))
        weights, move = fit(texts, lined)
    return weights, move


def scorer(weights: np.ndarray, move: np.ndarray):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        kinds = byte_kinds()
        for batch in batches:
            score = np.zeros(len(batch))
            made = [line_features(t, kinds) for t in batch]
            order = sorted(range(len(made)), key=lambda i: len(made[i][1]))
            at = 0
            while at < len(order):  # blocks of about 2**15 lines of texts of like length
                size = max(1, (1 << 15) // len(made[order[min(at + 512, len(order) - 1)]][1]))
                some = order[at: at + min(512, size)]
                block, mask = chains([made[i][0] for i in some])
                good = marginals(block, mask, weights, move)
                for i, g in zip(some, good, strict=True):
                    length = made[i][1] + 1
                    score[i] = (g[: len(length)] * length).sum() / length.sum()
                at += len(some)
            yield pd.Series(np.clip(score, 0.0, 1.0))

    return F.pandas_udf(run, DoubleType())


def described(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Labelled texts to their lines' features, as bytes; of long ones a stretch of lines."""
    kinds = byte_kinds()
    for batch in batches:
        lines = []
        for text in batch["text"]:
            made = line_features(text, kinds)[0]
            start = crc32((text or "").encode()) % max(1, len(made) - FIT_LINES + 1)
            lines.append(made[start: start + FIT_LINES].astype(np.float32).tobytes())
        yield pd.DataFrame({"doc_id": batch["doc_id"], "quality": batch["quality"], "lines": lines})


def learned(docs: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> tuple | float:
    """The fitted field, or the share of good labels if there is only one kind."""
    rows = labelled(docs, labels, "quality", most).mapInPandas(
        described, "doc_id long, quality int, lines binary").toPandas()  # about ``most`` rows
    rows = rows.sort_values(["doc_id", "quality", "lines"])
    if rows["quality"].nunique() < 2:
        return float(rows["quality"].mean()) if len(rows) else 0.5
    return fit_lines([np.frombuffer(b, np.float32).reshape(-1, N_FEATURES).astype(float)
                      for b in rows["lines"]], rows["quality"].tolist())


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = learned(docs, labels)
    score = F.lit(model) if isinstance(model, float) else scorer(*model)("text")
    return docs.select("doc_id", "text").withColumn("score", score).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
