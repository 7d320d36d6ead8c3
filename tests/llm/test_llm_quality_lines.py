"""Lines of one text may differ: labels of lines, moves between them, and texts of both kinds."""

from __future__ import annotations

import random

import numpy as np

from episeries.llm import quality

KINDS = quality.byte_kinds()


def lines(rng, good, n):
    def word():
        return "".join(rng.choice("etaoinshr") for _ in range(rng.randint(2, 8)))

    if good:
        return [" ".join(word() for _ in range(rng.randint(6, 14))).capitalize() + "." for _ in range(n)]
    return ["".join(word() + rng.choice(["$$$ ", "*** ", "&&&", "%% 99 "]) for _ in range(rng.randint(4, 9)))
            for _ in range(n)]


def made(text):
    return quality.line_features(text, KINDS)[0]


def field(mixed):
    rng, texts, labels = random.Random(2), [], []
    for i in range(200):
        own = lines(rng, i % 2, rng.randint(1, 9))
        if mixed and i % 3 == 0 and len(own) > 3:
            own[1:1] = lines(rng, 1 - i % 2, 1)
        texts.append("\n".join(own))
        labels.append(i % 2)
    return quality.fit_lines([made(t) for t in texts], labels)


def marginals(text, weights, move):
    f = made(text)
    return quality.marginals(f[None], np.ones((1, len(f)), bool), weights, move)[0]


def test_a_good_text_with_a_bad_block_gets_both_labels():
    for mixed in (False, True):
        weights, move = field(mixed)
        rng = random.Random(9)
        for _ in range(10):
            text = lines(rng, 1, 4) + lines(rng, 0, 3) + lines(rng, 1, 4)
            good = marginals("\n".join(text), weights, move) > 0.5
            right = good == np.r_[np.ones(4), np.zeros(3), np.ones(4)].astype(bool)
            # a line beside the other kind may be doubtful, those within are not
            assert right[[0, 1, 2, 5, 8, 9, 10]].all() and right.sum() >= 9


def test_neighbours_change_a_doubtful_line():
    weights, move = field(True)
    assert move[0, 0] + move[1, 1] > move[0, 1] + move[1, 0]
    block = np.zeros((1, 3, quality.N_FEATURES))  # state scores of 3, 0, 3 and of -3, 0, -3
    block[0, [0, 2], 0] = 3
    alone = np.zeros(quality.N_FEATURES)
    alone[0] = 1
    mask = np.ones((1, 3), bool)
    up = quality.marginals(block, mask, alone, move)[0, 1]
    down = quality.marginals(-block, mask, alone, move)[0, 1]
    assert up > 0.5 > down


def test_line_labels_keep_the_documents_share():
    length = np.array([10.0, 10, 10, 10, 60])
    good = np.array([0.01, 0.02, 0.03, 0.6, 0.9])
    assert quality.line_labels(good, length, 1).tolist() == [0, 0, 0, 1, 1]
    assert quality.line_labels(np.full(5, 0.01), length, 1).tolist() == [0, 0, 0, 1, 1]
    assert quality.line_labels(np.full(5, 0.01), length, 0).tolist() == [0] * 5
    assert quality.line_labels(np.array([0.01]), np.array([5.0]), 1).tolist() == [1]


def test_long_texts_give_a_stretch_for_fitting():
    import pandas as pd

    text = "\n".join(f"line {i}" for i in range(5_000))
    got = next(quality.described(iter([pd.DataFrame(
        {"doc_id": [1, 2], "quality": [1, 0], "text": [text, None]})])))
    assert [len(b) for b in got["lines"]] == [4 * quality.N_FEATURES * n for n in (quality.FIT_LINES, 1)]
