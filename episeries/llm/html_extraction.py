"""Main text of web pages from a recurrent block labeller.

A page is cut into leaf blocks. A bidirectional LSTM reads the whole sequence of blocks, each
as hashed vectors of its tag path and its words, and labels every block as main text or not,
so a label depends on the whole page. Main blocks, in page order, are the text.

The network is plain numpy. It learns on the driver from ``MADE_PAGES`` invented pages of many
layouts, whose blocks have known labels, and from about ``SAMPLED_PAGES`` pages of the table, whose
blocks get a label only where element names or attributes leave no doubt. Labelling handles
every block of every whole page, each row by itself; pages of like length are read together.

Defined cases: NULL and empty pages have no text. Broken markup is read as far as it goes: open
elements end with the page. Repeated rows get equal texts. A NULL ``page_id`` or ``url`` is passed on.
An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episeries.llm.html_blocks import N_FEATURES, Block, Hashing, blocks_of, features

HIDDEN = 24
MADE_PAGES, SAMPLED_PAGES = 900, 200
EPOCHS = 10

# Words in element names, classes and ids that tell what an element is for.
ASIDE = set("nav menu header footer aside sidebar side ad ads advert advertisement banner cookie "
            "cookies consent notice alert promo sponsor sponsored comment comments reply replies "
            "form search login subscribe newsletter related share social breadcrumb breadcrumbs "
            "pagination pager widget head title copyright popup modal button select textarea".split())
MAIN = set("article main content post entry story".split())
LAYOUTS = ["article", "main", "div class=content", "div id=main-content", "div class=post-body",
           "section class=entry", "article class=post", "div role=main", "td class=story", "main id=article"]
EXTRAS = ["div class=ad", "div class='ad banner'", "aside class=sidebar", "div class=cookie-notice",
          "div id=newsletter", "div class=related", "div class=share", "section class=comments",
          "div id=comments", "ol class=comment-list", "div class=promo", "aside", "div class=alert",
          "form class=search", "form id=login", "div class=sponsored", "div class=widget", "form"]


class Direction:
    """One LSTM that reads blocks of pages (pages, steps, features) from left to right."""

    def __init__(self, rng: np.random.Generator) -> None:
        self.w = rng.normal(0, 0.1, (N_FEATURES + HIDDEN, 4 * HIDDEN)).astype(np.float32)
        self.b = np.zeros(4 * HIDDEN, np.float32)
        self.b[HIDDEN: 2 * HIDDEN] = 1

    def forward(self, x: np.ndarray, keep: bool = False) -> tuple[np.ndarray, list]:
        """The hidden states, and what the way back needs."""
        n, steps, _ = x.shape
        h = c = np.zeros((n, HIDDEN), np.float32)
        fed = x @ self.w[:N_FEATURES] + self.b
        out, past = np.zeros((n, steps, HIDDEN), np.float32), []
        for t in range(steps):
            z = fed[:, t] + h @ self.w[N_FEATURES:]
            gates = 1 / (1 + np.exp(-z[:, : 3 * HIDDEN]))
            i, f, o = np.split(gates, 3, axis=1)
            g = np.tanh(z[:, 3 * HIDDEN:])
            before, c = c, f * c + i * g
            if keep:
                past.append((i, f, o, g, before, c, h))
            h = o * np.tanh(c)
            out[:, t] = h
        return out, past

    def backward(self, x: np.ndarray, past: list, slope: np.ndarray) -> tuple:
        """Slopes of the weights from slopes of the hidden states."""
        dz_all = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
        dh = dc = np.zeros((len(x), HIDDEN), np.float32)
        dw = np.zeros_like(self.w)
        for t in range(x.shape[1] - 1, -1, -1):
            i, f, o, g, before, c, h = past[t]
            dh = dh + slope[:, t]
            tanh = np.tanh(c)
            dc = dc + dh * o * (1 - tanh**2)
            dz = np.hstack([dc * g * i * (1 - i), dc * before * f * (1 - f),
                            dh * tanh * o * (1 - o), dc * i * (1 - g**2)])
            dz_all[:, t] = dz
            dw[N_FEATURES:] += h.T @ dz
            dh, dc = dz @ self.w[N_FEATURES:].T, dc * f
        dw[:N_FEATURES] = np.tensordot(x, dz_all, ([0, 1], [0, 1]))
        return dw, dz_all.sum(axis=(0, 1))


def turned(x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each sequence backwards, its padding still behind it."""
    steps = np.arange(x.shape[1])
    at = np.where(steps < lengths[:, None], lengths[:, None] - 1 - steps, steps)
    return np.take_along_axis(x, at[:, :, None], axis=1)


class Labeller:
    """Both directions and a logistic output; gives each block's probability of being main."""

    def __init__(self, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        self.ahead, self.back = Direction(rng), Direction(rng)
        self.v = rng.normal(0, 0.1, 2 * HIDDEN + 1).astype(np.float32)

    def run(self, x: np.ndarray, lengths: np.ndarray, keep: bool = False) -> tuple:
        a, past_a = self.ahead.forward(x, keep)
        b, past_b = self.back.forward(turned(x, lengths), keep)
        h = np.concatenate([a, turned(b, lengths)], axis=2)
        return 1 / (1 + np.exp(-(h @ self.v[:-1] + self.v[-1]))), h, past_a, past_b

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = EPOCHS) -> None:
        """Adam on the cross-entropy of labelled blocks; label -1 counts for nothing."""
        params = [self.ahead.w, self.ahead.b, self.back.w, self.back.b, self.v]
        means, squares = ([np.zeros_like(p) for p in params] for _ in range(2))
        rng, step = np.random.default_rng(9), 0
        pages = sorted(pages, key=lambda p: len(p[0]))
        groups = [pages[at: at + 32] for at in range(0, len(pages), 32)]
        for _ in range(epochs):
            for k in rng.permutation(len(groups)):
                x, lengths = padded([f for f, _ in groups[k]])
                y = np.full(x.shape[:2], -1, np.float32)
                for row, (_, labels) in zip(y, groups[k], strict=True):
                    row[: len(labels)] = labels
                p, h, past_a, past_b = self.run(x, lengths, keep=True)
                miss = np.where(y >= 0, p - y, 0).astype(np.float32) / max(1, (y >= 0).sum())
                dh = miss[:, :, None] * self.v[:-1]
                slopes = [*self.ahead.backward(x, past_a, dh[:, :, :HIDDEN]),
                          *self.back.backward(turned(x, lengths), past_b,
                                              turned(dh[:, :, HIDDEN:], lengths)),
                          np.append(np.tensordot(miss, h, ([0, 1], [0, 1])), miss.sum())]
                step += 1
                for param, m, s, slope in zip(params, means, squares, slopes, strict=True):
                    m += 0.1 * (slope - m)
                    s += 0.01 * (slope**2 - s)
                    param -= (0.01 * m / (1 - 0.9**step)
                              / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)).astype(np.float32)


def padded(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(r) for r in rows])
    x = np.zeros((len(rows), lengths.max(), N_FEATURES), np.float32)
    for i, r in enumerate(rows):
        x[i, : len(r)] = r
    return x, lengths


def silver(blocks: list[Block]) -> np.ndarray:
    """1 inside an element for main text, 0 inside any other telling one, -1 in doubt."""
    def label(block: Block) -> int:
        words = [set(step.split()) for step in block.path]
        inside = next((i for i, w in enumerate(words) if w & MAIN), None)
        rest = words if inside is None else words[inside + 1:]
        if any(w & ASIDE for w in rest):
            return 0
        return -1 if inside is None else 1

    return np.array([label(b) for b in blocks], np.float32)


def made_page(rng: random.Random) -> tuple[str, list[int]]:
    """An invented page and the labels of its blocks."""
    def word() -> str:
        return "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiouéäñ")
                       for _ in range(rng.randint(1, 4)))

    def words(low: int, high: int) -> str:
        some = [word() for _ in range(rng.randint(low, high))]
        return " ".join(w + rng.choice(["", "", "", "", ",", "."]) for w in some).capitalize()

    labels: list[int] = []

    def block(tag: str, text: str, label: int) -> str:
        labels.append(label)
        name = tag.split()[0]
        return f"<{tag}>{text}</{name}>"

    def links(n: int) -> str:
        return "<ul>" + "".join(block(
            "li", f"<a href='/{word()}'>{words(1, 3)}</a>", 0) for _ in range(n)) + "</ul>"

    def form() -> str:
        some = "".join(
            block(rng.choice(["p", "div", "p class=row"]), words(1, 6), 0)
            if rng.random() < 0.7 else block(rng.choice(["button", "textarea"]), words(1, 3), 0)
            for _ in range(rng.randint(1, 4)))
        return f"<form{rng.choice(['', ' action=/send', ' method=post'])}>{some}<input></form>"

    def extra() -> str:
        tag = rng.choice(EXTRAS)
        kind = rng.random()
        if kind < 0.3:
            return block(tag, words(3, 40), 0)
        inner = links(rng.randint(1, 5)) if kind < 0.5 else "".join(
            block(rng.choice(["p", "p", "div", "h3", "li"]), words(2, 40), 0)
            for _ in range(rng.randint(1, 4)))
        return f"<{tag}>{inner}</{tag.split()[0]}>"

    out = ["<html><head>", block("title", words(2, 9), 0), "</head><body>"]
    if rng.random() < 0.4:
        out.append(f"<header>{block(rng.choice(['h1', 'div class=logo', 'p']), words(1, 4), 0)}</header>")
    if rng.random() < 0.8:
        box = rng.choice(["nav", "div class=menu", "div id=nav", "nav class=navbar"])
        out.append(f"<{box}>{links(rng.randint(2, 9))}</{box.split()[0]}>")
    out += [extra() for _ in range(rng.choice([0, 1, 1, 2]))]
    box = rng.choice(LAYOUTS)
    body = []
    if rng.random() < 0.85:
        head = block(rng.choice(["h1", "h1", "h2"]), words(2, 12), 1)
        body.append(f"<header>{head}</header>" if rng.random() < 0.15 else head)
    for _ in range(rng.choice([1, 2, 4, 8, 14])):
        kind = rng.random()
        if kind < 0.1 and len(body) > 1:
            body.append(form() if rng.random() < 0.3 else extra())
        elif kind < 0.18:
            body.append("<ul>" + "".join(block("li", words(2, 15), 1)
                                         for _ in range(rng.randint(1, 4))) + "</ul>")
        elif kind < 0.24:
            body.append(block(rng.choice(["h2", "h3", "blockquote", "pre", "figcaption"]), words(1, 12), 1))
        else:
            text = words(1, rng.choice([3, 30, 120]))
            body.append(block("p", rng.choice([text, f"<b>{text}</b>", f"{text} <a href='#'>{word()}</a>"]), 1))
    wrapped = f"<{box}>{''.join(body)}</{box.split()[0]}>"
    if box.startswith("td"):
        wrapped = f"<table><tr>{wrapped}</tr></table>"
    out.append(f"<div class={word()}>{wrapped}</div>" if rng.random() < 0.3 else wrapped)
    out += [extra() for _ in range(rng.choice([0, 1, 2, 3]))]
    if rng.random() < 0.9:
        foot = rng.choice(["footer", "div class=footer", "div id=footer"])
        if rng.random() < 0.3:
            inner = block("p", words(2, 25), 0) if rng.random() < 0.4 else ""
            out.append(f"<{foot}>{inner}{links(rng.randint(1, 4))}</{foot.split()[0]}>")
        else:
            out.append(block(foot, "&copy; " + words(2, 25), 0))
    return "".join(out) + "</body></html>", labels


def training_pages(n: int, seed: int = 3) -> list[tuple[np.ndarray, np.ndarray]]:
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        page, labels = made_page(rng)
        blocks = blocks_of(page)
        if len(blocks) == len(labels):
            out.append((features(blocks), np.array(labels, np.float32)))
    return out


def learned(pages: DataFrame, made: int = MADE_PAGES, sampled: int = SAMPLED_PAGES) -> Labeller:
    """A labeller fitted on invented pages and about ``sampled`` pages of the table."""
    share = min(1.0, sampled / max(1, pages.count()))
    number = F.conv(F.substring(F.md5(F.coalesce(F.col("page_id").cast("string"), F.lit(""))
                                      .cast("binary")), 1, 7), 16, 10).cast("long")
    rows = pages.filter(number < int(share * (1 << 28))).select("page_id", "html").collect()
    known = []
    for row in sorted(rows, key=lambda r: (r.page_id or 0, r.html or "")):
        if blocks := blocks_of(row.html):
            known.append((features(blocks), silver(blocks)))
    labeller = Labeller()
    labeller.fit(training_pages(made) + known)
    return labeller


def texts(pages: list[str | None], labeller: Labeller) -> list[str]:
    """The main text of each page."""
    cut, hashing = [blocks_of(p) for p in pages], Hashing()
    out = [""] * len(pages)
    order = sorted((i for i in range(len(cut)) if cut[i]), key=lambda i: len(cut[i]))
    at = 0
    while at < len(order):  # at most about 2**13 blocks at a time, unless one page has more
        size = max(1, (1 << 13) // len(cut[order[min(at + 127, len(order) - 1)]]))
        some = order[at: at + min(128, size)]
        x, lengths = padded([features(cut[i], hashing) for i in some])
        for i, p in zip(some, labeller.run(x, lengths)[0], strict=True):
            out[i] = "\n".join(b.text for b, q in zip(cut[i], p, strict=False) if q >= 0.5)
        at += len(some)
    return out


def extractor(labeller: Labeller):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            text = texts(batch["html"].tolist(), labeller)
            yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": text,
                                "n_chars": [len(t) for t in text]}).astype({"page_id": "Int64"})

    return run


def extracted(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    return pages.select("page_id", "url", "html").mapInPandas(
        extractor(learned(pages)), "page_id long, url string, text string, n_chars long")
