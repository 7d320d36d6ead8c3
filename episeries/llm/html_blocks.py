"""From HTML to leaf blocks: each with its text and hashed features of its tag path and words."""

from __future__ import annotations

import html as entities
import re
import zlib

import numpy as np

# Elements of HTML that matter for cutting a page into blocks.
INLINE = set("a abbr acronym b bdi bdo big cite code data dfn em font i ins del kbd label mark "
             "nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img "
             "picture source input math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot "
             "mover munder munderover mspace mstyle semantics annotation noscript object canvas svg".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|template|iframe"
# A drawing ends where it says so; one that is never closed takes nothing with it.
DRAWING = r"<svg\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?:(?<=/)>|>.*?</svg\s*>)"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b.*?(?:</(?P=raw)\s*>|\Z)|{DRAWING}|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)"
    r"(?P<more>(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)|(?P<text>[^<]+|<)",
    re.S | re.I)
NAMED = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", re.I)
PART = re.compile(r"[a-z]+")

PATH, WORDS, PLAIN = 256, 32, 8
N_FEATURES = PATH + WORDS + PLAIN


class Block:
    """Text of a leaf, the open elements around it and how much of it is link text."""

    __slots__ = ("path", "text", "linked")

    def __init__(self, path: tuple[str, ...], text: str, linked: int) -> None:
        self.path, self.text, self.linked = path, text, linked


def names_of(tag: str, more: str) -> str:
    """An element as one path step: its name and the words of its class, id and role."""
    parts = [tag]
    for _, value in NAMED.findall(more) if more else ():
        parts += PART.findall(value.lower())
    return " ".join(parts)


def blocks_of(page: str | None) -> list[Block]:
    """The leaf blocks of a page in order; text outside any block element is a block too."""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    text: list[str] = []
    in_link = linked = 0

    def close() -> None:
        nonlocal linked
        joined = " ".join(entities.unescape("".join(text)).split())
        if joined:
            out.append(Block(tuple(step for _, step in stack), joined, linked))
        text.clear()
        linked = 0

    for found in TOKEN.finditer(page or ""):
        if found["text"] is not None:
            text.append(found["text"])
            linked += len(found["text"]) if in_link else 0
            continue
        tag = (found["name"] or "").lower()
        if not tag:  # comments, scripts, declarations
            continue
        if tag == "a":
            in_link = 0 if found["end"] else 1
        if tag == "br":
            text.append(" ")
        elif tag in INLINE:
            if tag in VOID:
                text.append(" ")
        elif found["end"]:
            close()
            if tag in (name for name, _ in stack):
                while stack.pop()[0] != tag:
                    pass
            in_link = 0
        else:
            close()
            closes = {"p": "p", "li": "li", "dt": "dt", "dd": "dd", "tr": "tr", "td": "td",
                      "th": "th", "option": "option"}.get(tag, "p")
            if stack and stack[-1][0] in (closes, "p"):
                stack.pop()
            if tag not in VOID:
                stack.append((tag, names_of(tag, found["more"])))
    close()
    return out


def place(kind: str, word: str) -> tuple[int, float]:
    """Where a hashed word counts, and with which sign."""
    number = zlib.crc32(f"{kind} {word}".encode())
    size = PATH if kind == "path" else WORDS
    return number % size, 1.0 if kind == "path" or number >> 20 & 1 else -1.0


def path_vector(path: tuple[str, ...]) -> np.ndarray:
    """Steps near the block and words of their attributes, hashed."""
    out = np.zeros(PATH, np.float32)
    for depth, step in enumerate(reversed(path)):
        for word in step.split():
            at, sign = place("path", word)
            out[at] += sign if depth < 8 else sign / 2
    return np.minimum(out, 2)


class Hashing:
    """Places and path vectors already worked out; made inside a task and bounded."""

    def __init__(self, most: int = 1 << 16) -> None:
        self.places: dict[str, tuple[int, float]] = {}
        self.paths: dict[tuple[str, ...], np.ndarray] = {}
        self.most = most

    def place(self, word: str) -> tuple[int, float]:
        if word not in self.places:
            if len(self.places) >= self.most:
                self.places.clear()
            self.places[word] = place("word", word)
        return self.places[word]

    def path_vector(self, path: tuple[str, ...]) -> np.ndarray:
        if path not in self.paths:
            if len(self.paths) >= self.most >> 4:
                self.paths.clear()
            self.paths[path] = path_vector(path)
        return self.paths[path]


def features(blocks: list[Block], hashing: Hashing | None = None) -> np.ndarray:
    """A row per block: hashed path, hashed words, lengths, link share, punctuation, place."""
    hashing = hashing or Hashing()
    out = np.zeros((len(blocks), N_FEATURES), np.float32)
    for i, block in enumerate(blocks):
        out[i, :PATH] = hashing.path_vector(block.path)
        words = block.text.lower().split()
        for word in words:
            at, sign = hashing.place(word)
            out[i, PATH + at] += sign
        out[i, PATH: PATH + WORDS] /= len(words)
        n = len(block.text)
        out[i, PATH + WORDS:] = (
            1, np.log1p(n) / 6, np.log1p(len(words)) / 5, min(1.0, block.linked / n),
            8 * sum(map(block.text.count, ".,;:!?")) / n, n / len(words) / 10,
            i / len(blocks), block.text[-1] in ".!?")
    return out
