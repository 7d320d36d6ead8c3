"""Sorted runs of (code, doc, times) records, compressed in blocks, and their k-way merge."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import zstandard

#: Records in a block of a run: what a merge holds of each run.
BLOCK = 8_192
#: Byte lengths of the columns of a block, and of its head (records, compressed bytes).
WIDTHS, HEAD = (8, 8, 4), 8

Records = tuple[np.ndarray, np.ndarray, np.ndarray]


def _planes(column: np.ndarray, width: int) -> bytes:
    """Bytes of equal weight side by side, which compresses far better than whole numbers."""
    return column.astype(f"<i{width}").view(np.uint8).reshape(-1, width).T.tobytes()


def written_run(codes: np.ndarray, docs: np.ndarray, times: np.ndarray) -> bytes:
    """One run, sorted by code, as compressed blocks."""
    pack = zstandard.ZstdCompressor(level=1)
    parts = []
    for at in range(0, len(codes), BLOCK):
        code = codes[at:at + BLOCK]
        body = pack.compress(
            _planes(np.diff(code, prepend=np.int64(0)), 8) + _planes(docs[at:at + BLOCK], 8)
            + _planes(times[at:at + BLOCK], 4))
        parts += [np.array([len(code), len(body)], "<i4").tobytes(), body]
    return b"".join(parts)


def read_run(run: bytes) -> Iterator[Records]:
    """The blocks of a run, one at a time."""
    unpack, at = zstandard.ZstdDecompressor(), 0
    while at < len(run):
        n, size = np.frombuffer(run, "<i4", 2, at).tolist()
        body = np.frombuffer(unpack.decompress(run[at + HEAD:at + HEAD + size]), np.uint8)
        at += HEAD + size
        columns, begin = [], 0
        for width in WIDTHS:
            plane = body[begin:begin + n * width].reshape(width, n)
            columns.append(np.ascontiguousarray(plane.T).view(f"<i{width}")[:, 0])
            begin += n * width
        yield np.cumsum(columns[0]), columns[1], columns[2]


def merged(runs: Iterable[bytes]) -> Iterator[Records]:
    """All records in the order of their codes, in parts that never step back.

    Of every run one block is open. Up to the least last code of the open blocks all records
    are known, so these leave together. One heap holds the blocks' next codes, one their last.
    """
    readers = [read_run(run) for run in runs]
    opened: list[Records | None] = [None] * len(readers)
    age = [0] * len(readers)
    heads: list[tuple[int, int]] = []
    lasts: list[tuple[int, int, int]] = []

    def advance(run: int) -> None:
        opened[run] = next(readers[run], None)
        age[run] += 1
        if opened[run] is not None:
            code = opened[run][0]
            heapq.heappush(heads, (int(code[0]), run))
            heapq.heappush(lasts, (int(code[-1]), run, age[run]))

    for run in range(len(readers)):
        advance(run)
    while heads:
        while lasts[0][2] != age[lasts[0][1]]:  # of a block that has gone
            heapq.heappop(lasts)
        bound, taken, used = lasts[0][0], [], []
        while heads and heads[0][0] <= bound:
            run = heapq.heappop(heads)[1]
            block = opened[run]
            cut = int(np.searchsorted(block[0], bound, "right"))
            taken.append(tuple(column[:cut] for column in block))
            if cut < len(block[0]):
                opened[run] = tuple(column[cut:] for column in block)
                heapq.heappush(heads, (int(block[0][cut]), run))
            else:
                used.append(run)
        for run in used:
            advance(run)
        codes, docs, times = (np.concatenate(column) for column in zip(*taken, strict=True))
        order = np.argsort(codes, kind="stable")
        yield codes[order], docs[order], times[order]


def totals(values: np.ndarray, *weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct values and the whole-number sums of their weights."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    begin = np.flatnonzero(np.diff(ordered, prepend=ordered[:1] - 1))
    return ordered[begin], *(np.add.reduceat(w[order].astype(np.int64), begin) for w in weights)


def counted(runs: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each code once with its sum over all runs; only the last code stays open."""
    code, total = None, 0
    for codes, _, times in merged(runs):
        found, sums = totals(codes, times)
        if code is not None:
            if found[0] == code:
                sums[0] += total
            else:
                yield np.array([code]), np.array([total])
        code, total = int(found[-1]), int(sums[-1])
        if len(found) > 1:
            yield found[:-1], sums[:-1]
    if code is not None:
        yield np.array([code]), np.array([total])
