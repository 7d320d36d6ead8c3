"""Whole groups from a stream of rows that is sorted by a 64-bit group key."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Groups are handed over together until so many rows or bytes are reached.
CHUNK_ROWS, CHUNK_BYTES = 20_000, 16 << 20


def starts_of(key: np.ndarray) -> np.ndarray:
    """Where a new value begins, the end included."""
    change = np.flatnonzero(key[1:] != key[:-1]) + 1
    return np.concatenate([[0], change, [len(key)]]) if len(key) else np.zeros(1, np.int64)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str = "tile") -> Iterator[pa.Table]:
    """Tables of whole groups; at most one group and a chunk are held at a time."""
    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        size += batch.nbytes
        if rows < CHUNK_ROWS and size < CHUNK_BYTES:
            continue
        table = pa.Table.from_batches(held)
        last = int(starts_of(table[key].to_numpy())[-2])
        if last:
            yield table.slice(0, last)
        held = table.slice(last).to_batches()
        rows, size = table.num_rows - last, 0
    if rows:
        yield pa.Table.from_batches(held)
