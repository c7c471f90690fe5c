"""Tokens of whole Arrow columns as numpy arrays: spans, 64-bit hashes and grouped batches.

Texts are handled as UTF-8 bytes in slices of about ``SLICE`` bytes (a longer text is a slice of its own),
so memory follows the slice and not the batch that Spark sends.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
#: Odd, hence invertible modulo 2**64.
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 over uint64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def separators(chars: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(chars)] = True
    return table


#: The bytes between words `[^\x20\x09-\x0D]+`.
SPACE = separators(b" \t\n\x0b\x0c\r")
#: Everything in ASCII but letters and digits.
NOT_ALNUM = separators(bytes(i for i in range(128) if not chr(i).isalnum()))
PLAIN = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
#: As PLAIN, with A-Z read as a-z.
LOWER = PLAIN.copy()
LOWER[65:91] = PLAIN[97:123]

_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        size = max(n, 2 * SLICE)
        steps = np.full(size, BASE if kind == "up" else BASE_INVERSE, np.uint64)
        steps[0] = 1
        _powers[kind] = np.multiply.accumulate(steps)
    return _powers[kind][:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = PLAIN) -> np.ndarray:
    """Hash of data[start:end] for each span; equal bytes give equal hashes wherever they stand."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * _power("up", len(data)), out=sums[1:])
    down = _power("down", len(data) + 1)
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


@dataclass
class Slice:
    """Rows [first, last) of a batch: their bytes, and where each text begins and ends in them."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return self.last - self.first

    def spans(self, sep: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and row (from 0) of each run of bytes outside ``sep``; runs end with their text."""
        n = len(self.data)
        inside = np.zeros(n + 2, dtype=bool)
        inside[1:-1] = ~sep[self.data]
        cut = np.zeros(n + 1, dtype=bool)
        cut[self.offsets] = True
        before, after = inside[:-1], inside[1:]
        starts = np.flatnonzero(after & (~before | cut))
        ends = np.flatnonzero(before & (~after | cut))
        return starts, ends, np.searchsorted(self.offsets, starts, side="right") - 1


def slices(column: pa.Array, limit: int = SLICE) -> Iterator[Slice]:
    """Slices of a string column; null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if len(column) == 0:
        return
    _, offsets, values = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    values = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        last = min(last, len(column))
        yield Slice(first, last, values[at[first] : at[last]], at[first : last + 1] - at[first])
        first = last


def bounds(rows: np.ndarray, n: int) -> np.ndarray:
    """Positions 0..n where each row's tokens begin, given the ascending row of each token."""
    return np.searchsorted(rows, np.arange(n + 1))


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups, from batches in which the rows of a group stand together."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        same = np.ones(batch.num_rows, dtype=bool)
        for key in keys:
            values = batch.column(key).to_numpy()
            same &= values == values[-1]
        change = 0 if same.all() else int(np.flatnonzero(~same)[-1]) + 1
        if change:
            yield pa.Table.from_batches([*kept, batch.slice(0, change)])
            kept = [batch.slice(change)]
        elif kept and any(kept[0].column(key)[0] != batch.column(key)[0] for key in keys):
            yield pa.Table.from_batches(kept)
            kept = [batch]
        else:
            kept.append(batch)
    if kept:
        yield pa.Table.from_batches(kept)


def group_edges(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Row numbers at which the groups of ``table`` begin, and its length."""
    change = np.zeros(table.num_rows + 1, dtype=bool)
    change[[0, table.num_rows]] = True
    for key in keys:
        values = table.column(key).to_numpy()
        change[1:-1] |= values[1:] != values[:-1]
    return np.flatnonzero(change)


def give_back() -> None:
    """Returns freed memory to the system, the tables of powers too, which are soon made again."""
    _powers["up"] = _powers["down"] = np.ones(1, np.uint64)
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


#: What workers keep between tasks, by the module that keeps it: how to drop it.
KEPT: dict[str, Callable[[], None]] = {}


def drop_kept(owner: str | None) -> None:
    """Drops what other modules than ``owner`` keep in this process."""
    for name, drop in KEPT.items():
        if name != owner:
            drop()


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], owner: str | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, after which a worker gives freed memory back to the system: workers stay and would keep each task's peak.

    Before it, the worker drops what other operators left in it; ``owner`` names the module whose memory stays.
    """

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept(owner)
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped
