"""Array operations over the UTF-8 bytes of many texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_RANDOM = np.random.default_rng(20240229)
BYTE_CODE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MULTIPLIER = 0x9E3779B97F4A7C15
# Powers of the multiplier for a slice of text, and of its inverse modulo 2 ** 64.
SLICE = 1 << 18
SLICE_POWERS, SLICE_INVERSES = (
    np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(SLICE - 1, base, dtype=np.uint64)])) for base in (MULTIPLIER, pow(MULTIPLIER, -1, 2**64))
)
LONG_RUN = 65_536
POWERS = SLICE_POWERS[:LONG_RUN]
STEP_CODES = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column without nulls, and where each row starts (one more than rows)."""
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    if len(column) == 0 or column.buffers()[2] is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0]: offsets[-1]]
    return data, offsets - offsets[0]


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of True that do not cross rows: starts, ends and the row of each."""
    n = len(mask)
    if n == 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    cut = np.zeros(n + 1, dtype=bool)
    cut[offsets] = True
    opens, closes = mask.copy(), mask.copy()
    opens[1:] &= ~mask[:-1] | cut[1:n]
    closes[:-1] &= ~mask[1:] | cut[1:n]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    before = np.searchsorted(starts, offsets)
    return starts, ends, np.repeat(np.arange(len(offsets) - 1), np.diff(before))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each run; the runs are in order and do not overlap.

    The bytes of a run count by powers of a multiplier. Sums over a slice of text take the powers from the slice's start, and
    the inverse of the run's first power moves them to the run's own.
    """
    if len(starts) == 0:
        return np.zeros(0, dtype=np.uint64)
    lengths = ends - starts
    if lengths.max() > LONG_RUN:
        return _long_run_hashes(data, starts, ends)
    total, first = np.empty(len(starts), dtype=np.uint64), 0
    while first < len(starts):
        low = int(starts[first])
        last = int(np.searchsorted(ends, low + SLICE, side="right"))
        terms = BYTE_CODE[data[low:int(ends[last - 1])]]
        terms *= SLICE_POWERS[: len(terms)]
        sums, at = np.cumsum(terms), starts[first:last] - low
        total[first:last] = (sums[ends[first:last] - low - 1] - sums[at] + terms[at]) * SLICE_INVERSES[at]
        first = last
    return mix(total + mix(lengths.astype(np.uint64)))


def _long_run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The same for runs of any length, in which the powers repeat."""
    lengths = ends - starts
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    inside = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(first, lengths)
    terms = BYTE_CODE[data[inside + np.repeat(starts, lengths)]] * POWERS[inside & (LONG_RUN - 1)]
    return mix(np.add.reduceat(terms, first) + mix(lengths.astype(np.uint64)))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive hashes."""
    if len(hashes) < size:
        return np.zeros(0, dtype=np.uint64)
    total = hashes[: len(hashes) - size + 1] * STEP_CODES[0]
    for step in range(1, size):
        total = mix(total) + hashes[step: len(hashes) - size + 1 + step] * STEP_CODES[step]
    return mix(total)


def whole_windows(rows: np.ndarray, size: int) -> np.ndarray:
    """Which windows of ``size`` consecutive entries stay inside one row."""
    return rows[size - 1:] == rows[: max(0, len(rows) - size + 1)]
