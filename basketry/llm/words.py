"""Words of many texts at once: boundaries and 64-bit hashes by array operations over the UTF-8 bytes."""

from __future__ import annotations

import numpy as np

# Odd multipliers of the hashes below: fixed values, any odd 64-bit numbers do.
ROOT = 0x9E3779B97F4A7C15
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
# Bytes hashed at a time; the powers of ROOT are tabled up to here.
SEGMENT = 1 << 18

_powers: list[np.ndarray] = []


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(MIX[0])
    h ^= h >> np.uint64(27)
    h *= np.uint64(MIX[1])
    return h ^ (h >> np.uint64(31))


def _tables(size: int) -> list[np.ndarray]:
    """Powers of ROOT and of its inverse modulo 2^64."""
    if not _powers or len(_powers[0]) < size:
        with np.errstate(over="ignore"):
            _powers[:] = [
                np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(size - 1, base, np.uint64))])
                for base in (np.uint64(ROOT), np.uint64(pow(ROOT, -1, 1 << 64)))
            ]
    return _powers


def boundaries(kind: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end positions of maximal runs of one kind (0: no word); runs end with their text."""
    if not len(kind):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    change = np.empty(len(kind) + 1, bool)
    change[0] = change[-1] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:-1])
    change[offsets] = True
    at = np.flatnonzero(change)
    real = kind[at[:-1]] != 0
    return at[:-1][real], at[1:][real]


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes; runs are in order and do not overlap."""
    out = np.empty(len(starts), np.uint64)
    row = 0
    while row < len(starts):
        base = starts[row]
        last = max(row + 1, int(np.searchsorted(ends, base + SEGMENT, "right")))
        end = ends[last - 1]
        power, inverse = _tables(max(SEGMENT, int(end - base)) + 1)
        with np.errstate(over="ignore"):
            sums = np.zeros(end - base + 1, np.uint64)
            np.cumsum((data[base:end].astype(np.uint64) + np.uint64(1)) * power[:end - base], out=sums[1:])
            a, b = starts[row:last] - base, ends[row:last] - base
            out[row:last] = mix((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64) * np.uint64(MIX[0]))
        row = last
    return out


def owners(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of the text that each run lies in."""
    return np.searchsorted(offsets, starts, "right") - 1
