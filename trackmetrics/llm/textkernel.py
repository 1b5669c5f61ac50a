"""Word and shingle hashes of a batch of texts, computed on whole byte buffers with numpy.

A word is a run of bytes other than ASCII white space, A-Z taken in lower case; its hash is a polynomial over
64-bit values drawn per byte, mixed with its length, so a word of a buffer costs a few array
operations and no Python object.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _byte_values() -> np.ndarray:
    lowered = np.arange(256, dtype=np.uint64)
    lowered[65:91] += 32
    return mix(lowered + np.uint64(0x51ED270B))


_VALUES = _byte_values()
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n of each."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 20)
        for i, b in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, b, dtype=np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0], _powers[1]


def slices(column, max_bytes: int = 1 << 20, max_rows: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of rows of an Arrow string column of about ``max_bytes``, at most ``max_rows``; nulls are empty."""
    import pyarrow as pa

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + max_bytes, "right")) - 1)
        last = min(last, len(column), first + max_rows)
        at = offsets[first : last + 1]
        yield first, data[at[0] : at[-1]], at - at[0]
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words, their first bytes, and for each row the index of its first word (one more at the end)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    space = _SPACE[data]
    starts = ~space
    before = np.empty(n, dtype=bool)
    before[0], before[1:] = True, space[:-1]
    rows = offsets[:-1]
    before[rows[rows < n]] = True
    after = np.empty(n, dtype=bool)
    after[-1], after[:-1] = True, space[1:]
    ends_of_rows = offsets[1:] - 1
    after[ends_of_rows[ends_of_rows >= 0]] = True
    first = np.flatnonzero(starts & before)
    last = np.flatnonzero(starts & after) + 1
    up, down = _tables(n)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_VALUES[data] * up[:n], out=total[1:])
    hashes = (total[last] - total[first]) * down[first]
    hashes = mix(hashes + (last - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return hashes, first, np.searchsorted(first, offsets)


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words, rows not regarded."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        out = out * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[j : j + n]
    return mix(out)


def shingle_sets(column, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct hashes of its k-word shingles); fewer words form one shingle, no words none."""
    for first, data, offsets in slices(column):
        hashes, _, bounds = words(data, offsets)
        every = shingles(hashes, k)
        for row, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            if b - a >= k:
                yield first + row, np.unique(every[a : b - k + 1])
            elif b > a:
                yield first + row, shingles(hashes[a:b], b - a) + np.uint64(b - a)
            else:
                yield first + row, np.zeros(0, np.uint64)


def digests(values: np.ndarray) -> tuple[int, int]:
    """Two independent signed 64-bit digests of a set of hashes."""
    with np.errstate(over="ignore"):
        one = values.sum(dtype=np.uint64)
        two = mix(values * np.uint64(0x8CB92BA72F3D8DD7)).sum(dtype=np.uint64)
    return int(one.astype(np.int64)), int(two.astype(np.int64))
