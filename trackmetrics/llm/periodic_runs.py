"""Maximal runs of repeated words, found by recompression.

1. Words of a slice of documents are numbered exactly; documents stand one after the other, each closed by a mark that occurs once.
2. Candidates (i, q) come from a harmonic grid.  A run of period q has at least ``least(q)`` words, so word i equals word
   i + q on a stretch of at least ``least(q) - q`` places, and every stretch of that length holds a multiple of it: the grid of period q
   has that step, and all grids together have about n log n / 3 places.  A place counts if it and two neighbours on one side agree.
3. Documents with candidates are recompressed: blocks of one symbol become a symbol, then pairs of a left and a right symbol become one,
   until each document is a single symbol.  Equal stretches are parsed alike except near their ends, so a longest
   common extension climbs the levels of this run-length grammar while both sides start a symbol, and comes down where they differ:
   a constant number of steps a level.  The same levels, mirrored, answer extensions to the left.
4. Extensions of a candidate to both sides give its maximal stretch; the least q of equal stretches is the smallest period, as all
   its periods up to a quarter of the length are multiples of the least one.

A null text has no words.  Empty texts have no runs; repeated rows are treated one by one; an empty table gives no rows.
The words of one document are held by one task, whatever its length; documents of some MB of text are held at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: A run has at least LEAST_WORDS words and LEAST_PERIODS periods.
LEAST_WORDS = 6
LEAST_PERIODS = 4
#: Bytes of text held at a time, and places of the grid compared at a time.
SLICE_BYTES = 2 << 20
GRID_PLACES = 1 << 17


def least(q):
    """Fewest words of a run of period q."""
    return np.maximum(LEAST_WORDS, LEAST_PERIODS * q)


class Level:
    """Symbols of one level of the grammar; ``up``: index of the symbol above that covers each, ``first``: first index that each symbol above covers."""

    def __init__(self, symbols: np.ndarray, up: np.ndarray, first: np.ndarray, blocks: bool):
        self.symbols, self.up, self.blocks = symbols, up, blocks
        self.first = np.append(first, len(symbols))

    def mirrored(self) -> Level:
        n = len(self.first) - 1
        return Level(self.symbols[::-1], (n - 1 - self.up)[::-1], (len(self.symbols) - self.first[1:])[::-1], self.blocks)


class Grammar:
    """Run-length grammar of sequences of non-negative numbers, with longest common extensions.

    Marks (negative, each occurring once) close the sequences and are never merged.  ``rules`` lists, per level, the new
    symbols' left part and either their right part (pairs) or their number (blocks).
    """

    def __init__(self, symbols: np.ndarray):
        self.levels: list[Level] = []
        self.rules: list[tuple[np.ndarray, np.ndarray]] = []
        named = int(symbols.max(initial=0)) + 1
        blocks, seed = True, 0
        while not self._single(symbols):
            starts, left, right, merged = self._blocks(symbols) if blocks else self._pairs(symbols, seed)
            if merged.any():
                where = np.flatnonzero(merged)
                kinds, name = _named(left[where], right[where])
                above = symbols[starts]
                above[where] = named + name
                self.rules.append(kinds)
                named += len(kinds[0])
                begins = np.zeros(len(symbols), dtype=np.int64)
                begins[starts] = 1
                self.levels.append(Level(symbols, np.cumsum(begins) - 1, starts, blocks))
                symbols = above
            seed += not blocks
            blocks = not blocks
        n = np.arange(len(symbols))
        self.levels.append(Level(symbols, n, n, True))
        self._back: list[Level] | None = None

    @staticmethod
    def _single(symbols: np.ndarray) -> bool:
        """Each sequence is one symbol at most."""
        plain = symbols >= 0
        return not (plain[1:] & plain[:-1]).any()

    @staticmethod
    def _blocks(symbols: np.ndarray):
        starts = np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1]))
        length = np.diff(np.append(starts, len(symbols)))
        return starts, symbols[starts], length, length > 1

    @staticmethod
    def _pairs(symbols: np.ndarray, seed: int):
        """A bit per symbol and round deals the symbols to the left and the right side."""
        bit = (_mixed(symbols.astype(np.uint64) + np.uint64((seed + 1) * 0x9E3779B97F4A7C15 % (1 << 64))) >> np.uint64(40)) & np.uint64(1)
        plain = symbols >= 0
        second = np.zeros(len(symbols), dtype=bool)
        second[1:] = plain[1:] & plain[:-1] & (bit[1:] == 1) & (bit[:-1] == 0)
        starts = np.flatnonzero(~second)
        merged = np.append(second, False)[starts + 1]
        return starts, symbols[starts], np.append(symbols, -1)[starts + 1], merged

    def extensions(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from i on equal those from j on (i < j in one sequence)."""
        return _extend(self.levels, i, j)

    def extensions_back(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols up to and including i equal those up to j (i < j in one sequence); a mark must stand before the first sequence."""
        if self._back is None:
            self._back = [level.mirrored() for level in self.levels]
        last = len(self.levels[0].symbols) - 1
        return _extend(self._back, last - i, last - j)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _named(left: np.ndarray, right: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray]:
    """Distinct rows (left, right), and the index of each row among them."""
    width = int(right.max()) + 1
    kinds, name = np.unique(left * width + right, return_inverse=True)
    return (kinds // width, kinds % width), name


def _extend(levels: list[Level], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    a, b = i.astype(np.int64), j.astype(np.int64)
    turned = np.full(len(a), len(levels) - 1)
    climbing = np.arange(len(a))
    for k, level in enumerate(levels[:-1]):
        if not len(climbing):
            break
        x, y = a[climbing], b[climbing]
        up_x, up_y = level.up[x], level.up[y]
        inside = (level.first[up_x] != x) | (level.first[up_y] != y)
        differ = inside & (level.symbols[x] != level.symbols[y])
        step = inside & ~differ
        if level.blocks:  # the shorter rest of the two blocks agrees; where one is longer, the next symbols differ
            rest_x, rest_y = level.first[up_x + 1] - x, level.first[up_y + 1] - y
            move = np.where(step, np.minimum(rest_x, rest_y), 0)
            differ |= step & (rest_x != rest_y)
        else:  # a right symbol ends its parent on both sides
            move = step.astype(np.int64)
        x, y = x + move, y + move
        turned[climbing[differ]] = k
        a[climbing], b[climbing] = x, y
        climbing = climbing[~differ]
        a[climbing], b[climbing] = level.up[x[~differ]], level.up[y[~differ]]
    # At the last level each sequence is one symbol, so the two sides stand on different ones.
    for k in range(len(levels) - 1, 0, -1):
        down = np.flatnonzero(turned >= k)
        if not len(down):
            continue
        level = levels[k - 1]
        x, y = a[down], b[down]
        low_x, low_y = level.first[x], level.first[y]
        same = level.symbols[low_x] == level.symbols[low_y]
        if level.blocks:
            move = np.where(same, np.minimum(level.first[x + 1] - low_x, level.first[y + 1] - low_y), 0)
        else:
            move = same.astype(np.int64)
        a[down], b[down] = low_x + move, low_y + move
    return a - i


def grid(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidate places and periods in ``words``: sequences of ``sizes`` words, longest first, each closed by a mark, with marks at both ends."""
    n = len(words)
    ends = np.cumsum(sizes + 1) + 1
    places, periods = [], []
    q, most = 1, int(sizes.max(initial=0)) // LEAST_PERIODS
    while q <= most:
        # Only sequences of at least least(q) words, which stand first, can hold a run of period q.
        reach = int(ends[np.searchsorted(-sizes, -int(least(q)), "right") - 1]) if sizes[0] >= least(q) else 0
        if not reach:
            break
        per = max(1, reach // int(least(q) - q))
        some = np.arange(q, min(most, q + max(0, GRID_PLACES // per - 1)) + 1)
        step = least(some) - some
        many = -(-reach // step)
        period = np.repeat(some, many)
        i = (np.arange(len(period)) - np.repeat(np.cumsum(many) - many, many)) * np.repeat(step, many)
        found = i + period < reach
        i, period = i[found], period[found]
        found = words[i] == words[i + period]
        i, period = i[found], period[found]
        agree = [_agree(words, i + d, period, n) for d in (-2, -1, 1, 2)]
        found = (agree[0] & agree[1]) | (agree[2] & agree[3])
        places.append(i[found])
        periods.append(period[found])
        q = int(some[-1]) + 1
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(periods)


def _agree(words: np.ndarray, i: np.ndarray, q: np.ndarray, n: int) -> np.ndarray:
    inside = (i >= 0) & (i + q < n)
    return inside & (words[np.where(inside, i, 0)] == words[np.where(inside, i + q, -1)])


class _Numbers(dict):
    """Numbers keys in the order in which they are asked for."""

    def __missing__(self, key):
        self[key] = out = len(self)
        return out


def runs_of(texts: Sequence[Sequence]) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each sequence of words, by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    number = _Numbers().__getitem__
    order = [k for k in sorted(range(len(texts)), key=lambda k: -len(texts[k])) if len(texts[k]) >= LEAST_WORDS]
    if not order:
        return out
    words, sizes = _joined([np.fromiter(map(number, texts[k]), np.int64, len(texts[k])) for k in order])
    places, periods = grid(words, sizes)
    starts = np.cumsum(sizes + 1) - sizes
    owner = np.searchsorted(starts, places, "right") - 1
    inside = places + periods < starts[owner] + sizes[owner]
    places, periods, owner = places[inside], periods[inside], owner[inside]
    if not len(places):
        return out
    # Only sequences with candidates are compressed; they keep their order.
    used = np.unique(owner)
    if len(used) < len(sizes):
        own = np.searchsorted(used, owner)
        places = places - starts[owner]
        words, sizes = _joined([words[starts[d] : starts[d] + sizes[d]] for d in used])
        starts = np.cumsum(sizes + 1) - sizes
        owner, order = own, [order[d] for d in used]
        places = places + starts[owner]
    grammar = Grammar(words)
    right = grammar.extensions(places, places + periods)
    back = grammar.extensions_back(places, places + periods) - 1
    start, length = places - back, right + back + periods
    fits = length >= least(periods)
    found = np.stack([owner[fits], start[fits] - starts[owner[fits]], length[fits], periods[fits]], axis=1)
    found = found[np.lexsort(found.T[::-1])]
    first = np.ones(len(found), dtype=bool)
    first[1:] = (found[1:, :3] != found[:-1, :3]).any(axis=1)
    found = found[first]
    for d, s, n, q in found[np.lexsort((found[:, 3], found[:, 1], found[:, 0]))].tolist():
        out[order[d]].append((s, n, q))
    return out


def _joined(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The parts with a mark before the first and after each, and their sizes."""
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    out = np.empty(int(sizes.sum()) + len(parts) + 1, dtype=np.int64)
    ends = np.append(0, np.cumsum(sizes + 1))
    out[ends] = -1 - np.arange(len(ends))
    for p, a in zip(parts, ends.tolist()):
        out[a + 1 : a + 1 + len(p)] = p
    return out, sizes


def collapsed(words: list[bytes], runs: Sequence[tuple[int, int, int]]) -> bytes:
    """Words joined by one space, without those that a run holds after its first period."""
    if runs:
        gone = np.zeros(len(words), dtype=bool)
        for start, length, period in runs:
            gone[start + period : start + length] = True
        words = [words[k] for k in np.flatnonzero(~gone).tolist()]
    return b" ".join(words)


def with_repetition(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Documents with a tenth of the checksums of doc_id repeat a stretch of their own words up to their end; no id, no change."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", change: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """Per document: doc_id, n_words, runs (array of start, length, period, by start, then period), collapsed (text without the repeats).

    Words are runs of characters other than ASCII white space, compared as they are.  ``change`` may replace the words of a document first.
    """
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(run)), ("collapsed", pa.string())])

    def found(ids: list, texts: list) -> pa.RecordBatch:
        words = [t.encode().split() for t in texts]
        if change is not None:
            words = [change(i, w) for i, w in zip(ids, words)]
        runs = runs_of(words)
        columns = [
            ids, list(map(len, words)), [[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs],
            [collapsed(w, own).decode() for w, own in zip(words, runs)],
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def scan(batches):
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            some, size, first = [], 0, 0
            for k in range(len(batch)):
                some.append(texts[k].as_py() or "")
                size += len(some[-1])
                if size >= SLICE_BYTES or k + 1 == len(batch):
                    yield found(ids[first : k + 1].to_pylist(), some)
                    some, size, first = [], 0, k + 1

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(scan, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def summarised(found: DataFrame) -> DataFrame:
    """Per document of ``find_runs``: number of runs, the longest one (ties: smallest start, then period) and digests of the runs and of the text without repeats."""
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r.start, r.length, r.period))
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r.length).alias("shorter"), r.start.alias("start"), r.period.alias("period"))))
    return found.withColumn("longest", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("longest.start").alias("start"), (-F.col("longest.shorter")).alias("length"), F.col("longest.period").alias("period"),
        F.expr("(-longest.shorter * 1000L) div longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
