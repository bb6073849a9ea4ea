"""Periodic runs of words by multi-scale minimizers.

A run is a stretch of words with smallest period q, at least ``MIN_WORDS`` long and at least three periods, that neither
neighbour extends. Words become numbers; a prefix hash gives the hash of any stretch.

Periods up to ``LAGS`` are found by scanning lags: a run of period q holds a stretch of 16 or more words equal to the
words q further on, so every 16th word is compared at each lag. Longer periods come in scales (A, 2A]. At a scale the
hashes of A/4 words compete in windows of A/4 places, and the minima are kept. What is kept at a place depends on fewer
than A words around it, so inside a run it repeats at the distance of the period. Of equal minima close to each other
only the first stays (their overlap has a period of an earlier scale), which bounds the equal minima within reach of
one to 16. Pairs of equal minima at a distance d of the scale are seeds: a seed is kept if the d words before or after it
recur at distance d, and is then extended word by word in both directions. No run is missed: of the first two
periods of any run of length 3q some minimum has its whole context, and that of its repetition, inside the run.

Scale: a text is one row and never leaves its task, so there is no key to be skewed; texts are worked in chunks of about
a megabyte and a longer text alone. Work is linear in the words, times a small factor for each scale the longest texts
have; extension never reads a stretch of one period twice.

Edge cases: null, empty and blank texts have no words, no run and an empty collapsed text. Words are compared as they
are, in full. Words repeated once more than a run, across two texts, do not count: texts are kept apart. Ties for the
strongest run go to the smallest start, then the smallest period. Repeated rows and other columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, spaced

MIN_WORDS = 24
PERIODS = 3
LAGS = 16

_RUN = "struct<start:long,length:long,period:long>"
FOUND = f"runs array<{_RUN}>, best {_RUN}, collapsed string"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x.astype(np.uint64) + np.uint64(1)) * _BASE
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _window_fold(x: np.ndarray, width: int, fold) -> np.ndarray:
    """``fold`` (minimum or maximum) of every ``width`` neighbours, in two linear passes over blocks of ``width``."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    spare = -len(x) % width
    padded = np.concatenate((x, np.full(spare, x[-1], x.dtype))).reshape(-1, width)
    ahead = fold.accumulate(padded, axis=1).ravel()
    back = fold.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return fold(back[:n], ahead[width - 1 : width - 1 + n])


class _Sequence:
    """Word numbers of several texts with a number of its own between them."""

    def __init__(self, ids: np.ndarray):
        self.ids = ids
        power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(ids), _BASE))))
        self.sums = np.concatenate(([np.uint64(0)], np.cumsum(_mix(ids) * power[:-1])))
        self.inverse = np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(ids), _BACK))))

    def hashes(self, at: np.ndarray, size: int) -> np.ndarray:
        """Hash of the ``size`` words from each place."""
        return (self.sums[at + size] - self.sums[at]) * self.inverse[at]

    def recurs(self, at: np.ndarray, d: np.ndarray, need: np.ndarray) -> np.ndarray:
        """Whether the ``need`` words before or after a place recur ``d`` words on (up to chance)."""
        n = len(self.ids)
        after = at + d + need <= n
        before = (at >= need) & (at + d <= n)
        ok = np.zeros(len(at), bool)
        p, e, m = at[after], d[after], need[after]
        ok[after] = (self.sums[p + m] - self.sums[p]) * self.inverse[p] == (
            self.sums[p + e + m] - self.sums[p + e]
        ) * self.inverse[p + e]
        left = before & ~ok
        p, e, m = at[left] - need[left], d[left], need[left]
        ok[left] = (self.sums[p + m] - self.sums[p]) * self.inverse[p] == (
            self.sums[p + e + m] - self.sums[p + e]
        ) * self.inverse[p + e]
        return ok

    def stretch(self, at: int, d: int) -> tuple[int, int]:
        """The widest range around ``at`` whose words all equal those ``d`` further on; empty if there is none."""
        ids, n = self.ids, len(self.ids) - d
        right, step = at, 32
        while right < n:
            stop = min(right + step, n)
            differ = ids[right:stop] != ids[right + d : stop + d]
            if differ.any():
                right += int(differ.argmax())
                break
            right, step = stop, step * 2
        left, step = at, 32
        while left > 0:
            stop = max(left - step, 0)
            differ = (ids[stop:left] != ids[stop + d : left + d])[::-1]
            if differ.any():
                left -= int(differ.argmax())
                break
            left, step = stop, step * 2
        return left, right


def _extend(seq: _Sequence, at: np.ndarray, d: np.ndarray, found: dict[tuple[int, int], int]) -> None:
    """Adds the runs around seeds; a stretch is read once per period, multiples of a smaller period are left out."""
    order = np.lexsort((at, d))
    last, until = 0, -1
    for p, q in zip(at[order].tolist(), d[order].tolist()):
        if q == last and p <= until:
            continue
        left, right = seq.stretch(p, q)
        last, until = q, max(right, p)
        length = right - left + q
        if right > left and length >= max(MIN_WORDS, PERIODS * q):
            found.setdefault((left, length), q)


def _short_periods(seq: _Sequence, end: int, found: dict) -> None:
    for q in range(1, LAGS + 1):
        need = max(MIN_WORDS, PERIODS * q) - q
        at = np.arange(0, end - q, need)
        at = at[seq.ids[at] == seq.ids[at + q]]
        half = np.full(len(at), max(need // 2, 1))
        lag = np.full(len(at), q)
        keep = seq.recurs(at, lag, half)
        _extend(seq, at[keep], lag[keep], found)


def _minimizers(seq: _Sequence, end: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of windows' minima, of equal ones no more than half a ``width`` apart the first."""
    h = seq.hashes(np.arange(max(end - width + 1, 0)), width)
    least = _window_fold(h, width, np.minimum)
    if not len(least):
        return np.empty(0, np.int64), h[:0]
    edge = np.zeros(width - 1, h.dtype)
    at = np.flatnonzero(_window_fold(np.concatenate((edge, least, edge)), width, np.maximum) == h)
    kept = h[at]
    order = np.lexsort((at, kept))
    at, kept = at[order], kept[order]
    first = np.ones(len(at), bool)
    first[1:] = (kept[1:] != kept[:-1]) | (np.diff(at) > width // 2)
    return at[first], kept[first]


def _long_periods(seq: _Sequence, sizes: np.ndarray, ends: np.ndarray, found: dict) -> None:
    """Texts stand longest first, so those that can hold the periods of a scale are a prefix."""
    low = LAGS
    while PERIODS * (low + 1) <= sizes[0]:
        end = int(ends[np.searchsorted(-sizes, -PERIODS * (low + 1), "right")])
        at, h = _minimizers(seq, end, low // 4)
        seeds, gaps = [], []
        for r in range(1, len(at)):
            gap = at[r:] - at[:-r]
            near = (h[r:] == h[:-r]) & (gap <= 2 * low)
            if not near.any():
                break
            near &= gap > low
            seeds.append(at[:-r][near])
            gaps.append(gap[near])
        if seeds:
            p, d = np.concatenate(seeds), np.concatenate(gaps)
            keep = seq.recurs(p, d, d)
            _extend(seq, p[keep], d[keep], found)
        low *= 2


def find_runs(texts: list[list[int]]) -> list[list[tuple[int, int, int]]]:
    """Runs as (start, length, period) of each sequence of numbers (at least 0), by start, then period."""
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    sizes = np.array([len(texts[i]) for i in order], np.int64)
    ends = np.concatenate(([0], np.cumsum(sizes + 1)))
    ids = np.empty(int(ends[-1]), np.int64)
    for k, i in enumerate(order):
        ids[ends[k] : ends[k + 1] - 1] = texts[i]
        ids[ends[k + 1] - 1] = -1 - k
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not len(sizes) or sizes[0] < MIN_WORDS:
        return out
    seq, found = _Sequence(ids), {}
    _short_periods(seq, int(ends[np.searchsorted(-sizes, -MIN_WORDS, "right")]), found)
    _long_periods(seq, sizes, ends, found)
    for (start, length), period in found.items():
        k = int(np.searchsorted(ends, start, "right")) - 1
        out[order[k]].append((start - int(ends[k]), length, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


def _strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    best = None
    for r in runs:  # by start, then period: only a greater exponent replaces
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    drop = np.zeros(len(words), bool)
    for start, length, period in runs:
        drop[start + period : start + length] = True
    return b" ".join([w for w, gone in zip(words, drop.tolist()) if not gone])


def periodic_runs(text: Column) -> Column:
    """Struct of ``runs`` by start, then period, the ``best`` of them and the text ``collapsed`` to one period a run."""
    keys = ("start", "length", "period")

    @F.pandas_udf(FOUND)
    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for part in chunks(texts, spaced):
            words = [t.split() for t in part]
            number = {w: i for i, w in enumerate(dict.fromkeys(w for ws in words for w in ws))}
            every = find_runs([list(map(number.__getitem__, ws)) for ws in words])
            for whole, ws, runs in zip(part, words, every):
                best = _strongest(runs)
                short = _collapsed(ws, runs) if runs else whole
                rows.append(([dict(zip(keys, r)) for r in runs], best and dict(zip(keys, best)), short.decode("utf-8")))
        return pd.DataFrame(rows, columns=["runs", "best", "collapsed"])

    return scan(text)
