"""Shared pieces of the training-data operators: normalised word buffers, vectorised hashing, small frame helpers.

Python work runs inside Spark tasks on Arrow batches. Texts of a batch are handled in chunks of bounded bytes, a text
longer than a chunk alone; only that one text is then held together with its temporaries.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20

# bytes of the word pattern [^\x00-\x2F\x3A-\x60\x7B-\x7F]: digits, letters and everything beyond ASCII; A-Z is lower-cased
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold(key: Column, parts: int) -> Column:
    """crc32 of the key as text modulo ``parts``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % parts


def unit_hash(*keys: Column) -> Column:
    """A repeatable number in [0, 1) for sampling by key."""
    return F.pmod(F.xxhash64(F.lit("sample"), *keys), F.lit(1 << 30)) / float(1 << 30)


def letters(text: str | None) -> bytes:
    """Lower-cased words of digits, letters and non-ASCII characters, joined by one space."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").translate(_LETTERS).split())


def plain(text: str | None) -> bytes:
    """Words between ASCII white space with A-Z lower-cased, joined by one space."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())


def spaced(text: str | None) -> bytes:
    """Words between ASCII white space as they are, joined by one space."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").split())


def byte_pieces(words: bytes) -> Iterator[bytes]:
    """A normalised text in pieces of about ``CHUNK_BYTES``, cut at spaces."""
    at = 0
    while at < len(words):
        cut = words.find(b" ", at + CHUNK_BYTES)
        cut = len(words) if cut < 0 else cut
        yield words[at:cut]
        at = cut + 1


def chunks(texts: Iterable[str | None], norm) -> Iterator[list[bytes]]:
    """Normalised texts in lists of about ``CHUNK_BYTES``."""
    held, size = [], 0
    for text in texts:
        words = norm(text)
        if held and size + len(words) > CHUNK_BYTES:
            yield held
            held, size = [], 0
        held.append(words)
        size += len(words)
    if held:
        yield held


class Words:
    """Word positions of several normalised texts in one buffer.

    ``start``/``end``: byte range of each word; ``doc``: index of its text; ``first``: first word of each text, with
    the total at the end.
    """

    def __init__(self, texts: list[bytes]):
        self.raw = b" ".join(texts) + b" " * 9
        self.buf = np.frombuffer(self.raw, np.uint8)
        sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        begin = np.concatenate(([0], np.cumsum(sizes + 1)))[:-1]
        space = self.buf == 32
        inside = ~space
        self.start = np.flatnonzero(inside & np.concatenate(([True], space[:-1])))
        self.end = np.flatnonzero(space[1:] & inside[:-1]) + 1
        self.first = np.concatenate((np.searchsorted(self.start, begin), [len(self.start)]))
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(texts)), self.counts)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and text of every run of ``size`` words inside one text."""
        n = len(self.start) - size + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.flatnonzero(self.doc[:n] == self.doc[size - 1 :])
        return at, self.doc[at]

    def prefix_hash(self) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.buf)
        power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, _BASE))))
        sums = np.concatenate(([np.uint64(0)], np.cumsum((self.buf.astype(np.uint64) + np.uint64(1)) * power[:n])))
        inverse = np.cumprod(np.concatenate(([np.uint64(1)], np.full(n, _BASE_INV))))
        return sums, inverse

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hash of byte ranges; equal bytes hash alike wherever they stand."""
        if not hasattr(self, "_prefix"):
            self._prefix = self.prefix_hash()
        sums, inverse = self._prefix
        h = (sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return h ^ (h >> np.uint64(32))


_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (
        11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261,
    )
)  # fixed values: the primes of XXH64


def _rotl(x: np.ndarray, r: int) -> np.ndarray:
    return (x << np.uint64(r)) | (x >> np.uint64(64 - r))


def _round(acc, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * _P2, 31) * _P1


def xxh64(buf: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of many byte ranges of ``buf``, which needs eight spare bytes at its end."""
    with np.errstate(over="ignore"):
        seed = np.uint64(seed)
        lane8 = np.ndarray((len(buf) - 7,), "<u8", buf.data, strides=(1,))
        lane4 = np.ndarray((len(buf) - 3,), "<u4", buf.data, strides=(1,))
        size = end - start
        h = np.full(len(start), seed + _P5)
        pos = start.copy()
        long = np.flatnonzero(size >= 32)
        if len(long):
            at, stop = start[long], end[long]
            v = [np.full(len(long), x) for x in (seed + _P1 + _P2, seed + _P2, seed, seed - _P1)]
            live = np.arange(len(long))
            while len(live):
                for k in range(4):
                    v[k][live] = _round(v[k][live], lane8[at[live] + 8 * k])
                at[live] += 32
                live = live[stop[live] - at[live] >= 32]
            g = _rotl(v[0], 1) + _rotl(v[1], 7) + _rotl(v[2], 12) + _rotl(v[3], 18)
            for x in v:
                g = (g ^ _round(np.uint64(0), x)) * _P1 + _P4
            h[long] = g
            pos[long] = at
        h += size.astype(np.uint64)
        for _ in range(3):
            live = np.flatnonzero(end - pos >= 8)
            if not len(live):
                break
            h[live] = _rotl(h[live] ^ _round(np.uint64(0), lane8[pos[live]]), 27) * _P1 + _P4
            pos[live] += 8
        live = np.flatnonzero(end - pos >= 4)
        h[live] = _rotl(h[live] ^ (lane4[pos[live]].astype(np.uint64) * _P1), 23) * _P2 + _P3
        pos[live] += 4
        for _ in range(3):
            live = np.flatnonzero(end > pos)
            h[live] = _rotl(h[live] ^ (buf[pos[live]].astype(np.uint64) * _P5), 11) * _P1
            pos[live] += 1
        h ^= h >> np.uint64(33)
        h *= _P2
        h ^= h >> np.uint64(29)
        h *= _P3
        return h ^ (h >> np.uint64(32))
