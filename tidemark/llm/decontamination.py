"""Benchmark decontamination by a broadcast hash set of test n-grams.

Benchmark texts become windows of ten normalised words; an item of fewer words is one window. Their hashes are
broadcast with the words themselves. Every document is scanned once: the hash of each window of its words is looked up,
a hit is verified by comparing the bytes, and all words of a verified window are marked. Documents are not shuffled.

Broadcast bound: a block of at most ``block_bytes`` of normalised benchmark text (one item, if that is longer) with four
numbers a window. A larger benchmark is cut into blocks of items. Each further block is a pass of its own over the rows
and their marks so far, written to the shared folder, so that driver and tasks hold one block at a time; nothing is left
out.

Edge cases: null and empty texts have no word and no hit; benchmark items without words match nothing. Items with a
null id mark words but are not listed. Repeated items count once by id. Other columns are ignored or kept untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.worker import share, shared
from tidemark.llm.common import Words, chunks, letters
from tidemark.session import materialise

WINDOW = 10
BLOCK_BYTES = 32 << 20
FOUND = "n_words long, n_hit long, items array<string>, spans array<struct<first:long,last:long>>"


@dataclass
class NGrams:
    """Windows of a block of items: per window length the sorted hashes, item numbers and places of the words in ``raw``."""

    ids: list[str | None]
    raw: bytes = b""
    tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)

    @staticmethod
    def of(items: list[tuple[str | None, bytes]], window: int) -> NGrams:
        w = Words([t for _, t in items])
        out = NGrams([i for i, _ in items], w.raw)
        short = {int(n) for n in w.counts if 0 < n < window}
        for size in sorted(short | {window}):
            at, doc = w.windows(size)
            keep = np.ones(len(at), bool) if size == window else w.counts[doc] == size
            at, doc = at[keep], doc[keep]
            if len(at):
                start, end = w.start[at], w.end[at + size - 1]
                h = w.hashes(start, end)
                order = np.argsort(h, kind="stable")
                out.tables[size] = (h[order], doc[order], start[order], end[order])
        return out

    def scan(self, texts: list[bytes]):
        """Per text: number of words, marks of hit words, numbers of matching items."""
        w = Words(texts)
        marks = np.zeros(len(w.start) + 1, np.int64)
        items: list[set[int]] = [set() for _ in texts]
        for size, (known, owner, start, end) in self.tables.items():
            at, doc = w.windows(size)
            if not len(at):
                continue
            h = w.hashes(w.start[at], w.end[at + size - 1])
            lo, hi = np.searchsorted(known, h, "left"), np.searchsorted(known, h, "right")
            for k in np.flatnonzero(hi > lo):
                a = at[k]
                text = w.raw[w.start[a] : w.end[a + size - 1]]
                same = [owner[j] for j in range(lo[k], hi[k]) if self.raw[start[j] : end[j]] == text]
                if same:
                    items[doc[k]].update(same)
                    marks[a] += 1
                    marks[a + size] -= 1
        hit = np.cumsum(marks[:-1]) > 0
        for d in range(len(texts)):
            yield int(w.counts[d]), hit[w.first[d] : w.first[d + 1]], items[d]


def _spans(hit: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return [{"first": int(a), "last": int(b - 1)} for a, b in zip(edge[::2], edge[1::2])]


def blocks(benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> Iterator:
    """Broadcast blocks of windows, one at a time; at least one, which may be empty."""
    sc = benchmark.sparkSession.sparkContext
    rows = benchmark.select(F.col("item_id").cast("string").alias("id"), "text").toLocalIterator()
    held, size, some = [], 0, False
    for row in rows:
        words = letters(row["text"])
        if not words:
            continue
        if held and size + len(words) > block_bytes:
            yield share(sc, NGrams.of(held, window))
            held, size, some = [], 0, True
        held.append((row["id"], words))
        size += len(words)
    if held or not some:
        yield share(sc, NGrams.of(held, window))


def matches(text: Column, block, before: Column | None = None) -> Column:
    """Struct of ``n_words``, ``n_hit``, ``items`` (ids as text, sorted, distinct) and word ``spans`` that are hit.

    ``before``: what earlier blocks found, which is united with the hits of this one.
    """

    def rows(texts: pd.Series, earlier) -> pd.DataFrame:
        known, out = shared(block), []
        for part in chunks(texts, letters):
            for n, hit, items in known.scan(part):
                spans, ids = earlier[len(out)] if earlier else ((), ())
                for s in spans:
                    hit[s["first"] : s["last"] + 1] = True
                ids = sorted({i for k in items if (i := known.ids[k]) is not None}.union(ids))
                out.append((n, int(hit.sum()), ids, _spans(hit)))
        return pd.DataFrame(out, columns=["n_words", "n_hit", "items", "spans"])

    @F.pandas_udf(FOUND)
    def scan(texts: pd.Series) -> pd.DataFrame:
        return rows(texts, None)

    @F.pandas_udf(FOUND)
    def scan_on(texts: pd.Series, spans: pd.Series, ids: pd.Series) -> pd.DataFrame:
        return rows(texts, list(zip(spans, ids)))

    return scan(text) if before is None else scan_on(text, before["spans"], before["items"])


def matched(documents: DataFrame, keep: Column, benchmark: DataFrame, window: int = WINDOW,
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``keep``, ``text`` and ``_m``, the matches with the whole benchmark."""
    found, last = documents.select(keep, "text"), None
    for block in blocks(benchmark, window, block_bytes):
        if last is not None:
            found = materialise(found, "matches")
            last.unpersist()
        found = found.withColumn("_m", matches(F.col("text"), block, None if last is None else F.col("_m")))
        last = block
    return found


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_hit``, ``items``, ``spans`` and ``contaminated`` per document."""
    found = matched(documents, F.col("doc_id"), benchmark, window, block_bytes)
    return found.select("doc_id", "_m.*", (F.col("_m.n_hit") > 0).alias("contaminated"))


def keep_uncontaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                        block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents without any benchmark window, with their columns as they came."""
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row")
    found = matched(documents, row, benchmark, window, block_bytes)
    return found.filter(F.col("_m.n_hit") == 0).select("_row.*")


def remove_spans(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, gap: str = "\n",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents with hit words, and what stands between them, cut out of ``text``; other columns as they came."""
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        import re

        word = re.compile(pattern)
        out = []
        for text, hit in zip(texts, spans):
            if text is not None and len(hit):
                ends = [m.span() for m in word.finditer(text)]
                parts, at = [], 0
                for s in hit:
                    parts.append(text[at : ends[s["first"]][0]])
                    at = ends[s["last"]][1]
                text = gap.join([*parts, text[at:]])
            out.append(text)
        return pd.Series(out, dtype=object)

    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns if c != "text"]).alias("_row")
    marked = matched(documents, row, benchmark, window, block_bytes)
    cleaned = marked.select("_row.*", cut("text", "_m.spans").alias("text"))
    return cleaned.select(*[F.col(f"`{c}`") for c in documents.columns])


def items_digest(items: Column) -> Column:
    return F.sha2(F.array_join(items, ","), 256)
