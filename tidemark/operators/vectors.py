"""Hashed and encoded embeddings, exact cosine search."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import WORD
from tidemark.functions.worker import once_per_worker, share, shared
from tidemark.operators.blocks import ID_TYPES, id_type, in_blocks

# Sizes of hashed and encoded vectors.
HASH_DIMENSIONS = 64
ENCODER_DIMENSIONS = 384

# Similarities are compared after rounding, so equal vectors tie wherever they are stored.
_DIGITS = 9
# Bytes of query vectors that one scan hands to every task; more queries take more scans.
QUERY_BYTES = 32 << 20
# similarities that a task holds at once
CELLS = 1 << 22


class _WordCodes(dict):
    """Twice the bucket of a word, plus one if its sign is negative; words met lately are kept."""

    def __init__(self, dimensions: int, most: int = 1 << 18):
        super().__init__()
        self.dimensions, self.most = dimensions, most

    def __missing__(self, word: str) -> int:
        digest = hashlib.sha256(word.encode()).digest()
        code = 2 * (int.from_bytes(digest[:4], "big") % self.dimensions) + digest[4] % 2
        if len(self) >= self.most:
            self.clear()
        if len(word) <= 64:
            self[word] = code
        return code


def _hashed_counts(dimensions: int) -> Callable[[Column], Column]:
    """Signed word counts per bucket of one lower-case text (see ``hash_bucket``, ``hash_sign``); zeros for null."""

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        code, find = _WordCodes(dimensions).__getitem__, re.compile(WORD).findall
        for texts in batches:
            cells = np.zeros((len(texts), dimensions), dtype="int64")
            for i, text in enumerate(texts):
                found = find(text.as_py() or "")
                if found:
                    signed = np.bincount(np.fromiter(map(code, found), np.int64, len(found)), minlength=2 * dimensions)
                    cells[i] = signed[::2] - signed[1::2]
            starts = np.arange(0, cells.size + 1, dimensions, dtype="int32")
            yield pa.ListArray.from_arrays(pa.array(starts), pa.array(cells.ravel()))

    return count


def hash_embed(
    rows: DataFrame, keys: Sequence[str], text_col: str = "text", dimensions: int = HASH_DIMENSIONS
) -> DataFrame:
    """``keys`` and ``embedding``: signed word counts per hash bucket at unit length.

    A text without words becomes the zero vector. A text is counted within its own row, so its words are never rows; the
    sums of rows with equal keys stand in one row per text, which combines on the map side and is all that is shuffled.
    """
    counted = rows.select(*keys, _hashed_counts(dimensions)(F.lower(F.col(text_col))).alias("c"))
    sums = [F.sum(F.col("c")[i]).alias(f"b{i}") for i in range(dimensions)]
    cells = counted.groupBy(*keys).agg(*sums).select(*keys, F.array(*[F.col(f"b{i}") for i in range(dimensions)]).alias("cells"))
    square = F.aggregate("cells", F.lit(0).cast("bigint"), lambda a, s: a + s * s)
    norm = F.when(square == 0, F.lit(1.0)).otherwise(F.sqrt(square.cast("double")))
    # handed over as an array, the norm is taken once per text; within a lambda it would be for every cell
    unit = F.zip_with("cells", F.array_repeat(norm, dimensions), lambda c, n: c / n)
    return cells.select(*keys, unit.alias("embedding"))


def index_text(rows: DataFrame) -> DataFrame:
    """Sections with the text that is embedded: title, line end, content."""
    return rows.withColumn("text", F.concat_ws("\n", "title", "content"))


def encode_texts(
    rows: DataFrame, text_col: str, load: Callable[[], Callable[[list[str]], np.ndarray]]
) -> DataFrame:
    """Add ``embedding`` from an injected batch encoder.

    ``load`` returns a function from a list of texts to a matrix; it runs once per
    Python worker. Vectors are brought to unit length.
    """
    kept = once_per_worker("encoder", load)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = kept()
        for texts in batches:
            matrix = np.asarray(encoder(texts.tolist()), dtype="float64")
            norms = np.linalg.norm(matrix, axis=1, keepdims=True)
            yield pd.Series(list(matrix / np.where(norms == 0, 1.0, norms)))

    return rows.withColumn("embedding", encode(F.col(text_col)))


class _Best:
    """The k best similarities and ids (rows of numbers) per query; equal values go to the smaller id.

    What can still enter is put aside for all queries at once and ranked when there is enough of it.
    """

    def __init__(self, queries: np.ndarray, k: int, width: int):
        norms = np.linalg.norm(queries, axis=1)
        self.matrix = (queries / np.where(norms == 0, 1.0, norms)[:, None]).T
        self.k = k
        # the k-th best of each query and the first number of its id; zero vectors take no part
        self.least = np.where(norms > 0, -np.inf, np.inf)
        self.least_id = np.full(len(norms), np.iinfo("int64").max)
        self.held = (np.empty(0, dtype="int64"), np.empty(0), np.empty((0, width), dtype="int64"))  # query, similarity, id
        self.new: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        norms = np.linalg.norm(vectors, axis=1)
        ids, vectors = ids[norms > 0], vectors[norms > 0] / norms[norms > 0][:, None]
        if not len(ids) or not self.matrix.shape[1]:
            return
        step = max(1, CELLS // self.matrix.shape[1])
        for lo in range(0, len(ids), step):
            self._add(ids[lo : lo + step], vectors[lo : lo + step] @ self.matrix)

    def _add(self, ids: np.ndarray, sims: np.ndarray) -> None:
        lowest = self.least - 10.0**-_DIGITS  # what may be rounded up to the k-th best
        if len(sims) > self.k and np.isneginf(lowest).any():
            lowest = np.maximum(lowest, np.partition(sims, -self.k, axis=0)[-self.k] - 10.0**-_DIGITS)
        row, q = np.divmod(np.flatnonzero(sims >= lowest), sims.shape[1])
        s = np.round(sims[row, q], _DIGITS)
        close = (s > self.least[q]) | ((s == self.least[q]) & (ids[row, 0] <= self.least_id[q]))
        if close.any():
            self.new.append((q[close], s[close], ids[row[close]]))
            self.waiting += len(self.new[-1][0])
            if self.waiting > 4 * self.k * len(self.least):
                self.settle()

    def settle(self) -> None:
        q, s, i = (np.concatenate(parts) for parts in zip(self.held, *self.new))
        order = np.lexsort((*i.T[::-1], -s, q))
        place = np.arange(len(order)) - np.searchsorted(q[order], q[order])
        last, kept = order[place == self.k - 1], order[place < self.k]
        self.least[q[last]], self.least_id[q[last]] = s[last], i[last, 0]
        self.held, self.new, self.waiting = (q[kept], s[kept], i[kept]), [], 0

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the query, similarity and id of all that is held, best first in each query."""
        if self.new:
            self.settle()
        return self.held

    def rows(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        q, s, i = self.found()
        for n in np.unique(q):
            yield n, s[q == n], i[q == n]


def _dense(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(len(column), -1)


def _scan(vectors: DataFrame, keys: Sequence[str], ids: list, kind: str, matrix: np.ndarray, k: int) -> DataFrame:
    """The best ``k`` per query that each task meets while it reads the vectors once."""
    block = share(vectors.sparkSession.sparkContext, (pa.array(ids, ID_TYPES[kind]), matrix))
    width = len(keys)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, queries = shared(block)
        best = _Best(queries, k, width)
        for batch in batches:
            if batch.num_rows:
                best.add(np.stack([batch.column(c).to_numpy() for c in range(width)], axis=1), _dense(batch.column(width)))
        q, s, i = best.found()
        columns = [qids.take(pa.array(q)), *[pa.array(i[:, c].copy()) for c in range(width)], pa.array(s)]
        yield pa.RecordBatch.from_arrays(columns, ["question_id", *keys, "similarity"])

    return vectors.mapInArrow(search, f"question_id {kind}, {', '.join(f'{c} bigint' for c in keys)}, similarity double")


def cosine_topk(
    vectors: DataFrame, queries: DataFrame, k: int = 3, keys: Sequence[str] = ("vec_id",), query_bytes: int = QUERY_BYTES
) -> DataFrame:
    """Exact top ``k`` of ``vectors(*keys, embedding)`` for ``queries(question_id, vector)``; ids are int, bigint or string.

    Every vector is compared, as in a scan without an index, but no pair is emitted: a
    task keeps the k best per query while it reads and only those are ranked at the
    end. Queries are handed to the tasks in blocks of at most ``query_bytes``, one scan
    per block, of which a task compares ``CELLS`` pairs at a time; vectors are never shuffled. Null and zero vectors
    take no part.
    """
    rows = vectors.select(*[F.col(c).cast("bigint").alias(c) for c in keys], "embedding").filter("embedding is not null")
    asked, kind = queries.select("question_id", "vector").filter("vector is not null"), id_type(queries)

    def answer(block: list[Row]) -> DataFrame:
        matrix = np.array([r["vector"] for r in block] or np.empty((0, 1)), dtype="float64")
        found = _scan(rows if block else rows.limit(0), keys, [r["question_id"] for r in block], kind, matrix, k)
        w = Window.partitionBy("question_id").orderBy(F.desc("similarity"), *keys)
        return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)

    return in_blocks(asked, lambda r: 8 * len(r["vector"]) + 64, query_bytes, answer, "cosine")
