"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation flips signs and applies a fast Hadamard transform, three times over; a unit vector is assigned to the
signed axis nearest to its rotation. ``CODES`` rotations make one bucket of a table, and there are ``TABLES`` of them. A
query looks up its own bucket and the next likely ones in each table (``PROBES`` in all), ordered by how far the axes fall
short of the nearest. All vectors met in any table are candidates, whose cosine with the query is then taken in double
precision from the original vectors.

Scale: the queries are a stated set. They go to the tasks in blocks of at most ``BLOCK_BYTES`` of vectors and probes, as
tables sorted by bucket (three times as large), and every task hashes the rows it reads and looks their buckets up there. Vectors are not
shuffled and no pair leaves a task: what moves are k rows per query and task. So a bucket or a group of copies that holds
a third of all rows is spread like the rows themselves, and nothing is capped. Each further block of queries is a pass of
its own. A query that met fewer than k candidates is compared with all rows in one more pass. Two codes a table suit up to
some 10^6 vectors; with more rows take three or four and more tables, so that a bucket stays small.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows without an
id, nor vectors whose number of components is not the most frequent one (of equally frequent numbers the smallest). Rows
with the id of the query are never its neighbours. Every other row is a candidate of its own: repeated rows are returned
as often as they occur, copies tie and go by id. Of several queries with one id the smallest vector is asked. Components
of any finite size are scaled by powers of two first, which is exact. Empty tables give no rows; extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.worker import share, shared
from tidemark.session import materialise, scratch_dir

TOP = 5
TABLES = 32
CODES = 2
PROBES = 160
SEED = 42
BLOCK_BYTES = 16 << 20
ROWS = 2048
PAIRS = 1 << 15
FOUND = "query_id long, vec_id long, score double"


@dataclass(frozen=True)
class Rotations:
    """Signs of the pseudo-rotations: tables x codes x 3 x padded dimension."""

    dim: int
    signs: np.ndarray

    @staticmethod
    def make(dim: int, tables: int = TABLES, codes: int = CODES, seed: int = SEED) -> Rotations:
        width = 1 << max(dim - 1, 0).bit_length()
        drawn = np.random.default_rng(seed).integers(0, 2, (tables, codes, 3, width))
        return Rotations(dim, (2 * drawn - 1).astype(np.float32))

    @property
    def axes(self) -> int:
        return 2 * self.signs.shape[-1]

    @property
    def bucket_type(self) -> str:
        return "<u2" if self.axes ** self.signs.shape[1] <= 1 << 16 else "<i8"

    def rotate(self, units: np.ndarray, table: int, code: int) -> np.ndarray:
        width = self.signs.shape[-1]
        x = np.zeros((len(units), width), np.float32)
        x[:, : self.dim] = units
        for signs in self.signs[table, code]:
            x = hadamard(x * signs)
        return x

    def buckets(self, units: np.ndarray) -> np.ndarray:
        """Bucket of each vector in each table."""
        tables, codes = self.signs.shape[:2]
        out = np.zeros((len(units), tables), np.int64)
        for t in range(tables):
            for c in range(codes):
                x = self.rotate(units, t, c)
                axis = np.abs(x).argmax(axis=1)
                sign = np.take_along_axis(x, axis[:, None], 1)[:, 0] < 0
                out[:, t] = out[:, t] * self.axes + 2 * axis + sign
        return out.astype(self.bucket_type)

    def probes(self, units: np.ndarray, count: int) -> np.ndarray:
        """The ``count`` likeliest buckets of each vector in each table, likeliest first."""
        tables, codes = self.signs.shape[:2]
        count = min(count, self.axes**codes)
        out = np.zeros((len(units), tables, count), np.int64)
        for t in range(tables):
            lack, bucket = np.zeros((len(units), 1), np.float32), np.zeros((len(units), 1), np.int64)
            for c in range(codes):
                x = self.rotate(units, t, c)
                ahead = np.stack((x, -x), axis=2).reshape(len(x), -1)
                short = (ahead.max(axis=1, keepdims=True) - ahead) ** 2
                near = np.argsort(short, axis=1, kind="stable")[:, :count]
                # both lists ascend: the i-th with the j-th comes behind (i + 1) * (j + 1) - 1 other pairs
                i, j = np.divmod(np.arange(lack.shape[1] * near.shape[1]), near.shape[1])
                i, j = (v[(i + 1) * (j + 1) <= count] for v in (i, j))
                lack = lack[:, i] + np.take_along_axis(short, near, 1)[:, j]
                bucket = bucket[:, i] * self.axes + near[:, j]
                best = np.argsort(lack, axis=1, kind="stable")[:, :count]
                lack, bucket = np.take_along_axis(lack, best, 1), np.take_along_axis(bucket, best, 1)
            out[:, t] = bucket
        return out.astype(self.bucket_type)


def hadamard(x: np.ndarray) -> np.ndarray:
    """Orthonormal Walsh-Hadamard transform of each row; the row length is a power of two."""
    n, width = x.shape
    half = 1
    while half < width:
        x = x.reshape(n, width // (2 * half), 2, half)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2)
        half *= 2
    return x.reshape(n, width) / np.float32(math.sqrt(width))


def scaled(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors times a power of two, so that the largest component is near one, and their lengths."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, initial=0))
    vectors = np.ldexp(vectors, -exponent[:, None])
    return vectors, np.sqrt(np.einsum("ij,ij->i", vectors, vectors))


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def usable(vector: Column) -> Column:
    def fine(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    return F.coalesce(F.forall(vector, fine) & F.exists(vector, lambda x: x != 0), F.lit(False))


@dataclass
class Block:
    """Queries of one pass; ``tables`` hold sorted buckets with the query that probes each."""

    ids: np.ndarray
    vectors: np.ndarray
    norms: np.ndarray
    rotations: Rotations
    tables: list[tuple[np.ndarray, np.ndarray]] | None  # None: compare with all rows

    @staticmethod
    def of(rows: list, rotations: Rotations, exact: bool) -> Block:
        ids = np.array([r["query_id"] for r in rows], np.int64)
        vectors, norms = scaled(np.array([r["vector"] for r in rows], np.float64))
        if exact:
            return Block(ids, vectors, norms, rotations, None)
        probes = np.stack([np.frombuffer(r["probes"], rotations.bucket_type) for r in rows]).reshape(len(rows), len(rotations.signs), -1)
        tables = []
        for t in range(len(rotations.signs)):
            flat = probes[:, t].ravel()
            order = np.argsort(flat, kind="stable")
            tables.append((flat[order], (order // probes.shape[2]).astype(np.int32)))
        return Block(ids, vectors, norms, rotations, tables)

    def candidates(self, vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Queries x rows: whether they meet in any table."""
        if self.tables is None:
            return np.ones((len(self.ids), len(vectors)), bool)
        met = np.zeros((len(self.ids), len(vectors)), bool)
        own = self.rotations.buckets(vectors / norms[:, None])
        for t, (bucket, query) in enumerate(self.tables):
            first = np.searchsorted(bucket, own[:, t], "left")
            count = np.searchsorted(bucket, own[:, t], "right") - first
            row = np.repeat(np.arange(len(own)), count)
            place = np.arange(len(row)) + np.repeat(first - (np.cumsum(count) - count), count)
            met[query[place], row] = True
        return met


def _ranked(q: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int):
    """The ``k`` best of each query, equal scores by id."""
    order = np.lexsort((ids, -score, q))
    q, ids, score = q[order], ids[order], score[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q, "left")
    top = rank < k
    return q[top], ids[top], score[top]


def _scan(vectors: DataFrame, block, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b: Block = shared(block)
        best = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float64))
        bar = np.full(len(b.ids), -np.inf)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                x, norms = scaled(_matrix(part.column(1), b.rotations.dim))
                query, row = np.nonzero(b.candidates(x, norms))
                for lo in range(0, len(query), PAIRS):
                    q, r = query[lo : lo + PAIRS], row[lo : lo + PAIRS]
                    score = np.einsum("ij,ij->i", b.vectors[q], x[r]) / (b.norms[q] * norms[r])
                    good = (score >= bar[q]) & (ids[r] != b.ids[q])
                    q, r, score = q[good], r[good], score[good]
                    best = _ranked(*(np.concatenate(p) for p in zip(best, (q, ids[r], score))), k)
                    full = np.bincount(best[0], minlength=len(b.ids)) >= k
                    low = np.full(len(b.ids), np.inf)
                    np.minimum.at(low, best[0], best[2])
                    bar[full] = low[full]
        yield pa.RecordBatch.from_arrays(
            [pa.array(b.ids[best[0]], pa.int64()), pa.array(best[1], pa.int64()), pa.array(best[2], pa.float64())],
            ["query_id", "vec_id", "score"],
        )

    return vectors.mapInArrow(run, FOUND)


def _with_probes(queries: DataFrame, rotations: Rotations, count: int) -> DataFrame:
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                x, norms = scaled(_matrix(part.column(1), rotations.dim))
                found = rotations.probes(x / norms[:, None], count)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([p.tobytes() for p in found], pa.binary())],
                    ["query_id", "vector", "probes"],
                )

    return queries.mapInArrow(probe, "query_id long, vector array<double>, probes binary")


def _blocks(queries: DataFrame, rotations: Rotations, exact: bool, block_bytes: int) -> Iterator:
    sc = queries.sparkSession.sparkContext
    held, size = [], 0
    for row in queries.toLocalIterator():
        one = 8 * rotations.dim + (0 if exact else len(row["probes"]))
        if held and size + one > block_bytes:
            yield share(sc, Block.of(held, rotations, exact))
            held, size = [], 0
        held.append(row)
        size += one
    if held:
        yield share(sc, Block.of(held, rotations, exact))


def _passes(vectors: DataFrame, queries: DataFrame, rotations: Rotations, k: int, exact: bool, block_bytes: int,
            path: str) -> None:
    for n, block in enumerate(_blocks(queries, rotations, exact, block_bytes)):
        _scan(vectors, block, k).write.parquet(f"{path}/exact={int(exact)}/block={n}")
        block.unpersist()


def search(vectors: DataFrame, queries: DataFrame, k: int = TOP, *, key: str = "vec_id", vector: str = "embedding",
           tables: int = TABLES, codes: int = CODES, probes: int = PROBES, seed: int = SEED,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` (cosine) of the ``k`` nearest found for every query.

    Both frames have the columns ``key`` and ``vector``.
    """
    spark = vectors.sparkSession
    path = scratch_dir(spark, "neighbours")
    spark.createDataFrame([], FOUND).write.parquet(f"{path}/exact=0/block=-1")

    def clean(df, name):
        df = df.select(F.col(key).cast("long").alias(name), F.col(vector).cast("array<double>").alias("vector"))
        return df.filter(F.col(name).isNotNull() & usable(F.col("vector")))

    rows = clean(vectors, "vec_id")
    sizes = rows.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if sizes is not None:
        of_dim = F.size("vector") == sizes["dim"]
        rotations = Rotations.make(sizes["dim"], tables, codes, seed)
        rows = rows.filter(of_dim)
        asked = clean(queries, "query_id").filter(of_dim).groupBy("query_id").agg(F.min("vector").alias("vector"))
        asked = materialise(_with_probes(asked, rotations, probes), "probes")
        _passes(rows, asked, rotations, k, False, block_bytes, path)
        found = spark.read.schema(FOUND).parquet(f"{path}/exact=0").groupBy("query_id").count()
        short = asked.join(found.filter(F.col("count") >= k), "query_id", "left_anti").drop("probes")
        _passes(rows, short, rotations, k, True, block_bytes, path)
    every = spark.read.schema(f"{FOUND}, exact int, block int").parquet(path)
    # what a query found in the first pass is found again where it had to be compared with all rows
    order = Window.partitionBy("query_id", "exact").orderBy(F.desc("score"), "vec_id")
    ranked = every.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    final = ranked.withColumn("last", F.max("exact").over(Window.partitionBy("query_id"))).filter("exact = last")
    return final.select("query_id", "rank", "vec_id", "score")
