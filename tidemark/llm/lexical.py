"""Ranked lexical search: term-at-a-time scoring with a limited number of accumulators.

Documents are scored for each query by the weights of its terms, saturated by their number in the document and damped by
its length, in whole numbers. The corpus is read once: each task turns its documents into blocks of an inverted index over
the terms that are asked for, and the blocks are written to the shared folder. Statistics of the corpus (documents,
terms, documents per term) are sums over all blocks. Then every block is searched by itself. The terms of a query are
taken rarest first. A document that first appears under a term can still gain the sum of the bounds (weight times the
highest impact in the block) of this and all later terms; once that sum is below the k-th best partial score no new
accumulator is opened, while the open ones are carried on exactly. A task also knows the k-th best score of its earlier
blocks, which serves as a bound as well. The best k of each block meet per query. Results are exact.

Scale: texts are not shuffled; what is written are postings of asked terms, what moves are k rows per query and block.
Queries go to the tasks in blocks of at most ``block_bytes`` of text (one query, if that is longer); each further block
is a pass of its own over the documents, so that driver and tasks hold one at a time. A posting block is bounded by its
documents and postings, not by a key: a term in every document is cut up by block like any other.

Edge cases: null and empty texts have no term, do not count as documents and are never found. Queries without terms,
and terms that no document holds, find nothing. Every row is a document or query of its own: repeated ids are ranked as
often as they occur. A null doc_id counts, is returned as null and stands behind all others of its score (as does the
id 2^63-1, which stands for it). Texts of any length are counted in pieces. Extra columns are ignored. Products stay
within 64 bits up to 75 * (terms of the longest document) * documents < 2^63; beyond it lengths are computed in
unbounded integers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.worker import share, shared
from tidemark.llm.common import byte_pieces, letters
from tidemark.session import scratch_dir

TOP = 10
BLOCK_BYTES = 8 << 20
BLOCK_DOCS = 1 << 14
BLOCK_POSTINGS = 1 << 20
NO_ID = np.iinfo(np.int64).max

INDEX = (
    "n_docs long, n_terms long, ids array<long>, sizes array<long>, terms array<int>, counts array<int>, "
    "docs array<int>, tfs array<long>"
)
FOUND = "query int, doc_id long, score long"


class _Block:
    """Postings of some documents: ``terms`` with ``counts`` documents each, their ``docs`` and ``tfs`` in that order."""

    def __init__(self):
        self.n_docs = self.n_terms = 0
        self.ids, self.sizes, self.term, self.doc, self.tf = [], [], [], [], []

    def add(self, doc_id, size: int, found: Counter) -> None:
        self.n_docs += 1
        self.n_terms += size
        if found:
            self.term.extend(found)
            self.tf.extend(found.values())
            self.doc.extend([len(self.ids)] * len(found))
            self.ids.append(NO_ID if doc_id is None else doc_id)
            self.sizes.append(size)

    def full(self) -> bool:
        return len(self.ids) >= BLOCK_DOCS or len(self.term) >= BLOCK_POSTINGS

    def row(self) -> pa.RecordBatch:
        term = np.array(self.term, np.int32)
        order = np.argsort(term, kind="stable")
        terms, counts = np.unique(term, return_counts=True)
        lists = {
            "ids": np.array(self.ids, np.int64), "sizes": np.array(self.sizes, np.int64),
            "terms": terms.astype(np.int32), "counts": counts.astype(np.int32),
            "docs": np.array(self.doc, np.int32)[order], "tfs": np.array(self.tf, np.int64)[order],
        }
        columns = {"n_docs": pa.array([self.n_docs], pa.int64()), "n_terms": pa.array([self.n_terms], pa.int64())}
        for name, values in lists.items():
            columns[name] = pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))
        return pa.RecordBatch.from_pydict(columns)


def index(documents: DataFrame, vocabulary) -> DataFrame:
    """Blocks of postings of the terms in ``vocabulary``, a broadcast list of distinct terms as bytes."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(vocabulary.value)}
        asked, block = number.__contains__, _Block()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                size, found = 0, Counter()
                for piece in byte_pieces(letters(text.as_py())):
                    words = piece.split()
                    size += len(words)
                    found.update(filter(asked, words))
                if size:
                    block.add(doc_id, size, {number[t]: n for t, n in found.items()})
                if block.full():
                    yield block.row()
                    block = _Block()
        yield block.row()

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(build, INDEX)


@dataclass
class Queries:
    """A block of queries: terms with their number of repeats, rarest first, and the weights of all terms."""

    terms: list[list[tuple[int, int]]]
    weight: np.ndarray
    n_docs: int
    n_terms: int


def _weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def _impacts(tf: np.ndarray, size: np.ndarray, doc: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    if 75 * int(size.max()) * n_docs >= 1 << 63:
        relative = np.array([75 * int(s) * n_docs // n_terms for s in size], np.int64)
    else:
        relative = 75 * size * n_docs // n_terms
    damp = 100 - 75 + relative
    return 1_000_000_000 * tf // (1000 * tf + 8 * damp[doc])


def accumulate(parts: list[tuple[np.ndarray, np.ndarray, int]], n_docs: int, k: int, floor: int = 0):
    """Documents that can be among the best ``k``, and their exact scores.

    ``parts`` are (documents, gains, highest gain) per term. ``floor`` is a score that k other documents reach.
    """
    score, open_ = np.zeros(n_docs, np.int64), np.zeros(n_docs, bool)
    rest = sum(top for _, _, top in parts)
    opening = True
    for docs, gains, top in parts:
        if opening and rest < floor:
            opening = False
        if opening and rest <= (best := int(score.max(initial=0))) and best:
            held = score[open_]
            if len(held) >= k and rest < np.partition(held, len(held) - k)[len(held) - k]:
                opening = False
        if opening:
            score[docs] += gains
            open_[docs] = True
        else:
            kept = open_[docs]
            score[docs[kept]] += gains[kept]
        rest -= top
    at = np.flatnonzero(open_ & (score > 0))
    return at, score[at]


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, equal ones by id."""
    if len(scores) > k:
        among = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        among = np.arange(len(scores))
    return among[np.lexsort((ids[among], -scores[among]))][:k]


def _search(blocks: DataFrame, asked, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q: Queries = shared(asked)
        best = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in q.terms]
        for batch in batches:
            for r in range(batch.num_rows):
                ids, sizes, terms, counts, docs, tfs = (
                    batch.column(c)[r].values.to_numpy(zero_copy_only=False) for c in range(2, 8)
                )
                if not len(ids):
                    continue
                impact = _impacts(tfs, sizes, docs, q.n_docs, q.n_terms)
                ends = np.cumsum(counts, dtype=np.int64)
                place = {int(t): (int(e - c), int(e)) for t, c, e in zip(terms, counts, ends)}
                tops = dict(zip(terms.tolist(), np.maximum.reduceat(impact, ends - counts).tolist()))
                for i, wanted in enumerate(q.terms):
                    parts = []
                    for t, n in wanted:
                        if t in place:
                            a, b = place[t]
                            factor = n * int(q.weight[t])
                            parts.append((docs[a:b], factor * impact[a:b], factor * tops[t]))
                    if not parts:
                        continue
                    old_ids, old = best[i]
                    at, score = accumulate(parts, len(ids), k, int(old[-1]) if len(old) == k else 0)
                    all_ids, all_ = np.concatenate((old_ids, ids[at])), np.concatenate((old, score))
                    top = _best(all_ids, all_, k)
                    best[i] = (all_ids[top], all_[top])
        number = np.repeat(np.arange(len(best), dtype=np.int32), [len(s) for _, s in best])
        ids = np.concatenate([i for i, _ in best]) if best else np.empty(0, np.int64)
        scores = np.concatenate([s for _, s in best]) if best else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(number, pa.int32()), pa.array(ids, pa.int64(), mask=ids == NO_ID), pa.array(scores, pa.int64())],
            ["query", "doc_id", "score"],
        )

    return blocks.mapInArrow(run, FOUND)


def _query_blocks(queries: DataFrame, key: str, block_bytes: int) -> Iterator[list[tuple[object, bytes]]]:
    held, size = [], 0
    for row in queries.select(F.col(key).alias("key"), "text").toLocalIterator():
        terms = letters(row["text"])
        if not terms:
            continue
        if held and size + len(terms) > block_bytes:
            yield held
            held, size = [], 0
        held.append((row["key"], terms))
        size += len(terms)
    if held:
        yield held


def _one_block(documents: DataFrame, held: list[tuple[object, bytes]], k: int, path: str) -> DataFrame:
    spark = documents.sparkSession
    sc = spark.sparkContext
    counted = [Counter(text.split()) for _, text in held]
    vocabulary = sorted(set().union(*counted))
    number = {t: i for i, t in enumerate(vocabulary)}
    known = sc.broadcast(vocabulary)
    index(documents, known).write.parquet(path)
    known.unpersist()
    blocks = spark.read.schema(INDEX).parquet(path)
    total = blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    df = np.zeros(len(vocabulary), np.int64)
    pairs = blocks.select(F.explode(F.arrays_zip("terms", "counts")).alias("p"))
    for row in pairs.groupBy("p.terms").agg(F.sum("p.counts").alias("df")).collect():  # one row a term that is asked for
        df[row["terms"]] = row["df"]
    rarest = [sorted(((number[t], n) for t, n in c.items()), key=lambda p: (df[p[0]], p[0])) for c in counted]
    asked = share(sc, Queries(rarest, _weights(df, total[0] or 0), total[0] or 0, total[1] or 0))
    return _search(blocks, asked, k)


def search(documents: DataFrame, queries: DataFrame, key: str = "item_id", k: int = TOP,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``k`` best documents of every query: its ``key``, ``rank`` from 1, ``doc_id`` and ``score``."""
    spark = documents.sparkSession
    kind = queries.schema[key].dataType
    found = T.StructType([T.StructField("query", T.IntegerType()), T.StructField(key, kind),
                          T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
    path = scratch_dir(spark, "ranked")
    spark.createDataFrame([], found).write.parquet(f"{path}/block=-1")
    for b, held in enumerate(_query_blocks(queries, key, block_bytes)):
        names = spark.createDataFrame(
            list(enumerate(name for name, _ in held)), T.StructType([found["query"], found[key]])
        )
        hits = _one_block(documents, held, k, scratch_dir(spark, "postings"))
        hits.join(names, "query").select(*found.names).write.parquet(f"{path}/block={b}")
    rows = spark.read.schema(T.StructType([*found.fields, T.StructField("block", T.IntegerType())])).parquet(path)
    order = Window.partitionBy("block", "query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(key, "rank", "doc_id", "score")
