"""The pipeline and the registered queries on the smallest tables."""

import collections
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import brute_components, brute_contamination
from tidemark.llm import simhash
from tidemark.llm.common import plain, read
from tidemark.llm.queries import ORACLE, QUERIES
from tools.check import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = read(spark, SF, "documents"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def rows_of(df):
    return collections.Counter(map(tuple, df.collect()))


def test_stages_filter_rows_and_keep_columns(spark, stages):
    before = read(spark, SF, "documents")
    for after in stages[:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes
        assert not rows_of(after) - rows_of(before) and 0 < after.count() <= before.count()
        before = after


def test_near_duplicates_leave_one_each(stages):
    rows = [(r.doc_id, r.text) for r in stages[1].collect()]
    lanes = simhash._fingerprints([plain(t) for _, t in rows], 5, 3).astype(np.uint64)
    prints = [(i, sum(int(x) << 64 * k for k, x in enumerate(v))) for (i, _), v in zip(rows, lanes)]
    want = {c for _, _, c in brute_components(prints, simhash.WIDE_BITS)}
    left = {r.doc_id for r in stages[2].collect()}
    # a pair may meet in no table: such a document stays, none goes without a link
    assert want <= left and len(left - want) <= 0.02 * len(rows)


def shingles(text):
    words = text.split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


@pytest.mark.parametrize("least, most, recall", [(0.8, 0.85, 0.85), (0.85, 0.9, 0.95), (0.9, 1.0, 0.99)])
def test_planted_near_copies_are_found(spark, least, most, recall):
    rnd = random.Random(int(100 * least))
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randrange(3, 9)))
    rows, planted = [], 0
    while planted < 150:
        base = [word() for _ in range(rnd.randrange(150, 600))]
        copy = [word() if rnd.random() < (1 - least) / 7 else w for w in base]
        x, y = shingles(" ".join(base)), shingles(" ".join(copy))
        if least <= len(x & y) / len(x | y) < most:
            rows += [(2 * planted, " ".join(base)), (2 * planted + 1, " ".join(copy))]
            planted += 1
    rows += [(1000 + k, " ".join(word() for _ in range(200))) for k in range(150)]
    left = {r.doc_id for r in simhash.keep_one_similar(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert left >= {i for i, _ in rows if i % 2 == 0 or i >= 1000}
    assert sum(2 * k + 1 not in left for k in range(planted)) >= recall * planted


def test_near_copies_of_odd_documents(spark):
    rows = [(3, None), (1, ""), (2, " "), (None, "a b"), (7, "a b"), (7, "a b"), (8, "x y z"), (9, "X y  z")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit(1)).withColumn("lanes", F.lit(2))
    left = [(r.doc_id, r.text) for r in simhash.keep_one_similar(df).collect()]
    assert sorted(left) == [(1, ""), (7, "a b"), (8, "x y z")]
    assert simhash.keep_one_similar(df).columns == df.columns
    assert simhash.keep_one_similar(df.limit(0)).count() == 0


def test_no_benchmark_passage_is_left(spark, stages):
    items = [(r.item_id, r.text) for r in read(spark, SF, "benchmark").collect()]
    bad = {r.doc_id for r in stages[2].collect() if brute_contamination(r.text, items)[1]}
    left = {r.doc_id for r in stages[3].collect()}
    assert left == {r.doc_id for r in stages[2].collect()} - bad


def test_last_stage_packs_what_is_left(stages):
    pieces = stages[4].collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in stages[3].collect()}
    assert sum(r.length for r in pieces) == sum({r.doc_id: r.doc_tokens for r in pieces}.values())


def test_stages_take_empty_tables(spark):
    docs = read(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_run_equals_the_stages(spark, stages):
    drop = lambda df: rows_of(df.select("doc_id", "doc_tokens").distinct())
    assert drop(corpus_pipeline.run(spark, SF)) == drop(stages[4])


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    ok, _, _, note = compare(spark, duck(SF), name, SF)
    assert ok, note


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - {"op13_nearest_neighbours"}))
def test_one_row_per_document(spark, name):
    table = "pages" if name.startswith("op3") else "documents"
    key = "page_id" if table == "pages" else "doc_id"
    got = {r[key] for r in QUERIES[name](spark, SF).collect()}
    assert got == {r[key] for r in read(spark, SF, table).collect()}


def test_every_query_vector_finds_five(spark):
    got = collections.Counter(r.query_id for r in QUERIES["op13_nearest_neighbours"](spark, SF).collect())
    ids = {r.vec_id for r in read(spark, SF, "embeddings").collect() if r.vec_id % 50 == 0}
    assert got == dict.fromkeys(ids, 5)


def test_held_out_flags(spark):
    for name, parts, rest in (("op6_language_id", 4, 2), ("op9_toxicity", 3, 1)):
        for r in QUERIES[name](spark, SF).collect():
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == rest)
