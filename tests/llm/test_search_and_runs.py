"""Lexical search, periodic runs and nearest neighbours against brute force on small and odd inputs."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import CLASHES, DOC, LETTER_WORD, SPACE_WORD, odd_texts, sentence, words_of
from tidemark.llm import lexical, neighbours, periodic, queries


@pytest.fixture(scope="module")
def documents(spark):
    rows = [(i, t, "en", "s", None) for i, t in enumerate(odd_texts())]
    rows += [(3, "one", "en", "s", 3), (None, "a b c d", "de", None, None), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, DOC)
    return df.select("*", *[F.lit("clash").alias(c) for c in (*CLASHES, "rank", "query", "runs", "best")]).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOC)


# -- op 11


def brute_search(docs, items, k=10):
    held = [(i, words_of(t, LETTER_WORD)) for i, t in docs]
    held = [(i, w, collections.Counter(w)) for i, w in held if w]
    n_docs, n_terms = len(held), sum(len(w) for _, w, _ in held)
    df = collections.Counter(t for _, _, c in held for t in c)
    out = []
    for item, text in items:
        terms = collections.Counter(words_of(text, LETTER_WORD))
        scored = []
        for doc, w, c in held:
            m = 25 + 75 * len(w) * n_docs // n_terms
            s = 0
            for t, n in terms.items():
                if c[t]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    s += n * weight * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if s > 0:
                scored.append((-s, doc is None, doc or 0))
        scored.sort()
        out += [(item, r + 1, None if null else d, -s) for r, (s, null, d) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def found_rows(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


ITEMS = [
    (1, "the MIT license applies"), (2, None), (3, ""), (4, "zzz nowhere"), (5, "x x x one two"), (None, "a b c d"),
    (1, "a b"), (7, "é ü 漢字 I'll"), (8, "one " * 50),
]


def test_search_equals_brute_force(spark, documents):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("doc_id", F.lit(9))
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    assert found_rows(lexical.search(documents, items)) == brute_search(docs, ITEMS)
    # one query a block, and a k beyond the number of documents
    got = found_rows(lexical.search(documents, items, k=50, block_bytes=1))
    assert got == brute_search(docs, ITEMS, 50)


def test_search_over_many_blocks_with_ties(spark, monkeypatch):
    monkeypatch.setattr(lexical, "BLOCK_DOCS", 7)
    rnd = random.Random(3)
    docs = []
    for i in range(400):
        text = " ".join(f"w{min(int(rnd.expovariate(0.3)), 30)}" for _ in range(rnd.randrange(1, 40)))
        docs += [(i, text)] * rnd.choice([1, 1, 1, 5])
    items = [(j, " ".join(f"w{rnd.randrange(31)}" for _ in range(rnd.randrange(1, 9)))) for j in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = found_rows(lexical.search(df, spark.createDataFrame(items, "item_id long, text string")))
    assert got == brute_search(docs, items)


def test_accumulators_stop_and_survivors_stay_exact():
    rnd = np.random.default_rng(1)
    stopped = 0
    for _ in range(200):
        parts = []
        for term in range(6):
            docs = np.flatnonzero(rnd.random(60) < 0.05 * (term + 1) ** 1.5)
            gains = rnd.integers(1, 1000 // (term + 1) ** 2 + 2, len(docs))
            if len(docs):
                parts.append((docs, gains, int(gains.max())))
        full = np.zeros(60, np.int64)
        for docs, gains, _ in parts:
            full[docs] += gains
        at, score = lexical.accumulate(parts, 60, 3)
        assert (full[at] == score).all()
        stopped += len(at) < (full > 0).sum()
        kth = np.sort(full)[-3]
        assert set(np.flatnonzero((full >= kth) & (full > 0))) <= set(at.tolist())
    assert stopped > 50


def test_search_of_and_in_nothing(spark, documents, empty):
    none = spark.createDataFrame([], "item_id string, text string")
    some = spark.createDataFrame([("i", "one")], "item_id string, text string")
    assert lexical.search(documents, none).collect() == []
    assert lexical.search(empty, some).collect() == []
    assert lexical.search(empty, none).dtypes[0] == ("item_id", "string")
    assert lexical.search(documents, some).count() == 3  # with the text of repeated lines


# -- op 12


def brute_runs(words):
    x, seen, out = np.array(words), set(), []
    for q in range(1, len(words) // 3 + 1):
        equal = np.concatenate(([False], x[q:] == x[:-q], [False])).astype(np.int8)
        edge = np.flatnonzero(np.diff(equal)).tolist()
        for a, b in zip(edge[::2], edge[1::2]):
            if b - a + q >= max(24, 3 * q) and (a, b - a + q) not in seen:
                seen.add((a, b - a + q))
                out.append((a, b - a + q, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def repetitive(rnd, n):
    letters = rnd.choice([1, 2, 2, 3, 8, 200])
    kind = rnd.randrange(5)
    x = [rnd.randrange(letters) for _ in range(n)]
    if kind == 0:  # powers of powers
        x = []
        while len(x) < n:
            base = [rnd.randrange(letters) for _ in range(rnd.randrange(1, 12))] * rnd.randrange(1, 9)
            x += (base + [rnd.randrange(letters)] * rnd.randrange(3)) * rnd.randrange(1, 6)
    elif kind == 1:  # Thue-Morse and Fibonacci words
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + (a if letters > 2 else [1 - v for v in b])
        x = b[:n] * rnd.randrange(1, 4)
    elif n > 30:  # planted periods of any length
        for _ in range(3):
            q = rnd.randrange(1, n // 3)
            start = rnd.randrange(n - 3 * q + 1)
            for i in range(start + q, min(n, start + rnd.randrange(2 * q, 6 * q + 2))):
                x[i] = x[i - q]
    return x


def test_runs_equal_brute_force():
    rnd, total = random.Random(11), 0
    for n in [0, 1, 23, 24, 25, 48, 49, 50, 51, *[rnd.randrange(20, 400) for _ in range(150)], 2000, 3000, 4000]:
        texts = [repetitive(rnd, n), repetitive(rnd, rnd.randrange(0, 120)), []]
        want = [brute_runs(t) if len(t) > 2 else [] for t in texts]
        assert periodic.find_runs(texts) == want
        total += sum(map(len, want))
    assert total > 300


def brute_row(doc, text):
    words = SPACE_WORD.findall(text or "")
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    runs = brute_runs([number[w] for w in words]) if n > 2 else []
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in (lines, left)]
    return (doc, len(runs), *best, best[0] is not None and 1000 * best[1] // best[2] or None, *sha)


def test_periodic_query_equals_brute_force(spark, tmp_path):
    rnd = random.Random(2)
    texts = [t for t in odd_texts() if t is None or len(t) < 20_000]
    texts += [" ".join(f"t{v}" for v in repetitive(rnd, rnd.randrange(10, 300))) for _ in range(150)]
    texts += ["a\tb\x0bc\x1cd \x85 a b " * 30, "lone"]
    rows = list(enumerate(texts)) + [(3, "ab " * 40), (3, "ab " * 40), (None, "x y " * 20), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df.select("*", *[F.lit("clash").alias(c) for c in ("w", "a", "p", "g", "f")]).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, queries.op12_periodic_runs(spark, str(tmp_path)).collect()), key=repr)
    want = sorted((brute_row(i, t) for i, t in rows), key=repr)
    assert got == want
    planted = [r for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10 == 0]
    assert len(planted) > 10


def test_a_very_long_text_of_one_run():
    words = sentence(random.Random(1), 3_001).split() * 40
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    found = periodic.find_runs([[number[w] for w in words]])[0]
    assert (0, 3_001 * 40, 3_001) in found


def test_no_periodic_runs_in_nothing(spark, empty):
    assert empty.select(periodic.periodic_runs(F.col("text")).alias("f")).select("f.*").collect() == []


# -- op 13


def brute_neighbours(rows, asked, k):
    def unit(v):
        v = np.array(v, float)
        v = v / np.abs(v).max()
        return v / np.linalg.norm(v)

    out = {}
    for i, v in asked:
        scored = sorted((-float(unit(v) @ unit(x)), j) for j, x in rows if j != i)
        out[i] = [(j, -s) for s, j in scored[:k]]
    return out


def vectors_of(spark, rows, parts=3):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(parts)
    return df.select("*", *[F.lit("clash").alias(c) for c in ("vector", "query_id", "probes", "score", "rank", "dim")])


def by_query(df):
    out = collections.defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out[r.query_id]) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_neighbours_recall_and_scores(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 64)) * rng.uniform(0.1, 9, (4000, 1))
    x[1000:2300] = x[1000] + rng.normal(size=(1300, 64)) * 1e-3  # a third of all are near copies
    x[3000:3040] = x[3000]  # exact copies tie
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = vectors_of(spark, rows)
    got = by_query(neighbours.search(df, df.filter("vec_id % 50 = 0")))
    want = brute_neighbours(rows, [r for r in rows if r[0] % 50 == 0], 5)
    assert set(got) == set(want) and {len(g) for g in got.values()} == {5}
    hits = sum(len({j for j, _ in got[q]} & {j for j, _ in w}) for q, w in want.items())
    assert hits >= 0.9 * 5 * len(want)
    assert [j for j, _ in got[3000]] == [3001, 3002, 3003, 3004, 3005]
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    assert max(abs(s - unit[q] @ unit[j]) for q, g in got.items() for j, s in g) < 1e-12
    # small blocks of queries give the same rows
    assert by_query(neighbours.search(df, df.filter("vec_id % 50 = 0"), block_bytes=1 << 20)) == got


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0, 0.0]), (1, [2.0, 0.0, 0.0]), (2, [1e300, 1e300, 0.0]), (3, [1e-320, 0.0, 0.0]), (4, [-1.0, 0.0, 0.0]),
        (5, None), (6, [0.0, 0.0, 0.0]), (7, [1.0, None, 0.0]), (8, [nan, 1.0, 0.0]), (9, [inf, 1.0, 0.0]), (10, []),
        (11, [1.0, 2.0]), (None, [1.0, 0.0, 0.0]), (0, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0]),
    ]
    df = vectors_of(spark, rows)
    got = by_query(neighbours.search(df, df))
    fit = [(i, v) for i, v in rows if i in (0, 1, 2, 3, 4)]
    asked = {i: min(v for j, v in fit if j == i) for i in range(5)}
    want = brute_neighbours(fit, asked.items(), 5)
    assert set(got) == set(want)
    for q, w in want.items():
        assert [j for j, _ in got[q]] == [j for j, _ in w]
        assert np.allclose([s for _, s in got[q]], [s for _, s in w], atol=1e-15)


def test_no_neighbours_in_nothing(spark):
    df = vectors_of(spark, [])
    assert neighbours.search(df, df).collect() == []
    one = vectors_of(spark, [(50, [1.0])])
    assert neighbours.search(one, one).collect() == []


def test_rotations_keep_lengths_and_probe_their_own_bucket():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(50, 12))
    x /= np.linalg.norm(x, axis=1)[:, None]
    r = neighbours.Rotations.make(12, tables=3, codes=2)
    assert np.allclose(np.linalg.norm(r.rotate(x, 1, 1), axis=1), 1, atol=1e-5)
    probes = r.probes(x, 40)
    assert (probes[:, :, 0] == r.buckets(x)).all()
    assert all(len(set(p)) == 40 for q in probes for p in q)
