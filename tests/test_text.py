import os
import random
import re
import subprocess
import sys
from hashlib import sha256
from math import sqrt
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.text import split_sections, token_set
from tidemark.functions.vector import cosine_similarity, vector_literal
from tidemark.operators import retrieval as rt
from tidemark.operators import vectors as vec
from tidemark.plans import retrieval as plan
from tidemark.sources import readers

TEXTS = [
    "plain text\nsecond line",
    "# One\nalpha beta\n## Two ##\ngamma\n\nkey:\nvalue\n",
    "intro\r\n# A\r\n# B\r\n  body  \r\n#\r\nuntitled body",
    "", "   \n \t", "#\n", "only:\n", "a # T\x0bb\x1cc: \nd", "#x", "x\n\n\n", "  # indented\nyes\nno : \nend",
]


def brute_sections(text):
    out, title, body = [], "Introduction", []
    for line in [*text.splitlines(), None]:
        bare = "" if line is None else line.strip()
        if line is None or bare[:1] == "#" or bare[-1:] == ":":
            content = "\n".join(body).strip()
            if content:
                out.append((title, content))
            title, body = bare.lstrip("#").strip() or "Untitled", []
        else:
            body.append(line)
    return out


def test_sections(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")
    got = df.select("i", split_sections(F.col("text")).alias("s")).orderBy("i").collect()
    assert [[(s.title, s.content) for s in r.s] for r in got] == [brute_sections(t) for t in TEXTS]


def test_tokens(spark):
    df = spark.createDataFrame([("The Feature_Store is a x Y2 store, STORE and é1 for z9!",)], "t string")
    assert df.select(token_set(F.col("t"))).first()[0] == ["feature_store", "y2", "store", "z9"][:4]


DOCS = [
    (1, "doc/1", "# Feature store\nfeature views and stores\n# Training\nmodel training run"),
    (2, "doc/2", "feature feature feature store"),
    (3, "doc/3", "nothing here"),
]


def documents(spark):
    return spark.createDataFrame(DOCS, "doc_id bigint, path string, text string")


def test_overlap_order(spark):
    got = rt.overlap_topk(rt.sections(documents(spark)), ["what feature store", "training", "zzz"], k=3).collect()
    ranks = {(r.question_id, r["rank"]): (r.doc_id, r.section_no, r.overlap) for r in got}
    assert ranks == {(0, 1): (2, 0, 2), (0, 2): (1, 0, 2), (1, 1): (1, 1, 1)}


@pytest.mark.parametrize("query_bytes", [1, 1 << 20])
def test_overlap_of_a_question_table_equals_brute_force(spark, query_bytes, monkeypatch):
    monkeypatch.setattr(rt, "CELLS", 64)
    rnd = random.Random(5)
    vocabulary = [a + b for a in "bcdfgh" for b in "aeiou"]
    words = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    docs = [(i, "p", words(rnd.randrange(1, 12))) for i in range(60)]
    asked = [(f"q{i}", words(rnd.randrange(0, 4))) for i in range(12)] + [("none", None), ("far", "zzzz")]
    rows = rt.sections(spark.createDataFrame(docs, "doc_id bigint, path string, text string").repartition(3))
    questions = spark.createDataFrame(asked, "question_id string, question string")
    found = rt.overlap_topk(rows, questions, k=4, query_bytes=query_bytes).collect()
    got = {(r.question_id, r["rank"]): (r.doc_id, r.overlap, r.content) for r in found}
    want = {}
    for q, text in asked:
        own = set((text or "").split())
        scored = [(-len(own & set(t.split())), -len(t), i) for i, _, t in docs if own & set(t.split())]
        for place, (overlap, _, i) in enumerate(sorted(scored)[:4]):
            want[q, place + 1] = (i, -overlap, docs[i][2])
    assert got == want
    assert rt.overlap_topk(rows, questions.limit(0)).count() == 0


def test_answers(spark):
    rules = (rt.TopicRule("tool", ("feature",), ("doc/1", "doc/2"), "(sto[a-z]+)", "Found: ", 2),)
    questions = ["Feature store?", "zzz"]
    matches = rt.overlap_topk(rt.sections(documents(spark)), questions)
    out = rt.answers(spark, questions, matches, rt.observations(documents(spark), rules), rules)
    a, b = out.orderBy("question_id").collect()
    assert a.answer.startswith("Tool observations:\n- tool: Found: store, stores\n\nRelevant platform context:\n- ")
    assert a.citations == ["doc/1", "doc/2"] and a.matched_sections[0] == "tool"
    assert (b.answer, b.citations, b.matched_sections) == (rt.NO_MATCH, [], [])
    plain = rt.answers(spark, questions, matches).orderBy("question_id").first()
    assert "Tool observations" not in plain.answer
    block = rt.context_blocks(matches).first().context
    assert block.startswith("[1] doc/2 :: Introduction\nfeature")


def test_platform_tools(spark):
    docs = spark.createDataFrame(
        [
            (1, "defs.py", 'name="user_id" name="a_features" name="transaction_request"'),
            (2, "fit.py", "no defaults here"),
            (3, "services.yml", "MLFLOW_URI: x"),
        ],
        "doc_id bigint, path string, text string",
    )
    rules = rt.platform_rules("defs.py", "fit.py", "services.yml", "Detector")
    a, b, c = rt.observations(docs, rules).orderBy("rule_no").collect()
    assert a.summary == "Indexed Feast-related definitions: a_features, transaction_request"
    assert b.summary == (
        "Training CLI defaults reference model(s): none found; docker-compose MLflow service configured: True."
    )
    assert b.citations == ["fit.py", "services.yml"]
    assert c.summary == "Configured storage paths: "
    asked = spark.createDataFrame([(0, "Is the Feature Store on S3?"), (1, "hello")], "q int, text string")
    assert [r.tool for r in rt.route(asked, rules).orderBy("rule_no").collect()] == ["feature_store_tool", "storage_tool"]


def brute_hash(text, d):
    v = [0.0] * d
    for w in re.findall("[a-zA-Z0-9_]+", text.lower()):
        h = sha256(w.encode()).digest()
        v[int.from_bytes(h[:4], "big") % d] += 1 if h[4] % 2 == 0 else -1
    norm = sqrt(sum(x * x for x in v)) or 1.0
    return [x / norm for x in v]


@pytest.mark.parametrize("d", [8, 64])
def test_hash_embedding(spark, d):
    texts = ["hello world hello", "", "!!", "a b c d e f g h", "Größe é x1"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for r in vec.hash_embed(df, ["i"], dimensions=d).collect():
        assert r.embedding == pytest.approx(brute_hash(texts[r.i], d))


def test_vector_literal(spark):
    df = spark.createDataFrame([([0.5, -0.25, 0.0],)], "v array<double>")
    assert df.select(vector_literal(F.col("v"))).first()[0] == "[0.50000000, -0.25000000, 0.00000000]"


def test_cosine_column(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    got = [r[0] for r in df.select(cosine_similarity(F.col("a"), F.col("b"))).collect()]
    assert got[0] == pytest.approx(1 / sqrt(2)) and got[1] is None


@pytest.mark.parametrize("query_bytes", [1 << 20, 3 * 16 * 8])
def test_cosine_topk(spark, query_bytes):
    rng = np.random.default_rng(1)
    m = rng.normal(size=(300, 16))
    m[7] = 0
    m[100:110] = m[50]
    q = np.vstack([rng.normal(size=(7, 16)), m[50], np.zeros(16)])
    v = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(m)], "vec_id long, embedding array<double>")
    asked = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(q)], "question_id long, vector array<double>")
    got = {}
    for r in vec.cosine_topk(v.repartition(5), asked, 4, query_bytes=query_bytes).collect():
        got[r.question_id, r["rank"]] = r.vec_id
    want = {}
    for i in range(8):
        keep = [j for j in range(300) if j != 7]
        sims = [(-round(float(m[j] @ q[i] / np.linalg.norm(m[j]) / np.linalg.norm(q[i])), 9), j) for j in keep]
        want.update({(i, n + 1): j for n, (_, j) in enumerate(sorted(sims)[:4])})
    assert got == want
    assert vec.cosine_topk(v, asked.limit(0)).count() == 0


def test_injected_encoder(spark):
    def load_counter():
        return lambda texts: np.array([[len(t), t.count("a"), 1.0] for t in texts])

    df = spark.createDataFrame([(1, "aab"), (2, "")], "i int, text string")
    got = {r.i: r.embedding for r in vec.encode_texts(df, "text", load_counter).collect()}
    assert got[1] == pytest.approx(np.array([3, 2, 1]) / sqrt(14)) and got[2] == [0, 0, 1]


def test_encoder_is_loaded_once_per_worker(spark, tmp_path):
    folder = str(tmp_path)

    def load():
        import os
        import uuid

        open(f"{folder}/{os.getpid()}-{uuid.uuid4().hex}", "w").close()
        return lambda texts: np.ones((len(texts), 2))

    for _ in range(2):
        df = spark.range(0, 64, 1, 16).select(F.col("id").cast("string").alias("text"))
        assert vec.encode_texts(df, "text", load).agg(F.sum(F.size("embedding"))).first()[0] == 128
    workers = [p.name.partition("-")[0] for p in tmp_path.iterdir()]
    assert workers and len(workers) == len(set(workers))


def test_index_and_search(spark, tmp_path):
    root = str(tmp_path / "index")
    assert plan.build_index(documents(spark), root) == 4
    top = plan.search(spark, ["model training run"], root, k=1).first()
    assert (top.doc_id, top.section_no, top.section) == (1, 1, "Training")
    out = plan.answer(spark, ["model training run"], documents(spark), 1, root).first()
    assert "- Training: model training run" in out.answer and out.citations[-1] == "doc/1"


def test_index_search_by_text_ids(spark, tmp_path):
    root = str(tmp_path / "index")
    plan.build_index(documents(spark), root)
    asked = spark.createDataFrame([("q/1", "model training run"), ("q/2", "")], "question_id string, question string")
    rows = plan.search(spark, asked, root, k=1).collect()
    assert [(r.question_id, r.section) for r in rows] == [("q/1", "Training")]
    big = asked.withColumn("question_id", F.lit(1 << 40))
    assert {r.question_id for r in plan.search(spark, big, root, k=1).collect()} == {1 << 40}


def test_cosine_in_tiles_and_without_vectors(spark, monkeypatch):
    rng = np.random.default_rng(3)
    m = rng.normal(size=(50, 4))
    v = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(m)], "vec_id long, embedding array<double>")
    asked = spark.createDataFrame([("a", m[3].tolist()), ("b", None), ("c", m[9].tolist())], "question_id string, vector array<double>")
    whole = vec.cosine_topk(v, asked, 3).collect()
    assert {r.question_id for r in whole} == {"a", "c"} and {r.vec_id for r in whole if r["rank"] == 1} == {3, 9}
    # a task holds the products of seven rows at a time
    best = vec._Best(m[:2], 3, 1)
    monkeypatch.setattr(vec, "CELLS", 14)
    seen = []
    monkeypatch.setattr(best, "_add", lambda ids, sims, add=best._add: (seen.append(sims.size), add(ids, sims)))
    best.add(np.arange(50)[:, None], m)
    assert max(seen) <= 14 and [i[0][0] for _, _, i in best.rows()] == [0, 1]


def test_hashed_embedding_moves_one_row_per_text(spark):
    df = spark.createDataFrame([(i, f"w{i} a b a") for i in range(20)], "i int, text string")
    text = vec.hash_embed(df, ["i"])._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1


def test_blocks_of_questions_do_not_grow_the_plan(spark):
    rows = rt.sections(documents(spark))
    asked = spark.createDataFrame([(i, f"model run {i}") for i in range(12)], "question_id int, question string")
    shown = lambda df: sorted(map(repr, df.collect()))
    many = rt.overlap_topk(rows, asked, 2, query_bytes=200)
    assert shown(many) == shown(rt.overlap_topk(rows, asked, 2))
    plans = [rt.overlap_topk(rows, asked.limit(n), 2, query_bytes=200)._jdf.queryExecution().executedPlan().toString() for n in (4, 12)]
    assert all("Union" not in p for p in plans) and abs(len(plans[0]) - len(plans[1])) < 1500


WITHOUT_PACKAGE = """
import sys
sys.path.insert(0, {repo!r})
from tidemark.session import build_session
spark = build_session(master="local[2]", **{{"spark.ui.enabled": "false", "spark.checkpoint.dir": {folder!r}}})
from tidemark.operators import retrieval as rt, vectors as vec
def imports(_):
    import importlib.util
    return [importlib.util.find_spec("tidemark") is None]
assert spark.sparkContext.parallelize([0], 1).mapPartitions(imports).collect() == [True]
docs = spark.createDataFrame([(1, "doc/1", "# T\\nmodel run")], "doc_id bigint, path string, text string")
{body}
"""


def without_package(tmp_path, body):
    script = tmp_path / "script.py"
    script.write_text(WITHOUT_PACKAGE.format(repo=str(Path(__file__).resolve().parents[1]), folder=str(tmp_path), body=body))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]


def test_workers_need_no_copy_of_the_package(tmp_path):
    without_package(tmp_path, """
assert rt.overlap_topk(rt.sections(docs), ["model"], 1).count() == 1
v = spark.createDataFrame([(1, [1.0, 0.0])], "vec_id bigint, embedding array<double>")
q = spark.createDataFrame([(1, [1.0, 0.0])], "question_id bigint, vector array<double>")
assert vec.cosine_topk(v, q, 1).count() == 1
""")


def test_text_documents_skip_missing(spark, tmp_path):
    (tmp_path / "docs").mkdir()
    (tmp_path / "a.md").write_text("# A\nx")
    (tmp_path / "docs" / "b.md").write_text("y")
    got = readers.text_documents(spark, str(tmp_path), ["a.md", "docs/b.md", "no.md"]).orderBy("path").collect()
    assert [(r.path, r.text) for r in got] == [("a.md", "# A\nx"), ("docs/b.md", "y")]


def test_peek(spark):
    df = spark.createDataFrame([('{"a": 1}', 0, 5), ("x" * 500, 0, 6)], "value string, partition int, offset bigint")
    a, b = readers.peek(df, 2).orderBy("offset").collect()
    assert (a.message, a.is_json, a.offset) == ('{"a":1}', True, 5)
    assert (len(b.message), b.is_json) == (200, False)
    assert readers.peek(df, 1).count() == 1


def test_section_keys_do_not_collide(spark):
    far = 1 << 20
    rows = [(1, far, [1.0, 0.0]), (2, 0, [0.0, 1.0]), (1 << 50, 3, [0.6, 0.8])]
    v = spark.createDataFrame(rows, "doc_id long, section_no long, embedding array<double>")
    asked = spark.createDataFrame([(0, [1.0, 0.0])], "question_id long, vector array<double>")
    got = vec.cosine_topk(v, asked, 3, ("doc_id", "section_no")).orderBy("rank").collect()
    assert [(r.doc_id, r.section_no) for r in got] == [(1, far), (1 << 50, 3), (2, 0)]


def test_documents_that_do_not_exist_are_skipped(spark, tmp_path):
    (tmp_path / "a+b").mkdir()
    (tmp_path / "a+b" / "x.md").write_text("# x")
    root = str(tmp_path / "a+b")
    assert [r.path for r in readers.text_documents(spark, root, ["x.md", "no.md"]).collect()] == ["x.md"]
    assert readers.text_documents(spark, root, ["no.md"]).count() == 0
    assert readers.text_documents(spark, root, ["no.md", "nor.md"]).count() == 0


def test_hashed_words_are_never_rows(spark):
    rows = [("a", "X1 x1 b"), ("a", "b c"), (None, "z"), ("n", None), ("n", "b"), ("e", "!")]
    df = spark.createDataFrame(rows, "k string, text string")
    found = vec.hash_embed(df, ["k"], dimensions=8)
    assert "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()
    got = {r.k: r.embedding for r in found.collect()}
    want = {"a": "x1 x1 b b c", None: "z", "n": "b", "e": ""}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(brute_hash(t, 8)) for k, t in want.items())


def test_best_of_many_queries_are_ranked_together(monkeypatch):
    rng = np.random.default_rng(7)
    m, q = rng.integers(-2, 3, size=(400, 6)).astype("float64"), rng.integers(-2, 3, size=(300, 6)).astype("float64")
    ids = rng.permutation(400)[:, None]
    sorts, sort = [], np.lexsort
    monkeypatch.setattr(vec, "CELLS", 300 * 20)
    monkeypatch.setattr(np, "lexsort", lambda keys: (sorts.append(1), sort(keys))[1])
    best = vec._Best(q, 4, 1)
    for lo in range(0, 400, 100):
        best.add(ids[lo : lo + 100], m[lo : lo + 100])
    got = {n: list(zip(s.tolist(), i[:, 0].tolist())) for n, s, i in best.rows()}
    assert len(sorts) <= 30
    unit = lambda x: x / np.linalg.norm(x)
    for n in range(300):
        if q[n].any():
            sims = sorted((-round(float(unit(m[j]) @ unit(q[n])), 9), int(ids[j, 0])) for j in range(400) if m[j].any())
            assert [i for _, i in got[n]] == [i for _, i in sims[:4]]
        else:
            assert n not in got


def test_texts_of_answers_are_dealt_by_the_number_of_questions(spark, monkeypatch):
    monkeypatch.setattr(rt, "QUESTIONS_PER_TASK", 2)
    asked = spark.createDataFrame([(i, f"model run {i}") for i in range(60)] + [(None, "feature store")], "question_id int, question string")
    matches = rt.overlap_topk(rt.sections(documents(spark)), asked, k=2)
    found = [rt.answers(spark, asked, matches), rt.context_blocks(matches, questions=asked)]
    for df in found:
        plan_text = df._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(question_id" in plan_text and ", 31), REPARTITION_BY_NUM" in plan_text
    assert found[0].count() == 61
    shown = lambda df: sorted(map(repr, df.collect()))
    assert shown(found[1]) == shown(rt.context_blocks(matches))


@pytest.mark.parametrize(("chars", "each", "wanted"), [(1 << 20, 4096, 1 << 20), (400, 4096, 1 << 20), (1 << 20, 3, 0)])
def test_texts_go_to_pieces_of_questions(spark, monkeypatch, chars, each, wanted):
    for name, value in (("PIECE_CHARS", chars), ("QUESTIONS_PER_PIECE", each), ("WANTED_ROWS", wanted), ("TEXT_BYTES", 300)):
        monkeypatch.setattr(rt, name, value)
    rnd = random.Random(5)
    docs = [(i, f"doc/{i}", f"{zipf_words(rnd, rnd.randrange(1, 60), 40)}  ") for i in range(30)]
    docs += [docs[3], (4, "doc/4", f"# other\n{zipf_words(rnd, 20, 40)}"), (None, "none", "w1 w2"), (31, None, "w1 w3"), (32, "p", None)]
    rows = rt.materialise(rt.sections(spark.createDataFrame(docs, "doc_id bigint, path string, text string").repartition(4)), "s")
    asked = [(f"q{i}", zipf_words(rnd, rnd.randrange(1, 6), 45)) for i in range(40)]
    asked += [asked[0], asked[0], ("q1", "w1"), (None, "w1 w2"), ("none", None), ("nothing", "elsewhere")]
    asked = spark.createDataFrame(asked, "question_id string, question string").repartition(3)
    rules = (rt.TopicRule("tool", ("w2",), ("doc/1",), "(w[0-9]+)", "Words: ", 3),)
    tools = rt.observations(spark.createDataFrame(docs, "doc_id bigint, path string, text string"), rules)
    narrow, whole = rt.overlap_topk(rows, asked, texts=False), rt.overlap_topk(rows, asked)
    assert "content" not in narrow.columns
    shown = lambda df: sorted(map(repr, df.collect()))
    assert shown(rt.answers(spark, asked, narrow, tools, rules, rows)) == shown(rt.answers(spark, asked, whole, tools, rules))
    blocks = rt.context_blocks(narrow, 2, sections=rows)
    assert shown(blocks) == shown(rt.context_blocks(whole, 2)) and blocks.count() > 30


def test_a_text_is_brought_to_a_piece_once(spark, monkeypatch):
    monkeypatch.setattr(rt, "QUESTIONS_PER_PIECE", 100)
    docs = [(i, f"doc/{i}", f"w{i % 2} {'long ' * 2000}") for i in range(2)]
    rows = rt.materialise(rt.sections(spark.createDataFrame(docs, "doc_id bigint, path string, text string")), "s")
    asked = spark.createDataFrame([(i, f"w{i % 2}") for i in range(400)], "question_id int, question string")
    brought, put = spark.sparkContext.accumulator(0), rt._put_together

    def counted(batches):
        for batch in batches:
            brought.add(len(batch.column("text").drop_null()))
            yield from put([batch])

    monkeypatch.setattr(rt, "_put_together", counted)
    found = rt.context_blocks(rt.overlap_topk(rows, asked, k=1, texts=False), sections=rows).collect()
    assert len(found) == 400 and all(len(r.context) > 9000 for r in found)
    assert brought.value <= 6


def zipf_words(rnd, n, vocabulary=400):
    return " ".join(f"w{min(int(rnd.paretovariate(0.7)), vocabulary)}" for _ in range(n))


@pytest.mark.parametrize("query_bytes", [600, 1 << 20])
def test_overlap_beyond_the_longest_sections_equals_brute_force(spark, query_bytes, monkeypatch):
    monkeypatch.setattr(rt, "CELLS", 500)
    rnd = random.Random(11)
    docs = [(i, "p", zipf_words(rnd, rnd.choice((3, 8, 8, 20, 60)))) for i in range(300)]
    docs += [(300 + i, "p", docs[i % 7][2]) for i in range(40)] + [(i, "p", "w1 w2 w3 w9999 w9998") for i in range(340, 344)]
    asked = [(i, zipf_words(rnd, rnd.randrange(1, 25))) for i in range(30)] + [(90, "w9999 w9998"), (91, "nowhere"), (92, None)]
    rows = rt.sections(spark.createDataFrame(docs, "doc_id bigint, path string, text string").repartition(5))
    questions = spark.createDataFrame(asked, "question_id int, question string")
    found = rt.overlap_topk(rows, questions, query_bytes=query_bytes).collect()
    want = set()
    for q, text in asked:
        own = set((text or "").split())
        scored = sorted((-len(own & set(t.split())), -len(t), i) for i, _, t in docs if own & set(t.split()))
        want |= {(q, place + 1, i, -n) for place, (n, _, i) in enumerate(scored[:3])}
    assert {(r.question_id, r["rank"], r.doc_id, r.overlap) for r in found} == want and len(found) == len(want)


def test_sections_that_cannot_win_are_not_compared(monkeypatch):
    rnd = random.Random(3)
    held = sorted((set(zipf_words(rnd, rnd.randrange(5, 120), 3000).split()) for _ in range(900)), key=len, reverse=True)
    spread = {}
    for tokens in held:
        for t in tokens:
            spread[t] = spread.get(t, 0) + 1
    own = [{t for t in zipf_words(rnd, 25, 3000).split() if t in spread} for _ in range(50)]
    asked = [(i, sorted(tokens, key=lambda t: (spread[t], t))) for i, tokens in enumerate(own)]
    least = np.array([sorted(len(q & s) for s in held[:30])[-3] for q in own])
    index = rt._TokenIndex.of(asked, rt.ID_TYPES["int"])
    index = rt.replace(index, least=least)
    texts = rt.pa.array([" ".join(sorted(s)) for s in held[30:]])
    looked, counted = [], rt._counted
    monkeypatch.setattr(rt, "_counted", lambda pairs, most: (looked.append(len(pairs)), counted(pairs, most))[1])
    got = {(r, q): n for rows in index.overlaps(texts, least + 1) for r, q, n in zip(*(x.tolist() for x in rows))}
    common = {(r, q): len(o & s) for r, s in enumerate(held[30:]) for q, o in enumerate(own) if o & s}
    assert got == {at: n for at, n in common.items() if n > least[at[1]]}
    assert sum(looked) < sum(common.values()) / 4


def test_sections_are_cut_once_for_all_blocks_of_questions(spark):
    seen = spark.sparkContext.accumulator(0)
    touch = F.udf(lambda x: (seen.add(1), x)[1], "string")
    rows = rt.sections(documents(spark)).withColumn("content", touch("content"))
    asked = spark.createDataFrame([(i, f"model feature{i} store training") for i in range(6)], "question_id int, question string")
    assert rt.overlap_topk(rows, asked, 1, query_bytes=1).count() == 6
    assert seen.value == 4
