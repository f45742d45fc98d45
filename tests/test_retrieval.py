import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.functions.vectors import TopHits, few_places, hashing_encoder
from brindle.operators import nearest, retrieval as rt, trainset as ts
from brindle.operators.generation import echo_generator


def brute_force(queries, corpus, k):
    """{query id: [corpus ids]} by cosine, ties to the smaller id."""
    out = {}
    for qid, q in queries:
        scored = sorted((-round(float(np.dot(q, v) / (np.linalg.norm(q) * np.linalg.norm(v))), 12), cid) for cid, v in corpus)
        out[qid] = [cid for _, cid in scored[:k]]
    return out


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    corpus = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    # A third of the corpus are copies of one vector.
    corpus += [(1000 + i, corpus[0][1]) for i in range(150)]
    queries = [(f"q{i}", rng.normal(size=8).astype(np.float32).tolist()) for i in range(20)] + [("hot", corpus[0][1])]
    return queries, corpus


@pytest.fixture(scope="module")
def tables(spark, vectors):
    queries = spark.createDataFrame(vectors[0], "query_id string, embedding array<float>")
    corpus = spark.createDataFrame(vectors[1], "chunk_id int, embedding array<float>")
    return queries, corpus.repartition(5)


def found(hits):
    out = {}
    for r in hits.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r.corpus_id)
    return out


@pytest.mark.parametrize(("settings", "k"), [({}, 1), ({}, 4), ({}, 200), ({}, 900), ({"broadcast_floats": 0, "block_rows": 60}, 4), ({"broadcast_floats": 0, "block_rows": 60}, 200), ({"broadcast_floats": 0, "block_rows": 200}, 900)])
def test_equals_brute_force(tables, vectors, settings, k):
    assert found(rt.retrieve_topk(*tables, k=k, **settings)) == brute_force(*vectors, k)


def by_metric(queries, corpus, k, metric):
    out = {}
    for qid, q in queries:
        q = np.array(q)
        values = [-float(((q - np.array(v)) ** 2).sum()) if metric == "l2" else float(q @ np.array(v)) for _, v in corpus]
        scored = sorted((-round(s, 12), cid) for s, (cid, _) in zip(values, corpus, strict=True))
        out[qid] = [cid for _, cid in scored[:k]]
    return out


@pytest.mark.parametrize("settings", [{}, {"broadcast_floats": 0, "block_rows": 40}])
@pytest.mark.parametrize("metric", ["l2", "ip"])
def test_other_metrics(tables, vectors, settings, metric):
    assert found(rt.retrieve_topk(*tables, k=5, metric=metric, **settings)) == by_metric(*vectors, 5, metric)


def clustered(spark, seed, n, centers=12, dim=16):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centers, dim)) * 3
    rows = [(k, (middle[rng.integers(centers)] + rng.normal(size=dim) * 0.2).astype(np.float32).tolist()) for k in range(n)]
    return rows, spark.createDataFrame(rows, "id int, vector array<float>").repartition(4)


@pytest.mark.parametrize("metric", ["cosine", "ip", "l2"])
def test_block_pairs_that_cannot_win_are_not_joined(spark, metric):
    rows, df = clustered(spark, 4, 600)
    asked, stored = df.select(F.col("id").alias("query_id"), "vector"), df.select(F.col("id").alias("corpus_id"), "vector")
    hits, pairs = nearest.pruned_topk(asked, stored, 3, metric, 40)
    blocks = pairs.select("q_block").distinct().count()
    assert blocks >= 12 and pairs.count() == pairs.distinct().count() < blocks * blocks / 2
    want = brute_force(rows, rows, 3) if metric == "cosine" else by_metric(rows, rows, 3, metric)
    assert found(nearest.best_k(hits, 3)) == want


def test_recall_of_the_index(spark):
    rows, df = clustered(spark, 6, 1500)
    asked, stored = df.select(F.col("id").alias("query_id"), "vector"), df.select(F.col("id").alias("corpus_id"), "vector")
    exact = nearest.best_k(nearest.pruned_topk(asked, stored, 4, "cosine", 500)[0], 4)
    for block_rows in (50_000, 300):
        close = nearest.best_k(nearest.approximate_topk(asked, stored, 4, "cosine", block_rows=block_rows), 4)
        assert close.count() == 6000 and nearest.recall(close, exact) >= 0.9


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.1"])
def test_recall_of_the_index_on_a_table(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    exact = rt.retrieve_topk(vectors, vectors, 4, "vec_id", "vec_id")
    close = rt.retrieve_topk(vectors, vectors, 4, "vec_id", "vec_id", approximate={})
    assert nearest.recall(close, exact) >= 0.9


def test_empty_sides_and_unknown_metrics(spark):
    none = spark.createDataFrame([], "query_id int, chunk_id int, embedding array<float>")
    some = spark.createDataFrame([(1, 1, [1.0, 0.0])], none.schema)
    for queries, corpus in ((none, some), (some, none), (none, none)):
        for settings in ({}, {"broadcast_floats": 0}, {"approximate": {}}):
            assert rt.retrieve_topk(queries, corpus, **settings).count() == 0
    with pytest.raises(ValueError):
        rt.retrieve_topk(some, some, metric="other")


def test_blocks_in_any_order(vectors):
    queries, corpus = vectors
    ids = np.array([q for q, _ in queries])
    matrix = np.array([v for _, v in queries])
    rng = np.random.default_rng(1)
    for size in (1, 10, 137):
        order = rng.permutation(len(corpus))
        top = TopHits(ids, matrix, 4)
        for at in range(0, len(order), size):
            block = [corpus[i] for i in order[at : at + size]]
            top.add(np.array([c for c, _ in block]), np.array([v for _, v in block]))
        got = top.result()
        assert {q: g["corpus_id"].tolist() for q, g in got.groupby("query_id")} == brute_force(queries, corpus, 4)


def test_places_of_few_marks():
    rng = np.random.default_rng(2)
    for columns in (0, 1, 7, 8, 9, 63, 1000):
        for share in (0, 0.01, 0.5, 1):
            marks = rng.random((3, columns)) < share
            assert few_places(marks).tolist() == np.flatnonzero(marks).tolist()
            assert few_places(marks[:, ::2]).tolist() == np.flatnonzero(marks[:, ::2]).tolist()


@pytest.mark.parametrize("metric", ["cosine", "ip", "l2"])
def test_scores_at_the_floor_are_kept(metric):
    rng = np.random.default_rng(4)
    rows, asks = rng.integers(-2, 3, (301, 6)).astype(float), rng.integers(-2, 3, (40, 6)).astype(float)
    rows, asks = rows[np.abs(rows).sum(axis=1) > 0], asks[np.abs(asks).sum(axis=1) > 0]
    whole = TopHits(np.arange(len(asks)), asks, 5, metric)
    whole.add(np.arange(len(rows)), rows)
    want = whole.result()
    # Many rows tie; the k-th score of the whole is known before, and rows come in blocks.
    parts = TopHits(np.arange(len(asks)), asks, 5, metric)
    parts.floor = want.groupby("query_id")["score"].min().to_numpy()
    for at in range(0, len(rows), 37):
        parts.add(np.arange(at, min(at + 37, len(rows))), rows[at : at + 37])
    assert parts.result().to_numpy().tolist() == want.to_numpy().tolist()


def test_no_queries_and_missing_vectors(spark, tables):
    queries, corpus = tables
    assert rt.retrieve_topk(queries.limit(0), corpus).count() == 0
    holes = corpus.unionByName(spark.createDataFrame([(5000, None)], corpus.schema))
    assert found(rt.retrieve_topk(queries, holes)) == found(rt.retrieve_topk(queries, corpus))


def test_corpus_is_not_shuffled_for_few_queries(tables):
    plan = rt.retrieve_topk(*tables)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert plan.count("Exchange hashpartitioning") == 1  # the k best per task


def test_embeddings_have_unit_length_and_are_stable(spark):
    df = spark.createDataFrame([("a b c",), ("",), (None,)], "text string")
    rows = [r.embedding for r in rt.embed(df, "text", hashing_encoder(16)).collect()]
    assert np.linalg.norm(rows[0]) == pytest.approx(1) and not any(rows[1]) and not any(rows[2])
    assert rows[0] == [r.embedding for r in rt.embed(df, "text", hashing_encoder(16)).collect()][0]


def test_encoder_runs_once_per_text(spark):
    calls = spark.sparkContext.accumulator(0)

    def counting(texts):
        calls.add(len(texts))
        return np.ones((len(texts), 2))

    df = spark.range(40).select(F.col("id").cast("string").alias("text")).repartition(3)
    rt.embed(df, "text", counting).select(F.posexplode("embedding")).filter("col > 0").count()
    assert calls.value == 40


def test_context_texts_in_rank_order(spark):
    hits = spark.createDataFrame([("q", 2, "b"), ("q", 1, "a"), ("p", 1, "z")], "query_id string, rank int, t string")
    got = {r.query_id: r.context for r in rt.retrieved_context(hits, "t").collect()}
    assert got == {"q": "a\nb", "p": "z"}
    queries = spark.createDataFrame([("q", "ask "), ("none", "hm")], "query_id string, request string")
    prompts = {r.query_id: r.prompt for r in rt.request_with_context(queries, hits, "request", "t").collect()}
    assert prompts == {"q": "ask a b", "none": "hm"}


def test_shuffled_index_is_dense(spark, monkeypatch):
    df = spark.range(500).withColumnRenamed("id", "k")
    for rows in (100_000, 3):
        monkeypatch.setattr(ts, "_HEX_ROWS", rows)
        index, total = ts.shuffled_index(df, "k", seed=4)
        got = sorted((r.position, r.k) for r in index.collect())
        assert total == 500 and [p for p, _ in got] == list(range(500)) and sorted(k for _, k in got) == list(range(500))


@pytest.mark.parametrize("n_chunks, n, expected", [(30, 2, 2), (5, 2, 1), (4, 1, 0)])
def test_distractors_are_never_own_hits(spark, n_chunks, n, expected):
    chunks = spark.range(n_chunks).withColumnRenamed("id", "chunk_id")
    examples = spark.range(25).withColumnRenamed("id", "example_id")
    hits = examples.select(F.col("example_id").alias("query_id"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long"))).alias("corpus_id"))
    picked = ts.attach_distractors(examples, hits, chunks, n=n, k=4).collect()
    assert all(r.chunk_id > 3 for r in picked)
    per = {}
    for r in picked:
        per.setdefault(r.example_id, set()).add(r.chunk_id)
    assert len(picked) == 25 * expected and all(len(s) == expected for s in per.values())


def test_template_is_cut_at_the_context():
    assert ts.split_template("Use {context}. Answer: {question}.") == ("Use ", ". Answer: ")


def test_eval_set_asks_again_and_reports_errors(spark):
    chunks = spark.createDataFrame([("d1", "fine text"), ("d2", "about a chunk"), ("d3", "boom")], "doc_uri string, chunk_text string")
    about = []  # prompts about d2 seen by the task

    def generator(prompts):
        out = []
        for prompt in prompts:
            if "boom" in prompt:
                raise RuntimeError("refused")
            about.extend([prompt] if "about" in prompt and "Question" not in prompt else [])
            out.append("1. which chunk?" if prompt in about and len(about) < 3 else "1. what?")
        return out

    rows, failed = ts.build_eval_set(chunks, generator, echo_generator("A"))
    got = {r.expected_retrieved_context[0].doc_uri: r for r in rows.collect()}
    assert set(got) == {"d1", "d2"} and all(r.request == "what?" for r in got.values())
    bad = failed.collect()
    assert len(bad) == 1 and "refused" in bad[0].error


def test_blocks_travel_once_per_tile(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(k, rng.normal(size=32).astype(np.float32).tolist()) for k in range(400)]  # no bound helps
    df = spark.createDataFrame(rows, "id int, vector array<float>").repartition(4)
    kept = {}
    settle = nearest.settle
    monkeypatch.setattr(nearest, "settle", lambda rows, label: kept.setdefault(label, settle(rows, label)) if label == "tile-pairs" else settle(rows, label))
    asked, stored = df.select(F.col("id").alias("query_id"), "vector"), df.select(F.col("id").alias("corpus_id"), "vector")
    hits, pairs = nearest.pruned_topk(asked, stored, 3, "cosine", 10)
    assert found(nearest.best_k(hits, 3)) == brute_force(rows, rows, 3)
    assert hits.groupBy("query_id", "corpus_id").count().where("count > 1").count() == 0
    sent = sum(kept["tile-pairs"].select(block, "q_tile", "c_tile").distinct().count() for block in ("q_block", "c_block"))
    assert sent < 2 * pairs.count() / 4
