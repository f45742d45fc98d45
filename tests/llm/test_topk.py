"""Exact top-k search against all scores."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.llm import ball_trees
from brindle.llm.ball_trees import BallTree, TopK, exact_topk, search


def brute(rows, asks, k):
    out = {}
    for qid, q in rows:
        if not asks(qid):
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in rows if i != qid)
        out[qid] = [(n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return out


def found(df, k):
    out = {}
    for r in exact_topk(df, F.col("vec_id") % 3 == 0, k).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


def test_matches_brute_force_over_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(ball_trees, "SHARD_VALUES", 400)
    monkeypatch.setattr(ball_trees, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(1)
    rows = [(int(k), rng.integers(-9, 9, 4).tolist()) for k in range(330)]
    rows += [(int(k), [3, 3, 3, 3]) for k in range(330, 400)]  # a third of ties
    rows.append((400, [7]))
    df = spark.createDataFrame([(k, v, "s") for k, v in rows] + [(401, None, ""), (402, [1, None, 2, 3], ""), (None, [9, 9, 9, 9], "")], "vec_id long, vector array<long>, score string")
    assert found(df.repartition(3), 7) == brute(rows, lambda i: i % 3 == 0, 7)


def test_few_rows_large_values_and_empty_table(spark):
    rows = [(0, [2**30, -(2**30)]), (1, [2**30 + 1, 5]), (2, []), (3, [1, 1])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<long>")
    assert found(df, 20) == brute(rows, lambda i: i % 3 == 0, 20)
    assert found(df.limit(0), 5) == {}
    assert found(df.where("vec_id = 1"), 5) == {}


@pytest.mark.parametrize("spread", [1, 40])
def test_bounds_prune_without_loss(spread):
    rng = np.random.default_rng(5)
    centers = rng.integers(-100, 100, (30, 16)) * spread
    points = np.concatenate([c + rng.integers(-5, 6, (200, 16)) for c in centers])
    ids = np.arange(len(points))
    tree = BallTree.load(BallTree(ids, points).image())
    best = TopK(50, 5)
    search(tree, points[:50], ids[:50], best)
    scores = points[:50] @ points.T
    scores[np.arange(50), np.arange(50)] = -(2**60)
    for q in range(50):
        want = np.lexsort((ids, -scores[q]))[:5]
        assert best.id[best.row == q].tolist() == want.tolist()
    assert (tree.bounds(points[:50]) >= np.array([[scores[q, tree.ids[tree.begins[n] : tree.ends[n]]].max() for n in tree.leaves] for q in range(50)])).all()
