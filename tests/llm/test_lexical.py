"""Ranked lexical search against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from brindle.llm import lexical
from brindle.llm.lexical import Best, Shard, lexical_topk

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(k): chr(k + 32) for k in range(65, 91)})
DOCS, ITEMS = "doc_id long, text string, score string, rank int", "item_id long, text string, w string"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    split = [(d, Counter(terms(t))) for d, t, *_ in docs]
    split = [(d, c) for d, c in split if c]
    n, total = len(split), sum(sum(c.values()) for _, c in split)
    df = Counter(t for _, c in split for t in c)
    out = []
    for item, text, *_ in items:
        scored = []
        for d, c in split:
            m = 10 + 90 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) & c.keys())
            if s > 0:
                scored.append((-s, d is None, d))
        scored.sort()
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def found(spark, docs, items, **options):
    got = lexical_topk(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS).repartition(2), **options)
    return sorted((tuple(r) for r in got.collect()), key=repr)


def some(seed, n, words=400, length=40):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(words)]
    weights = [1 / (k + 1) for k in range(words)]
    return [" ".join(rng.choices(vocabulary, weights, k=rng.randint(1, length))) for _ in range(n)]


@pytest.mark.parametrize(("block_docs", "sent"), [(4, 0), (256, 1 << 18)])
def test_equals_brute_force(spark, monkeypatch, block_docs, sent):
    monkeypatch.setattr(lexical, "SENT_TERMS", sent)
    monkeypatch.setattr(lexical, "CELLS", 3)
    docs = [(k, t, "x", 1) for k, t in enumerate(some(1, 400))]
    items = [(k, t, "x") for k, t in enumerate(some(2, 30, length=12))]
    monkeypatch.setattr(lexical, "SHARD_ENTRIES", 1500)
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 8)
    assert found(spark, docs, items, block_docs=block_docs) == brute(docs, items)


def test_several_indexes_give_the_same(spark, monkeypatch):
    docs = [(k, t, "x", 1) for k, t in enumerate(some(3, 150))]
    items = [(k, t, "x") for k, t in enumerate(some(4, 20, length=12))]
    monkeypatch.setattr(lexical, "GROUP_TERMS", 40)
    assert found(spark, docs, items) == brute(docs, items)


def test_ties_copies_and_odd_rows(spark):
    docs = [(k, "The same TEXT, again", "x", 1) for k in range(40, 0, -1)]
    docs += [(None, "the same text again", "x", 1), (7, "the same text again", "x", 1), (90, None, "x", 1), (91, "", "x", 1), (92, "...", "x", 1)]
    docs += [(93, "été ÉTÉ Été", "x", 1), (94, "x" * 100000 + " same " * 3000, "x", 1)]
    items = [(1, "Same text", "x"), (None, "été", "x"), (3, None, "x"), (4, "?", "x"), (5, "absent", "x"), (6, "same", "x"), (6, "same", "x")]
    assert found(spark, docs, items) == brute(docs, items)


@pytest.mark.parametrize(("docs", "items"), [([], [(1, "a", "x")]), ([(1, "a", "x", 1)], []), ([], [])])
def test_empty_tables(spark, docs, items):
    assert found(spark, docs, items) == []


def test_blocks_below_the_bound_are_left_out():
    rng = np.random.default_rng(1)
    rows = []
    for d in range(2000):  # four kinds of documents, each with words of its own
        own = rng.choice(50, 10, replace=False) + 50 * (d % 4)
        rows.append(np.unique(np.append(own, 500)))
    indptr = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    flat = np.concatenate(rows).astype(np.int64)
    values = rng.integers(1, 1_000_000, len(flat))
    shard = Shard.load(Shard.build(np.arange(2000), indptr, flat, values, 64).image())
    terms_, weights = np.array([3, 7, 500]), np.array([9000, 8000, 1])
    best = Best(10)
    visited, held = shard.search(terms_, weights, best)
    score = np.zeros(2000, np.int64)
    for d, r in enumerate(rows):
        for t, v in zip(r, values[indptr[d] : indptr[d + 1]], strict=True):
            score[d] += dict(zip(terms_.tolist(), weights.tolist(), strict=True)).get(int(t), 0) * v
    want = np.lexsort((np.arange(2000), -score))[:10]
    assert best.ids.tolist() == want.tolist() and best.score.tolist() == score[want].tolist()
    assert visited < held / 2


def test_small_tables_have_no_blocks(spark):
    docs = [(k, f"word{k} and", "x", 1) for k in range(5)]
    items = [(1, "word3 and", "x")]
    assert found(spark, docs, items) == brute(docs, items)


def test_summaries_are_upper_bounds():
    rng = np.random.default_rng(2)
    indptr = np.arange(0, 3001, 10)
    flat = np.concatenate([np.sort(rng.choice(60, 10, replace=False)) for _ in range(300)]).astype(np.int64)
    values = rng.integers(1, 1_000_000, len(flat))
    shard = Shard.build(np.arange(300), indptr, flat, values, 8)
    ends = shard._ends()
    dense = np.zeros((300, len(shard.names)), np.int64)
    dense[np.repeat(np.arange(300), 10), shard.codes] = values
    for code in range(len(shard.names)):
        bound = shard._column(code) * (shard.tops[code] / 255) * (1 + 1e-9)
        for k, (a, b) in enumerate(zip(shard.cuts, ends, strict=True)):
            assert bound[k] >= dense[shard.members[a:b], code].max()
