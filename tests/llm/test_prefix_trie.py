"""The conversation trie and tree contraction against brute force."""

import hashlib
import random
import re
import zlib

import pytest

from brindle.llm.contraction import subtree_sums
from brindle.llm.prefix_trie import PRIME, after, branched, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, node string, parent string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows, rebuilt):
    turns = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(x)] for c, x in turns.items()}
    if rebuilt:
        share = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
        own = {c: own.get(c - c % 20, [])[: share[c]] + t[share[c] :] for c, t in own.items()}
    nodes = {}
    for c, t in own.items():
        for d in range(len(t) + 1):
            nodes.setdefault(tuple(t[:d]), []).append(c)
    children = {}
    for path in nodes:
        if path:
            children.setdefault(path[:-1], []).append(path)
    totals = {}
    for path in sorted(nodes, key=len, reverse=True):
        below = children.get(path, [])
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        totals[path] = (1 if not below else sum(totals[b][0] for b in below), (len(nodes[path]) - 1) * words + sum(totals[b][1] for b in below))
    out = []
    for path, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in members if len(own[c]) == len(path)))
        parent = min(nodes[path[:-1]]) if path else None
        out.append((min(members), len(path), parent, len(members), len(children.get(path, [])), *totals[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows, rebuilt=False):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted((tuple(r) for r in prefix_trie(df, rebuild=branched() if rebuilt else None).select(COLUMNS).collect()), key=repr)


def some(seed, convs, most, words=("a b", "c", "", "d e f", None)):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", None, "assistant"]), rng.choice(words), "x", "y") for c in range(convs) for t in range(rng.randint(1, most))]


@pytest.mark.parametrize("rebuilt", [False, True])
def test_equals_brute_force(spark, rebuilt):
    rows = some(1, 70, 5)
    assert found(spark, rows, rebuilt) == brute(rows, rebuilt)


def test_one_conversation_of_most_turns_spans_many_ranges(spark):
    rows = [(7, t, "user", f"w{t % 3}", "x", "y") for t in range(700)] + [(8, t, "user", f"w{t % 3}", "x", "y") for t in range(650)] + some(2, 6, 3)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted((tuple(r) for r in prefix_trie(df).select(COLUMNS).collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    assert got == brute(rows, False)


def test_hot_conversation_texts_and_first_turns(spark):
    rows = [(c, 0, "user", "hello there", "x", "y") for c in range(60)] + [(c, 1, "bot", f"t{c // 30}", "x", "y") for c in range(60)]
    rows += [(100 + c, t, "user", "same words here", "x", "y") for c in range(30) for t in range(3)]
    assert found(spark, rows, True) == brute(rows, True)


def test_defined_results_of_odd_rows(spark):
    rows = [
        (None, 0, "user", "lost", "x", "y"),
        (1, None, "user", "first", "x", "y"),
        (1, 0, None, None, "x", "y"),
        (1, 5, "user", "third", "x", "y"),
        (2, None, "user", "first", "x", "y"),
        (2, 0, "", "", "x", "y"),
        (2, 0, "", "", "x", "y"),
        (41, 0, "user", "only one", "x", "y"),
        (3, 1, "us", "er", "x", "y"),
        (4, 1, "u", "ser", "x", "y"),
        (5, 1, "user", "long " * 20000, "x", "y"),
    ]
    assert found(spark, rows) == brute(rows, False)
    assert found(spark, rows, True) == brute(rows, True)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_names_of_parts_make_the_name_of_the_whole():
    from brindle.llm.prefix_trie import BASE

    def name(values):
        total = 0
        for v in values:
            total = (total * BASE + v + 1) % PRIME
        return total

    values = [5, 9, 2, 2, 7]
    assert after(name(values[:2]), name(values[2:]), 3) == name(values)


@pytest.mark.parametrize("shape", ["chain", "star", "random", "caterpillar"])
def test_contraction_sums_any_forest(spark, shape):
    rng = random.Random(4)
    n = 300
    parent = {0: None}
    for k in range(1, n):
        parent[k] = {"chain": k - 1, "star": 0, "random": rng.randrange(k), "caterpillar": k - 1 if k % 2 else max(k - 2, 0)}[shape]
    depth, kids = {0: 0}, {k: 0 for k in range(n)}
    for k in range(1, n):
        depth[k] = depth[parent[k]] + 1
        kids[parent[k]] += 1
    want = {k: [k, 1 if not kids[k] else 0] for k in range(n)}
    for k in range(n - 1, 0, -1):
        want[parent[k]][0] += want[k][0]
        want[parent[k]][1] += want[k][1]
    rows = [(k, parent[k], depth[k], kids[k], k, 1 if not kids[k] else 0) for k in range(n)]
    df = spark.createDataFrame(rows, "node long, parent long, depth long, n_children long, s long, l long")
    got = {r["node"]: [r["s"], r["l"]] for r in subtree_sums(df).collect()}
    assert got == want
