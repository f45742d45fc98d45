import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.operators import graph as gr, lineage as ln


def reach(edges, seed):
    seen, todo = {seed}, [seed]
    while todo:
        node = todo.pop()
        for a, b in edges:
            if b == node and a not in seen:
                seen.add(a)
                todo.append(a)
    return seen


def test_ancestors_with_cycles(spark):
    rng = random.Random(11)
    graphs = {
        f"g{g:02d}": [(f"n{rng.randrange(9)}", f"n{rng.randrange(9)}") for _ in range(rng.randrange(1, 16))] for g in range(40)
    }
    edges = spark.createDataFrame([(g, a, b) for g, pairs in graphs.items() for a, b in pairs], "file string, src string, dst string")
    seeds = [(g, n) for g, pairs in graphs.items() for n in {n for e in pairs for n in e}]
    asked = spark.createDataFrame(seeds + [("g00", "unknown"), ("other", "n0")], "file string, seed string")
    got = {}
    for r in gr.ancestors(edges, asked, ["file"]).collect():
        got.setdefault((r.file, r.seed), []).append(r.node)
    assert {k: sorted(v) for k, v in got.items()} == {(g, s): sorted(reach(graphs[g], s)) for g, s in seeds}


def test_long_chain_compacts(spark, monkeypatch):
    monkeypatch.setattr(gr, "COMPACT_EVERY", 2)
    edges = spark.createDataFrame([(f"n{i:02d}", f"n{i + 1:02d}") for i in range(12)], "src string, dst string")
    seeds = spark.createDataFrame([("n12",)], "seed string")
    assert gr.ancestors(edges, seeds).count() == 13


def test_deep_graphs_take_few_rounds(spark, monkeypatch):
    n = 10_000
    pairs = [("g", f"n{k:05d}", f"n{k + 1:05d}") for k in range(n - 1)] + [("c", f"n{k:03d}", f"n{(k + 1) % 300:03d}") for k in range(300)]
    edges = spark.createDataFrame(pairs, "file string, src string, dst string")
    seeds = spark.createDataFrame([("g", f"n{n - 1:05d}"), ("g", "n00700"), ("c", "n005")], "file string, seed string")
    rounds, settle = [], gr.settle
    monkeypatch.setattr(gr, "settle", lambda df, label: rounds.append(label) or settle(df, label))
    found = gr.ancestors(edges, seeds, ["file"]).groupBy("file", "seed").agg(F.count("*").alias("n"), F.countDistinct("node").alias("d"))
    assert {(r.file, r.seed): (r.n, r.d) for r in found.collect()} == {("g", f"n{n - 1:05d}"): (n, n), ("g", "n00700"): (701, 701), ("c", "n005"): (300, 300)}
    assert sum(label in ("frontier", "jump") for label in rounds) < 25


@pytest.mark.parametrize("seed", [1, 2])
def test_compressed_chains_equal_plain_search(spark, monkeypatch, seed):
    monkeypatch.setattr(gr, "DEEP_AFTER", 1)
    rng = random.Random(seed)
    graphs = {}
    for g in range(25):
        n = rng.randrange(3, 14)
        pairs = {(f"n{k}", f"n{k + 1}") for k in range(n)}
        pairs |= {(f"n{rng.randrange(n)}", f"n{rng.randrange(n)}") for _ in range(rng.randrange(0, 3))} | {("z0", "z1"), ("z1", "z2"), ("z2", "z0")}
        graphs[f"g{g}"] = pairs
    edges = spark.createDataFrame([(g, a, b) for g, pairs in graphs.items() for a, b in pairs], "file string, src string, dst string")
    asked = [(g, n) for g, pairs in graphs.items() for n in {n for e in pairs for n in e}]
    got = {}
    for r in gr.ancestors(edges, spark.createDataFrame(asked, "file string, seed string"), ["file"]).collect():
        got.setdefault((r.file, r.seed), []).append(r.node)
    assert {k: sorted(v) for k, v in got.items()} == {(g, s): sorted(reach(graphs[g], s)) for g, s in asked}


def power(pairs, nodes, rounds=100, tol=1e-6):
    index = {n: i for i, n in enumerate(nodes)}
    matrix = np.eye(len(nodes))
    for a, b in set(pairs):
        matrix[index[b], index[a]] += 1
    x = np.full(len(nodes), 1 / len(nodes))
    for _ in range(rounds):
        last, x = x, matrix @ x
        x = x / np.linalg.norm(x)
        if np.abs(x - last).sum() < len(nodes) * tol:
            return dict(zip(nodes, x)), True
    return dict(zip(nodes, x)), False


def test_eigenvector_per_graph_and_fallback(spark):
    rng = random.Random(3)
    clique = [(a, b) for a in "abcd" for b in "abcd" if a != b]
    loose = [(f"x{rng.randrange(5)}", f"x{rng.randrange(5)}") for _ in range(9)] + [("x0", "x1"), ("x1", "x0")]
    chain = [("p", "q"), ("q", "r")]
    rows = [(g, a, b) for g, pairs in (("clique", clique), ("chain", chain)) for a, b in pairs]
    edges = spark.createDataFrame(rows, "file string, src string, dst string")
    got = {(r.file, r.node): r for r in gr.eigenvector_centrality(edges, ["file"], max_iter=4).collect()}
    want, done = power(clique, list("abcd"), 4)
    assert done and all(got["clique", n].converged and got["clique", n].centrality == pytest.approx(want[n]) for n in want)
    want, done = power(chain, list("pqr"), 4)
    assert not done and all(not got["chain", n].converged and got["chain", n].centrality == pytest.approx(want[n]) for n in want)
    both = {(r.file, r.node): r.centrality for r in gr.node_centrality(edges, ["file"], max_iter=4).collect()}
    assert both["chain", "q"] == 1.0 and both["chain", "p"] == 0.5
    one = spark.createDataFrame(loose, "src string, dst string")
    nodes = sorted({n for e in loose for n in e})
    want, _ = power(loose, nodes, 3)
    got = {r.node: r.centrality for r in gr.eigenvector_centrality(one, max_iter=3).collect()}
    assert got == pytest.approx(want)


def test_degree_of_lonely_nodes(spark):
    edges = spark.createDataFrame([], "file string, src string, dst string")
    nodes = spark.createDataFrame([("a", "x"), ("b", "y"), ("b", "z")], "file string, node string")
    got = {(r.file, r.node): r.centrality for r in gr.degree_centrality(edges, ["file"], nodes).collect()}
    assert got == {("a", "x"): 1.0, ("b", "y"): 0.0, ("b", "z"): 0.0}


def test_focused_view_is_cut_and_styled(spark):
    pairs = [(f"u{i:02d}", "hub") for i in range(30)] + [("hub", "t"), ("Constant: 1", "t")]
    edges = spark.createDataFrame(pairs, "src string, dst string")
    seeds = spark.createDataFrame([("t",), ("u00",)], "seed string")
    nodes, links = gr.focused_view(edges, seeds, n=4, method="degree")
    shown = {(r.seed, r.node): r for r in nodes.collect()}
    assert {n for s, n in shown if s == "t"} == {"hub", "t", "Constant: 1", "u00"}
    assert shown["t", "t"].style == "target" and shown["t", "Constant: 1"].style == "constant" and shown["t", "hub"].style == "variable"
    assert shown["t", "t"].truncated and not shown["u00", "u00"].truncated
    assert {(r.src, r.dst) for r in links.collect()} == {("hub", "t"), ("Constant: 1", "t"), ("u00", "hub")}
    everything, _ = gr.focused_view(edges, seeds, n=4, show_all=True)
    assert everything.filter("seed = 't'").count() == 33


# Lineage of C text

SAMPLE = "int area(int w) { int h = w; int *p; /* x = 9; */ h = h + 3; return h; }"


def lineage(spark, *texts):
    files = spark.createDataFrame([(f"f{i}.c", t) for i, t in enumerate(texts)], "path string, content string")
    functions = ln.extract_functions(files)
    variables = ln.extract_variables(functions)
    edges = ln.dependency_edges(functions, variables)
    return functions, variables, edges


def test_sample_file(spark):
    _, variables, edges = lineage(spark, SAMPLE)
    got = {(r.name, r.type, r.is_pointer) for r in variables.collect()}
    assert got == {("w", "int", False), ("h", "int", False), ("p", "int", True)}
    assert {(r.src, r.dst) for r in edges.collect()} == {("w", "h"), ("Constant: 3", "h")}


CODE = """
static char *name(const char *label, unsigned int n[4]) {
  for (int i = 0; i < n; i++) { label = pick(label * i, n); }
  if (label == 0) { return label; } else if (n) { goto end; }
  struct node item; double a, b = a * 2.5;
  a = b = c;
end:
  return label;
}
int other(void) { int open = 1; {
"""


def test_harder_code(spark):
    functions, variables, edges = lineage(spark, CODE)
    assert {r.function: r.params for r in functions.collect()} == {"name": "const char *label, unsigned int n[4]", "other": "void"}
    got = {(r.function, r.name, r.type, r.is_pointer) for r in variables.collect()}
    assert got == {
        ("name", "label", "char", True), ("name", "n", "int", False), ("name", "i", "int", False),
        ("name", "item", "node", False), ("name", "a", "double", False), ("name", "b", "double", False), ("other", "open", "int", False),
    }
    pairs = {(r.function, r.src, r.dst) for r in edges.collect()}
    assert pairs == {
        ("name", "i", "label"), ("name", "n", "label"), ("name", "Constant: 0", "i"), ("other", "Constant: 1", "open"),
        ("name", "a", "b"), ("name", "b", "a"), ("name", "Constant: 2", "b"), ("name", "Constant: 5", "b"),
    }


def test_every_declarator_of_a_list(spark):
    code = "int f(int z) { int u, v; v = z; u = v; for (int i = 0, n = g(x, y); i < n; i++) {} char *s, t[3] = {1, 2}, **q; }"
    _, variables, edges = lineage(spark, code)
    got = {(r.name, r.type, r.is_pointer) for r in variables.collect()}
    assert got == {("z", "int", False), ("u", "int", False), ("v", "int", False), ("i", "int", False), ("n", "int", False), ("s", "char", True), ("t", "char", False), ("q", "char", True)}
    assert {("z", "v"), ("v", "u"), ("Constant: 0", "i")} <= {(r.src, r.dst) for r in edges.collect()}


def induced(pairs):
    """Per node and direction its neighbours and their edges."""
    out = {}
    for v in {n for e in pairs for n in e}:
        for direction, near in (("upstream", {a for a, b in pairs if b == v}), ("downstream", {b for a, b in pairs if a == v})):
            if near:
                out[v, direction] = near, {(a, b) for a, b in pairs if a in near and b in near}
    return out


@pytest.mark.parametrize("loops", [False, True])
def test_neighbour_edges_and_centrality(spark, loops):
    rng = random.Random(9 + loops)
    graphs = {}
    for g in range(12):
        pairs = {(f"n{rng.randrange(8)}", f"n{rng.randrange(8)}") for _ in range(rng.randrange(5, 40))} | {("hub", f"n{k}") for k in range(8)}
        graphs[g] = {(a, b) for a, b in pairs if loops or a != b}
    edges = spark.createDataFrame([(g, a, b) for g, pairs in graphs.items() for a, b in pairs], "file int, src string, dst string")
    got = {}
    for r in gr.neighbour_edges(edges, ["file"]).collect():
        assert (r.src, r.dst) not in got.setdefault((r.file, r.center, r.direction), set())
        got[r.file, r.center, r.direction].add((r.src, r.dst))
    want = {(g, v, d): among for g, pairs in graphs.items() for (v, d), (_, among) in induced(pairs).items() if among}
    assert got == want
    central = {(r.file, r.node, r.direction, r.neighbour): r.centrality for r in gr.neighbour_centrality(edges, ["file"]).collect()}
    count = 0
    for g, pairs in graphs.items():
        for (v, d), (near, among) in induced(pairs).items():
            values, done = power(among, sorted(near))
            if not done:
                values = {n: 1.0 if len(near) == 1 else sum((a == n) + (b == n) for a, b in among) / (len(near) - 1) for n in near}
            for n in near:
                assert central[g, v, d, n] == pytest.approx(values[n], rel=1e-8), (g, v, d, n)
                count += 1
    assert count == len(central)


def test_small_graphs_need_no_joins(spark, monkeypatch):
    rng = random.Random(3)
    rows = {(g, f"n{rng.randrange(9)}", f"n{rng.randrange(9)}") for g in range(8) for _ in range(20)}
    edges = spark.createDataFrame(sorted(rows), "file int, src string, dst string")
    views = ["file", "node", "direction", "neighbour", "centrality"]
    seeds = edges.select("file", F.col("dst").alias("seed")).distinct()
    view = lambda: [sorted(map(tuple, df.collect()), key=str) for df in gr.focused_view(edges, seeds, ["file"], n=4)]
    monkeypatch.setattr(gr, "SMALL_NEIGHBOURHOODS", 0)
    wide, shown = sorted(map(tuple, gr.neighbour_centrality(edges, ["file"]).select(views).collect())), view()
    monkeypatch.undo()
    # Neither triangles nor degrees are joined for them.
    for name in ("neighbour_edges", "degree_centrality"):
        monkeypatch.setattr(gr, name, None)
    for at_once in (gr.PAIRS_AT_ONCE, 1):
        monkeypatch.setattr(gr, "PAIRS_AT_ONCE", at_once)
        assert sorted(map(tuple, gr.neighbour_centrality(edges, ["file"]).select(views).collect())) == wide
    assert view() == shown


def test_large_graphs_give_the_same_as_small_ones(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(g, f"n{rng.randrange(6)}", f"n{rng.randrange(6)}") for g in range(3) for _ in range(14)]
    edges = spark.createDataFrame(rows, "file int, src string, dst string")
    small = sorted(map(tuple, gr.eigenvector_centrality(edges, ["file"], max_iter=6).collect()))
    monkeypatch.setattr(gr, "SMALL_GRAPH", 0)
    large = sorted(map(tuple, gr.eigenvector_centrality(edges, ["file"], max_iter=6).collect()))
    assert [r[:2] + r[3:] for r in small] == [r[:2] + r[3:] for r in large]
    assert [r[2] for r in small] == pytest.approx([r[2] for r in large])


def test_last_function_of_a_name_wins(spark):
    functions, _, _ = lineage(spark, "int f(int a) { a = 1; } int f(int b) { b = 2; }", "void g() {}")
    assert {(r.file, r.function, r.params) for r in functions.collect()} == {("f0.c", "f", "int b"), ("f1.c", "g", "")}


def test_merged_scopes_and_neighbours(spark):
    _, variables, edges = lineage(spark, "int f(int a) { int b = a; } long g(long b) { long c = b; }")
    nodes, links = ln.merge_scopes(ln.lineage_nodes(variables, edges), edges)
    kinds = {r.name: (r.type, r.function) for r in nodes.collect()}
    assert kinds == {"a": ("int", "f"), "b": ("long", "g"), "c": ("long", "g")}
    near = {(r.name, r.direction, r.neighbour) for r in ln.neighbours(nodes, links).collect()}
    assert near == {("b", "upstream", "a"), ("a", "downstream", "b"), ("c", "upstream", "b"), ("b", "downstream", "c")}


def test_equal_contexts_are_searched_once(spark, monkeypatch):
    from brindle.plans import lineage_plans
    from brindle.operators import retrieval

    asked = []
    search = retrieval.retrieve_topk
    monkeypatch.setattr(retrieval, "retrieve_topk", lambda queries, *rest, **more: asked.append(queries.count()) or search(queries, *rest, **more))
    contexts = spark.createDataFrame([(f"f{k}", "v", "int a" if k % 2 else "int b c") for k in range(10)], "file string, name string, context string")
    files = spark.createDataFrame([("x.c", "int a"), ("y.c", "int b c")], "path string, content string")
    got = {r.file: r.context_md5 for r in lineage_plans._with_code(contexts, files).collect()}
    assert asked == [2] and len(got) == 10 and len(set(got.values())) == 2
