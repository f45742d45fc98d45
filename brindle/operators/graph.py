"""Ancestors, centrality and focused views over many directed graphs at once.

A graph is a set of rows with equal values in the ``graph`` columns (say, a file). Iterations
write their state to the shared folder, so the plan stays short and survives lost executors.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from brindle.operators.joins import attach
from brindle.operators.ranking import top_ranked
from brindle.session import settle

# Rounds of the ancestor search after which the visited pairs are rewritten into one table.
COMPACT_EVERY = 8
# Rounds after which a search that goes on is done over compressed chains.
DEEP_AFTER = 4
# Nodes and edges of a graph that is iterated in one task, and of the graphs that share a task.
SMALL_GRAPH = 1 << 17
GRAPHS_OF_A_TASK = 1 << 20
# Edges of a graph whose nodes' neighbourhoods are looked at in one task, of those that share a task,
# and pairs of edges that are held at once.
SMALL_NEIGHBOURHOODS = 1 << 10
NEIGHBOURHOODS_OF_A_TASK = 1 << 18
PAIRS_AT_ONCE = 1 << 20


def _links(edges: DataFrame, graph: Sequence[str], unique: bool) -> DataFrame:
    """The edges without duplicates; ``unique`` says that there are none."""
    links = edges.select(*graph, "src", "dst")
    return links if unique else links.distinct()


def edge_nodes(edges: DataFrame, graph: Sequence[str]) -> DataFrame:
    """The distinct ends of all edges as ``graph..., node``."""
    return edges.select(*graph, F.explode(F.array("src", "dst")).alias("node")).distinct()


def ancestors(
    edges: DataFrame, seeds: DataFrame, graph: Sequence[str] = (), nodes: DataFrame | None = None, unique: bool = False, deep: bool = True
) -> DataFrame:
    """``graph..., seed, node``: every node from which the seed can be reached, and the seed itself.

    ``seeds`` holds ``graph..., seed``; unknown seeds give no rows. Safe on cycles: a pair enters
    the frontier once. ``unique`` edges are read once per round: they should be settled. Deep graphs
    (``deep``) are searched over compressed chains, whose ends are found by doubling: the rounds
    follow the logarithm of a chain's length, not the length.
    """
    links = edges if unique else settle(_links(edges, graph, False), "edges")
    known = (nodes if nodes is not None else edge_nodes(links, graph)).select(*graph, F.col("node").alias("seed"))
    start = seeds.select(*graph, "seed").distinct().join(known.distinct(), [*graph, "seed"], "left_semi")
    frontier = settle(start.withColumn("node", F.col("seed")), "frontier")
    pair = [*graph, "seed", "node"]
    visited = [frontier]
    while True:
        step = frontier.join(links.withColumnRenamed("dst", "node"), [*graph, "node"]).select(
            *graph, "seed", F.col("src").alias("node")
        )
        seen = reduce(DataFrame.unionByName, visited)
        frontier = settle(step.distinct().join(seen, pair, "left_anti"), "frontier")
        if frontier.isEmpty():
            return seen
        visited.append(frontier)
        if deep and len(visited) > DEEP_AFTER:
            return settle(_deep_ancestors(links, settle(start, "seeds"), graph), "ancestors")
        if len(visited) > COMPACT_EVERY:
            visited = [settle(reduce(DataFrame.unionByName, visited), "visited")]


def chains(links: DataFrame, graph: Sequence[str] = ()) -> DataFrame:
    """``graph..., node, head, place``: the chain of each node, named by its first one, and its place there.

    A link lies in a chain if it is the only one that leaves its source and the only one that reaches
    its end. Heads are found by doubling. A cycle of such links has no first node: it is named by its
    least one, and ``place`` is null.
    """
    key = [*graph]
    count = lambda c: links.groupBy(*key, F.col(c).alias("node")).agg(F.count(F.lit(1)).alias(f"n_{c}"))
    into = links.join(count("dst").where("n_dst = 1").select(*key, F.col("node").alias("dst")), [*key, "dst"], "left_semi")
    inner = into.join(count("src").where("n_src = 1").select(*key, F.col("node").alias("src")), [*key, "src"], "left_semi").where("src <> dst")
    before = inner.select(*key, F.col("dst").alias("node"), F.col("src").alias("head"))
    state = edge_nodes(links, key).join(before, [*key, "node"], "left").select(
        *key, "node", F.coalesce("head", "node").alias("head"), F.when(F.col("head").isNull(), 0).otherwise(1).cast("long").alias("place"), F.coalesce(F.least("head", "node"), "node").alias("low")
    )
    state, left = settle(state, "jump"), None
    while True:
        ahead = state.select(*key, F.col("node").alias("head"), F.col("head").alias("next"), F.col("place").alias("more"), F.col("low").alias("lower"))
        jumped = state.join(ahead, [*key, "head"]).select(
            *key, "node", F.col("next").alias("head"), (F.col("place") + F.col("more")).alias("place"), F.least("low", "lower").alias("low"), (F.col("more") > 0).alias("open"), (F.col("lower") < F.col("low")).alias("fell")
        )
        state = settle(jumped, "jump")
        # In a chain fewer nodes are open after every round; what stays open lies in cycles, where the
        # least node is known once nothing falls any more.
        now = state.agg(F.count_if("open"), F.count_if(F.col("open") & F.col("fell"))).first()
        if not now[0] or (now[0] == left and not now[1]):
            break
        left = now[0]
    cycle = F.col("open")
    return state.select(*key, "node", F.when(cycle, F.col("low")).otherwise(F.col("head")).alias("head"), F.when(~cycle, F.col("place")).alias("place"))


def _deep_ancestors(links: DataFrame, start: DataFrame, graph: Sequence[str]) -> DataFrame:
    key = [*graph]
    member = settle(chains(links, key), "chains")
    head = lambda c: member.select(*key, F.col("node").alias(c), F.col("head").alias(f"{c}_chain"), F.col("place").alias(f"{c}_place"))
    ends = links.join(head("src"), [*key, "src"]).join(head("dst"), [*key, "dst"])
    # Links between chains, and from the end of one to its own head.
    over = settle(ends.where((F.col("src_chain") != F.col("dst_chain")) | (F.col("dst_place") == 0)).select(*key, F.col("src_chain").alias("src"), F.col("dst_chain").alias("dst")).distinct(), "chain-links")
    asked = settle(start.select(*key, "seed").join(head("seed"), [*key, "seed"], "left").withColumn("seed_chain", F.coalesce("seed_chain", "seed")), "seed-chains")
    wanted = asked.select(*key, F.col("seed_chain").alias("seed"))
    every = over.select(*key, F.explode(F.array("src", "dst")).alias("node")).unionByName(wanted.select(*key, F.col("seed").alias("node"))).distinct()
    reached = settle(ancestors(over, wanted, key, nodes=every, unique=True, deep=False), "chains-reached")
    # A chain that leads on to one of its ancestors, or to its own head, is reached whole.
    back = reached.withColumnsRenamed({"seed": "src", "node": "dst"}).join(over, [*key, "src", "dst"], "left_semi").select(*key, F.col("src").alias("seed_chain"), F.lit(True).alias("whole")).distinct()
    own = asked.join(back, [*key, "seed_chain"], "left").join(member.select(*key, F.col("head").alias("seed_chain"), "node", "place"), [*key, "seed_chain"])
    own = own.where(F.col("whole") | F.col("place").isNull() | (F.col("place") <= F.col("seed_place"))).select(*key, "seed", "node")
    others = reached.where("seed <> node").select(*key, F.col("seed").alias("seed_chain"), F.col("node").alias("head")).join(asked.select(*key, "seed", "seed_chain"), [*key, "seed_chain"])
    others = others.join(member.select(*key, "head", "node"), [*key, "head"]).select(*key, "seed", "node")
    alone = asked.where(F.col("seed_place").isNull()).join(member.select(*key, F.col("node").alias("seed")), [*key, "seed"], "left_anti").select(*key, "seed", F.col("seed").alias("node"))
    return own.unionByName(others).unionByName(alone)


def ancestor_subgraph(edges: DataFrame, reached: DataFrame, graph: Sequence[str] = (), unique: bool = False) -> DataFrame:
    """``graph..., seed, src, dst``: the edges among a seed's ancestors.

    A predecessor of an ancestor is an ancestor, so only the head of the edge is looked up.
    """
    heads = reached.select(*graph, "seed", F.col("node").alias("dst"))
    return _links(edges, graph, unique).join(heads, [*graph, "dst"]).select(*graph, "seed", "src", "dst")


def degree_centrality(
    edges: DataFrame, graph: Sequence[str] = (), nodes: DataFrame | None = None, unique: bool = False
) -> DataFrame:
    """``graph..., node, centrality``: (in + out edges) / (nodes - 1), and 1 for a lonely node."""
    links = _links(edges, graph, unique)
    ends = links.select(*graph, F.explode(F.array("src", "dst")).alias("node")).withColumn("one", F.lit(1))
    if nodes is not None:
        ends = ends.unionByName(nodes.select(*graph, "node").withColumn("one", F.lit(0)))
    degrees = settle(ends.groupBy(*graph, "node").agg(F.sum("one").alias("degree")), "degrees")
    counts = degrees.groupBy(*graph).agg(F.count(F.lit(1)).alias("n"))
    sized = attach(degrees, settle(counts, "node-counts"), graph) if graph else degrees.withColumn(
        "n", degrees.agg(F.count(F.lit(1))).scalar()
    )
    value = F.when(F.col("n") <= 1, F.lit(1.0)).otherwise(F.try_divide(F.col("degree"), F.col("n") - 1))
    return sized.select(*graph, "node", value.alias("centrality"))


def power_iteration(graph_of: np.ndarray, src: np.ndarray, dst: np.ndarray, max_iter: int, tol: float) -> tuple[np.ndarray, np.ndarray]:
    """Values and convergence of all nodes of many graphs at once.

    ``graph_of`` is the number of each node's graph, ``src`` and ``dst`` are numbers of nodes. Graphs
    that have converged keep their values and leave the iteration.
    """
    size = np.bincount(graph_of) if len(graph_of) else np.zeros(0, np.int64)
    x = 1.0 / size[graph_of]
    converged = np.zeros(len(size), bool)
    # Of the graphs that are still iterated: places of their nodes, their graphs and values.
    place, own, now = np.arange(len(x)), graph_of, x.copy()
    for _ in range(max_iter):
        if not len(place):
            break
        y = now + np.bincount(dst, weights=now[src], minlength=len(now))
        length = np.sqrt(np.bincount(own, weights=y**2, minlength=len(size)))
        fresh = y / np.where(length > 0, length, 1.0)[own]
        moved = np.bincount(own, weights=np.abs(fresh - now), minlength=len(size))
        now = fresh
        done = np.zeros(len(size), bool)
        done[own] = moved[own] < size[own] * tol
        if done.any():
            converged |= done
            x[place] = now
            still = ~done[own]
            edges = still[src]
            number = np.cumsum(still) - 1
            src, dst = number[src[edges]], number[dst[edges]]
            place, own, now = place[still], own[still], now[still]
    x[place] = now
    return x, converged[graph_of]


def degree_shares(graph_of: np.ndarray, src: np.ndarray, dst: np.ndarray) -> np.ndarray:
    """Degree centrality of all nodes of many graphs at once, numbered as in :func:`power_iteration`."""
    if not len(graph_of):
        return np.zeros(0)
    degree = np.bincount(src, minlength=len(graph_of)) + np.bincount(dst, minlength=len(graph_of))
    others = np.bincount(graph_of)[graph_of] - 1
    return np.where(others > 0, degree / np.maximum(others, 1), 1.0)


def _small_graphs(links: DataFrame, members: DataFrame, key: Sequence[str], max_iter: int, tol: float) -> DataFrame:
    """``x``, ``converged`` and ``by_degree`` (:func:`degree_centrality`) of graphs of bounded size, many of
    them in a task."""
    rows = members.count() + links.count()
    bucket = F.pmod(F.xxhash64(*key), F.lit(max(1, -(-rows // GRAPHS_OF_A_TASK)))).alias("__bucket")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in members.schema.fields if f.name in (*key, "node"))

    def iterate(nodes: pd.DataFrame, edges: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values([*key, "node"], kind="stable").reset_index(drop=True)
        ends = [edges[[*key, c]].rename(columns={c: "node"}) for c in ("src", "dst")]
        # Numbers of nodes in order of appearance: those of ``nodes`` come first.
        number = pd.concat([nodes[[*key, "node"]], *ends], ignore_index=True).groupby([*key, "node"], sort=False, dropna=False).ngroup().to_numpy()
        n, m = len(nodes), len(edges)
        own = nodes.groupby([*key], sort=False, dropna=False).ngroup().to_numpy()
        x, converged = power_iteration(own, number[n : n + m], number[n + m :], max_iter, tol)
        by_degree = degree_shares(own, number[n : n + m], number[n + m :])
        return nodes[[c for c in nodes.columns if c in (*key, "node")]].assign(x=x, converged=converged, by_degree=by_degree)

    dealt = members.select(*key, "node", bucket).groupBy("__bucket").cogroup(links.select(*key, "src", "dst", bucket).groupBy("__bucket"))
    return dealt.applyInPandas(iterate, f"{kinds}, x double, converged boolean, by_degree double")


def eigenvector_centrality(
    edges: DataFrame,
    graph: Sequence[str] = (),
    nodes: DataFrame | None = None,
    max_iter: int = 100,
    tol: float = 1e-6,
) -> DataFrame:
    """``graph..., node, centrality, converged`` by power iteration over in-edges.

    A round adds to every node the values of its predecessors and scales the graph to length one,
    starting from equal values. A graph is finished when the values moved less than ``tol`` per
    node; graphs that are not after ``max_iter`` rounds have ``converged = false``.

    Graphs of up to ``SMALL_GRAPH`` nodes and edges are iterated in the tasks, many at once, in one
    job; larger ones in rounds of joins. Both compute the same sums.
    """
    result = _centralities(edges, graph, nodes, max_iter, tol)
    return result.select(*graph, "node", _ten_digits("x").alias("centrality"), "converged")


def _ten_digits(x: str) -> Column:
    """What the order of a sum changes does not come out, and equal nodes have equal values."""
    return F.format_string("%.9e", x).cast("double")


def _centralities(edges: DataFrame, graph: Sequence[str], nodes: DataFrame | None, max_iter: int, tol: float = 1e-6, closed: bool = False) -> DataFrame:
    """``graph..., node, x, converged, by_degree``: both centralities of every node. With ``closed`` the edges
    are unique, ``nodes`` holds every end of them once, and both are settled."""
    key = [*graph] or ["__all"]
    whole = (lambda df: df) if graph else (lambda df: df.withColumn("__all", F.lit(0)))
    links = whole(edges).select(*key, "src", "dst")
    if closed:
        members = whole(nodes).select(*key, "node")
    else:
        links = settle(links.distinct(), "edges")
        members = edge_nodes(links, key)
        if nodes is not None:
            members = members.unionByName(whole(nodes).select(*key, "node")).distinct()
        members = settle(members, "graph-nodes")
    held = members.select(*key, F.lit(1).alias("n"), F.lit(0).alias("m")).unionByName(links.select(*key, F.lit(0).alias("n"), F.lit(1).alias("m")))
    counts = held.groupBy(*key).agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    large = settle(counts.where(F.col("n") + F.col("m") > SMALL_GRAPH), "large-graphs")
    result = _small_graphs(attach(links, large, key, "left_anti"), attach(members, large, key, "left_anti"), key, max_iter, tol)
    result = settle(result, "centrality")
    if not large.isEmpty():
        links, members = attach(links, large, key, "left_semi"), attach(members, large, key, "left_semi")
        power = _large_graphs(links, members, large.drop("m"), key, max_iter, tol)
        degree = degree_centrality(links, key, members, unique=True).withColumnsRenamed({"node": "__side_node", "centrality": "by_degree", **{c: f"__side_{c}" for c in key}})
        same = reduce(lambda a, b: a & b, [power[c].eqNullSafe(degree[f"__side_{c}"]) for c in (*key, "node")])
        result = result.unionByName(power.join(degree, same).select(*key, "node", "x", "converged", "by_degree"))
    return result


def _large_graphs(links: DataFrame, members: DataFrame, counts: DataFrame, key: Sequence[str], max_iter: int, tol: float) -> DataFrame:
    """Eigenvector centrality in rounds of joins: no graph lies in one task."""
    state = settle(attach(members, counts, key).select(*key, "node", (1 / F.col("n")).alias("x")), "centrality")
    finished: list[DataFrame] = []
    for _ in range(max_iter):
        passed = state.withColumnsRenamed({"node": "src"}).join(links, [*key, "src"]).select(
            *key, F.col("dst").alias("node"), "x", F.lit(None).cast("double").alias("old")
        )
        sums = state.withColumn("old", F.col("x")).unionByName(passed).groupBy(*key, "node").agg(
            F.sum("x").alias("x"), F.max("old").alias("old")
        )
        sums = settle(sums, "centrality")
        lengths = settle(sums.groupBy(*key).agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("length")), "lengths")
        scale = F.when(F.col("length") > 0, F.col("length")).otherwise(1.0)
        scaled = attach(sums, lengths, key).select(*key, "node", (F.col("x") / scale).alias("x"), "old")
        moved = scaled.groupBy(*key).agg(F.sum(F.abs(F.col("x") - F.col("old"))).alias("moved"), F.count(F.lit(1)).alias("n"))
        still = settle(moved.filter(F.col("moved") < F.col("n") * tol).select(*key), "converged")
        state = scaled.drop("old")
        if not still.isEmpty():
            finished.append(attach(state, still, key, "left_semi").withColumn("converged", F.lit(True)))
            state = settle(attach(state, still, key, "left_anti"), "centrality")
            if state.isEmpty():
                break
    else:
        finished.append(state.withColumn("converged", F.lit(False)))
    return reduce(DataFrame.unionByName, finished)


def node_centrality(
    edges: DataFrame,
    graph: Sequence[str] = (),
    nodes: DataFrame | None = None,
    method: str = "eigenvector",
    max_iter: int = 100,
    unique: bool = False,
    closed: bool = False,
) -> DataFrame:
    """Eigenvector centrality, replaced by degree centrality for graphs that do not converge.

    ``closed`` says that the edges are unique, that ``nodes`` holds every end of them once, and that
    both are settled: then neither is written again.
    """
    if method == "degree":
        return degree_centrality(edges, graph, nodes, unique)
    if method != "eigenvector":
        raise ValueError(f"method must be 'eigenvector' or 'degree', not {method!r}")
    both = _centralities(edges, graph, nodes, max_iter, closed=closed)
    return both.select(*graph, "node", F.when(F.col("converged"), _ten_digits("x")).otherwise(F.col("by_degree")).alias("centrality"))


def neighbour_edges(edges: DataFrame, graph: Sequence[str] = (), unique: bool = False) -> DataFrame:
    """``graph..., center, direction, src, dst``: the edges that a node's predecessors (``upstream``) or
    successors (``downstream``) have among themselves.

    Such an edge closes a triangle. Triangles are found by joining edges that lead from the end of
    fewer neighbours to that of more: there a node has at most about the square root of twice the
    number of edges, so a hub makes no pairs of its neighbours.
    """
    key = [*graph]
    links = edges if unique else settle(_links(edges, graph, False), "edges")
    plain = links.where("src <> dst")
    pairs = plain.groupBy(*key, F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b")).agg(
        F.bool_or(F.col("src") < F.col("dst")).alias("ab"), F.bool_or(F.col("src") > F.col("dst")).alias("ba")
    )
    pairs = settle(pairs, "pairs")
    degrees = settle(pairs.select(*key, F.explode(F.array("a", "b")).alias("node")).groupBy(*key, "node").agg(F.count(F.lit(1)).alias("degree")), "degrees")
    end = lambda c: degrees.select(*key, F.col("node").alias(c), F.struct("degree", "node").alias(f"rank_{c}"))
    ranked = pairs.join(end("a"), [*key, "a"]).join(end("b"), [*key, "b"])
    up = F.col("rank_a") < F.col("rank_b")
    turned = lambda x, y: F.when(up, F.col(x)).otherwise(F.col(y))
    oriented = settle(ranked.select(*key, turned("a", "b").alias("p"), turned("b", "a").alias("q"), turned("ab", "ba").alias("pq"), turned("ba", "ab").alias("qp")), "oriented")
    other = oriented.select(*key, "p", F.col("q").alias("r"), F.col("pq").alias("pr"), F.col("qp").alias("rp"))
    wedges = oriented.join(other, [*key, "p"]).where("q < r")
    closed = wedges.join(pairs.select(*key, F.col("a").alias("q"), F.col("b").alias("r"), F.col("ab").alias("qr"), F.col("ba").alias("rq")), [*key, "q", "r"])
    # Of a triangle every way a -> b, b -> c, a -> c counts: a -> b among those before c, b -> c among
    # those after a.
    ways = F.array(*[F.struct((F.col(x + y) & F.col(y + z) & F.col(x + z)).alias("is"), F.col(x).alias("a"), F.col(y).alias("b"), F.col(z).alias("c")) for x, y, z in ("pqr", "prq", "qpr", "qrp", "rpq", "rqp")])
    found = closed.select(*key, F.explode(F.filter(ways, lambda w: w["is"])).alias("w"))
    said = lambda center, direction, src, dst: F.struct(F.col(center).alias("center"), F.lit(direction).alias("direction"), F.col(src).alias("src"), F.col(dst).alias("dst"))
    induced = found.select(*key, F.explode(F.array(said("w.c", "upstream", "w.a", "w.b"), said("w.a", "downstream", "w.b", "w.c"))).alias("e")).select(*key, "e.*")
    # A node with a loop is its own neighbour: its loop is among its neighbours' edges, and so are its
    # edges to and from these.
    loops = links.where("src = dst").select(*key, F.col("src").alias("loop"))
    leaving, coming = (plain.withColumnRenamed(c, "loop").join(loops, [*key, "loop"]).select(*key, "loop", F.col(d).alias("far")) for c, d in (("src", "dst"), ("dst", "src")))
    mutual = leaving.join(coming, [*key, "loop", "far"], "left_semi")
    one = lambda df, center, direction, src, dst: df.select(*key, F.col(center).alias("center"), F.lit(direction).alias("direction"), F.col(src).alias("src"), F.col(dst).alias("dst"))
    parts = [
        one(leaving, "far", "upstream", "loop", "loop"), one(coming, "far", "downstream", "loop", "loop"),
        one(loops, "loop", "upstream", "loop", "loop"), one(loops, "loop", "downstream", "loop", "loop"),
        one(coming, "loop", "upstream", "far", "loop"), one(mutual, "loop", "upstream", "loop", "far"),
        one(leaving, "loop", "downstream", "loop", "far"), one(mutual, "loop", "downstream", "far", "loop"),
    ]
    return reduce(DataFrame.unionByName, parts, induced)


def neighbour_centrality(edges: DataFrame, graph: Sequence[str] = (), max_iter: int = 100) -> DataFrame:
    """``graph..., node, direction, neighbour, centrality``: how central each neighbour of a node is among
    the node's predecessors (``upstream``) or successors (``downstream``).

    The measure is that of :func:`node_centrality` on the graph that these neighbours induce:
    eigenvector centrality, degree centrality where it does not converge, 1 for a single one.
    """
    links = settle(_links(edges, graph, False), "edges")
    if not graph:
        return _wide_neighbourhoods(links, graph, max_iter)
    large = settle(links.groupBy(*graph).agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > SMALL_NEIGHBOURHOODS), "large-graphs")
    near = _small_neighbourhoods(attach(links, large, graph, "left_anti"), graph, links.count(), max_iter)
    value = F.when(F.col("converged"), _ten_digits("x")).otherwise(F.col("by_degree"))
    near = settle(near.select(*graph, "node", "direction", "neighbour", value.alias("centrality")), "centrality")
    if large.isEmpty():
        return near
    wide = _wide_neighbourhoods(settle(attach(links, large, graph, "left_semi"), "edges"), graph, max_iter)
    return near.unionByName(wide.select(near.columns))


def _small_neighbourhoods(links: DataFrame, graph: Sequence[str], rows: int, max_iter: int, tol: float = 1e-6) -> DataFrame:
    """The neighbourhoods of all nodes of graphs of few edges, many graphs in a task: the edges of a
    graph are sent once, and what its nodes' neighbours have among themselves is found there."""
    key = [*graph]
    bucket = F.pmod(F.xxhash64(*key), F.lit(max(1, -(-rows // NEIGHBOURHOODS_OF_A_TASK)))).alias("__bucket")
    kinds = ", ".join(f"`{c}` {links.schema[c].dataType.simpleString()}" for c in key)
    name = links.schema["src"].dataType.simpleString()

    def near(edges: pd.DataFrame) -> pd.DataFrame:
        own = edges.groupby(key, sort=False, dropna=False).ngroup().to_numpy()
        size = np.bincount(own)
        portion = ((np.cumsum(size * size // 4) - size * size // 4) // PAIRS_AT_ONCE)[own]
        parts = [_views(edges[portion == p].reset_index(drop=True), own[portion == p], key, max_iter, tol) for p in np.unique(portion)]
        return pd.concat(parts, ignore_index=True)

    dealt = links.select(*key, "src", "dst", bucket).groupBy("__bucket")
    return dealt.applyInPandas(near, f"{kinds}, node {name}, direction string, neighbour {name}, x double, converged boolean, by_degree double")


def _views(edges: pd.DataFrame, own: np.ndarray, key: Sequence[str], max_iter: int, tol: float) -> pd.DataFrame:
    """Each node's neighbours, before and after it, with their centralities among themselves. ``own`` is
    the number of each edge's graph."""
    m = len(edges)
    ends = pd.concat([edges["src"], edges["dst"]], ignore_index=True)
    codes = pd.factorize(ends, use_na_sentinel=False)[0]
    node = np.unique(np.concatenate([own, own]) * (int(codes.max()) + 1) + codes, return_inverse=True)[1]
    src, dst, n = node[:m], node[m:], int(node.max()) + 1
    # Every way x -> y, y -> c, x -> c: x -> y is an edge among those before c, y -> c among those after x.
    order = np.argsort(src, kind="stable")
    first = np.searchsorted(src[order], np.arange(n + 1))
    follow = np.diff(first)[dst]
    edge = np.repeat(np.arange(m), follow)
    x, y = src[edge], dst[edge]
    c = dst[order[first[y] + np.arange(len(edge)) - np.repeat(np.cumsum(follow) - follow, follow)]]
    known = np.sort(src * n + dst)
    at = np.minimum(np.searchsorted(known, x * n + c), m - 1)
    closed = known[at] == x * n + c
    x, y, c = x[closed], y[closed], c[closed]
    # Views: twice the number of the centre, and one more for those after it.
    view, member = np.concatenate([2 * dst, 2 * src + 1]), np.concatenate([src, dst])
    names = view * n + member
    order = np.argsort(names, kind="stable")
    place = lambda v, who: np.searchsorted(names[order], v * n + who)
    a, b = (np.concatenate([place(2 * c, p), place(2 * x + 1, q)]) for p, q in ((x, y), (y, c)))
    graph_of = np.unique(view[order], return_inverse=True)[1]
    values, converged = power_iteration(graph_of, a, b, max_iter, tol)
    edge, up = order % m, order < m
    source, target = edges["src"].to_numpy()[edge], edges["dst"].to_numpy()[edge]
    return edges[[*key]].iloc[edge].reset_index(drop=True).assign(
        node=np.where(up, target, source), direction=np.where(up, "upstream", "downstream"), neighbour=np.where(up, source, target),
        x=values, converged=converged, by_degree=degree_shares(graph_of, a, b),
    )


def _wide_neighbourhoods(links: DataFrame, graph: Sequence[str], max_iter: int) -> DataFrame:
    """The same for graphs of any size, in joins."""
    view = [*graph, "center", "direction"]
    members = links.select(*graph, F.col("dst").alias("center"), F.lit("upstream").alias("direction"), F.col("src").alias("node")).unionByName(
        links.select(*graph, F.col("src").alias("center"), F.lit("downstream").alias("direction"), F.col("dst").alias("node"))
    )
    members = settle(members, "neighbours")
    among = settle(neighbour_edges(links, graph, unique=True), "neighbour-edges")
    scored = node_centrality(among, view, members, "eigenvector", max_iter, unique=True, closed=True)
    return scored.withColumnRenamed("node", "neighbour").withColumnRenamed("center", "node")


def top_central(centrality: DataFrame, groups: Sequence[str] = (), n: int = 25) -> DataFrame:
    """The n most central nodes per group, ties by name."""
    if not groups:
        return centrality.orderBy(F.desc("centrality"), "node").limit(n)
    return top_ranked(centrality, groups, [F.desc("centrality"), F.col("node")], n)


def focused_view(
    edges: DataFrame,
    seeds: DataFrame,
    graph: Sequence[str] = (),
    n: int = 25,
    show_all: bool = False,
    method: str = "eigenvector",
    max_iter: int = 100,
    nodes: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(nodes, edges)`` of every seed's ancestor graph, cut to its n most central nodes.

    Nodes carry ``style``: constant, variable or target. ``truncated`` tells that the whole graph
    has more than n nodes.
    """
    links = settle(_links(edges, graph, False), "edges")
    reached = ancestors(links, seeds, graph, nodes, unique=True)  # already written, pair by pair
    view = [*graph, "seed"]
    among = settle(ancestor_subgraph(links, reached, graph, unique=True), "subgraph")
    sizes = settle(reached.groupBy(*view).agg((F.count(F.lit(1)) > n).alias("truncated")), "view-sizes")
    shown = reached
    if not show_all:
        # A predecessor of an ancestor is one: the reached nodes hold all ends.
        scored = node_centrality(among, view, reached, method, max_iter, unique=True, closed=True)
        shown = settle(top_central(scored, view, n).select(*view, "node"), "shown")
        among = among.join(shown.withColumnRenamed("node", "src"), [*view, "src"], "left_semi").join(
            shown.withColumnRenamed("node", "dst"), [*view, "dst"], "left_semi"
        )
    style = (
        F.when(F.startswith("node", F.lit("Constant:")), "constant").when(F.col("node") == F.col("seed"), "target").otherwise("variable")
    )
    return attach(shown.withColumn("style", style), sizes, view), among.select(*view, "src", "dst")
