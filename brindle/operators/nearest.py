"""Top-k retrieval of large query sets: exact with pruned block pairs, or approximate with an index."""

from __future__ import annotations

from collections.abc import Callable

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from brindle.functions.vectors import TopHits, comparable
from brindle.session import settle

PIVOTS = 256  # similar rows are laid into blocks around as many rows of the corpus at most
BLOCKS_OF_A_TASK = 1024  # summaries that meet in a task, on either side
MAX_TASKS = 10_000
ADDED_ROWS = 10_000  # corpus rows that a task compares at once
TILE_ROWS = 50_000  # rows of neighbouring blocks that travel and meet together, on either side
SLACK = 1e-6
BUCKET_ROWS = 256


def stack(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float)


def scorer(k: int, metric: str, ids: tuple[str, str] = ("query_id", "corpus_id")) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """The k best hits of some queries among some corpus rows. A column ``floor`` of the queries is a
    score that k rows are known to reach."""

    def score(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if q.empty or c.empty:
            return pd.DataFrame({"query_id": q[ids[0]][:0], "corpus_id": c[ids[1]][:0], "score": pd.Series(dtype=float)})
        top = TopHits(q[ids[0]].to_numpy(), stack(q["vector"]), k, metric)
        if "floor" in q:
            top.floor = np.maximum(top.floor, q["floor"].fillna(-np.inf).to_numpy())
        for start in range(0, len(c), ADDED_ROWS):
            some = c.iloc[start : start + ADDED_ROWS]
            top.add(some[ids[1]].to_numpy(), stack(some["vector"]))
        return top.result()

    return score


def bounds(q_centers: np.ndarray, q_radii: np.ndarray, c_centers: np.ndarray, c_radii: np.ndarray, metric: str) -> np.ndarray:
    """No row of a query block scores higher with any row of a corpus block: inner products by
    ``q.c + |q| R + |c| r + r R`` around the centres, squared distances by the triangle inequality."""
    dots = q_centers @ c_centers.T
    q_length, c_length = np.linalg.norm(q_centers, axis=1)[:, None], np.linalg.norm(c_centers, axis=1)[None, :]
    if metric == "l2":
        apart = np.sqrt(np.maximum(q_length**2 + c_length**2 - 2 * dots, 0))
        # Cancellation may take some digits of the distance of centres.
        near = np.maximum(apart - q_radii[:, None] - c_radii[None, :] - SLACK * (1 + q_length + c_length), 0)
        return -(near**2)
    bound = dots + q_length * c_radii[None, :] + c_length * q_radii[:, None] + q_radii[:, None] * c_radii[None, :]
    return bound + SLACK * (1 + q_length * c_length)


def _pivots(stored: DataFrame, metric: str, block_rows: int) -> np.ndarray:
    """Some rows of the corpus, the least by a hash of the id: two for each full block, but a bounded
    number, whatever its size."""
    number = max(1, min(PIVOTS, 2 * stored.count() // block_rows))
    rows = stored.select("vector", F.xxhash64("corpus_id").alias("h"), "corpus_id").orderBy("h", "corpus_id").limit(number).collect()
    return _chained(comparable(np.array([r["vector"] for r in rows], float), metric)) if rows else np.zeros((0, 0))


def _chained(points: np.ndarray) -> np.ndarray:
    """The points in an order in which each is followed by the nearest of those left."""
    order, left = [0], set(range(1, len(points)))
    while left:
        some = sorted(left)
        order.append(some[int(((points[some] - points[order[-1]]) ** 2).sum(axis=1).argmin())])
        left.remove(order[-1])
    return points[order]


def _blocked(rows: DataFrame, id_col: str, pivots: np.ndarray, metric: str, block_rows: int) -> DataFrame:
    """The rows with their block: that of the nearest pivot, cut into even parts where it is large. And
    with their tile: blocks that follow each other, of ``TILE_ROWS`` rows or a block at most, or of
    fewer where the cores would not have a pair of tiles each."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    @F.pandas_udf("int")
    def nearest(vectors: pd.Series) -> pd.Series:
        points, centers = comparable(stack(vectors), metric), shared.value
        return pd.Series((2 * points @ centers.T - (centers**2).sum(axis=1)).argmax(axis=1), index=vectors.index)

    placed = settle(rows.withColumn("pivot", nearest.asNondeterministic()("vector")), "placed")
    counts = settle(placed.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.ceil(F.count(F.lit(1)) / block_rows).alias("parts")), "pivot-counts")  # at most PIVOTS rows
    before = F.coalesce(F.sum("n").over(Window.orderBy("pivot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = counts.agg(F.sum("n")).first()[0] or 0
    tile_rows = min(TILE_ROWS, max(1, int(total / (2 * rows.sparkSession.sparkContext.defaultParallelism) ** 0.5)))
    starts = settle(counts.select("pivot", "n", "parts", before.alias("before")), "pivot-starts")
    laid = placed.join(starts, "pivot").withColumn("part", F.pmod(F.xxhash64(id_col), F.col("parts")))
    tile = F.floor((F.col("before") + F.col("part") * F.col("n") / F.col("parts")) / tile_rows)
    return settle(laid.withColumn("block", F.concat_ws("-", "pivot", "part")).withColumn("tile", tile).drop("pivot", "n", "parts", "before", "part"), "blocked")


def _summaries(blocked: DataFrame, name: str, metric: str) -> DataFrame:
    def summarize(rows: pd.DataFrame) -> pd.DataFrame:
        points = comparable(stack(rows["vector"]), metric)
        center = points.mean(axis=0)
        return pd.DataFrame({name: rows["block"][:1], "center": [center.tolist()], "radius": [float(np.linalg.norm(points - center, axis=1).max())]})

    found = blocked.select("block", "vector").groupBy("block").applyInPandas(summarize, f"{name} string, center array<double>, radius double")
    return settle(found, "summaries")


def _meeting(left: DataFrame, right: DataFrame, metric: str, pick: str) -> DataFrame:
    """``(q_block, c_block)`` out of the summaries of both sides, in tasks of bounded numbers of them:
    with ``pick`` "best" each query block's partner of the highest bound, with "open" all whose bound
    reaches the query block's floor."""
    sizes = [max(1, -(-side.count() // BLOCKS_OF_A_TASK)) for side in (left, right)]
    own = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    other = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = left.withColumn("x", own("q_block", sizes[0])).withColumn("y", other(sizes[1]))
    right = right.withColumn("y", own("c_block", sizes[1])).withColumn("x", other(sizes[0]))

    def meet(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if q.empty or c.empty:
            return pd.DataFrame({"q_block": q["q_block"][:0], "c_block": c["c_block"][:0], "bound": pd.Series(dtype=float)})
        q, c = q.sort_values("q_block").reset_index(drop=True), c.sort_values("c_block").reset_index(drop=True)
        bound = bounds(stack(q["center"]), q["radius"].to_numpy(), stack(c["center"]), c["radius"].to_numpy(), metric)
        i, j = (np.arange(len(q)), bound.argmax(axis=1)) if pick == "best" else np.nonzero(bound >= q["floor"].to_numpy()[:, None])
        return pd.DataFrame({"q_block": q["q_block"].to_numpy()[i], "c_block": c["c_block"].to_numpy()[j], "bound": bound[i, j]})

    met = left.groupBy("x", "y").cogroup(right.groupBy("x", "y")).applyInPandas(meet, "q_block string, c_block string, bound double")
    if pick == "best":
        met = met.groupBy("q_block").agg(F.max_by("c_block", F.struct("bound", "c_block")).alias("c_block"))
    return settle(met.select("q_block", "c_block"), "block-pairs")


def pruned_topk(asked: DataFrame, stored: DataFrame, k: int, metric: str, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """``(hits, pairs)``: at least the k best of ``(corpus_id, vector)`` for each of ``(query_id, vector)``,
    and the pairs of blocks that were compared.

    Either side is laid into blocks of similar rows with a centre and a radius. Every query block
    first meets the one corpus block that promises most. A block of queries and one of the corpus
    whose bound is below the k-th score that all its queries have by then are never joined. Blocks
    hold ``block_rows`` at most, by hash of the unique ids, and travel in tiles of ``TILE_ROWS`` rows
    or one block, so no task gathers more.
    """
    pivots = _pivots(stored, metric, block_rows)
    kind = asked.schema["query_id"].dataType.simpleString(), stored.schema["corpus_id"].dataType.simpleString()
    schema = f"query_id {kind[0]}, corpus_id {kind[1]}, score double"
    if not len(pivots):
        none = asked.sparkSession.createDataFrame([], schema)
        return none, asked.sparkSession.createDataFrame([], "q_block string, c_block string")
    queries = _blocked(asked, "query_id", pivots, metric, block_rows)
    corpus = _blocked(stored, "corpus_id", pivots, metric, block_rows)
    left, right = _summaries(queries, "q_block", metric), _summaries(corpus, "c_block", metric)

    q_places, c_places = (blocked.select(F.col("block").alias(f"{side}_block"), F.col("tile").alias(f"{side}_tile")).distinct() for side, blocked in (("q", queries), ("c", corpus)))
    corpus = corpus.withColumnRenamed("block", "c_block").withColumnRenamed("tile", "c_tile")

    # Every query block meets one block of the corpus.
    first = _meeting(left, right, metric, "best")
    by = ["q_block", "c_block"]
    q = queries.withColumnRenamed("block", "q_block").join(first, "q_block")
    c = corpus.join(first, "c_block").select(*by, "corpus_id", "vector")
    hits = settle(q.groupBy(*by).cogroup(c.groupBy(*by)).applyInPandas(scorer(k, metric), schema), "hits")
    floors = hits.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("floor"))
    queries = settle(queries.join(floors, "query_id", "left"), "floored")
    # A query without k hits has no floor, and then neither has its block.
    lowest = queries.groupBy(F.col("block").alias("q_block")).agg(F.min(F.coalesce("floor", F.lit(float("-inf")))).alias("floor"))
    pairs = _meeting(left.join(lowest, "q_block"), right, metric, "open")
    rest = settle(pairs.join(first, ["q_block", "c_block"], "left_anti"), "block-pairs")

    # The others meet by tiles: a block travels once to each tile of the other side in which it has a
    # partner, not once for each partner.
    by = ["q_tile", "c_tile"]
    tiled = settle(rest.join(q_places, "q_block").join(c_places, "c_block"), "tile-pairs")
    tasks = max(1, min(MAX_TASKS, 3 * tiled.select(*by).distinct().count()))
    met = first.withColumnRenamed("c_block", "met")
    goes = lambda block: tiled.select(block, *[F.col(c).alias(c) for c in by]).distinct()
    q = queries.withColumnRenamed("block", "q_block").drop("tile").join(goes("q_block"), "q_block").join(met, "q_block").repartition(tasks, *by)
    c = corpus.drop("c_tile").join(goes("c_block"), "c_block").repartition(tasks, *by)
    later = settle(q.groupBy(*by).cogroup(c.groupBy(*by)).applyInPandas(_tile_scorer(k, metric), schema), "hits")
    return hits.unionByName(later), first.unionByName(rest)


def _tile_scorer(k: int, metric: str) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """The k best hits of some blocks of queries among some blocks of the corpus. A pair of blocks is
    compared if its bound reaches the lowest ``floor`` of its queries, and if the query block has not
    ``met`` the other before."""

    def summaries(rows: pd.DataFrame, points: np.ndarray, column: str) -> tuple[list[str], list[np.ndarray], np.ndarray, np.ndarray]:
        places = rows.groupby(column, sort=True).indices
        own = list(places.values())
        centers = np.stack([points[at].mean(axis=0) for at in own])
        return list(places), own, centers, np.array([np.linalg.norm(points[at] - c, axis=1).max() for at, c in zip(own, centers, strict=True)])

    def score(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        found = [pd.DataFrame({"query_id": q["query_id"][:0], "corpus_id": c["corpus_id"][:0], "score": pd.Series(dtype=float)})]
        if q.empty or c.empty:
            return found[0]
        q_ids, c_ids, floor, met = q["query_id"].to_numpy(), c["corpus_id"].to_numpy(), q["floor"].fillna(-np.inf).to_numpy(), q["met"].to_numpy()
        asks, rows = stack(q["vector"]), stack(c["vector"])
        _, q_own, q_centers, q_radii = summaries(q, comparable(asks, metric), "q_block")
        c_names, c_own, c_centers, c_radii = summaries(c, comparable(rows, metric), "c_block")
        lowest = np.array([floor[at].min() for at in q_own])
        reach = bounds(q_centers, q_radii, c_centers, c_radii, metric) >= lowest[:, None]
        for at, open_ones in zip(q_own, reach, strict=True):
            some = [c_own[j] for j in np.flatnonzero(open_ones) if c_names[j] != met[at[0]]]
            if some:
                top = TopHits(q_ids[at], asks[at], k, metric)
                top.floor = np.maximum(top.floor, floor[at])
                some = np.concatenate(some)
                for start in range(0, len(some), ADDED_ROWS):
                    top.add(c_ids[some[start : start + ADDED_ROWS]], rows[some[start : start + ADDED_ROWS]])
                found.append(top.result())
        return pd.concat([f for f in found if len(f)] or found[:1], ignore_index=True)

    return score


def plane_signs(table: int, bit: int, dim: int) -> np.ndarray:
    """A plane of the index by rule: +1 or -1 per dimension, by the first digit of an md5."""
    return np.array([1.0 if hashlib.md5(f"{table}:{bit}:{d}".encode()).hexdigest()[0] < "8" else -1.0 for d in range(dim)])


def _codes(rows: DataFrame, tables: int, bits: int, probes: int, dim: int, metric: str) -> DataFrame:
    """The rows once per table and probe, with ``code``: on which side of each plane they lie. Probes
    after the first flip one bit, those of the planes that lie nearest first."""
    planes = np.concatenate([np.stack([plane_signs(t, b, dim) for b in range(bits)]) for t in range(tables)]) if dim else np.zeros((tables * bits, 0))
    shared = rows.sparkSession.sparkContext.broadcast(planes)

    @F.pandas_udf("array<struct<t: int, code: bigint>>")
    def coded(vectors: pd.Series) -> pd.Series:
        apart = (comparable(stack(vectors), metric) @ shared.value.T).reshape(len(vectors), tables, bits)
        own = ((apart >= 0) << np.arange(bits)).sum(axis=2)
        near = np.argsort(np.abs(apart), axis=2, kind="stable")[:, :, : probes - 1]
        every = np.concatenate([own[:, :, None], own[:, :, None] ^ (1 << near)], axis=2)
        return pd.Series([[{"t": t, "code": int(c)} for t in range(tables) for c in row[t]] for row in every], index=vectors.index)

    return rows.withColumn("bucket", F.explode(coded.asNondeterministic()("vector"))).select("*", "bucket.*").drop("bucket")


def approximate_topk(
    asked: DataFrame, stored: DataFrame, k: int, metric: str, tables: int = 6, bits: int | None = None, probes: int = 8, block_rows: int = 50_000
) -> DataFrame:
    """Hits of ``(query_id, vector)`` among the rows of ``(corpus_id, vector)`` that share a bucket of an
    index with it, k of each bucket at most, scored exactly.

    The index deals every row out to one bucket in each of ``tables``, by the sides of ``bits`` planes
    on which it lies (so many that a bucket holds some ``BUCKET_ROWS`` rows, if not given). A query
    probes its own bucket and those across the planes nearest to it. A large bucket is cut into parts,
    which each of its queries meets in a task of their own; no pairs of rows are made.
    """
    size = stored.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("dim")).first()
    bits = bits if bits is not None else int(min(48, max(1, np.ceil(np.log2(max(size["n"], 1) / BUCKET_ROWS)))))
    own = settle(_codes(stored, tables, bits, 1, size["dim"] or 0, metric), "index")
    counts = settle(own.groupBy("t", "code").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("parts")), "buckets")
    corpus = own.join(counts, ["t", "code"]).withColumn("part", F.pmod(F.xxhash64("corpus_id"), F.col("parts"))).select("t", "code", "part", "corpus_id", "vector")
    probed = _codes(asked, tables, bits, min(probes, bits + 1), size["dim"] or 0, metric).join(counts, ["t", "code"])
    # Queries of a bucket are cut as well, so that neither side of a task is unbounded.
    asks = settle(probed.groupBy("t", "code").agg(F.ceil(F.count(F.lit(1)) / block_rows).alias("asks")), "asks")
    queries = probed.join(asks, ["t", "code"]).withColumn("ask", F.pmod(F.xxhash64("query_id"), F.col("asks"))).withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
    corpus = corpus.join(asks, ["t", "code"]).withColumn("ask", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("asks") - 1)))
    kind = asked.schema["query_id"].dataType.simpleString(), stored.schema["corpus_id"].dataType.simpleString()
    by = ["t", "code", "part", "ask"]
    met = queries.select(*by, "query_id", "vector").groupBy(*by).cogroup(corpus.select(*by, "corpus_id", "vector").groupBy(*by))
    return met.applyInPandas(scorer(k, metric), f"query_id {kind[0]}, corpus_id {kind[1]}, score double").distinct()


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact hits ``(query_id, corpus_id)`` that are among the found ones."""
    both = exact.select("query_id", "corpus_id").join(found.select("query_id", "corpus_id", F.lit(1).alias("hit")).distinct(), ["query_id", "corpus_id"], "left")
    return both.agg(F.coalesce(F.avg(F.coalesce("hit", F.lit(0))), F.lit(1.0))).first()[0]


def best_k(hits: DataFrame, k: int) -> DataFrame:
    """The k best hits per query with their ``rank``, ties to the smaller id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "corpus_id")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
