"""Exact inner-product top-k with one ball tree per shard and branch and bound.

Rows are dealt out to shards of bounded size, each with its tree; queries are dealt out to blocks.
Blocks meet shards in a grid of cells, so either side is copied once per row or column of the grid.
Every block first searches one shard; the k-th score found there is a lower bound that all cells
start from, and inside a cell the bound goes from shard to shard. Nodes are visited in the order of
their upper bound ``q.c + |q| r`` and left out below the current k-th score.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from brindle.llm.arrowtext import batch
from brindle.session import settle

LEAF = 256
SHARD_VALUES = 1 << 20  # components of the vectors of one shard
BLOCK_ROWS = 1024
LOWEST = np.iinfo(np.int64).min


class BallTree:
    """Centres and radii of nested halves of a set of vectors; leaves are ranges of rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, centers=None, radii=None, parents=None, begins=None, ends=None):
        self.ids, self.vectors = ids, vectors
        if centers is None:
            self._grow()
        else:
            self.centers, self.radii, self.parents, self.begins, self.ends = centers, radii, parents, begins, ends
        self.leaves = np.setdiff1d(np.arange(len(self.parents)), self.parents)

    def _grow(self) -> None:
        points = self.vectors.astype(np.float64)
        order = np.arange(len(points))
        nodes: list[tuple[np.ndarray, float, int, int, int]] = []
        stack = [(0, len(points), -1)]
        while stack:
            begin, end, parent = stack.pop()
            own = points[order[begin:end]]
            center = own.mean(axis=0) if len(own) else np.zeros(points.shape[1])
            apart = np.linalg.norm(own - center, axis=1)
            nodes.append((center, float(apart.max(initial=0.0)), parent, begin, end))
            if end - begin > LEAF and apart.max() > 0:
                # Split at the median along the line between two far points.
                one = own[apart.argmax()]
                other = own[np.linalg.norm(own - one, axis=1).argmax()]
                half = (end - begin) // 2
                order[begin:end] = order[begin:end][np.argpartition(own @ (other - one), half)]
                here = len(nodes) - 1
                stack += [(begin, begin + half, here), (begin + half, end, here)]
        self.ids, self.vectors = self.ids[order], self.vectors[order]
        self.centers = np.array([n[0] for n in nodes])
        self.radii, self.parents, self.begins, self.ends = (np.array([n[k] for n in nodes]) for k in range(1, 5))

    def image(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, ids=self.ids, vectors=self.vectors, centers=self.centers, radii=self.radii, parents=self.parents, begins=self.begins, ends=self.ends)
        return out.getvalue()

    @classmethod
    def load(cls, image: bytes) -> BallTree:
        with np.load(io.BytesIO(image)) as saved:
            return cls(**saved)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Upper bounds of the scores below each leaf, for each query; a node's bound holds below it."""
        points = queries.astype(np.float64)
        length = np.linalg.norm(points, axis=1)[:, None]
        dots = points @ self.centers.T
        reach = length * self.radii
        # Rounding must not take a bound below a score.
        bound = dots + reach + 1e-9 * (np.abs(dots) + reach + length * np.linalg.norm(self.centers, axis=1)) + 1e-6
        for node in range(1, len(self.parents)):  # parents come before their children
            np.minimum(bound[:, node], bound[:, self.parents[node]], out=bound[:, node])
        return bound[:, self.leaves]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products; in floating point where every sum is below 2**53."""
    if float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1] < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a.astype(np.int64) @ b.T.astype(np.int64)


class TopK:
    """The best ``k`` (score, id) of each of ``n`` queries so far."""

    def __init__(self, n: int, k: int, floor: np.ndarray | None = None):
        self.k = k
        self.row, self.id, self.score = (np.zeros(0, np.int64) for _ in range(3))
        self.floor = np.full(n, LOWEST) if floor is None else floor.copy()

    def add(self, row: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        row, ids, score = np.append(self.row, row), np.append(self.id, ids), np.append(self.score, score)
        order = np.lexsort((ids, -score, row))
        row, ids, score = row[order], ids[order], score[order]
        first = np.flatnonzero(np.diff(row, prepend=-1))
        nth = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
        keep = nth < self.k
        self.row, self.id, self.score = row[keep], ids[keep], score[keep]
        last = nth == self.k - 1
        self.floor[row[last]] = np.maximum(self.floor[row[last]], score[last])


def search(tree: BallTree, queries: np.ndarray, query_ids: np.ndarray, best: TopK) -> None:
    """Visit the leaves of every query from the highest bound down, twice as many in each round,
    until the next bound is below its k-th score. Ties are kept: a smaller id may still win."""
    if not len(tree.ids) or not len(queries):
        return
    width = max(tree.vectors.shape[1], queries.shape[1])
    queries = np.pad(queries, ((0, 0), (0, width - queries.shape[1])))
    vectors = np.pad(tree.vectors, ((0, 0), (0, width - tree.vectors.shape[1])))
    if tree.centers.shape[1] < width:
        tree.centers = np.pad(tree.centers, ((0, 0), (0, width - tree.centers.shape[1])))
    bound = tree.bounds(queries)
    order = np.argsort(-bound, axis=1, kind="stable")
    ordered = np.take_along_axis(bound, order, axis=1)
    done, step = 0, 1
    while done < order.shape[1]:
        open_ = ordered[:, done : done + step] >= best.floor[:, None]
        if not open_.any():
            return
        row, nth = np.nonzero(open_)
        leaf = order[row, done + nth]
        by = np.argsort(leaf, kind="stable")
        row, leaf = row[by], leaf[by]
        cuts = np.flatnonzero(np.diff(leaf, prepend=-1))
        found = []
        for a, b in zip(cuts, [*cuts[1:], len(leaf)], strict=True):
            node = tree.leaves[leaf[a]]
            begin, end = int(tree.begins[node]), int(tree.ends[node])
            some = row[a:b]
            score = products(queries[some], vectors[begin:end])
            good = (score >= best.floor[some][:, None]) & (tree.ids[begin:end] != query_ids[some][:, None])
            x, y = np.nonzero(good)
            found.append((some[x], tree.ids[begin:end][y], score[x, y]))
        best.add(*(np.concatenate([f[k] for f in found]) for k in range(3)))
        done, step = done + step, step * 2


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors as rows, shorter ones filled up with zeros."""
    rows = [np.asarray(v.values, dtype=np.int64) for v in column]
    out = np.zeros((len(rows), max(map(len, rows), default=0)), np.int64)
    for k, r in enumerate(rows):
        out[k, : len(r)] = r
    small = np.abs(out).max(initial=0) < 1 << 15
    return out.astype(np.int16) if small else out


def exact_topk(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vec_col: str = "vector") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows of highest integer inner product with each
    query row, ties to the smaller id; all other rows, if there are fewer.

    ``vectors`` are arrays of integers. Rows of null id, of null vector or of a vector that holds a
    null take no part. Rows of a query's own id are not its candidates; rows of one id otherwise
    count one by one, and each query row has its own result. Shorter vectors count as filled up
    with zeros, the empty one scores 0. Scores are exact while the sums fit in 64 bits, and wrap
    beyond. No queries, or an empty table, give an empty result. Other columns are dropped.
    """
    spark = vectors.sparkSession
    vec = F.col(vec_col).cast("array<long>")
    usable = F.col(id_col).isNotNull() & vec.isNotNull() & F.coalesce(~F.exists(vec, lambda x: x.isNull()), F.lit(False))
    rows = vectors.where(usable).select(F.col(id_col).cast("long").alias("id"), vec.alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("d"), F.count_if("asks").alias("q")).first()
    shards = max(1, -(-size["n"] * max(size["d"] or 1, 1) // SHARD_VALUES))
    blocks = max(1, -(-size["q"] // BLOCK_ROWS))
    # Dealt out by position, not by id: rows of one id do not gather.
    dealt = rows.withColumn("at", F.monotonically_increasing_id())

    def grow(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        ids = table["id"].to_numpy()
        tree = BallTree(ids, _matrix(table["vector"].combine_chunks()))
        return pa.table({"shard": pa.array([table["shard"][0].as_py()], pa.int64()), "tree": pa.array([tree.image()], pa.binary())})

    def gather(table: pa.Table) -> pa.Table:
        out = io.BytesIO()
        np.savez(out, ids=table["id"].to_numpy(), vectors=_matrix(table["vector"].combine_chunks()))
        return pa.table({"block": pa.array([table["block"][0].as_py()], pa.int64()), "queries": pa.array([out.getvalue()], pa.binary())})

    trees = dealt.withColumn("shard", F.pmod("at", F.lit(shards))).select("shard", "id", "vector").groupBy("shard").applyInArrow(grow, "shard long, tree binary")
    asked = dealt.where("asks").withColumn("block", F.pmod(F.xxhash64("at"), F.lit(blocks))).select("block", "id", "vector").groupBy("block").applyInArrow(gather, "block long, queries binary")
    trees, asked = settle(trees, "trees"), settle(asked, "queries")

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Shards of one block follow each other; its results go out when the next block begins."""
        block, ids, points, best = None, None, None, None

        def result() -> pa.RecordBatch:
            return batch({"block": pa.array(np.full(len(best.row), block), pa.int64()), "row": best.row, "query_id": ids[best.row], "vec_id": best.id, "score": best.score})

        for part in batches:
            for r in range(part.num_rows):
                if part.column("block")[r].as_py() != block:
                    if block is not None:
                        yield result()
                    block = part.column("block")[r].as_py()
                    with np.load(io.BytesIO(part.column("queries")[r].as_py())) as saved:
                        ids, points = saved["ids"], saved["vectors"]
                    floor = part.column("floor")[r].values
                    best = TopK(len(ids), k, None if floor is None else np.asarray(floor, np.int64))
                search(BallTree.load(part.column("tree")[r].as_py()), points, ids, best)
        if block is not None:
            yield result()

    kinds = "block long, row long, query_id long, vec_id long, score long"
    nothing = F.lit(None).cast("array<long>")
    one = asked.withColumn("shard", F.pmod("block", F.lit(shards))).withColumn("floor", nothing).join(trees, "shard")
    seeds = one.mapInArrow(answer, kinds).groupBy("block", "row").agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
    floors = seeds.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("row", F.coalesce("floor", F.lit(int(LOWEST))).alias("floor")))).alias("found"))
    # A query without any candidate in that shard has no row in its block: its floor is the lowest.
    by_row = F.map_from_entries("found")
    seeded = asked.join(floors, "block", "left").withColumn(
        "floor", F.when(F.col("found").isNotNull(), F.transform(F.sequence(F.lit(0).cast("long"), F.array_max(F.map_keys(by_row))), lambda x: F.coalesce(by_row[x], F.lit(int(LOWEST)))))
    )
    seeded = settle(seeded.select("block", "queries", "floor"), "floors")
    # Few pairs are spread one to a cell; many share cells of 8 by 8, to copy less.
    span = 1 if shards * blocks <= 1024 else 8
    down, across = -(-shards // span), -(-blocks // span)
    cells_of_tree = trees.withColumn("x", F.floor(F.col("shard") / span)).withColumn("y", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
    cells_of_block = seeded.withColumn("y", F.floor(F.col("block") / span)).withColumn("x", F.explode(F.sequence(F.lit(0), F.lit(down - 1))))
    met = cells_of_tree.select("x", F.col("y").cast("long").alias("y"), "tree").join(cells_of_block.select(F.col("x").cast("long").alias("x"), "y", "block", "queries", "floor"), ["x", "y"])
    found = met.repartition(min(down * across, 4096 * 4), "x", "y").sortWithinPartitions("x", "y", "block").mapInArrow(answer, kinds)
    rank = F.row_number().over(Window.partitionBy("block", "row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
