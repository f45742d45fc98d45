"""Exact range join of vectors by cosine, in metric cells.

On the unit sphere ``cosine >= t`` is a distance of at most ``r = sqrt(2 - 2 t)``. Equal vectors are one
class with a weight. Cells that are too large are partitioned by pivots drawn from them: a vector
belongs to its nearest pivot, and visits those other cells that may hold a vector within ``r`` of it.
The triangle inequality tells which: ``d(v, q) <= R_q + r`` and ``d(v, q) >= L_q - r``, with the
greatest and least distances of the cell's own vectors from its pivot, and ``d(v, q) <= d(v, p) + 2 r``
for every other pivot. Of two cells only the vectors of the wider one visit the other, so each pair
meets once. Vectors within ``r / 2`` of a pivot form a core: they all link with each other and are
counted without being compared. Cells then join independently, block by block.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from brindle.llm.arrowtext import batch, sums
from brindle.llm.components import components
from brindle.llm.hubs import join_hubs
from brindle.session import settle

CELL_ROWS = 2048  # own vectors of a cell that is not partitioned further, and of a block
SLICE_ROWS = 8192  # vectors of one cell that a task measures at a time
MOST_PIVOTS = 32
SLACK = 1e-6  # of distances, far above their rounding errors

_SIGNED = "id long, cell string, class binary, vec binary, n long"
_STATE = "cell string, class binary, weight long, vec binary, own boolean"


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, scaled by their largest component first so that no square overflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of unit vectors; off by less than ``SLACK``."""
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


def _matrix(column, width: int) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, np.float32 if width == 4 else np.float64).reshape(len(column), -1).astype(np.float64)


def linked(a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Which pairs of raw vectors reach the cosine. Where rounding could decide, the sums are taken
    exactly."""
    cosine = unit(a) @ unit(b).T
    out = cosine >= least
    for i, j in zip(*np.nonzero(np.abs(cosine - least) < 1e-12), strict=True):
        x, y = (np.ldexp(v, -int(np.frexp(np.abs(v).max())[1])) for v in (a[i], b[j]))  # exact scaling
        out[i, j] = math.fsum(x * y) / math.sqrt(math.fsum(x * x) * math.fsum(y * y)) >= least
    return out


def forest(near: np.ndarray) -> np.ndarray:
    """``(root, other)`` rows of stars that span the parts of a symmetric relation."""
    found = []
    open_ = near.any(axis=1)
    while open_.any():
        root = int(np.argmax(open_))
        open_[root] = False
        edge = near[root] & open_
        while edge.any():
            fresh = np.flatnonzero(edge)
            found.append(np.stack([np.full(len(fresh), root), fresh], axis=1))
            open_[fresh] = False
            edge = near[fresh].any(axis=0) & open_
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def _signed(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, width: int) -> DataFrame:
    """One row per vector with its class: a 128-bit name of label and components. Of equal vectors of
    a batch one carries the components and their number."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            lists = part.column("vec")
            flat = np.asarray(pc.fill_null(lists.flatten(), float("nan")), np.float64)
            offsets = np.concatenate([[0], np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(lists), 0), np.int64))])
            good = (sums((~np.isfinite(flat)).astype(np.int64), offsets) == 0) & (sums((flat != 0).astype(np.int64), offsets) > 0)
            cells, classes, vecs = [], [], []
            seen: dict[bytes, int] = {}
            count = [0] * part.num_rows
            for k, label in enumerate(part.column("label").to_pylist()):
                if label is None or not good[k]:
                    cells.append(None), classes.append(None), vecs.append(None)
                    continue
                own = flat[offsets[k] : offsets[k + 1]] + 0.0
                data = (own.astype(np.float32) if width == 4 else own).tobytes()
                cell = f"{len(own)}:{label}"
                name = hashlib.blake2b(cell.encode() + b"\0" + data, digest_size=16).digest()
                first = seen.setdefault(name, k)
                count[first] += 1
                cells.append(cell), classes.append(name), vecs.append(data if first == k else None)
            kinds = (("cell", pa.string(), cells), ("class", pa.binary(), classes), ("vec", pa.binary(), vecs), ("n", pa.int64(), count))
            yield batch({"id": part.column("id")} | {name: pa.array(values, kind) for name, kind, values in kinds})

    kind = "array<float>" if width == 4 else "array<double>"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vec_col).cast(kind).alias("vec"))
    return rows.mapInArrow(sign, _SIGNED)


def _choose(cells: DataFrame, big: DataFrame, cell_rows: int, radius: float, width: int) -> DataFrame:
    """``(cell, pivots)``: a few own vectors of each cell, further than the radius from each other, out
    of a bounded sample by hash (8 candidates for a pivot)."""
    wanted = F.least(F.lit(MOST_PIVOTS), F.greatest(F.lit(2), F.ceil(2 * F.col("n") / cell_rows))).cast("int")
    sample = cells.where("own").join(big.select("cell", "n", wanted.alias("wanted")), "cell")
    hashed = F.xxhash64("cell", "class")
    # Thinned before they are ranked, so that few rows of a large cell meet.
    thin = sample.where(F.pmod(hashed, F.col("n")) < 16 * F.col("wanted"))
    rank = F.row_number().over(Window.partitionBy("cell").orderBy(hashed, "class"))
    few = thin.withColumn("rank", rank).where(F.col("rank") <= 8 * MOST_PIVOTS).where(F.col("rank") <= 8 * F.col("wanted"))

    def pick(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("rank")
        points = unit(_matrix(table["vec"], width))
        kept: list[int] = []
        for k in range(len(points)):
            if len(kept) < table["wanted"][0].as_py() and (not kept or distances(points[k : k + 1], points[kept]).min() > radius):
                kept.append(k)
        return pa.table({"cell": table["cell"].slice(0, 1), "pivots": pa.array([points[kept].tobytes()], pa.binary())})

    return few.select("cell", "vec", "rank", "wanted").groupBy("cell").applyInArrow(pick, "cell string, pivots binary")


def _partition(cells: DataFrame, plan: DataFrame, radius: float, width: int) -> tuple[DataFrame, DataFrame]:
    """The vectors of too large cells dealt out to smaller ones, and ``(cell, core, n, stuck)`` of these.

    ``plan`` has the pivots of each cell and the number of slices in which its vectors are measured.
    """
    sliced = cells.join(plan.select("cell", "slices"), "cell").withColumn("slice", F.pmod(F.xxhash64("class", "own"), F.col("slices")))
    rows = sliced.select(F.col("cell").alias("c"), F.col("slice").alias("s"), "class", "weight", "vec", "own")

    def placed(table: pa.Table, guide: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        points = unit(_matrix(table["vec"], width))
        pivots = np.frombuffer(guide["pivots"][0].as_py(), np.float64).reshape(-1, points.shape[1])
        apart = distances(points, pivots)
        nearest = apart.argmin(axis=1)
        return apart, nearest, apart[np.arange(len(points)), nearest] <= radius / 2 - SLACK, table["own"].to_numpy()

    def measure(table: pa.Table, guide: pa.Table) -> pa.Table:
        if not table.num_rows or not guide.num_rows:
            return pa.table({"c": pa.array([], pa.string()), "q": pa.array([], pa.int32()), "n": pa.array([], pa.int64()), "low": pa.array([], pa.float64()), "high": pa.array([], pa.float64())})
        apart, nearest, core, own = placed(table.combine_chunks(), guide)
        code = 2 * nearest[own] + core[own]
        reach = apart[own, nearest[own]]
        order = np.argsort(code, kind="stable")
        head = np.flatnonzero(np.diff(code[order], prepend=-1))
        low, high = (np.minimum.reduceat(reach[order], head), np.maximum.reduceat(reach[order], head)) if len(head) else (reach, reach)
        return pa.table({"c": pa.array([table["c"][0].as_py()] * len(head), pa.string()), "q": pa.array(code[order][head], pa.int32()), "n": np.diff(np.append(head, len(code))), "low": low, "high": high})

    guides = plan.select(F.col("cell").alias("c"), "pivots", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("s"))
    by = ("c", "s")
    parts = rows.groupBy(*by).cogroup(guides.groupBy(*by)).applyInArrow(measure, "c string, q int, n long, low double, high double")
    parts = settle(parts.groupBy("c", "q").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")), "parts")
    every = parts.groupBy("c").agg(F.array_sort(F.collect_list(F.struct("q", "low", "high"))).alias("parts"))
    guides = plan.select(F.col("cell").alias("c"), "pivots", "slices").join(every, "c").select("c", "pivots", "parts", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("s"))

    def deal(table: pa.Table, guide: pa.Table) -> pa.Table:
        if not table.num_rows or not guide.num_rows:
            return pa.table({"cell": pa.array([], pa.string()), "class": pa.array([], pa.binary()), "weight": pa.array([], pa.int64()), "vec": pa.array([], pa.binary()), "own": pa.array([], pa.bool_())})
        table = table.combine_chunks()
        apart, nearest, core, own = placed(table, guide)
        known = guide["parts"][0].as_py()
        q, low, high = (np.array([p[c] for p in known]) for c in ("q", "low", "high"))
        # Cells in the order of their radius: vectors visit narrower ones only.
        place = np.full(int(q.max()) + 2, len(q))
        place[q] = np.lexsort((q, high)).argsort()
        reach = apart[:, q // 2]
        near = (reach <= high + radius + SLACK) & (reach >= low - radius - SLACK) & (reach <= apart.min(axis=1)[:, None] + 2 * radius + SLACK)
        mine = 2 * nearest + core
        inner = own[:, None] & (place[q][None, :] >= place[np.minimum(mine, len(place) - 1)][:, None])
        home = own[:, None] & (q[None, :] == mine[:, None])
        row, to = np.nonzero((near & ~inner) | home)
        names = [f"{table['c'][0].as_py()}/{x // 2}{'core' if x % 2 else ''}" for x in q]
        at = pa.array(row)
        return pa.table({"cell": pa.array([names[x] for x in to], pa.string()), "class": table["class"].take(at), "weight": table["weight"].take(at), "vec": table["vec"].take(at), "own": home[row, to]})

    dealt = rows.groupBy(*by).cogroup(guides.groupBy(*by)).applyInArrow(deal, _STATE)
    whole = parts.groupBy("c").agg(F.sum("n").alias("whole"))
    name = F.concat(F.col("c"), F.lit("/"), (F.col("q") / 2).cast("int").cast("string"), F.when(F.col("q") % 2 == 1, "core").otherwise(""))
    # A cell that its pivots hardly divide is left as it is, and joined in blocks.
    sizes = parts.join(whole, "c").select(name.alias("cell"), (F.col("q") % 2 == 1).alias("core"), "n", (10 * F.col("n") > 9 * F.col("whole")).alias("stuck"))
    return settle(dealt, "cells"), sizes


def _met(cells: DataFrame, sizes: DataFrame, least: float, block_rows: int, width: int) -> DataFrame:
    """``(class, linked, a, b)``: for each class the weights of those it links with, block by block,
    and edges that span the links of a block."""
    counts = cells.groupBy("cell").agg(F.ceil(F.count_if("own") / block_rows).alias("owns"), F.ceil(F.count_if(~F.col("own")) / block_rows).alias("visits"), F.sum(F.when(F.col("own"), F.col("weight"))).alias("held"), F.min(F.when(F.col("own"), F.col("class"))).alias("least"))
    counts = settle(counts.join(sizes.select("cell", "core"), "cell", "left").withColumn("core", F.coalesce("core", F.lit(False))), "blocks")
    known = cells.join(counts, "cell").where("owns > 0")
    block = F.pmod(F.xxhash64("class"), F.when(F.col("own"), F.col("owns")).otherwise(F.col("visits")))
    seq = lambda low, high: F.when(high > low, F.sequence(low, high - 1)).otherwise(F.array().cast("array<long>"))
    zero = F.lit(0).cast("long")
    # Own blocks meet own ones (but in a core, whose vectors all link) and the visitors' blocks.
    inside = F.transform(F.when(F.col("core"), F.array().cast("array<long>")).otherwise(seq(zero, F.col("owns"))), lambda x: F.struct(F.lit(False).alias("visit"), F.least(x, F.col("block")).alias("i"), F.greatest(x, F.col("block")).alias("j")))
    outside = F.transform(seq(zero, F.col("visits")), lambda x: F.struct(F.lit(True).alias("visit"), F.col("block").alias("i"), x.alias("j")))
    coming = F.transform(seq(zero, F.col("owns")), lambda x: F.struct(F.lit(True).alias("visit"), x.alias("i"), F.col("block").alias("j")))
    tasks = F.when(F.col("own"), F.concat(inside, outside)).otherwise(coming)
    dealt = known.withColumn("block", block).select("cell", "class", "weight", "vec", "own", "block", F.explode(tasks).alias("task"))
    dealt = dealt.select("cell", F.col("task.visit").alias("visit"), F.col("task.i").alias("i"), F.col("task.j").alias("j"), "class", "weight", "vec", "own", "block")

    def meet(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        visit, i, j = (table[c][0].as_py() for c in ("visit", "i", "j"))
        own, block, weight = table["own"].to_numpy(), table["block"].to_numpy(), table["weight"].to_numpy()
        points = _matrix(table["vec"], width)
        left, right = (np.flatnonzero(own), np.flatnonzero(~own)) if visit else (np.flatnonzero(block == i), np.flatnonzero(block == j))
        near = linked(points[left], points[right], least)
        if not visit and i == j:
            np.fill_diagonal(near, False)
        total = np.zeros(len(own))
        total[left] += near @ weight[right].astype(np.float64)
        if visit or i != j:
            total[right] += near.T @ weight[left].astype(np.float64)
        some = np.flatnonzero(total)
        # Only vectors with links take part in the spanning edges.
        place = np.full(len(own), -1)
        place[some] = np.arange(len(some))
        x, y = np.nonzero(near)
        both = np.zeros((len(some), len(some)), bool)
        both[place[left[x]], place[right[y]]] = both[place[right[y]], place[left[x]]] = True
        edges = some[forest(both)]
        names = table["class"].combine_chunks()
        none = pa.nulls(len(some), pa.binary())
        counted = pa.table({"class": names.take(pa.array(some)), "linked": total[some].astype(np.int64), "a": none, "b": none})
        spanned = pa.table({"class": pa.nulls(len(edges), pa.binary()), "linked": pa.nulls(len(edges), pa.int64()), "a": names.take(pa.array(edges[:, 0])), "b": names.take(pa.array(edges[:, 1]))})
        return pa.concat_tables([counted, spanned])

    found = dealt.groupBy("cell", "visit", "i", "j").applyInArrow(meet, "class binary, linked long, a binary, b binary")
    cores = cells.where("own").join(counts.where("core").select("cell", "held", "least"), "cell")
    whole = cores.select("class", (F.col("held") - F.col("weight")).alias("linked"), F.col("least").alias("a"), F.col("class").alias("b"))
    return found.unionByName(whole)


def metric_links(
    vectors: DataFrame, least: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", cell_rows: int = CELL_ROWS
) -> DataFrame:
    """``(id, n_links, component_id, kept)`` of every row: links are pairs of rows of one label with a
    cosine of at least ``least``.

    ``n_links`` counts the other rows that a row links with, ``component_id`` is the smallest id that
    links reach, the own one included, and ``kept`` tells whether that is the row's own. Rows of null
    label, and vectors that are null, empty or zero or hold null or non-finite components, link with
    nothing and are their own component. Vectors of different length do not link. Rows of one id are
    linked as others are. A null id is never a component's id unless all of its ids are null; then it
    is null, and such rows are kept. An empty table gives an empty result. Other columns are dropped.

    The cosine is taken in double precision, float components as their exact values; where rounding
    could decide, from exact sums. Equality of vectors is that of 128-bit names. ``least`` must be
    above 0. What is compared in a cell grows with its own vectors times its visitors: vectors without
    any structure, which no pivot can tell apart, are compared with all others of their label.
    """
    if not 0 < least <= 1:
        raise ValueError("the least cosine must be above 0 and at most 1")
    radius = math.sqrt(2 - 2 * least)
    width = 4 if vectors.schema[vec_col].dataType.simpleString() == "array<float>" else 8
    signed = settle(_signed(vectors, id_col, vec_col, label_col, width), "vectors")
    usable = signed.where("class is not null")
    classes = usable.groupBy("class").agg(F.sum("n").alias("weight"), F.min("id").alias("least"))
    # Of each class one vector of those that batches have sent.
    vecs = usable.where("vec is not null").select("cell", "class", "vec").dropDuplicates(["class"])
    classes = settle(classes.join(vecs, "class"), "classes")
    open_ = classes.select("cell", "class", "weight", "vec", F.lit(True).alias("own"))
    sizes = settle(open_.groupBy("cell").agg(F.count("*").alias("n")).select("cell", F.lit(False).alias("core"), "n", F.lit(False).alias("stuck")), "sizes")
    done: list[DataFrame] = []
    cores: list[DataFrame] = []
    while True:
        big = sizes.where((F.col("n") > cell_rows) & ~F.col("core") & ~F.col("stuck"))
        cores.append(sizes.where("core"))
        if big.isEmpty():
            done.append(open_)
            break
        done.append(open_.join(big.select("cell"), "cell", "left_anti"))
        slices = open_.groupBy("cell").agg(F.ceil(F.count("*") / SLICE_ROWS).alias("slices"))
        plan = settle(_choose(open_, big, cell_rows, radius, width).join(slices, "cell"), "pivots")
        open_, sizes = _partition(open_.join(big.select("cell"), "cell", "left_semi"), plan, radius, width)
        sizes = settle(sizes, "sizes")
    cells, known = done[0], cores[0]
    for more, core in zip(done[1:], cores[1:], strict=True):
        cells, known = cells.unionByName(more), known.unionByName(core)
    met = settle(_met(cells, known, least, cell_rows, width), "met")
    degree = met.where("class is not null").groupBy("class").agg(F.sum("linked").alias("linked"))
    labels = settle(components(met.select("a", "b")), "labels")
    linked_to = classes.select("class", "weight", "least").join(labels.withColumnRenamed("node", "class"), "class", "left")
    named = settle(linked_to.join(degree, "class", "left").select("class", "weight", "least", F.coalesce("component", "class").alias("component"), (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "named")
    groups = settle(named.groupBy("component").agg(F.count("*").alias("members"), F.min("least").alias("component_id")), "groups")
    by_class = settle(join_hubs(named.drop("least"), groups, "component", "members").drop("component"), "named")
    found = join_hubs(usable.select("id", "class"), by_class, "class", "weight").select("id", "n_links", "component_id")
    alone = signed.where("class is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    every = found.unionByName(alone)
    return every.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
