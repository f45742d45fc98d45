"""Boosted trees for several classes, fitted on histograms that Spark aggregates.

Features are coded once by quantile bins. A round grows one tree per class on the gradients of the
softmax loss, level by level: every task adds up gradients and curvatures per class, node, feature and
bin of its rows, the sums are aggregated, and splits are searched on them alone. The driver holds sums
and trees, whose number follows from the settings, never rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from brindle.session import settle


@dataclass
class Tree:
    """A complete tree: node ``i`` has the children ``2 i + 1`` and ``2 i + 2``. A row goes left when its
    code of ``feature`` is at most ``cut``; a node that is not split has the cut of all codes."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def leaves(self, codes: np.ndarray, depth: int) -> np.ndarray:
        at = np.zeros(len(codes), np.int64)
        rows = np.arange(len(codes))
        for _ in range(depth):
            at = 2 * at + 1 + (codes[rows, self.feature[at]] > self.cut[at])
        return at


@dataclass
class BoostedTrees:
    """Trees of all rounds, one per class in each."""

    labels: list[str]
    features: list[str]
    cuts: list[np.ndarray]
    prior: np.ndarray
    depth: int
    rounds: list[list[Tree]] = field(default_factory=list)

    def codes(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """Bins of the features; missing values have the code 0, as the least."""
        out = np.zeros((len(columns[0]), len(columns)), np.uint8)
        for k, values in enumerate(columns):
            values = np.asarray(values, float)
            out[:, k] = np.where(np.isnan(values), 0, np.searchsorted(self.cuts[k], values, side="left"))
        return out

    def margins(self, codes: np.ndarray) -> np.ndarray:
        total = np.tile(self.prior, (len(codes), 1))
        for trees in self.rounds:
            for k, tree in enumerate(trees):
                total[:, k] += tree.value[tree.leaves(codes, self.depth)]
        return total

    def add_probabilities(self, df: DataFrame, out: str) -> DataFrame:
        """A column with one probability per label, in the order of ``labels``."""
        model = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf("array<double>")
        def scored(rows: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for pdf in rows:
                own = model.value
                yield pd.Series(list(softmax(own.margins(own.codes([pdf[c].to_numpy(float) for c in own.features])))), index=pdf.index)

        return df.withColumn(out, scored.asNondeterministic()(F.struct(*[F.col(c).cast("double").alias(c) for c in self.features])))


def softmax(margins: np.ndarray) -> np.ndarray:
    weight = np.exp(margins - margins.max(axis=1, keepdims=True))
    return weight / weight.sum(axis=1, keepdims=True)


def histogram(model: BoostedTrees, growing: list[Tree], level: int, codes: np.ndarray, target: np.ndarray, bins: int) -> np.ndarray:
    """Sums of gradient and curvature, ``(2, classes, nodes of the level, features, bins)``."""
    p = softmax(model.margins(codes))
    classes, nodes, width = len(model.labels), 1 << level, codes.shape[1]
    total = np.zeros((2, classes, nodes, width, bins))
    for k in range(classes):
        node = growing[k].leaves(codes, level) - (nodes - 1)
        gradient, curvature = (target == k) - p[:, k], p[:, k] * (1 - p[:, k])
        for f in range(width):
            cell = node * bins + codes[:, f]
            for i, weight in enumerate((gradient, curvature)):
                total[i, k, :, f] = np.bincount(cell, weights=weight, minlength=nodes * bins).reshape(nodes, bins)
    return total


def best_splits(sums: np.ndarray, penalty: float, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Feature and cut of each node of one class from its sums ``(2, nodes, features, bins)``; the cut of
    all codes where no split gains."""
    left = np.cumsum(sums, axis=3)
    whole = left[:, :, :, -1:]
    right = whole - left
    worth = lambda s: s[0] ** 2 / (s[1] + penalty)
    gain = worth(left) + worth(right) - worth(whole)
    gain[(left[1] < least) | (right[1] < least)] = 0
    # What the order of sums changes must not decide between equal splits.
    gain = np.round(gain, 9).reshape(len(gain), -1)
    best = gain.argmax(axis=1)
    bins = sums.shape[3]
    found = gain[np.arange(len(gain)), best] > 0
    return np.where(found, best // bins, 0), np.where(found, best % bins, bins)


def fit_boosted_trees(
    df: DataFrame, features: Sequence[str], label: str, rounds: int = 20, depth: int = 3, rate: float = 0.3, bins: int = 32, penalty: float = 1.0, least: float = 1e-3
) -> BoostedTrees:
    """Fit on the rows with a label. ``bins`` quantile bins per feature (at most 255), ``rounds`` trees of
    ``depth`` levels per class, leaves of ``rate * sum(gradient) / (sum(curvature) + penalty)``.

    One job per level and round, and one per round for the leaves; each sends back sums only.
    """
    rows = df.where(F.col(label).isNotNull()).select(*[F.col(c).cast("double").alias(f"f{k}") for k, c in enumerate(features)], F.col(label).cast("string").alias("label"))
    counts = rows.groupBy("label").count().orderBy("label").collect()
    labels = [r["label"] for r in counts]
    if not labels:
        raise ValueError("there is no row with a label")
    shares = [(k + 1) / bins for k in range(bins - 1)]
    quantiles = rows.agg(*[F.percentile_approx(F.nanvl(f"f{k}", F.lit(None)), shares, 10_000).alias(f"q{k}") for k in range(len(features))]).first()
    cuts = [np.unique(np.array(q or [], float)) for q in quantiles]
    prior = np.log(np.array([r["count"] for r in counts], float) / sum(r["count"] for r in counts))
    model = BoostedTrees(labels, list(features), cuts, prior, depth)
    number = {name: k for k, name in enumerate(labels)}

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            columns = [np.asarray(part.column(f"f{k}").to_numpy(zero_copy_only=False), float) for k in range(len(features))]
            target = np.array([number[x] for x in part.column("label").to_pylist()], np.int32)
            codes = [row.tobytes() for row in model.codes(columns)]
            yield pa.RecordBatch.from_arrays([pa.array(codes, pa.binary()), pa.array(target)], ["codes", "target"])

    coded = settle(rows.mapInArrow(code, "codes binary, target int"), "coded")

    def summed(growing: list[Tree], level: int) -> np.ndarray:
        shared = df.sparkSession.sparkContext.broadcast((model, growing))
        shape = (2, len(labels), 1 << level, len(features), bins)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            known, trees = shared.value
            for part in batches:
                codes = np.frombuffer(b"".join(part.column("codes").to_pylist()), np.uint8).reshape(part.num_rows, -1)
                total += histogram(known, trees, level, codes, part.column("target").to_numpy(), bins)
            flat = total.reshape(2, -1)
            held = np.flatnonzero(flat[1])
            yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(flat[0, held]), pa.array(flat[1, held])], ["cell", "g", "h"])

        sums = coded.mapInArrow(add, "cell long, g double, h double").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()
        shared.unpersist()
        total = np.zeros((2, int(np.prod(shape[1:]))))
        total[:, sums["cell"].to_numpy()] = sums["g"].to_numpy(), sums["h"].to_numpy()
        return total.reshape(shape)

    for _ in range(rounds):
        size = (1 << depth + 1) - 1
        growing = [Tree(np.zeros(size, np.int64), np.full(size, bins), np.zeros(size)) for _ in labels]
        for level in range(depth):
            sums = summed(growing, level)
            nodes = slice((1 << level) - 1, (1 << level + 1) - 1)
            for k, tree in enumerate(growing):
                tree.feature[nodes], tree.cut[nodes] = best_splits(sums[:, k], penalty, least)
        leaves = summed(growing, depth)[:, :, :, 0].sum(axis=3)
        for k, tree in enumerate(growing):
            tree.value[(1 << depth) - 1 :] = rate * leaves[0, k] / (leaves[1, k] + penalty)
        model.rounds.append(growing)
    return model
