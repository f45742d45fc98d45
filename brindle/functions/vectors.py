"""Text encoders and blockwise similarity scores, on numpy arrays inside tasks."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd

from brindle.functions.splitting import _TOKEN

Encoder = Callable[[Sequence[str]], np.ndarray]

# Scores are compared to this many digits: what lies beyond is noise of the order of summation, and
# equal vectors must tie everywhere. Displays may round further.
SCORE_DIGITS = 12


@lru_cache(maxsize=200_000)
def _token_hash(token: str) -> int:
    return int(hashlib.md5(token.encode()).hexdigest()[:8], 16)


def hashing_encoder(dim: int = 64) -> Encoder:
    """Deterministic default encoder: token counts hashed to ``dim`` buckets, unit length."""

    def encode(texts: Sequence[str]) -> np.ndarray:
        vectors = np.zeros((len(texts), dim))
        for row, text in zip(vectors, texts):
            buckets = [_token_hash(t) % dim for t in _TOKEN.findall((text or "").lower())]
            row += np.bincount(buckets, minlength=dim) if buckets else 0
        return unit_rows(vectors)

    return encode


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norms, out=np.zeros_like(vectors, dtype=float), where=norms > 0)


METRICS = ("cosine", "ip", "l2")


def comparable(vectors: np.ndarray, metric: str) -> np.ndarray:
    """Vectors whose inner products (or, for ``l2``, distances) the metric is about."""
    return unit_rows(vectors) if metric == "cosine" else vectors


def distinct_enough(ids: np.ndarray, vectors: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort by id and keep the k smallest ids of every group of equal vectors.

    Equal vectors have equal scores, so no other copy can be among the k best of any query.
    """
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], np.ascontiguousarray(vectors[order])
    copies = pd.Series(vectors.view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).ravel())
    kept = (copies.map(bytes).groupby(copies.map(bytes)).cumcount() < k).to_numpy()
    return ids[kept], vectors[kept]


def few_places(marks: np.ndarray) -> np.ndarray:
    """Where in the flat order of an array of booleans the true ones stand, eight being passed over at a
    time where all are false."""
    flat = np.ascontiguousarray(marks).ravel()
    even = len(flat) // 8 * 8
    at = (np.flatnonzero(flat[:even].view(np.uint64))[:, None] * 8 + np.arange(8)).ravel()
    return np.concatenate([at[flat[at]], even + np.flatnonzero(flat[even:])])


class TopHits:
    """The k best corpus rows per query so far, ties to the smaller id.

    ``metric`` is ``cosine``, ``ip`` (inner product) or ``l2``, where the score is the negative squared
    distance. A block is compared in single precision with each query's current k-th score; only
    what comes close is scored again in double precision and ranked.
    """

    MARGIN = 1e-5
    CELLS = 4_000_000

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int, metric: str = "cosine"):
        self.query_ids, self.k, self.metric = query_ids, k, metric
        self.exact = comparable(queries, metric)
        self.rough = self._lifted(self.exact, True)
        self.length = np.linalg.norm(self.rough.astype(float), axis=1)
        self.floor = np.full(len(query_ids), -np.inf)
        self.best = pd.DataFrame({"q": pd.Series(dtype=np.int64), "corpus_id": pd.Series(dtype=object), "score": pd.Series(dtype=float)})

    def _lifted(self, points: np.ndarray, asks: bool) -> np.ndarray:
        """Single-precision vectors whose inner products are the scores."""
        if self.metric == "l2":
            square, one = (points**2).sum(axis=1, keepdims=True), np.ones((len(points), 1))
            points = np.hstack([2 * points, -one, -square] if asks else [points, square, one])
        return points.astype(np.float32)

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        ids, vectors = distinct_enough(ids, vectors, self.k)
        corpus = comparable(vectors, self.metric)
        rough = self._lifted(corpus, False).T
        reach = float(np.linalg.norm(rough.astype(float), axis=0).max(initial=0))
        step = max(1, self.CELLS // len(ids))
        near = [self._near(at, min(at + step, len(self.query_ids)), corpus, rough, reach) for at in range(0, len(self.query_ids), step)]
        q, c, score = (np.concatenate(x) for x in zip(*near, strict=True))
        found = pd.DataFrame({"q": q, "corpus_id": ids[c], "score": np.round(score, SCORE_DIGITS)})
        merged = pd.concat([self.best, found], ignore_index=True) if len(self.best) else found
        ranked = merged.sort_values(["q", "score", "corpus_id"], ascending=[True, False, True], kind="stable")
        self.best = ranked[ranked.groupby("q").cumcount() < self.k]
        full = self.best.groupby("q")["score"].agg(["min", "size"])
        full = full[full["size"] == self.k]
        at = full.index.to_numpy()
        self.floor[at] = np.maximum(self.floor[at], full["min"].to_numpy())

    def _near(self, start: int, stop: int, corpus: np.ndarray, rough: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Numbers of queries and corpus rows that may be hits, and their exact scores."""
        scores = self.rough[start:stop] @ rough
        floor = self.floor[start:stop]
        if self.k < scores.shape[1] and np.isneginf(floor).any():
            floor = np.maximum(floor, -np.partition(-scores, self.k - 1, axis=1)[:, self.k - 1])
        margin = self.MARGIN * np.maximum(self.length[start:stop] * reach, 1)
        # Every cell is compared in its own precision.
        least = np.nextafter((floor - margin).astype(np.float32), np.float32(-np.inf))
        q, c = np.divmod(few_places(scores >= least[:, None]), scores.shape[1])
        q += start
        if self.metric == "l2":
            score = -((self.exact[q] - corpus[c]) ** 2).sum(axis=1)
        else:
            score = np.einsum("ij,ij->i", self.exact[q], corpus[c])
        return q, c, score

    def result(self) -> pd.DataFrame:
        return pd.DataFrame(
            {"query_id": self.query_ids[self.best["q"].to_numpy()], "corpus_id": self.best["corpus_id"], "score": self.best["score"]}
        )
