"""Language identification: averaged hashed subword embeddings with a linear softmax.

Features are the byte n-grams of the lower-cased letters of each word, word ends included, hashed to
a fixed number of buckets. Training is plain stochastic gradient descent in numpy on a bounded
sample; prediction uses the product of embeddings and output weights, one row per bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from brindle.llm.arrowtext import batch, bounded, filled, give_back, narrow, pieces, sums

BUCKETS = 1 << 14  # the upper 14 bits of a 32-bit hash
GRAMS = (2, 3, 4)
SLICE_BYTES = 1 << 20  # of texts whose n-grams a task holds at once
UNKNOWN = "und"
_BLANK, _EMPTY = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())


@dataclass
class LanguageModel:
    """What the tasks need: scores per bucket and label (embeddings times output weights), bias,
    temperature and the calibrated score below which a prediction is rejected."""

    labels: list[str]
    scores: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of all strings, and the offsets of the strings in them."""
    letters = pc.replace_substring_regex(pc.utf8_lower(pa.array(words, pa.large_string())), r"[^\p{L}]+", " ")
    framed = pc.binary_join_element_wise(_BLANK, letters, _BLANK, _EMPTY)
    ends = np.cumsum(np.asarray(pc.binary_length(framed)).astype(np.int64))
    data = np.frombuffer(framed.buffers()[2], np.uint8)[: ends[-1] if len(ends) else 0].astype(np.uint32)
    owner = np.repeat(np.arange(len(words)), np.diff(ends, prepend=0))
    blank = np.cumsum(data == 32)
    found, owners = [], []
    for n in GRAMS:
        if len(data) < n:
            continue
        code = np.full(len(data) - n + 1, n, np.uint32)
        for k in range(n):
            code = code * np.uint32(16777619) ^ data[k : len(data) - n + 1 + k]
        # A gram lies in one word of one string: no blank inside, and not two blanks alone.
        inside = blank[n - 2 : len(data) - 1] == blank[: len(data) - n + 1]
        inside &= (owner[n - 1 :] == owner[: len(data) - n + 1]) & ((data[: len(data) - n + 1] != 32) | (data[n - 1 :] != 32) | (n > 2))
        code = code[inside] * np.uint32(2654435769)
        found.append((code >> np.uint32(18)).astype(np.int64))
        owners.append(owner[: len(inside)][inside])
    if not found:
        return np.zeros(0, np.int64), np.zeros(len(words) + 1, np.int64)
    buckets, owner = np.concatenate(found), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return buckets[order], np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(words)))])


def _bags(rows: DataFrame) -> DataFrame:
    """Each text as distinct buckets with counts: at most ``BUCKETS`` entries, whatever its length."""

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for part in (some for whole in batches for some in bounded(whole, SLICE_BYTES)):
            ids, counts = [], []
            for text in filled(part.column("text")).to_pylist():
                cut = pieces(pa.array([text], pa.large_string()))
                buckets, offsets = subwords(cut.distinct)
                weight = np.repeat(np.bincount(cut.codes, minlength=len(cut.distinct)), np.diff(offsets))
                total = np.bincount(buckets, weights=weight, minlength=BUCKETS)
                ids.append(np.flatnonzero(total).astype(np.int32))
                counts.append(total[ids[-1]].astype(np.float32))
            own = {c: part.column(c) for c in ("label", "order", "hash")}
            yield batch(own | {"ids": pa.array(ids, pa.list_(pa.int32())), "counts": pa.array(counts, pa.list_(pa.float32()))})
        give_back()

    return rows.select("label", "order", "hash", "text").mapInArrow(bag, "label string, order long, hash long, ids array<int>, counts array<float>")


def _fewest(rows: DataFrame, per_label: int, max_rows: int, *order: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("label").orderBy(*order))
    return rows.withColumn("rank", rank).where(F.col("rank") <= per_label).orderBy("rank", "label").limit(max_rows).drop("rank")


def labelled_sample(docs: DataFrame, label_col: str, per_label: int, max_rows: int, id_col: str, text_col: str) -> DataFrame:
    """Bags of at most ``per_label`` rows of each label and ``max_rows`` in all, chosen by hashes of id
    and text.

    Ids are chosen from the narrow columns; only their texts are then read, and made into bags in
    the tasks. An id may have many rows: bags are counted once more.
    """
    order = F.xxhash64(F.col(id_col), F.lit(17)).alias("order")
    narrowed = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc"), F.col(label_col).cast("string").alias("label"), order).where("label is not null")
    ids = _fewest(narrowed, per_label, max_rows, "order", "doc").select("doc").distinct()
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).alias("doc"), F.col(label_col).cast("string").alias("label"), order, F.xxhash64(text).alias("hash"), text.alias("text"))
    # At most max_rows ids.
    found = texts.where("label is not null").join(F.broadcast(ids), "doc", "left_semi")
    return _fewest(_bags(found), per_label, max_rows, "order", "hash")


def train(bags: pa.Table, dim: int = 16, least_steps: int = 1500, epochs: int = 6, rate: float = 0.5, precision: float = 0.99, seed: int = 7) -> LanguageModel:
    """Fit on bags of (label, ids, counts).

    Four fifths are trained on. The rest gives the temperature (least log loss) and the threshold:
    the lowest score, one half at least, from which on the share ``precision`` of predictions is right.
    """
    bags = bags.filter(pc.greater(pc.list_value_length(bags["ids"]), 0)).combine_chunks()
    if not bags.num_rows:
        return LanguageModel([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    labels = sorted(set(bags["label"].to_pylist()))
    target = np.array([labels.index(x) for x in bags["label"].to_pylist()])
    ids, weights = ([x.values.to_numpy() for x in bags[c]] for c in ("ids", "counts"))
    weights = [w / w.sum() for w in weights]
    # Collecting gives no order; the fit must not depend on it.
    key = [(labels[k], i.tobytes(), w.tobytes()) for k, i, w in zip(target, ids, weights, strict=True)]
    order = sorted(range(len(key)), key=key.__getitem__)
    target, ids, weights = target[order], [ids[k] for k in order], [weights[k] for k in order]
    del key
    random = np.random.default_rng(seed)
    order = random.permutation(len(ids))
    held = order[: len(order) // 5]
    fit = order[len(order) // 5 :]
    embed = random.normal(0, 0.1, (BUCKETS, dim))
    out = random.normal(0, 0.1, (dim, len(labels)))
    bias = np.zeros(len(labels))
    # Few rows are passed over more often.
    epochs = max(epochs, -(-least_steps // -(-len(fit) // 16)))
    steps, step = epochs * -(-len(fit) // 16), 0
    for _ in range(epochs):
        random.shuffle(fit)
        for start in range(0, len(fit), 16):
            some = fit[start : start + 16]
            flat = np.concatenate([ids[k] for k in some])
            own = np.concatenate([weights[k] for k in some])
            size = np.array([len(ids[k]) for k in some])
            hidden = np.add.reduceat(embed[flat] * own[:, None], np.cumsum(size) - size)
            logits = hidden @ out + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(some)), target[some]] -= 1
            pace = rate * (1 - step / steps)
            back = p @ out.T
            out -= pace * hidden.T @ p / len(some)
            bias -= pace * p.mean(axis=0)
            # Embeddings of rare features see few updates, so their step is not averaged.
            np.subtract.at(embed, flat, pace * 8 * own[:, None] * np.repeat(back, size, axis=0))
            step += 1
    model = LanguageModel(labels, embed @ out, bias, 1.0, 0.5)
    check = held if len(held) else fit
    logits = np.stack([weights[k] @ model.scores[ids[k]] for k in check]) + bias
    tried = {t: -np.log(LanguageModel(labels, model.scores, bias, t, 0).probabilities(logits)[np.arange(len(check)), target[check]] + 1e-12).mean() for t in np.geomspace(0.05, 20, 60)}
    model.temperature = float(min(tried, key=tried.get))
    p = model.probabilities(logits)
    order = np.argsort(-p.max(axis=1), kind="stable")
    score = p.max(axis=1)[order]
    share = np.cumsum(p.argmax(axis=1)[order] == target[check][order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero(share >= precision)
    if not len(good) or good[-1] < len(order) - 1:
        model.threshold = max(model.threshold, float(score[good[-1]]) if len(good) else 1.0)
    return model


def fit_languages(
    docs: DataFrame, label_col: str = "lang", per_label: int = 400, max_rows: int = 4000, id_col: str = "doc_id", text_col: str = "text", **options
) -> LanguageModel:
    """Train on a sample of the rows with a label, at most ``per_label`` of each and ``max_rows`` in
    all; whole texts are turned into bags in the tasks, so the driver holds at most ``max_rows``
    sparse bags. Rows of null label or id are not learned from. Without labelled rows the model
    knows no language."""
    sample = labelled_sample(docs, label_col, per_label, max_rows, id_col, text_col)
    return train(sample.select("label", "ids", "counts").toArrow(), **options)


def identify_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(id, *keep, lang_pred, score, accepted)`` of every row, whole texts, no shuffle.

    ``score`` is the calibrated probability of ``lang_pred``. A null text, and one without letters,
    is ``und`` with score 0 and not accepted; other rows are accepted from the model's threshold on.
    A model without labels gives ``und`` for all. Null or repeated ids give one row each; an empty
    table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    # The text goes to Python alone and does not come back; the other columns wait in the JVM.
    @F.arrow_udf("struct<lang_pred: string, score: double, accepted: boolean>")
    def predict(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        give_back()
        for whole in texts:
            found = [_predicted(model, part.column("text")) for part in bounded(batch({"text": whole}), SLICE_BYTES)]
            yield pa.concat_arrays(found) if found else pa.array([], _PREDICTION)
            give_back()

    names = [F.col(c).alias(f"keep{k}") for k, c in enumerate((id_col, *keep))]
    out = docs.select(*names, predict.asNondeterministic()(F.col(text_col).cast("string")).alias("found"))
    return out.select(*[F.col(f"keep{k}").alias(c) for k, c in enumerate((id_col, *keep))], "found.lang_pred", "found.score", "found.accepted")


_PREDICTION = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("accepted", pa.bool_())])


def _predicted(model: LanguageModel, texts: pa.Array) -> pa.Array:
    cut = pieces(filled(texts))
    buckets, offsets = subwords(cut.distinct)
    size = np.diff(offsets).astype(np.float64)
    n = sums(size[cut.codes], cut.offsets)
    known = (n > 0) & bool(model.labels)
    if model.labels:
        own = np.stack([sums(model.scores[buckets, k], offsets)[cut.codes] for k in range(len(model.labels))], axis=1)
        p = model.probabilities(sums(own, cut.offsets) / np.maximum(n, 1)[:, None] + model.bias)
        best = np.array(model.labels, dtype=object)[p.argmax(axis=1)]
        score = np.where(known, p.max(axis=1), 0.0)
    else:
        best, score = np.full(len(n), UNKNOWN, dtype=object), np.zeros(len(n))
    columns = [pa.array(np.where(known, best, UNKNOWN), pa.string()), pa.array(np.round(score, 9)), pa.array(known & (score >= model.threshold))]
    return pa.StructArray.from_arrays(columns, fields=list(_PREDICTION))
