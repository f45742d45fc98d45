"""Embedding and top-k vector retrieval."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from brindle.functions.vectors import METRICS, Encoder, TopHits, hashing_encoder
from brindle.operators.nearest import approximate_topk, best_k, pruned_topk, stack
from brindle.session import settle

# Query vectors that every task holds at once (floats), and corpus rows of one block.
BROADCAST_FLOATS = 4_000_000
BLOCK_ROWS = 50_000


def embed(df: DataFrame, text: str, encoder: Encoder | None = None, out: str = "embedding") -> DataFrame:
    """Add a vector per text. Only the text column goes through Python, in Arrow batches."""
    encode = encoder or hashing_encoder()

    @F.pandas_udf("array<float>")
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(list(np.asarray(encode(texts.tolist()), dtype=np.float32)), index=texts.index)

    # Marked as not deterministic, so that a filter inferred from a later explode does not encode
    # every text a second time.
    return df.withColumn(out, vectors.asNondeterministic()(text))


def vector_key(vector: str) -> Column:
    """A name of the vector by 128 bits of it: rows with one name have the same hits, so that a search
    needs each of them once."""
    return F.concat_ws("-", *[F.xxhash64(F.lit(seed), F.col(vector)) for seed in (1, 2)])


def retrieve_topk(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 4,
    query_id: str = "query_id",
    corpus_id: str = "chunk_id",
    query_vector: str = "embedding",
    corpus_vector: str = "embedding",
    metadata: Sequence[str] = (),
    broadcast_floats: int = BROADCAST_FLOATS,
    block_rows: int = BLOCK_ROWS,
    metric: str = "cosine",
    approximate: Mapping | None = None,
) -> DataFrame:
    """The k nearest corpus rows per query: ``query_id, corpus_id, score, distance, rank`` and the
    corpus columns in ``metadata``. Ids are unique; ties go to the smaller id.

    ``metric`` is ``cosine`` or ``ip`` (the score is the inner product and the distance one minus it) or
    ``l2`` (the distance is the squared one, the score its negative).

    Exact by default. A measured, bounded set of queries is sent to all tasks and the corpus is
    streamed past it without a shuffle. More queries than that are laid into blocks of similar rows,
    and so is the corpus; pairs of blocks that cannot hold a hit are never joined. With
    ``approximate``, the settings of :func:`brindle.operators.nearest.approximate_topk` (empty for its
    defaults), only rows that share a bucket of an index with the query are scored. Either way a
    task emits k rows per query, never all pairs.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}, not {metric!r}")
    asked = queries.filter(F.col(query_vector).isNotNull()).select(
        F.col(query_id).alias("query_id"), F.col(query_vector).cast("array<float>").alias("vector")
    )
    stored = corpus.filter(F.col(corpus_vector).isNotNull()).select(
        F.col(corpus_id).alias("corpus_id"), F.col(corpus_vector).cast("array<float>").alias("vector")
    )
    asked = settle(asked, "queries")
    size = asked.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("vector")).alias("floats")).first()
    # Rows count too: vectors may be empty.
    if approximate is not None:
        hits = approximate_topk(asked, stored, k, metric, block_rows=block_rows, **approximate)
    elif (size.floats or 0) + size.rows <= broadcast_floats:
        hits = _against_broadcast(asked, stored, k, metric)
    else:
        hits, _ = pruned_topk(asked, stored, k, metric, block_rows)
    distance = -F.col("score") if metric == "l2" else 1 - F.col("score")
    ranked = best_k(hits, k).withColumn("distance", F.round(distance, 6))
    if metadata:
        extra = corpus.select(F.col(corpus_id).alias("corpus_id"), *metadata)
        ranked = ranked.join(extra, "corpus_id")
    return ranked


def _against_broadcast(asked: DataFrame, stored: DataFrame, k: int, metric: str) -> DataFrame:
    kind = asked.schema["query_id"].dataType.simpleString(), stored.schema["corpus_id"].dataType.simpleString()
    schema = f"query_id {kind[0]}, corpus_id {kind[1]}, score double"
    block = asked.toPandas()  # bounded by the caller
    if block.empty:
        return asked.sparkSession.createDataFrame([], schema)
    shared = asked.sparkSession.sparkContext.broadcast((block["query_id"].to_numpy(), stack(block["vector"])))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, vectors = shared.value
        top = TopHits(ids, vectors, k, metric)
        for pdf in batches:
            if len(pdf):
                top.add(pdf["corpus_id"].to_numpy(), stack(pdf["vector"]))
        yield top.result()

    return stored.mapInPandas(scan, schema)


def retrieved_context(hits: DataFrame, text: str, separator: str = "\n") -> DataFrame:
    """The retrieved texts of every query in rank order, joined: ``query_id, context``."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", F.col(text).alias("text"))))  # k per query
    joined = F.array_join(F.transform(ordered, lambda h: h["text"]), separator)
    return hits.groupBy("query_id").agg(joined.alias("context"))


def request_with_context(queries: DataFrame, hits: DataFrame, request: str, text: str, query_id: str = "query_id") -> DataFrame:
    """Append the retrieved texts, joined by blanks, to every request as ``prompt``."""
    context = retrieved_context(hits, text, " ").withColumnRenamed("query_id", query_id)
    joined = queries.join(context, query_id, "left")
    return joined.withColumn("prompt", F.concat(F.col(request), F.coalesce("context", F.lit("")))).drop("context")
