"""Documents and code files to chunk rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from brindle.functions.splitting import split_code, split_document, whitespace_tokens
from brindle.functions.text import content_id


SLICE_BYTES = 1 << 20  # of texts that are Python strings at once


def text_slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """The array in slices of about ``most`` bytes, one row at least."""
    size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64))
    cuts = np.flatnonzero(np.diff(size // most, prepend=0))
    edges = sorted({0, *map(int, cuts), len(texts)})
    for a, b in zip(edges, edges[1:], strict=False):
        yield texts.slice(a, b - a)


def _splitter(split: Callable[[str], list[str]]):
    """A function of a text column to arrays of texts. A batch is cut some bytes at a time, so that what
    a worker holds beside the batch does not grow with its rows."""

    @F.arrow_udf("array<string>")
    def arrays(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.string())
        for texts in batches:
            made = [pa.array([None if t is None else split(t) for t in some.to_pylist()], kind) for some in text_slices(texts)]
            yield pa.concat_arrays(made) if made else pa.array([], kind)

    return arrays


def chunk_documents(
    df: DataFrame,
    text: str,
    size: int = 300,
    overlap: int = 100,
    separator: str = "\n\n",
    count_tokens: Callable[[str], int] = whitespace_tokens,
    out: str | None = None,
) -> DataFrame:
    """One row per chunk with all source columns, ``<text>_chunk`` and its md5 as ``chunk_id``.

    Only the text column goes through Python, whole texts in Arrow batches and without a shuffle.
    """
    out = out or f"{text}_chunk"
    split = _splitter(lambda t: split_document(t, size, overlap, separator, count_tokens))

    # Marked as not deterministic, so that no optimizer rule runs the function twice.
    chunks = df.select("*", F.explode(split.asNondeterministic()(text)).alias(out))
    return chunks.withColumn("chunk_id", content_id(F.col(out)))


def chunk_code(df: DataFrame, path: str = "path", content: str = "content", size: int = 1000, overlap: int = 200) -> DataFrame:
    """``id, content, file_path, chunk_index, total_chunks`` per chunk of every code file."""
    split = _splitter(lambda t: split_code(t, size, overlap))
    files = df.select(F.col(path).alias("file_path"), split.asNondeterministic()(content).alias("chunks"))
    rows = files.select("file_path", F.size("chunks").alias("total_chunks"), F.posexplode("chunks").alias("chunk_index", "content"))
    return rows.select(
        content_id(F.col("file_path"), F.col("chunk_index"), F.col("content")).alias("id"),
        "content",
        "file_path",
        "chunk_index",
        "total_chunks",
    )
