"""Whole texts as Arrow batches: pieces cut at spaces, distinct pieces, sums per document.

Every text operator here works on the distinct pieces of a batch and spreads the result to the
documents with one gather, so its Python cost follows the vocabulary of a batch, not its length.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

# White space that is followed by a space: there the run must not be cut (RE2 has no look-around).
_RUN = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "
_SPACE, _EMPTY = pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())
_CUT = regex.compile(r"(?<=\S)(?= )")


def narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(doc, text)`` only: extra columns, whatever their names, never meet internal names."""
    return docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))


def total_bytes(docs: DataFrame, text_col: str) -> int:
    """Bytes of all texts, to size partitions by."""
    return docs.select(F.sum(F.octet_length(F.col(text_col).cast("string"))).alias("n")).first()["n"] or 0


def filled(column: pa.Array) -> pa.Array:
    """The texts of a batch, null as empty. The offsets begin at zero: a slice keeps those of the whole
    batch when it is cast, which ``pc.ascii_lower`` takes for its own and then gives other texts back."""
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(texts):
        return texts
    _, offsets, data = texts.buffers()
    own = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not (texts.offset or own[0]):
        return texts
    data = data.slice(own[0], own[-1] - own[0]) if data is not None else None
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(own - own[0]), data)


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of ``values[offsets[i]:offsets[i + 1]]``; empty ranges give 0. Exact for integers."""
    running = np.zeros((len(values) + 1, *values.shape[1:]), dtype=values.dtype)
    np.cumsum(values, axis=0, out=running[1:])
    return running[offsets[1:]] - running[offsets[:-1]]


@dataclass
class Pieces:
    """Texts cut in front of single spaces. ``distinct[codes[offsets[i]:offsets[i + 1]]]``,
    concatenated, is text ``i``."""

    distinct: list[str]
    codes: np.ndarray
    offsets: np.ndarray


def pieces(texts: pa.Array) -> Pieces:
    """Cut every text in front of each space that does not follow white space.

    No token of a byte-level pre-tokenizer and no SentencePiece piece crosses such a place, so the
    pieces can be handled by themselves.
    """
    lists = pc.split_pattern(texts, " ")
    runs = pc.match_substring_regex(texts, _RUN)
    if pc.any(runs).as_py():
        own = [
            [part[1:] if k else part for k, part in enumerate(_CUT.split(text))] if run else None
            for text, run in zip(texts.to_pylist(), runs.to_pylist(), strict=True)
        ]
        whole = [text if mine is None else "" for text, mine in zip(texts.to_pylist(), own, strict=True)]
        cut = pc.split_pattern(pa.array(whole, pa.large_string()), " ").to_pylist()
        lists = pa.array([mine or other for mine, other in zip(own, cut, strict=True)], pa.list_(pa.large_string()))
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    offsets = offsets - offsets[0]
    flat = lists.flatten()
    encoded = flat.dictionary_encode()
    codes = np.asarray(encoded.indices).astype(np.int64)
    distinct = pc.binary_join_element_wise(_SPACE, encoded.dictionary, _EMPTY).to_pylist()
    # The first piece of a text has no space in front of it.
    first = flat.take(pa.array(offsets[:-1])).dictionary_encode()
    codes[offsets[:-1]] = np.asarray(first.indices).astype(np.int64) + len(distinct)
    return Pieces(distinct + first.dictionary.to_pylist(), codes, offsets)


def bounded(part: pa.RecordBatch, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``most`` bytes of text (one row at least)."""
    size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(part.column("text")), 0)))
    cuts = np.flatnonzero(np.diff(size // most, prepend=0)) if len(size) else []
    edges = sorted({0, *map(int, cuts), part.num_rows})
    for a, b in zip(edges, edges[1:], strict=False):
        yield part.slice(a, b - a)


def give_back() -> None:
    """Returns freed memory to the system: a Python worker lives on from stage to stage, and what an
    earlier one has freed would else stay with it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def batch(columns: dict[str, pa.Array | np.ndarray | list]) -> pa.RecordBatch:
    """A record batch from named columns, in their order."""
    arrays = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c) for c in columns.values()]
    return pa.RecordBatch.from_arrays([a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a for a in arrays], list(columns))
