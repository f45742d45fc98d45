"""Token ids of a corpus in compressed shard files that answer rank and select queries.

A shard is a wavelet matrix: the ids of consecutive documents as bit-planes, each sorted by the bits
above it, packed, cut into compressed blocks, with ranks counted at every block. A shard file holds a
few megabytes, whatever the corpus; Spark writes and reads the files, so a lost task is written again
and any store that Spark reaches will do.
"""

from __future__ import annotations

import os
import struct
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from brindle.llm.arrowtext import batch, bounded, filled, narrow, pieces
from brindle.session import shared_path

MAGIC = b"WMX1"
BLOCK = 1 << 13  # bytes of a bit-plane that are compressed together
SHARD_TOKENS = 1 << 20
MEMO_PIECES = 500_000


class WaveletMatrix:
    """A shard file in memory. Bit-planes are opened block by block, when a query touches them."""

    def __init__(self, image: bytes):
        magic, self.n, symbols, self.levels = struct.unpack_from("<4sQII", image)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        at = struct.calcsize("<4sQII")
        self.blocks = -(-(-(-self.n // 8)) // BLOCK)

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(image, kind, count, at)
            at += found.nbytes
            return found

        self.alphabet = take("<u4", symbols)
        self.zeros = take("<u8", self.levels)
        self.ranks = take("<u8", self.levels * (self.blocks + 1)).reshape(self.levels, -1)
        sizes = take("<u4", self.levels * self.blocks).astype(np.int64)
        self.places = at + np.concatenate([[0], np.cumsum(sizes)])
        self.image = image
        self._bits = lru_cache(maxsize=256)(self._open)

    @staticmethod
    def build(ids: np.ndarray) -> bytes:
        """The file image of a sequence of ids below 2**32."""
        present = np.flatnonzero(np.bincount(ids)) if len(ids) and ids.max() < 1 << 22 else np.unique(ids)
        levels = max(1, int(len(present) - 1).bit_length())
        narrow_kind = np.uint16 if levels <= 16 else np.uint32
        if len(ids) and present[-1] < 1 << 22:
            number = np.zeros(int(present[-1]) + 1, dtype=narrow_kind)
            number[present] = np.arange(len(present), dtype=narrow_kind)
            order = number[ids]
        else:
            order = np.searchsorted(present, ids).astype(narrow_kind)
        pack = zstandard.ZstdCompressor(level=1)
        zeros, ranks, sizes, body = [], [], [], []
        for level in range(levels - 1, -1, -1):
            bit = (order & order.dtype.type(1 << level)).astype(bool)
            low = np.compress(~bit, order)  # several times as fast as a boolean index
            order = np.concatenate([low, np.compress(bit, order)])
            zeros.append(len(low))
            packed = np.packbits(bit)
            steps = range(0, len(packed), BLOCK)
            counts = np.add.reduceat(bit, np.arange(0, len(bit), BLOCK * 8), dtype=np.int64) if len(bit) else []
            ranks.append(np.concatenate([[0], np.cumsum(counts)]).astype("<u8"))
            for start in steps:
                body.append(pack.compress(packed[start : start + BLOCK].tobytes()))
                sizes.append(len(body[-1]))
        head = struct.pack("<4sQII", MAGIC, len(ids), len(present), levels)
        parts = [present.astype("<u4"), np.array(zeros, "<u8"), *ranks, np.array(sizes, "<u4")]
        return b"".join([head, *(p.tobytes() for p in parts), *body])

    def _open(self, level: int, block: int) -> np.ndarray:
        k = level * self.blocks + block
        raw = zstandard.ZstdDecompressor().decompress(self.image[self.places[k] : self.places[k + 1]], max_output_size=BLOCK)
        return np.unpackbits(np.frombuffer(raw, np.uint8))

    def _rank1(self, level: int, at: int) -> int:
        block, inside = divmod(at, BLOCK * 8)
        ones = int(self.ranks[level, block])
        return ones + (int(self._bits(level, block)[:inside].sum()) if inside else 0)

    def _place(self, level: int, nth: int, bit: int) -> int:
        """Where in a level the ``nth`` (from 0) such bit stands."""
        steps = np.arange(self.blocks + 1, dtype=np.int64) * BLOCK * 8
        before = self.ranks[level].astype(np.int64) if bit else np.minimum(steps, self.n) - self.ranks[level].astype(np.int64)
        block = int(np.searchsorted(before, nth, side="right")) - 1
        return block * BLOCK * 8 + int(np.flatnonzero(self._bits(level, block) == bit)[nth - int(before[block])])

    def _code(self, token: int) -> int | None:
        k = int(np.searchsorted(self.alphabet, token))
        return k if k < len(self.alphabet) and self.alphabet[k] == token else None

    def access(self, at: int) -> int:
        """The token at a place."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        code = 0
        for level in range(self.levels):
            block, inside = divmod(at, BLOCK * 8)
            bit = int(self._bits(level, block)[inside])
            ones = self._rank1(level, at)
            at = int(self.zeros[level]) + ones if bit else at - ones
            code = code << 1 | bit
        return int(self.alphabet[code])

    def _range(self, code: int, low: int, high: int) -> tuple[int, int]:
        for level in range(self.levels):
            a, b = self._rank1(level, low), self._rank1(level, high)
            if code >> (self.levels - 1 - level) & 1:
                low, high = int(self.zeros[level]) + a, int(self.zeros[level]) + b
            else:
                low, high = low - a, high - b
        return low, high

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """Occurrences of a token in ``[low, high)``."""
        code = self._code(token)
        if code is None:
            return 0
        first, last = self._range(code, low, self.n if high is None else high)
        return last - first

    def select(self, token: int, nth: int) -> int:
        """Where the ``nth`` occurrence (from 0) of a token stands."""
        code = self._code(token)
        first, last = self._range(code, 0, self.n) if code is not None else (0, 0)
        if not 0 <= nth < last - first:
            raise IndexError(nth)
        at = first + nth
        for level in range(self.levels - 1, -1, -1):
            bit = code >> (self.levels - 1 - level) & 1
            at = self._place(level, at - int(self.zeros[level]) if bit else at, bit)
        return at

    def decode(self) -> np.ndarray:
        """All ids, as unsigned 32-bit integers."""
        codes = np.zeros(self.n, dtype=np.uint16 if self.levels <= 16 else np.uint32)
        for level in range(self.levels - 1, -1, -1):
            blocks = [self._open(level, b) for b in range(self.blocks)]
            bit = np.concatenate(blocks)[: self.n].view(bool) if blocks else np.zeros(0, bool)
            above = np.empty_like(codes)
            above[np.flatnonzero(~bit)] = codes[: self.zeros[level]]
            above[np.flatnonzero(bit)] = codes[self.zeros[level] :] | codes.dtype.type(1 << (self.levels - 1 - level))
            codes = above
        return self.alphabet[codes]


class PieceMemo:
    """Ids of pieces that a worker met before, as bytes. Two generations bound it: when the young one
    is full it becomes the old one, and what is still used moves over again."""

    def __init__(self, path: str):
        # Spark runs a worker per core already.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        plain = [(k, t.content) for k, t in self.tokenizer.get_added_tokens_decoder().items() if t.special and not (t.normalized or t.lstrip or t.rstrip or t.single_word)]
        self.mark_id, self.mark = plain[0] if plain and self.tokenizer.normalizer is None else (-1, None)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ids(self, distinct: list[str]) -> list[bytes]:
        if len(self.young) > MEMO_PIECES:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        missing = []
        for piece in distinct:
            if piece not in young:
                known = old.get(piece)
                if known is None:
                    missing.append(piece)
                else:
                    young[piece] = known
        for start in range(0, len(missing), 10_000):
            some = missing[start : start + 10_000]
            young.update(zip(some, self._encoded(some), strict=True))
        return [young[piece] for piece in distinct]

    def _encoded(self, some: list[str]) -> list[bytes]:
        """The ids of each piece, from one call. A special token splits a text before anything else
        is done to it, so some pieces at a time go to the tokenizer as one text with that between."""
        if self.mark is not None:
            texts = [self.mark.join(some[k : k + 20]) + self.mark for k in range(0, len(some), 20)]
            ids = np.concatenate([np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])
            ends = (np.flatnonzero(ids == self.mark_id) * 4).tolist()
            if len(ends) == len(some):  # else a piece holds the mark itself
                raw = ids.tobytes()
                return [raw[a:b] for a, b in zip([0, *(e + 4 for e in ends)], ends, strict=False)]
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]


@lru_cache(maxsize=1)
def piece_memo(path: str) -> PieceMemo:
    return PieceMemo(path)


def gather(flat: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Concatenate the ranges ``codes`` of a ragged array; also the running lengths."""
    starts = np.cumsum(lengths) - lengths
    own = lengths[codes]
    ends = np.cumsum(own)
    return flat[np.repeat(starts[codes] - (ends - own), own) + np.arange(ends[-1] if len(ends) else 0)], ends


def encode_texts(path: str, texts: pa.Array, end_id: int, rows: int = 1024) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The ids of a batch, the end id after each text, some rows at a time: first row, ids, and the
    number of ids of each row.

    The tokenizer encodes each distinct piece once; a worker remembers about twice ``MEMO_PIECES``.
    """
    cut = pieces(texts)
    found = piece_memo(path).ids(cut.distinct)
    lengths = np.append(np.fromiter(map(len, found), np.int64, len(found)) // 4, 1)
    flat = np.append(np.frombuffer(b"".join(found), np.uint32), np.uint32(end_id))
    for first in range(0, len(texts), rows):
        bounds = cut.offsets[first : first + rows + 1]
        codes = np.insert(cut.codes[bounds[0] : bounds[-1]], bounds[1:] - bounds[0], len(lengths) - 1)
        ids, ends = gather(flat, lengths, codes)
        yield first, ids, np.diff(ends[bounds[1:] - bounds[0] + np.arange(len(bounds) - 1)], prepend=0)


def write_token_files(
    docs: DataFrame, folder: str, path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", partitions: int | None = None, shard_tokens: int = SHARD_TOKENS
) -> None:
    """Encode all texts in ascending id order and write them to ``folder`` as shard files.

    The table is dealt out by ranges of ids to ``partitions`` (default: as many as other shuffles),
    so one shuffle of the texts orders the corpus; each partition is then encoded as a stream and cut into shards of about ``shard_tokens`` ids, never
    inside a document. Rows of a shard: partition, number in it, ids before it in the partition, ids
    and lengths of its documents, file image. A null text is an empty one and gives the end id
    alone; null ids come first; rows of one id follow each other in the order of their texts' hash.
    An empty table gives files without shards.
    """
    rows = narrow(docs, id_col, text_col).withColumn("hash", F.xxhash64("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    spark = docs.sparkSession
    parts = partitions or max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = rows.repartitionByRange(parts, "doc", "hash").sortWithinPartitions("doc", "hash", "text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, before = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        size = 0

        def shard() -> pa.RecordBatch:
            nonlocal held, size, seq, before
            names = pa.concat_arrays([names for names, _, _ in held])
            ids, lengths = (np.concatenate([h[k] for h in held]) for k in (1, 2))
            made = batch(
                {
                    "part": pa.array([part], pa.int32()),
                    "seq": pa.array([seq], pa.int32()),
                    "before": pa.array([before], pa.int64()),
                    "n": pa.array([size], pa.int64()),
                    "docs": pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names),
                    "lengths": pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), pa.array(lengths, pa.int64())),
                    "image": pa.array([WaveletMatrix.build(ids)], pa.binary()),
                }
            )
            seq, before, held, size = seq + 1, before + size, [], 0
            return made

        for some in (part for rows in batches for part in bounded(rows, 12 << 20)):
            for start, ids, lengths in encode_texts(path, filled(some.column("text")), end_id):
                first = at = 0
                # Cut behind the document with which a shard is full.
                for k, n in enumerate(lengths):
                    size += int(n)
                    at += int(n)
                    if size >= shard_tokens or k == len(lengths) - 1:
                        begin = at - int(lengths[first : k + 1].sum())
                        held.append((some.column("doc").slice(start + first, k + 1 - first), ids[begin:at], lengths[first : k + 1]))
                        first = k + 1
                        if size >= shard_tokens:
                            yield shard()
        if held:
            yield shard()

    schema = f"part int, seq int, before long, n long, docs array<{kind}>, lengths array<long>, image binary"
    # The images are compressed already; small row groups keep a reader's memory small.
    ordered.mapInArrow(write, schema).write.option("compression", "uncompressed").option("parquet.block.size", 16 << 20).parquet(folder)


def read_token_files(spark: SparkSession, folder: str, id_col: str = "doc_id") -> DataFrame:
    """``(id, start, n_tokens, ids)`` of every document from the shard files: ``start`` counts the
    ids of all documents before it, ``ids`` are little-endian unsigned 32-bit integers."""
    shards = spark.read.parquet(folder)
    kind = shards.schema["docs"].dataType.elementType.simpleString()
    totals = shards.groupBy("part").agg(F.sum("n").alias("n"))
    # One row per partition of the writer, not per shard or document.
    offsets = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("offset"))
    # The offsets are one row of two numbers for each partition that wrote: small beside one shard.
    placed = shards.join(F.broadcast(offsets), "part").select(F.col("before").__add__(F.col("offset")).alias("start"), "docs", "lengths", "image")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for k in range(rows.num_rows):
                lengths = np.asarray(rows.column("lengths")[k].values)
                ids = WaveletMatrix(rows.column("image")[k].as_py()).decode().astype("<u4")
                ends = np.cumsum(lengths)
                offsets = pa.array(np.concatenate([[0], ends * 4]), pa.int32())
                yield batch(
                    {
                        "doc": rows.column("docs")[k].values,
                        "start": rows.column("start")[k].as_py() + ends - lengths,
                        "n_tokens": pa.array(lengths, pa.int64()),
                        "ids": pa.Array.from_buffers(pa.binary(), len(lengths), [None, offsets.buffers()[1], pa.py_buffer(ids)]),
                    }
                )

    return placed.mapInArrow(decode, f"doc {kind}, start long, n_tokens long, ids binary").withColumnRenamed("doc", id_col)


def token_files(docs: DataFrame, path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the shard files of ``docs`` to a new folder below ``spark.checkpoint.dir`` and read them back."""
    folder = shared_path(docs.sparkSession, "token-files")
    write_token_files(docs, folder, path, end_id, id_col, text_col)
    return read_token_files(docs.sparkSession, folder, id_col)
