"""Where in a corpus repeated windows may stand: the common first job of the substring operators.

A window of ``window`` units (words or bytes) holds ``window - gram + 1`` grams; the least hash among
them belongs to its content, so equal windows have equal values. Consecutive windows of one value
form a run. Only runs whose value stands at two places of the corpus at least can hold a repeated
window. That is found by shuffling one small record per run, not one per unit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from brindle.llm.arrowtext import batch
from brindle.session import settle

_TOP = np.uint64(2**64 - 1)
# The id that stands for a null id; it sorts first. It cannot be an id itself.
NULL_ID = -(2**63)
GROUP_BYTES = 8 << 20
SLOTS = 1 << 22  # bits of the array of wanted documents; fixed, whatever the corpus


def keyed(docs: DataFrame, id_col: str, text_col: str, *carried: str) -> DataFrame:
    """``(id, hash, text, *carried)``: rows equal in id and text are one document."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_ID)).alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"), *carried)


def grouped(rows: DataFrame, text_bytes: int) -> DataFrame:
    """Keyed rows with the number ``g`` of a group of some megabytes of documents, in which answers
    reach them."""
    groups = max(1, -(-text_bytes // GROUP_BYTES))
    return rows.select("id", "hash", F.pmod(F.xxhash64("id", "hash"), F.lit(groups)).alias("g"), "text")


def unkeyed(id_col: str):
    """The id column again, null where it was."""
    return F.when(F.col("id") != NULL_ID, F.col("id")).alias(id_col)


def likely(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """All rows of wanted documents and few others, so that the join with them shuffles few texts."""
    return rows.where(among(wanted, "id", "hash"))


def among(wanted: DataFrame, *keys: str, of: str = "") -> Column:
    """True for all rows whose keys (fields of the struct ``of``, if given) are wanted and few others.

    A bit array of fixed size has the bits of the wanted keys' hashes; with very many of them it is
    full and keeps every row.
    """

    def place(names: list[str]) -> tuple[Column, Column]:
        slot = F.pmod(F.xxhash64(*names), F.lit(SLOTS))
        bit = slot.bitwiseAND(F.lit(63)).cast("int")
        return F.shiftright(slot, 6).cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), bit)

    word, one = place([*keys])
    filled = wanted.groupBy(word.alias("word")).agg(F.bit_or(one).alias("bits"))
    every = wanted.sparkSession.range(SLOTS // 64).select(F.col("id").cast("int").alias("word")).join(filled, "word", "left")
    every = every.agg(F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))).alias("a"))
    bits = settle(every.select(F.transform("a", lambda x: x["bits"]).alias("bits")), "bits").scalar()
    word, one = place([f"{of}.{k}" if of else k for k in keys])
    return F.get(bits, word).bitwiseAND(one) != 0


def to_blob(columns: dict[str, np.ndarray | pa.Array]) -> bytes:
    """Columns as one compressed binary value; a shuffle then moves few large rows."""
    data, sink = batch(columns), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, data.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(data)
    return sink.getvalue().to_pybytes()


def from_blobs(blobs: list[bytes]) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(b).read_all() for b in blobs])


def mix(x: np.ndarray) -> np.ndarray:
    """Well mixed 64-bit values (the finalizer of splitmix64)."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


BASE = 0x9E3779B97F4A7C15


def rolled(units: np.ndarray, length: int) -> np.ndarray:
    """Polynomial hashes of ``length`` consecutive units from each place, by doubling. Places whose
    range would pass the end hold rubbish."""
    have, size = units, 1
    for bit in bin(length)[3:]:
        have = have * np.uint64(pow(BASE, size, 2**64)) + _ahead(have, size)
        size *= 2
        if bit == "1":
            have = have * np.uint64(BASE) + _ahead(units, size)
            size += 1
    return have


def _ahead(x: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(x)
    if by < len(x):
        out[:-by] = x[by:]
    return out


def sliding(x: np.ndarray, width: int, pick: np.ufunc, beyond: int) -> np.ndarray:
    """``pick`` over ``x[i:i + width]`` for each ``i``; beyond the end stands ``beyond``."""
    have = np.concatenate([x, np.full(width, beyond, x.dtype)])
    size = 1
    while size * 2 <= width:
        have[:-size] = pick(have[:-size], have[size:])
        size *= 2
    return pick(have[: len(x)], have[width - size : width - size + len(x)])


def runs(grams: np.ndarray, offsets: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, ...]:
    """Runs of windows of one value in documents that lie one behind another, and the values that
    stand at two places at least.

    Returns document, first window (in the document), number of windows and value of each run, and
    the sorted repeated values.
    """
    width = window - gram + 1
    length = np.diff(offsets)
    owner = np.repeat(np.arange(len(length)), length)
    left = offsets[1:][owner] - np.arange(len(owner))  # units from here to the document's end
    grams = np.where(left >= gram, np.minimum(mix(grams), _TOP - np.uint64(1)), _TOP)
    least = sliding(grams, width, np.minimum, int(_TOP))
    inside = left >= window
    # A gram stands for a window that holds it if it is as small as that window's least hash.
    highest = sliding(np.where(inside, least, 0)[::-1], width, np.maximum, 0)[::-1]
    places, counts = np.unique(grams[(highest == grams) & (left >= gram)], return_counts=True)
    starts = inside.copy()
    starts[1:] &= (least[1:] != least[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(starts)
    ends = np.flatnonzero(inside & np.append(starts[1:] | ~inside[1:], True)) if len(inside) else at
    return owner[at], at - offsets[owner[at]], ends - at + 1, least[at], places[counts > 1]


def repeated_runs(
    docs: DataFrame, units: Callable[[pa.Array], Iterator[tuple[int, np.ndarray, np.ndarray]]], gram: int, window: int, buckets: int, extra: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None
) -> DataFrame:
    """``(g, data, counts)``: answers to groups of documents with their runs whose value stands at
    two places of the corpus, as blobs of (id, hash, start, n, value).

    ``units`` yields, for a column of texts, pieces of it: the first row, hashes of the units and
    offsets of the rows. A batch answers for values that it holds twice itself and sends one record
    for such a value, so a value that every document holds is one record per batch. ``extra`` may
    add a vector of fixed size per piece; its sum over a task is a row with null data.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for part in batches:
            keys = {c: np.asarray(part.column(c)) for c in ("id", "hash", "g")}
            for first, values, offsets in units(part.column("text")):
                grams = rolled(values, gram)
                doc, start, n, value, twice = runs(grams, offsets, gram, window)
                if extra is not None:
                    more = extra(values, offsets)
                    total = more if total is None else total + more
                if not len(doc):
                    continue
                own = {c: v[doc + first] for c, v in keys.items()} | {"start": start.astype(np.int32), "n": n.astype(np.int32), "value": value}
                known = twice[np.minimum(np.searchsorted(twice, value), max(len(twice) - 1, 0))] == value if len(twice) else np.zeros(len(value), bool)
                yield from answers({c: v[known] for c, v in own.items()})
                # Single values carry their document; repeated ones only themselves, with n = 0.
                sent = {c: np.append(v[~known], twice if c == "value" else np.zeros(len(twice), v.dtype)) for c, v in own.items()}
                yield from scattered(sent, (sent["value"] % np.uint64(buckets)).astype(np.int64), buckets)
        if total is not None:
            yield _rows([-1], [-1], [None], [total.tolist()])

    def settle_bucket(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        table = from_blobs(blobs)
        value = table["value"].to_numpy()
        order = np.argsort(value, kind="stable")
        value, n = value[order], table["n"].to_numpy()[order]
        same = value[1:] == value[:-1]
        again = np.append(same, False) | np.append(False, same)
        begin = np.append(True, ~same)
        noted = np.maximum.reduceat(n == 0, np.flatnonzero(begin))[np.cumsum(begin) - 1]
        keep = order[(again | noted) & (n > 0)]
        yield from answers({c: table[c].to_numpy()[keep] for c in table.column_names})

    return reduced(docs.select("id", "hash", "g", "text").mapInArrow(find, SENT), settle_bucket)


# What the first stage of a job sends: a blob to a bucket, or (bucket -1) an answer to a group.
SENT = "bucket int, g long, data binary, counts array<long>"
_KINDS = {"bucket": pa.int32(), "g": pa.int64(), "data": pa.binary(), "counts": pa.list_(pa.int64())}


def as_table(rows: list[pa.RecordBatch]) -> pa.Table:
    return pa.Table.from_batches(rows, pa.schema(_KINDS))


def scattered(columns: dict[str, np.ndarray], bucket: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """One blob row per bucket; the order of the records stays."""
    order = np.argsort(bucket, kind="stable")
    bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
    rows = [(k, to_blob({c: v[order[a:b]] for c, v in columns.items()})) for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)) if b > a]
    if rows:
        yield _rows([k for k, _ in rows], [-1] * len(rows), [b for _, b in rows], [None] * len(rows))


def answers(columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """One blob row per group of documents, from records with the group in ``g``."""
    order = np.argsort(columns["g"], kind="stable")
    g = columns["g"][order]
    if len(g):
        cuts = np.flatnonzero(np.diff(g, prepend=-1))
        data = [to_blob({c: v[order[a:b]] for c, v in columns.items() if c != "g"}) for a, b in zip(cuts, [*cuts[1:], len(g)], strict=True)]
        yield _rows([-1] * len(cuts), g[cuts].tolist(), data, [None] * len(cuts))


def _rows(bucket: list[int], g: list[int], data: list[bytes | None], counts: list) -> pa.RecordBatch:
    return batch({c: pa.array(v, kind) for (c, kind), v in zip(_KINDS.items(), (bucket, g, data, counts), strict=True)})


def reduced(sent: DataFrame, settle_bucket: Callable[[list[bytes]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """Answers of all buckets, and the answers that are ready already, as ``(g, data, counts)``.

    Buckets are dealt out by key and met in order, so a task holds one bucket at a time; ready
    answers pass through.
    """
    by = F.when(F.col("bucket") >= 0, F.col("bucket").cast("long")).otherwise(F.xxhash64("g"))

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = -1, []
        for part in batches:
            bucket = np.asarray(part.column("bucket"))
            ready = np.flatnonzero(bucket < 0)
            if len(ready):
                yield part.take(pa.array(ready)).select(["g", "data", "counts"])
            for k in np.flatnonzero(bucket >= 0):
                if bucket[k] != current:
                    yield from (x.select(["g", "data", "counts"]) for x in (settle_bucket(held) if held else ()))
                    current, held = bucket[k], []
                held.append(part.column("data")[k].as_py())
        yield from (x.select(["g", "data", "counts"]) for x in (settle_bucket(held) if held else ()))

    dealt = sent.withColumn("by", by).repartition("by").sortWithinPartitions("bucket").drop("by")
    return dealt.mapInArrow(settle, "g long, data binary, counts array<long>")


def with_answers(docs: DataFrame, sent: DataFrame, work: Callable[[int, pa.Table, dict[str, np.ndarray], np.ndarray], pa.Table], schema: str) -> DataFrame:
    """``work(g, documents, records, owner)`` of every group: its documents in the order of their keys,
    the columns of all records sent to it, sorted by document, and the number of each record's
    document. Groups are of bounded size. Equal rows are adjacent; records belong to the first."""

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        g = left["g"][0].as_py() if left.num_rows else -1
        left = left.select(["id", "hash", "text"]).sort_by([("id", "ascending"), ("hash", "ascending")]).combine_chunks()
        blobs = right["data"].to_pylist()
        if not blobs or not left.num_rows:
            return work(g, left, {}, np.zeros(0, np.int64))
        table = from_blobs(blobs)
        keys = [np.unique(np.concatenate([left[c].to_numpy(), table[c].to_numpy()]), return_inverse=True)[1] for c in ("id", "hash")]
        key = keys[0] * (keys[1].max() + 1) + keys[1]
        own, asked = key[: left.num_rows], key[left.num_rows :]
        owner = np.searchsorted(own, asked)
        order = np.lexsort((table["start"].to_numpy(), owner))
        return work(g, left, {c: table[c].to_numpy()[order] for c in table.column_names if c not in ("id", "hash")}, owner[order])

    return docs.groupBy("g").cogroup(sent.select("g", "data").groupBy("g")).applyInArrow(meet, schema)
