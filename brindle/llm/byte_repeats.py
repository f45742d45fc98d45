"""Removal of repeated byte strings with run-length BWT indexes.

Runs of windows that may repeat (``repeats``) are cut out of the texts and dealt out by their value,
so equal windows meet in one bucket of bounded size. Segments that are equal as a whole are counted,
not indexed. Over the different segments of the values that have several, a bucket builds the
Burrows-Wheeler transform and keeps its runs with the text positions of the run ends (the samples of
an r-index). A position inside a run inherits its match with its neighbour from the position before
it, one byte shorter; only run ends compare text. So streaming the positions in text order gives
every position's longest match with another place, and those of at least ``window`` bytes are marked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from brindle.llm.arrowtext import filled, total_bytes
from brindle.llm.repeats import SENT, answers, as_table, from_blobs, grouped, keyed, mix, reduced, repeated_runs, scattered, unkeyed, with_answers
from brindle.session import settle

BUCKET_BYTES = 24 << 20  # text bytes behind one bucket of runs
INDEX_BYTES = 2 << 20  # and behind one index, which takes some 120 bytes of memory for each of its own
SLICE_BYTES = 1 << 19
_BYTE_HASHES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def byte_units(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Hashes of the bytes of the texts, a slice of rows at a time (one long row may fill one)."""
    raw = filled(texts).cast(pa.large_binary())
    ends = np.cumsum(np.asarray(pc.binary_length(raw)).astype(np.int64))
    first = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset] if len(raw) else 0
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[first:]
    at = 0
    while at < len(ends):
        begin = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, begin + SLICE_BYTES, side="right")))
        yield at, _BYTE_HASHES[data[begin : ends[stop - 1]]], np.concatenate([[0], ends[at:stop] - begin])
        at = stop


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffixes of a sequence of symbols below 512 in order; only suffixes that are still tied are
    sorted again, by the rank of what follows, with doubled length."""
    n = len(symbols)
    width = 7
    key = np.zeros(n, np.int64)
    for k in range(width):
        key = key << 9
        key[: n - k] |= symbols[k:]
    order = np.argsort(key)
    sorted_key = key[order]
    begins = np.append(True, sorted_key[1:] != sorted_key[:-1])
    place = np.flatnonzero(begins)
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = place[np.cumsum(begins) - 1]
    # Suffixes that end inside the key are shorter than their ties: their own order is by what follows.
    while True:
        tied = np.flatnonzero(~(begins & np.append(begins[1:], True)))
        if not len(tied):
            return order
        members = order[tied]
        follow = rank[np.minimum(members + width, n)]
        group = rank[members]
        again = np.argsort(group * (n + 1) + follow + 1)
        members, group, follow = members[again], group[again], follow[again]
        order[tied] = members
        fresh = np.append(True, (group[1:] != group[:-1]) | (follow[1:] != follow[:-1]))
        begins[tied] = fresh
        rank[members] = tied[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
        width *= 2


def common_lengths(symbols: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many symbols agree from the places ``a`` and ``b`` on."""
    n = len(symbols)
    padded = np.concatenate([symbols, np.full(8, 511, symbols.dtype)]).astype(np.int64)
    packed = np.zeros(n + 1, np.int64)
    for k in range(7):
        packed = packed << 9 | padded[k : n + 1 + k]
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    while len(live):
        x, y = a[live] + out[live], b[live] + out[live]
        inside = np.maximum(x, y) < n
        live, x, y = live[inside], x[inside], y[inside]
        same = packed[x] == packed[y]
        rest = live[~same]
        xr, yr = x[~same], y[~same]
        for k in range(6):
            # The end of the sequence agrees with nothing.
            fits = np.maximum(xr, yr) + k < n
            step = np.zeros(len(rest), bool)
            step[fits] = symbols[xr[fits] + k] == symbols[yr[fits] + k]
            out[rest[step]] += 1
            rest, xr, yr = rest[step], xr[step], yr[step]
        live = live[same]
        out[live] += 7
        over = np.maximum(a[live], b[live]) + out[live] > n
        out[live[over]] = n - np.maximum(a[live[over]], b[live[over]])
        live = live[~over]
    return out


class RunIndex:
    """Run-compressed BWT of a text with the text positions of the run ends."""

    def __init__(self, symbols: np.ndarray):
        order = suffix_array(symbols)
        before = np.where(order > 0, symbols[order - 1].astype(np.int64), -1)
        heads = np.flatnonzero(np.append(True, before[1:] != before[:-1]))
        self.n = len(symbols)
        self.heads = heads  # where the runs start in the transform
        self.letters = before[heads]
        self.head_samples = order[heads]
        self.tail_samples = order[np.append(heads[1:], self.n) - 1]
        # What two neighbouring runs share where they meet.
        meet = common_lengths(symbols, self.tail_samples[:-1], self.head_samples[1:])
        self.with_previous = np.append(0, meet)
        self.with_next = np.append(meet, 0)

    def matches(self) -> np.ndarray:
        """The longest match of each text position with any other position."""
        best = np.zeros(self.n, np.int64)
        for samples, shared in ((self.head_samples, self.with_previous), (self.tail_samples, self.with_next)):
            at = np.argsort(samples)
            places, values = samples[at], shared[at]
            last = np.searchsorted(places, np.arange(self.n), side="right") - 1
            value = np.where(last >= 0, values[last] - (np.arange(self.n) - places[last]), 0)
            np.maximum(best, value, out=best)
        return best


def long_matches(segments: list[bytes], window: int) -> list[np.ndarray]:
    """For each segment, whether the window from each of its places also starts anywhere else in the
    segments."""
    sizes = np.array([len(s) for s in segments], np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    symbols = np.zeros(int((sizes + 1).sum()), np.int16)
    for at, segment in zip(begins.tolist(), segments, strict=True):
        symbols[at : at + len(segment)] = np.frombuffer(segment, np.uint8)
        symbols[at : at + len(segment)] += 1
    found = RunIndex(symbols).matches() >= window
    return [found[at : at + max(n - window + 1, 0)] for at, n in zip(begins.tolist(), sizes.tolist(), strict=True)]


def spans(flags: np.ndarray, offset: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of bytes that the flagged windows cover."""
    at = np.flatnonzero(flags)
    if not len(at):
        return at, at
    first = np.append(True, at[1:] > at[:-1] + window)
    return at[first] + offset, at[np.append(first[1:], True)] + window + offset


def remove_repeats(docs: DataFrame, window: int = 400, gram: int = 128, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_removed, spans, kept)`` of every row: texts as UTF-8 bytes without the bytes
    that a string of ``window`` bytes covers which also starts anywhere else in the corpus.

    All places of a repeated string go; matches may overlap and do not cross documents. Strings are
    judged on the input and compared byte by byte. ``spans`` are the maximal removed ranges of
    bytes, ``kept`` the other bytes (binary: a cut may fall inside a character).

    Ids are integers or null. Rows equal in id and text are one document, whose strings do not
    count as repeated for being in several rows; each row gets the document's result. Rows of one
    id and different texts are different documents. A null text is empty. An empty table gives an
    empty result. Other columns are dropped.
    """
    text_bytes = total_bytes(docs, text_col)
    rows = grouped(keyed(docs, id_col, text_col), text_bytes)
    indexes = max(1, -(-text_bytes // INDEX_BYTES))
    found = settle(repeated_runs(rows, byte_units, gram, window, max(1, -(-text_bytes // BUCKET_BYTES))), "runs")

    def segments(g: int, docs: pa.Table, runs: dict[str, np.ndarray], owner: np.ndarray) -> pa.Table:
        out: list[pa.RecordBatch] = []
        if len(owner):
            ids, hashes, texts = docs["id"].to_numpy(), docs["hash"].to_numpy(), docs["text"].cast(pa.binary())
            # Equal rows in several tasks have sent equal runs.
            records = sorted(set(zip(owner.tolist(), runs["start"].tolist(), runs["n"].tolist(), runs["value"].tolist(), strict=True)))
            own: dict[tuple[int, bytes], list[tuple[int, int, int]]] = {}
            doc, text = -1, b""
            for k, start, n, value in records:
                if k != doc:
                    doc, text = k, texts[k].as_py()
                own.setdefault((value, text[start : start + n - 1 + window]), []).append((k, start, start + n - 1 + window))
            whole = [place for places in own.values() if len(places) > 1 for place in places]
            out += answers(_marks([(int(ids[k]), int(hashes[k]), g, a, b) for k, a, b in whole]))
            firsts = [(value, segment, places[0], len(places) > 1) for (value, segment), places in own.items()]
            at = np.array([p[0] for _, _, p, _ in firsts])
            columns = {
                "value": np.array([v for v, _, _, _ in firsts], np.uint64),
                "id": ids[at],
                "hash": hashes[at],
                "g": np.full(len(at), g),
                "start": np.array([p[1] for _, _, p, _ in firsts], np.int32),
                "several": np.array([m for _, _, _, m in firsts]),
                "segment": np.array([s for _, s, _, _ in firsts], dtype=object),
            }
            out += scattered(columns, (columns["value"] % np.uint64(indexes)).astype(np.int64), indexes)
        return as_table(out)

    def index(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        table = from_blobs(blobs).to_pydict()
        own: dict[int, dict[bytes, list[int]]] = {}
        for k, (value, segment) in enumerate(zip(table["value"], table["segment"], strict=True)):
            own.setdefault(value, {}).setdefault(segment, []).append(k)
        marked: list[tuple[int, ...]] = []
        asked: list[tuple[bytes, int | None]] = []

        def mark(k: int, a: int, b: int) -> None:
            marked.append((table["id"][k], table["hash"][k], table["g"][k], a, b))

        for different in own.values():
            for segment, places in different.items():
                whole = len(places) > 1 or table["several"][places[0]]
                if whole:
                    for k in places:
                        mark(k, table["start"][k], table["start"][k] + len(segment))
                if len(different) > 1 or (not whole and len(segment) > window):
                    asked.append((segment, None if whole else places[0]))
        for (_, k), flags in zip(asked, long_matches([s for s, _ in asked], window) if asked else [], strict=True):
            if k is not None:
                for a, b in zip(*(x.tolist() for x in spans(flags, table["start"][k], window)), strict=True):
                    mark(k, a, b)
        yield from answers(_marks(marked))

    # Both times the texts are dealt out by group, so Spark shuffles them once.
    marks = reduced(with_answers(rows, found, segments, SENT), index)

    def cut(g: int, docs: pa.Table, covered: dict[str, np.ndarray], owner: np.ndarray) -> pa.Table:
        ids, hashes = docs["id"].to_numpy(), docs["hash"].to_numpy()
        bounds = np.searchsorted(owner, np.arange(len(ids) + 1))
        total, ranges, kept, first = [], [], [], 0
        for k, text in enumerate(docs["text"].cast(pa.binary()).to_pylist()):
            # Equal rows share the records of the first of them.
            first = first if k and ids[k] == ids[first] and hashes[k] == hashes[first] else k
            a, b = bounds[first], bounds[first + 1]
            gone = _joined(covered["start"][a:b].tolist(), covered["end"][a:b].tolist()) if b > a else []
            ends = [0, *(b for _, b in gone)]
            total.append(len(text))
            ranges.append([{"start": a, "end": b} for a, b in gone])
            kept.append(b"".join(text[a:b] for a, b in zip(ends, [*(a for a, _ in gone), len(text)], strict=True)) if gone else text)
        kinds = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table({"id": docs["id"], "n_bytes": pa.array(total, pa.int64()), "spans": pa.array(ranges, kinds), "kept": pa.array(kept, pa.binary())})

    out = with_answers(rows, marks, cut, "id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    return out.select(unkeyed(id_col), "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), "spans", "kept")


def _marks(marks: list[tuple[int, ...]]) -> dict[str, np.ndarray]:
    columns = np.array(marks, np.int64).reshape(-1, 5).T
    return dict(zip(("id", "hash", "g"), columns, strict=False)) | {"start": columns[3].astype(np.int32), "end": columns[4].astype(np.int32)}


def _joined(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """Union of ranges."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(zip(starts, ends, strict=True)):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out
