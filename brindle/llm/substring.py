"""Substring deduplication with prefix-partitioned suffix trees over words.

Suffixes are the word sequences from each place, cut at ``window`` words. Their letters are
fingerprints of ``window / 4`` words each, so a suffix is four letters of 32 bits. Suffixes that
cannot repeat are left out beforehand (``repeats``). The others are dealt out by variable-length
prefixes: a prefix of some bits of the first letter is merged with its neighbours while they are
few, and extended by the second letter where there are many, so that each group fits in memory. A
group's suffixes in lexicographic order are the leaves of its tree; neighbours that agree in all four
letters hang below one deep internal node, whose first leaf (by document and place) stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from brindle.llm.arrowtext import batch, bounded, total_bytes
from brindle.llm.repeats import SENT, answers, as_table, from_blobs, grouped, keyed, mix, reduced, repeated_runs, rolled, scattered, unkeyed, with_answers
from brindle.session import settle

PREFIX_BITS = 12
GROUP_SUFFIXES = 1 << 21
BUCKET_BYTES = 24 << 20  # text bytes behind one bucket of the first job


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of all texts, and the texts' offsets."""
    lists = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    offsets = np.asarray(lists.offsets).astype(np.int64)
    flat = lists.flatten().dictionary_encode()
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, flat.dictionary.cast(pa.large_binary()).to_pylist()), np.uint64, len(flat.dictionary))
    codes = np.asarray(flat.indices)
    filled = np.asarray(pc.greater(pc.binary_length(flat.dictionary), 0))[codes] if len(codes) else np.zeros(0, bool)
    kept = np.concatenate([[0], np.cumsum(filled)])
    return own[codes][filled], kept[offsets - offsets[0]]


def _units(texts: pa.Array):
    first = 0
    for part in bounded(batch({"text": texts})):
        yield first, *word_hashes(part.column("text"))
        first += part.num_rows


def letters(values: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The four letters of the suffix at each place, two to a 64-bit key."""
    step = window // 4
    letter = mix(rolled(values, step)) >> np.uint64(32)
    parts = [np.concatenate([letter[k * step :], np.zeros(min(k * step, len(letter)), np.uint64)])[: len(letter)] for k in range(4)]
    return parts[0] << np.uint64(32) | parts[1], parts[2] << np.uint64(32) | parts[3]


class Prefixes:
    """Which group a suffix belongs to, from the number of suffixes behind each short prefix."""

    def __init__(self, counts: np.ndarray, size: int = GROUP_SUFFIXES):
        self.bits = np.zeros(len(counts), np.uint64)  # further bits of a long prefix
        self.first = np.zeros(len(counts), np.int64)
        group, filled = -1, size
        for k, n in enumerate(counts.tolist()):
            if n > size:
                self.bits[k] = int(n // size).bit_length()
                self.first[k] = group + 1
                group, filled = group + (1 << int(self.bits[k])), size
                continue
            if filled + n > size:
                group, filled = group + 1, 0
            self.first[k], filled = group, filled + n
        self.groups = max(group + 1, 1)

    def of(self, high: np.ndarray) -> np.ndarray:
        short = (high >> np.uint64(64 - PREFIX_BITS)).astype(np.int64)
        bits = self.bits[short]
        longer = np.where(bits > 0, mix(high) >> np.minimum(np.uint64(64) - bits, np.uint64(63)), 0).astype(np.int64)
        return self.first[short] + longer


def deep_nodes(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The leaves in lexicographic order (ties in the given order), and which of them begins a node:
    the others agree with the leaf before them in the whole suffix."""
    order = np.lexsort((low, high))
    begins = np.ones(len(order), bool)
    begins[1:] = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
    return order, begins


def dedup_substrings(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_words, n_removed, kept)`` of every row: the text without repeated word sequences.

    Words are ``[^\\x20\\x09-\\x0D]+``. A word goes if a window of ``window`` words over it also
    starts earlier: in a document of a smaller id, or earlier in the same document. Windows are
    judged on the input. ``kept`` is the remaining words joined by single spaces.

    ``window`` must be a multiple of 4. Ids are integers; a null id is smaller than all others.
    Rows equal in id and text are one document: each gets the document's result. Rows of one id
    and different texts are different documents, ordered by the hash of their text. A null text has
    no words and gives an empty ``kept``. An empty table gives an empty result. Other columns are
    dropped. Equality of windows is that of 128-bit fingerprints of 64-bit word hashes.
    """
    if window % 4 or window <= 0:
        raise ValueError("window must be a multiple of 4")
    text_bytes = total_bytes(docs, text_col)
    rows = grouped(keyed(docs, id_col, text_col), text_bytes)
    buckets = max(1, -(-text_bytes // BUCKET_BYTES))

    def counted(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        high, _ = letters(values, window)
        return np.bincount((high >> np.uint64(64 - PREFIX_BITS)).astype(np.int64), minlength=1 << PREFIX_BITS)

    found = settle(repeated_runs(rows, _units, window // 2, window, buckets, counted), "runs")
    # One vector of fixed size per task: which short prefixes are frequent.
    counts = np.zeros(1 << PREFIX_BITS, np.int64)
    sized = found.where("counts is not null").select(F.posexplode("counts").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n"))
    for k, n in sized.collect():
        counts[k] = n
    prefixes = Prefixes(counts)
    where = found.where("data is not null")

    def suffixes(g: int, docs: pa.Table, runs: dict[str, np.ndarray], owner: np.ndarray) -> pa.Table:
        out: list[pa.RecordBatch] = []
        if len(owner):
            ids, hashes = docs["id"].to_numpy(), docs["hash"].to_numpy()
            values, offsets = word_hashes(docs["text"].combine_chunks())
            high, low = letters(values, window)
            chosen = np.zeros(len(values) + 1, np.int32)
            np.add.at(chosen, offsets[owner] + runs["start"], 1)
            np.add.at(chosen, offsets[owner] + runs["start"] + runs["n"], -1)
            at = np.flatnonzero(np.cumsum(chosen)[:-1] > 0)
            doc = np.searchsorted(offsets, at, side="right") - 1
            leaves, begins = deep_nodes(high[at], low[at])
            # Leaves that repeat within this group are known; the first of each node travels.
            later, sent = np.sort(leaves[~begins]), np.sort(leaves[begins])
            out += answers(_covered({"id": ids[doc[later]], "hash": hashes[doc[later]], "g": np.full(len(later), g)}, at[later] - offsets[doc[later]], window))
            spot, doc = at[sent], doc[sent]
            columns = {"high": high[spot], "low": low[spot], "id": ids[doc], "hash": hashes[doc], "g": np.full(len(doc), g), "start": (spot - offsets[doc]).astype(np.int32)}
            out += scattered(columns, prefixes.of(high[spot]), prefixes.groups)
        return as_table(out)

    def tree(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        table = from_blobs(blobs)
        columns = {c: table[c].to_numpy() for c in table.column_names}
        order = np.lexsort((columns["start"], columns["hash"], columns["id"]))
        columns = {c: v[order] for c, v in columns.items()}
        leaves, begins = deep_nodes(columns["high"], columns["low"])
        later = np.sort(leaves[~begins])
        yield from answers(_covered({c: columns[c][later] for c in ("id", "hash", "g")}, columns["start"][later], window))

    # Both times the texts are dealt out by group, so Spark shuffles them once.
    marks = reduced(with_answers(rows, where, suffixes, SENT), tree)

    def cut(g: int, docs: pa.Table, covered: dict[str, np.ndarray], owner: np.ndarray) -> pa.Table:
        ids, hashes = docs["id"].to_numpy(), docs["hash"].to_numpy()
        total, gone, kept = [], [], []
        bounds = np.searchsorted(owner, np.arange(len(ids) + 1))
        first = 0
        for k, text in enumerate(docs["text"].cast(pa.binary()).to_pylist()):
            # Equal rows share the records of the first of them.
            first = first if k and ids[k] == ids[first] and hashes[k] == hashes[first] else k
            words = text.split()
            total.append(len(words))
            a, b = bounds[first], bounds[first + 1]
            if b > a:
                stays = np.zeros(len(words) + 1, np.int32)
                np.add.at(stays, covered["start"][a:b], 1)
                np.add.at(stays, covered["end"][a:b], -1)
                words = [words[x] for x in np.flatnonzero(np.cumsum(stays[:-1]) == 0).tolist()]
            gone.append(total[-1] - len(words))
            kept.append(b" ".join(words))
        return pa.table({"id": docs["id"], "n_words": pa.array(total, pa.int64()), "n_removed": pa.array(gone, pa.int64()), "kept": pa.array(kept, pa.binary()).cast(pa.string())})

    out = with_answers(rows, marks, cut, "id long, n_words long, n_removed long, kept string")
    return out.select(unkeyed(id_col), "n_words", "n_removed", "kept")


def _covered(keys: dict[str, np.ndarray], start: np.ndarray, window: int) -> dict[str, np.ndarray]:
    """Words covered by windows (sorted by document and place), as ranges ``[start, end)``."""
    if not len(start):
        return keys | {"start": start.astype(np.int32), "end": start.astype(np.int32)}
    change = (np.diff(keys["id"]) != 0) | (np.diff(keys["hash"]) != 0) | (np.diff(start) > window)
    first, last = np.append(True, change), np.append(change, True)
    return {c: v[first] for c, v in keys.items()} | {"start": start[first].astype(np.int32), "end": (start[last] + window).astype(np.int32)}
