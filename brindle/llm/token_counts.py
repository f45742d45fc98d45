"""Token counts of byte-level BPE by rank-synchronous array merging.

The distinct pre-tokens of a batch lie in one ragged array of symbol ids. In every round each
sequence finds its lowest-rank adjacent pair and merges all places of that pair at once; sequences
without a mergeable pair leave with their number of symbols.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F

from brindle.llm.arrowtext import batch, filled, narrow, pieces, sums

# Fixed value: the published pre-token pattern of this tokenizer family.
PRETOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_NONE = np.int64(1) << 40


class MergeTable:
    """Merges of a byte-level BPE file as arrays: sorted pair keys with ranks, and the symbol that
    each rank makes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or before.get("type") != "ByteLevel" or spec["normalizer"] or before.get("add_prefix_space"):
            raise ValueError("only byte-level BPE files without a normalizer are supported")
        vocab = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in merges], dtype=np.int64)
        right = np.array([vocab[b] for _, b in merges], dtype=np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        rank_of = np.full(max(vocab.values()) + 1, -1, dtype=np.int64)
        rank_of[self.made] = np.arange(len(merges))
        if (np.maximum(rank_of[left], rank_of[right]) >= np.arange(len(merges))).any():
            raise ValueError("a merge precedes the merge that makes one of its parts")
        keys = left << 20 | right
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        # Printable Latin-1 bytes stand for themselves, the others for the code points from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        spare = iter(range(256, 512))
        letters = {b: chr(b) if b in plain else chr(next(spare)) for b in range(256)}
        self.byte_ids = np.array([vocab[letters[b]] for b in range(256)], dtype=np.int64)
        specials = [t["content"] for t in spec["added_tokens"]]
        self.specials = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))) if specials else None

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.ranks[at], _NONE)

    def pretokens(self, piece: str) -> tuple[list[str], int]:
        """The pre-tokens of a piece and how many added tokens stand between them."""
        if self.specials is None or not self.specials.search(piece):
            return PRETOKEN.findall(piece), 0
        parts = self.specials.split(piece)
        return [token for part in parts for token in PRETOKEN.findall(part)], len(parts) - 1


@lru_cache(maxsize=4)
def merge_table(path: str) -> MergeTable:
    return MergeTable(path)


def merged_lengths(table: MergeTable, words: pa.Array) -> np.ndarray:
    """How many symbols are left of each of the words (non-empty UTF-8 strings)."""
    raw = words.cast(pa.large_binary())
    lengths = np.asarray(pc.binary_length(raw)).astype(np.int64)
    text = np.frombuffer(raw.buffers()[2], dtype=np.uint8)
    first = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset] if len(raw) else 0
    symbols = table.byte_ids[text[first : first + lengths.sum()]]
    result = np.zeros(len(words), dtype=np.int64)
    owner = np.flatnonzero(lengths)
    lengths = lengths[owner]

    def last_of(lengths: np.ndarray) -> np.ndarray:
        return np.cumsum(lengths) - 1

    ranks = np.full(len(symbols), _NONE)
    if len(symbols) > 1:
        ranks[:-1] = table.rank(symbols[:-1], symbols[1:])
        ranks[last_of(lengths)] = _NONE
    while len(owner):
        starts = np.cumsum(lengths) - lengths
        lowest = np.minimum.reduceat(ranks, starts)
        live = lowest < _NONE
        if not live.all():
            result[owner[~live]] = lengths[~live]
            stay = np.repeat(live, lengths)
            symbols, ranks = symbols[stay], ranks[stay]
            owner, lengths, lowest = owner[live], lengths[live], lowest[live]
            if not len(owner):
                break
            starts = np.cumsum(lengths) - lengths
        hit = ranks == np.repeat(lowest, lengths)
        if (hit[1:] & hit[:-1]).any():
            # A pair of one symbol with itself overlaps in a run: merge every other place of a run.
            at = np.flatnonzero(hit)
            begin = np.r_[True, np.diff(at) > 1]
            nth = np.arange(len(at)) - np.maximum.accumulate(np.where(begin, np.arange(len(at)), 0))
            hit[at[nth % 2 == 1]] = False
        at = np.flatnonzero(hit)
        symbols[at] = table.made[ranks[at]]
        keep = np.ones(len(symbols), dtype=bool)
        keep[at + 1] = False
        lengths = lengths - np.add.reduceat(hit.astype(np.int64), starts)
        at = at - np.arange(len(at))
        symbols, ranks = symbols[keep], ranks[keep]
        ends = np.zeros(len(symbols), dtype=bool)
        ends[last_of(lengths)] = True
        for places in (at, at[at > 0] - 1):
            inner = places[~ends[places]]
            ranks[places] = _NONE
            ranks[inner] = table.rank(symbols[inner], symbols[inner + 1])
    return result


def text_counts(table: MergeTable, texts: pa.Array) -> np.ndarray:
    """Token counts of a batch of texts."""
    cut = pieces(texts)
    found = [table.pretokens(piece) for piece in cut.distinct]
    flat = pa.array([token for tokens, _ in found for token in tokens], pa.large_string()).dictionary_encode()
    offsets = np.concatenate([[0], np.cumsum(np.fromiter((len(t) for t, _ in found), np.int64, len(found)))])
    lengths = merged_lengths(table, flat.dictionary)
    per_piece = sums(lengths[np.asarray(flat.indices)], offsets) + np.fromiter((n for _, n in found), np.int64, len(found))
    return sums(per_piece[cut.codes], cut.offsets)


def count_tokens(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` of every row, whole texts, no shuffle.

    Counts are those of the tokenizer file without begin, end or added special tokens; strings of
    added tokens inside a text count as one token each. A null text counts as empty (0 bytes, 0
    tokens). Rows are independent: null or repeated ids give one row each. An empty table gives an
    empty result. Other columns are dropped.
    """
    rows = narrow(docs, id_col, text_col)
    kind = rows.schema["doc"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = merge_table(path)
        for rows in batches:
            texts = filled(rows.column("text"))
            n_bytes = np.asarray(pc.binary_length(texts)).astype(np.int64)
            yield batch({"doc": rows.column("doc"), "n_bytes": n_bytes, "n_tokens": text_counts(table, texts)})

    counted = rows.mapInArrow(count, f"doc {kind}, n_bytes long, n_tokens long")
    return counted.select(F.col("doc").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
