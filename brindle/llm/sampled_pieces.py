"""Sampled SentencePiece segmentations by forward filtering and backward sampling.

The probability of a segmentation is proportional to the product of its pieces' weights to the power
``alpha``. No piece holds a space mark behind another character, so the lattice of a text falls apart
at its spaces: the forward pass runs once over each distinct piece of text of a batch, the backward
pass samples every occurrence. The random number at a place depends only on the seed, the row key and
that place, so a segmentation does not depend on batches or partitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from brindle.llm.arrowtext import batch, bounded, filled, pieces, sums
from brindle.llm.token_files import gather

MARK = "▁"
# Stands for a literal MARK of a text, which must not decode to a space; no valid text holds it.
_LITERAL = "\ud800"
_END = (1 << 21) - 1
SLICE_BYTES = 1 << 20  # of text that are sampled at a time
LATTICES = 20_000  # distinct pieces of text whose lattices stand at a time


class PieceModel:
    """Pieces of a model file with log weights, and the ids of its byte pieces.

    Unigram models give their scores. BPE models have no weights: their score is minus the rank of
    the merge, and a piece weighs ``1 / (rank + 2)``, as in Zipf's law.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        known = self.processor
        scores = np.array([known.get_score(k) for k in range(known.get_piece_size())])
        plain = [k for k in range(len(scores)) if not (known.is_control(k) or known.is_unknown(k) or known.is_byte(k) or known.is_unused(k))]
        # User-defined runs of spaces carry no rank; they weigh as little as the last piece.
        scores = np.maximum(scores, scores[plain][scores[plain] > -1e6].min())
        if np.all(scores[plain] == np.round(scores[plain])):
            scores = -np.log(2 - np.minimum(scores, 0))
        self.weights = scores
        ids = {known.id_to_piece(k): k for k in plain}
        if any(MARK in piece.lstrip(MARK) for piece in ids):
            raise ValueError("pieces with a space mark behind another character are not supported")
        self.byte_ids = np.array([known.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int64)
        if not all(known.is_byte(int(k)) for k in self.byte_ids):
            raise ValueError("a model without byte pieces cannot encode every text")
        self.byte_weight = float(scores[plain].min())
        # The pieces as a trie: sorted keys (node, code point) with the node that each leads to.
        nodes = {prefix: n for n, prefix in enumerate(sorted({piece[:k] for piece in ids for k in range(len(piece) + 1)}))}
        self.piece_of = np.full(len(nodes), -1, np.int32)
        self.piece_of[[nodes[piece] for piece in ids]] = list(ids.values())
        steps = sorted((nodes[prefix[:-1]] << 21 | ord(prefix[-1]), n) for prefix, n in nodes.items() if prefix)
        self.keys, self.next = np.array([k for k, _ in steps], np.int64), np.array([n for _, n in steps], np.int64)

    def lattices(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Edges of the lattices of all texts, sorted by end, as starts, ends and piece ids; nodes
        are numbered across the texts. A character that is no piece itself gets an edge for its
        byte pieces, with minus one minus its code point as id. All places walk the trie at once."""
        ends_of = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        # What is no code point stands at the end of each text, so no walk leaves it.
        points = np.insert(points, ends_of, _END)
        at = np.flatnonzero(points != _END)
        here, node, width = at, np.zeros(len(at), np.int64), 0
        starts, ends, ids = [], [], []
        while len(here):
            key = node << 21 | points[here + width]
            found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[found] == key
            here, node, width = here[known], self.next[found[known]], width + 1
            piece = self.piece_of[node]
            whole = piece >= 0
            starts.append(here[whole])
            ends.append(here[whole] + width)
            ids.append(piece[whole].astype(np.int64))
            if width == 1:
                foreign = np.setdiff1d(at, here[whole], assume_unique=True)
                starts.append(foreign)
                ends.append(foreign + 1)
                ids.append(-1 - points[foreign])
        if not starts:
            return (np.zeros(0, np.int64),) * 3
        # Of the edges into a node the longest, which are mostly the likeliest, come first.
        start, end, piece = (np.concatenate(x[::-1]) for x in (starts, ends, ids))
        order = np.argsort(end, kind="stable")
        return start[order], end[order], piece[order]

    def spelled(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weights of edges, and their pieces as a ragged array."""
        raw = {k: (MARK if -1 - k == ord(_LITERAL) else chr(-1 - k)).encode() for k in np.unique(ids[ids < 0]).tolist()}
        lengths = np.ones(len(ids), np.int64)
        weights = self.weights[np.maximum(ids, 0)]
        foreign = np.flatnonzero(ids < 0)
        lengths[foreign] = [len(raw[k]) for k in ids[foreign].tolist()]
        weights[foreign] = self.byte_weight * lengths[foreign]
        flat = np.repeat(ids, lengths).astype(np.int32)
        if len(foreign):
            flat[flat < 0] = self.byte_ids[np.frombuffer(b"".join(raw[k] for k in ids[foreign].tolist()), np.uint8)]
        return weights, lengths, flat


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


@lru_cache(maxsize=2)
def surfaces(path: str) -> pa.Array:
    """The bytes that each piece stands for, marks as spaces."""
    import sentencepiece

    known = sentencepiece.SentencePieceProcessor(model_file=path)
    every = ((known.is_byte(k), known.id_to_piece(k)) for k in range(known.get_piece_size()))
    return pa.array([bytes([int(piece[1:-1], 16)]) if byte else piece.replace(MARK, " ").encode() for byte, piece in every], pa.large_binary())


def marked(text: str, first: bool) -> str:
    """A text in the model's alphabet; the first piece of a text gets the mark that decoding drops."""
    if MARK in text:
        text = text.replace(MARK, _LITERAL)
    return (MARK if first else "") + text.replace(" ", MARK)


class Lattices:
    """Lattices of many short texts in flat arrays, nodes numbered across all of them."""

    def __init__(self, model: PieceModel, texts: list[str], alpha: float):
        firsts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)])
        self.first, self.last = firsts[:-1], firsts[1:] - 1
        self.starts, ends, ids = model.lattices(texts)
        weights, self.lengths, self.flat = model.spelled(ids)
        weights = alpha * weights
        # Forward filtering: log sums of all ways to each node, level by level from the starts.
        alphas = np.zeros(firsts[-1])
        level = ends - np.repeat(self.first, np.diff(firsts))[ends] if len(ends) else ends
        order = np.argsort(level, kind="stable")
        bounds = np.flatnonzero(np.diff(level[order], prepend=-1)) if len(order) else []
        total = np.empty(len(ends))
        for a, b in zip(bounds, [*bounds[1:], len(order)], strict=False):
            some = order[a:b]
            value = alphas[self.starts[some]] + weights[some]
            begin = np.flatnonzero(np.diff(ends[some], prepend=-1))
            size = np.diff(np.append(begin, len(some)))
            top = np.maximum.reduceat(value, begin)
            part = np.exp(value - np.repeat(top, size))
            mass = np.add.reduceat(part, begin)
            alphas[ends[some[begin]]] = top + np.log(mass)
            total[some] = part / np.repeat(mass, size)
        # Edges lie sorted by end node; each knows the probability of all edges of its node up to it.
        running = np.cumsum(total)
        begin = np.flatnonzero(np.diff(ends, prepend=-1)) if len(ends) else np.zeros(0, np.int64)
        size = np.diff(np.append(begin, len(ends)))
        self.upto = running - np.repeat(running[begin] - total[begin], size)
        self.upto[begin + size - 1] = np.inf
        self.begin = np.zeros(int(firsts[-1]), np.int64)
        self.begin[ends[begin]] = begin

    def draw(self, nodes: np.ndarray, chance: np.ndarray) -> np.ndarray:
        """The edge into each node that a random number in [0, 1) picks."""
        edge = self.begin[nodes]
        open_ = np.flatnonzero(self.upto[edge] <= chance)
        while len(open_):
            edge[open_] += 1
            open_ = open_[self.upto[edge[open_]] <= chance[open_]]
        return edge


def _mix(x: np.ndarray) -> np.ndarray:
    """Well mixed 64-bit values of counters (the finalizer of splitmix64)."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def uniform(key: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Random numbers in [0, 1) that depend on a 64-bit row key and a place in the row."""
    return (_mix(_mix(key) + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def sample_texts(model: PieceModel, texts: pa.Array, keys: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray]:
    """Sampled ids of all texts, and the number of ids of each.

    Lattices stand for some of the distinct pieces of text at a time; all their occurrences are
    sampled before the next ones are built.
    """
    cut = pieces(texts)
    starts_text = np.zeros(len(cut.distinct), bool)
    starts_text[cut.codes[cut.offsets[:-1]]] = True
    spelled = [marked(p, first) for p, first in zip(cut.distinct, starts_text.tolist(), strict=True)]
    size = np.fromiter(map(len, spelled), np.int64, len(spelled))[cut.codes]
    row = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(cut.offsets))
    before = np.cumsum(size) - size
    before -= before[cut.offsets[:-1]][row]  # characters of the row before each piece
    lengths = np.zeros(len(cut.codes), np.int64)
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    for low in range(0, len(spelled), LATTICES):
        lattices = Lattices(model, spelled[low : low + LATTICES], alpha)
        places = np.flatnonzero((cut.codes >= low) & (cut.codes < low + LATTICES))
        code = cut.codes[places] - low
        node, first = lattices.last[code], lattices.first[code]
        at = np.flatnonzero(node > first)
        owners, edges = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
        while len(at):
            where = places[at]
            edge = lattices.draw(node[at], uniform(keys[row[where]], before[where] + node[at] - first[at]))
            owners.append(at.astype(np.int32))
            edges.append(edge.astype(np.int32))
            node[at] = lattices.starts[edge]
            at = at[node[at] > first[at]]
        # Backward sampling met the edges of a piece from its end: the last round comes first.
        owner, edge = np.concatenate(owners[::-1]), np.concatenate(edges[::-1])
        order = np.argsort(owner, kind="stable")
        ids, _ = gather(lattices.flat, lattices.lengths, edge[order])
        lengths[places] = np.bincount(owner, weights=lattices.lengths[edge], minlength=len(places)).astype(np.int64)
        parts.append((places, ids))
    starts = np.cumsum(lengths) - lengths
    out = np.empty(int(lengths.sum()), np.int32)
    for places, ids in parts:
        own = lengths[places]
        out[np.repeat(starts[places] - (np.cumsum(own) - own), own) + np.arange(len(ids))] = ids
    return out, sums(lengths, cut.offsets)


def texts_of(lists: pa.ListArray, table: pa.Array) -> pa.Array:
    """The texts of sequences of ids: the bytes that the pieces stand for, without the first one,
    which is the space of the first mark. Null stays null."""
    spelled = table.take(lists.flatten())
    # The bytes of all pieces lie one behind another already.
    ends = np.concatenate([[0], np.cumsum(np.asarray(pc.binary_length(spelled)).astype(np.int64))])
    bounds = ends[np.asarray(lists.offsets) - np.asarray(lists.offsets)[0]]
    filled_rows = bounds[1:] > bounds[:-1]
    data = np.delete(np.frombuffer(spelled.buffers()[2] or b"", np.uint8)[: ends[-1]], bounds[:-1][filled_rows])
    bounds = bounds - np.concatenate([[0], np.cumsum(filled_rows)])
    text = pa.Array.from_buffers(pa.large_string(), len(lists), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
    return pc.if_else(pc.is_valid(lists), text, pa.scalar(None, pa.large_string())).cast(pa.string())


def encode_sampled(
    docs: DataFrame, path: str, seed: int = 0, alpha: float = 1.0, id_col: str = "doc_id", text_col: str = "text", key: Column | None = None, decode: bool = False
) -> DataFrame:
    """``(id, ids)`` of every row: one sampled segmentation of the whole text; with ``decode`` also
    ``text``, decoded from the ids in the same task.

    ``key`` (default: the id) seeds a row together with ``seed``; rows of one key and text get one
    segmentation, also where ids repeat or are null. A null or empty text gives one space mark or, if
    the model samples it so, its bytes: it decodes to the empty text. An empty table gives an empty
    result. No shuffle. A text without spaces is one lattice: memory follows the longest text.
    """
    chosen = F.xxhash64(F.col(id_col).cast("string") if key is None else key, F.lit(seed))
    rows = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"), chosen.alias("key"))
    kind = rows.schema["doc"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for some in (part for whole in batches for part in bounded(whole, SLICE_BYTES)):
            keys = np.asarray(some.column("key")).view(np.uint64)
            ids, lengths = sample_texts(model, filled(some.column("text")), keys, alpha)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(ids, pa.int32()))
            yield batch({"doc": some.column("doc"), "ids": lists} | ({"text": texts_of(lists, surfaces(path))} if decode else {}))

    return rows.mapInArrow(encode, f"doc {kind}, ids array<int>" + ", text string" * decode).withColumnRenamed("doc", id_col)


def decode_sampled(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(id, *keep, text)`` of encoded rows. Null ids give a null text."""
    rows = encoded.select(F.col(id_col).alias("doc"), *keep, F.col(ids_col).alias("piece_ids"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (whole.slice(at, 512) for whole in batches for at in range(0, whole.num_rows, 512)):
            own = {name: part.column(name) for name in part.schema.names[:-1]}
            yield batch(own | {"text": texts_of(part.column("piece_ids"), surfaces(path))})

    return rows.mapInArrow(decode, f"{kinds}, text string").withColumnRenamed("doc", id_col)
