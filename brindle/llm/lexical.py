"""Ranked lexical search with geometric blocks in the posting lists.

Documents are dealt out to shards of bounded size. In a shard every posting list is cut into blocks of
documents that are similar to each other, and each block keeps a summary: for every term the greatest
value that a document of the block has for it, rounded up. The inner product of an item with a summary
is an upper bound of all scores in the block. Blocks are visited from the highest bound down and left
out once it is below the item's k-th score, so results are exact. Lists too short for a summary to be
smaller than its documents are evaluated as they are.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from brindle.llm.arrowtext import batch, bounded, filled
from brindle.llm.repeats import mix
from brindle.llm.substring import word_hashes
from brindle.session import settle

FILTER_BITS = 20  # of a bit array that tells most terms of no item
GROUP_TERMS = 1 << 16  # terms of the items that one index serves
BLOCK_ITEMS = 256
SENT_TERMS = 1 << 18  # terms of items that are sent to all tasks, 16 bytes each
CELLS = 128
SHARD_ENTRIES = 1 << 19
BLOCK_DOCS = 256
SHORT = 16  # documents of a list without blocks
TILE = 512  # terms whose summaries are one compressed piece
SIGNATURE = 64
NO_ID = np.iinfo(np.int64).max

# Bytes of UTF-8: A-Z to a-z; everything in ASCII but digits and letters to a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the terms of all texts, with repeats, and the texts' offsets."""
    texts = filled(texts)
    offsets = np.asarray(pc.cast(pc.binary_length(texts), pa.int64())).cumsum()
    data = b"".join(texts.cast(pa.large_binary()).to_pylist()).translate(_FOLD)
    starts = np.concatenate([[0], offsets]).astype(np.int64)
    folded = pa.Array.from_buffers(pa.large_string(), len(texts), [None, pa.py_buffer(starts.tobytes()), pa.py_buffer(data)])
    return word_hashes(folded)


def counted(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of each text in ascending order, how often each occurs, and the offsets."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    fresh = np.append(True, (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])) if len(values) else np.zeros(0, bool)
    at = np.flatnonzero(fresh)
    sizes = np.bincount(owner[at], minlength=len(offsets) - 1)
    return values[at], np.diff(np.append(at, len(values))), np.concatenate([[0], np.cumsum(sizes)])


def _lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def _tokenized(rows: DataFrame, bits: np.ndarray | None) -> DataFrame:
    """``(id, n, terms, tfs)`` of ``(id, text)``: the number of terms with repeats, and the distinct
    terms that pass the bit array with their counts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (some for whole in batches for some in bounded(whole, 4 << 20)):
            values, offsets = terms_of(part.column("text"))
            n = np.diff(offsets)
            if bits is not None:
                wanted = bits[(values & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)]
                values, offsets = values[wanted], np.concatenate([[0], np.cumsum(wanted)])[offsets]
            terms, tfs, offsets = counted(values, offsets)
            yield batch({"id": part.column("id"), "n": pa.array(n, pa.int64()), "terms": _lists(terms.view(np.int64), offsets, pa.int64()), "tfs": _lists(tfs, offsets, pa.int64())})

    return rows.mapInArrow(scan, "id long, n long, terms array<long>, tfs array<long>")


class Shard:
    """Forward vectors of some documents, and their posting lists in blocks with summaries.

    ``values[indptr[d]:indptr[d + 1]]`` are the values of document ``d`` for the terms ``codes[...]``.
    List ``t`` holds the documents ``members[starts[t]:starts[t + 1]]``, in blocks that begin at
    ``cuts[firsts[t]:firsts[t + 1]]``; a short list has none.
    """

    def __init__(self, **parts: np.ndarray):
        self.__dict__.update(parts)
        self._tiles: dict[int, np.ndarray] = {}

    @classmethod
    def build(cls, ids: np.ndarray, indptr: np.ndarray, terms: np.ndarray, values: np.ndarray, block_docs: int = BLOCK_DOCS) -> Shard:
        names, codes = np.unique(terms, return_inverse=True)
        owner = np.repeat(np.arange(len(ids)), np.diff(indptr))
        order = np.argsort(codes, kind="stable")
        members = owner[order]
        starts = np.searchsorted(codes[order], np.arange(len(names) + 1))
        points = cls._signatures(names, codes, values, indptr)
        cuts, firsts = [], [0]
        for a, b in zip(starts, starts[1:], strict=False):
            if b - a > SHORT:
                cuts += cls._cluster(members, int(a), int(b), points, block_docs)
            firsts.append(len(cuts))
        out = cls(ids=ids, indptr=indptr, codes=codes, values=values, names=names, members=members, starts=starts, cuts=np.array(cuts, np.int64), firsts=np.array(firsts))
        out._summarize(owner)
        return out

    @staticmethod
    def _signatures(names: np.ndarray, codes: np.ndarray, values: np.ndarray, indptr: np.ndarray) -> np.ndarray:
        """Directions of the documents in a random projection; equal documents have equal ones."""
        bits = mix(names.view(np.uint64))[:, None] >> np.arange(SIGNATURE, dtype=np.uint64) & np.uint64(1)
        signs = bits.astype(np.float32) * 2 - 1
        points = np.zeros((len(indptr) - 1, SIGNATURE), np.float32)
        for at in range(0, len(points), 512):
            few = slice(indptr[at], indptr[min(at + 512, len(points))])
            own = indptr[at : min(at + 512, len(points))] - indptr[at]
            points[at : at + 512] = np.add.reduceat(signs[codes[few]] * values[few, None].astype(np.float32), own, axis=0)
        return points / np.maximum(np.linalg.norm(points, axis=1, keepdims=True), 1e-30)

    @staticmethod
    def _cluster(members: np.ndarray, a: int, b: int, points: np.ndarray, block_docs: int) -> list[int]:
        """Orders one list by its nearest centres, members at even distances in it, and returns where
        its blocks begin."""
        own = members[a:b]
        centers = np.unique(np.linspace(0, b - a - 1, -(-(b - a) // block_docs)).astype(np.int64))
        nearest = (points[own] @ points[own[centers]].T).argmax(axis=1)
        order = np.argsort(nearest, kind="stable")
        members[a:b] = own[order]
        return (a + np.flatnonzero(np.diff(nearest[order], prepend=-1))).tolist()

    def _summarize(self, owner: np.ndarray) -> None:
        """Greatest values of the blocks, by term, as 255ths of the term's greatest value, rounded up."""
        self.tops = np.maximum.reduceat(self.values[np.argsort(self.codes, kind="stable")], self.starts[:-1]) if len(self.names) else np.zeros(0, np.int64)
        ends = self._ends()
        pieces = []
        for first in range(0, len(self.names), TILE):
            width = min(TILE, len(self.names) - first)
            own = np.flatnonzero((self.codes >= first) & (self.codes < first + width))
            dense = np.zeros((len(self.ids), width), np.uint8)
            code = self.codes[own]
            dense[owner[own], code - first] = -(-255 * self.values[own] // self.tops[code])
            tile = np.zeros((len(self.cuts), width), np.uint8)
            for k, (a, b) in enumerate(zip(self.cuts, ends, strict=True)):
                np.max(dense[self.members[a:b]], axis=0, out=tile[k])
            pieces.append(np.frombuffer(pa.compress(np.ascontiguousarray(tile.T).tobytes(), codec="zstd", asbytes=True), np.uint8))
        self.pieces = np.concatenate(pieces) if pieces else np.zeros(0, np.uint8)
        self.piece_ends = np.cumsum([len(p) for p in pieces]).astype(np.int64)

    def _ends(self) -> np.ndarray:
        """Where each block ends: at the next one of its list, or with the list."""
        ends = np.append(self.cuts[1:], 0)[: len(self.cuts)]
        last = self.firsts[1:][np.diff(self.firsts) > 0] - 1
        ends[last] = self.starts[1:][np.diff(self.firsts) > 0]
        return ends

    def image(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{k: v for k, v in self.__dict__.items() if k[0] != "_"})
        return pa.compress(out.getvalue(), codec="zstd", asbytes=True) + len(out.getvalue()).to_bytes(8, "little")

    @classmethod
    def load(cls, image: bytes) -> Shard:
        size = int.from_bytes(image[-8:], "little")
        with np.load(io.BytesIO(pa.decompress(image[:-8], decompressed_size=size, codec="zstd", asbytes=True))) as saved:
            return cls(**saved)

    def _column(self, code: int) -> np.ndarray:
        """One term's entry in the summaries of all blocks."""
        piece = code // TILE
        if piece not in self._tiles:
            width = min(TILE, len(self.names) - piece * TILE)
            begin = int(self.piece_ends[piece - 1]) if piece else 0
            data = pa.decompress(self.pieces[begin : int(self.piece_ends[piece])].tobytes(), decompressed_size=width * len(self.cuts), codec="zstd", asbytes=True)
            self._tiles[piece] = np.frombuffer(data, np.uint8).reshape(width, len(self.cuts))
        return self._tiles[piece][code % TILE]

    def scores(self, docs: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Exact scores of some documents; ``weight`` has one entry per term of the shard."""
        begins, sizes = self.indptr[docs], np.diff(self.indptr)[docs]
        ends = np.cumsum(sizes)
        at = np.repeat(begins - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        return np.add.reduceat(weight[self.codes[at]] * self.values[at], ends - sizes) if len(docs) else np.zeros(0, np.int64)

    def search(self, terms: np.ndarray, weights: np.ndarray, best: Best) -> tuple[int, int]:
        """Adds the documents of highest score for one item. Returns how many blocks it visited and
        how many its lists have."""
        code = np.minimum(np.searchsorted(self.names, terms), max(len(self.names) - 1, 0))
        here = self.names[code] == terms if len(self.names) else np.zeros(len(terms), bool)
        code, weights = code[here], weights[here]
        weight = np.zeros(len(self.names), np.int64)
        weight[code] = weights
        fresh = np.ones(len(self.ids), bool)

        def evaluate(docs: np.ndarray) -> None:
            docs = np.unique(docs[fresh[docs]])
            fresh[docs] = False
            best.add(self.ids[docs], self.scores(docs, weight))

        short = [self.members[self.starts[c] : self.starts[c + 1]] for c in code if self.firsts[c] == self.firsts[c + 1]]
        if short:
            evaluate(np.concatenate(short))
        blocks = np.concatenate([np.arange(self.firsts[c], self.firsts[c + 1]) for c in code] or [np.zeros(0, np.int64)])
        if not len(blocks):
            return 0, 0
        bound = np.zeros(len(blocks))
        for c, w in zip(code, weights, strict=True):
            bound += self._column(int(c))[blocks] * (float(w) * float(self.tops[c]) / 255)
        bound = bound * (1 + 1e-9) + 1  # rounding must not take a bound below a score
        order = np.argsort(-bound, kind="stable")
        ends, done, step = self._ends(), 0, 1
        while done < len(order) and bound[order[done]] >= best.least:
            some = [k for k in blocks[order[done : done + step]][bound[order[done : done + step]] >= best.least]]
            evaluate(np.concatenate([self.members[self.cuts[k] : ends[k]] for k in some]))
            done, step = done + len(some), step * 2
        return done, len(blocks)


class Best:
    """The ``k`` documents of highest score so far, ties to the smaller id; scores above 0 only."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.ids, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, ids: np.ndarray, score: np.ndarray) -> None:
        good = score >= self.least
        ids, score = np.append(self.ids, ids[good]), np.append(self.score, score[good])
        order = np.lexsort((ids, -score))[: self.k]
        self.ids, self.score = ids[order], score[order]
        if len(order) == self.k:
            self.least = max(self.least, int(self.score[-1]))


def _vocabulary_bits(asked: DataFrame) -> np.ndarray:
    """Which slots of a bit array of fixed size the terms of the items fall on."""
    slot = F.explode("terms").alias("term")
    places = asked.select(slot).select(F.col("term").bitwiseAND(F.lit((1 << FILTER_BITS) - 1)).alias("slot")).distinct().toArrow()
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[places["slot"].to_numpy()] = True
    return bits


def index_documents(postings: DataFrame, documents: int, terms: int, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``(shard, image)``: the index of ``(id, n, terms, tfs)``, given the number of documents with
    terms and of all their terms."""
    own = postings.where(F.size("terms") > 0)
    entries = own.agg(F.sum(F.size("terms"))).first()[0] or 0
    shards = max(1, -(-entries // SHARD_ENTRIES))
    dealt = own.withColumn("shard", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)))

    def build(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        lists, tfs = table["terms"].combine_chunks(), table["tfs"].combine_chunks()
        tf = np.asarray(tfs.flatten(), np.int64)
        indptr = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(lists), np.int64))])
        m = np.array([10 + 90 * n * documents // terms for n in table["n"].to_pylist()], np.int64)
        value = 1_000_000_000 * tf // (1000 * tf + 8 * np.repeat(m, np.diff(indptr)))
        ids = np.asarray(pc.fill_null(table["id"].combine_chunks(), NO_ID))
        shard = Shard.build(ids, indptr, np.asarray(lists.flatten(), np.int64), value, block_docs)
        return pa.table({"shard": table["shard"].slice(0, 1), "image": pa.array([shard.image()], pa.large_binary())}).cast(pa.schema([("shard", pa.int64()), ("image", pa.binary())]))

    return settle(dealt.groupBy("shard").applyInArrow(build, "shard long, image binary"), "index")


def _search(index: DataFrame, blocks: DataFrame, items: int, terms: int, k: int) -> DataFrame:
    """``(ask, id, score)``: every block of items against every shard; shards that follow each other in
    a task share the k-th scores. Items of few terms are sent to all tasks, others are copied to a
    fixed number of cells and meet the shards there."""
    asks = max(1, -(-items // BLOCK_ITEMS))
    tall = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(asks - 1).cast("long"))))
    if terms <= SENT_TERMS:
        met = tall.join(F.broadcast(blocks), "block")
    else:
        cell = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(CELLS - 1).cast("long"))).alias("x")
        wide = blocks.select("block", "asked", cell)
        met = tall.withColumn("x", F.pmod("shard", F.lit(CELLS))).join(wide.hint("merge"), ["x", "block"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, asked, best = None, [], []

        def result() -> pa.RecordBatch:
            sizes = [len(b.ids) for b in best]
            one = lambda values: pa.array(np.concatenate([np.zeros(0, np.int64), *values]), pa.int64())
            return batch({"ask": one([np.full(n, q[0]) for q, n in zip(asked, sizes, strict=True)]), "id": one([b.ids for b in best]), "score": one([b.score for b in best])})

        for part in batches:
            for r in range(part.num_rows):
                if part.column("block")[r].as_py() != block:
                    if block is not None:
                        yield result()
                    block = part.column("block")[r].as_py()
                    asked = [(q["ask"], np.array([t["term"] for t in q["terms"]], np.int64), np.array([t["w"] for t in q["terms"]], np.int64)) for q in part.column("asked")[r].as_py()]
                    best = [Best(k) for _ in asked]
                shard = Shard.load(part.column("image")[r].as_py())
                for (_, terms, weights), own in zip(asked, best, strict=True):
                    shard.search(terms, weights, own)
        if block is not None:
            yield result()

    return met.select("block", "asked", "image").sortWithinPartitions("block").mapInArrow(answer, "ask long, id long, score long")


def lexical_topk(
    docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_docs: int = BLOCK_DOCS
) -> DataFrame:
    """``(item, rank, id, score)``: the ``k`` documents of highest score above 0 for each item.

    Terms are runs of digits, ASCII letters (A-Z lower-cased) and characters beyond ASCII in the whole
    text. With ``N`` documents that have terms, ``L`` terms of all of them and ``df`` documents with a
    term, the term weighs ``w = floor(1000 ln((2 N + 2) / (2 df + 1)))``; a document of ``n`` terms has
    ``m = 10 + 90 n N div L``, and scores the sum of ``w * (10**9 tf div (1000 tf + 8 m))`` over the
    item's distinct terms. Equal scores are ranked by id.

    Null texts have no terms; items without terms, or without a matching document, give no row.
    Documents of one id are ranked one by one, a null id last among equal scores. Rows of one item id
    each have their own result. Empty tables give an empty result. Other columns are dropped. Terms
    are told apart by 64-bit hashes. The index holds the terms of the items only, of at most
    ``GROUP_TERMS`` of them at a time; more items are served by several indexes, one after another.
    """
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).cast("long").alias("id"), F.col(item_text_col).cast("string").alias("text"))
    asked = settle(_tokenized(asked, None).select(F.monotonically_increasing_id().alias("ask"), F.col("id").alias("item"), "terms"), "asked")
    bits = _vocabulary_bits(asked)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    postings = settle(_tokenized(rows, bits), "postings")
    corpus = postings.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    vocabulary = asked.select(F.explode("terms").alias("term")).distinct()
    df = postings.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    w = F.floor(1000 * F.log((2.0 * F.lit(float(corpus["documents"])) + 2) / (2.0 * F.col("df") + 1))).cast("long")
    weights = settle(vocabulary.join(df, "term").select("term", w.alias("w")).where("w > 0"), "weights")
    held = asked.agg(F.count("*").alias("items"), F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("terms")).first()
    groups = max(1, -(-held["terms"] // GROUP_TERMS))
    weighted = asked.select("ask", "item", F.explode("terms").alias("term")).join(weights, "term")
    weighted = settle(weighted.groupBy("ask", "item").agg(F.array_sort(F.collect_list(F.struct("term", "w"))).alias("terms")).withColumn("group", F.pmod(F.xxhash64("ask"), F.lit(groups))), "weighted")
    found: DataFrame | None = None
    for group in range(groups):
        own = weighted.where(F.col("group") == group)
        few = own.select(F.explode("terms.term").alias("term")).distinct()
        indexed = postings
        if groups > 1:
            entries = postings.withColumn("row", F.monotonically_increasing_id()).select("row", "id", "n", F.explode(F.arrays_zip("terms", "tfs")).alias("e"))
            kept = entries.select("row", "id", "n", F.col("e.terms").alias("term"), F.col("e.tfs").alias("tf")).join(few, "term")
            indexed = settle(kept.groupBy("row", "id", "n").agg(F.array_sort(F.collect_list(F.struct("term", "tf"))).alias("e")).select("id", "n", F.col("e.term").alias("terms"), F.col("e.tf").alias("tfs")), "postings")
        index = index_documents(indexed, corpus["documents"], max(corpus["terms"], 1), block_docs)
        number, terms = own.agg(F.count("*"), F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()
        blocks = max(1, -(-number // BLOCK_ITEMS))
        block = F.pmod(F.xxhash64("ask", F.lit(1)), F.lit(blocks))
        asks = settle(own.groupBy(block.alias("block")).agg(F.array_sort(F.collect_list(F.struct("ask", "terms"))).alias("asked")), "asks")
        part = settle(_search(index, asks, number, terms, k), "found")
        found = part if found is None else found.unionByName(part)
    rank = F.row_number().over(Window.partitionBy("ask").orderBy(F.desc("score"), "id"))
    best = found.withColumn("rank", rank).where(F.col("rank") <= k)
    named = best.join(asked.select("ask", "item"), "ask")
    return named.select(F.col("item").alias(item_col), "rank", F.when(F.col("id") != int(NO_ID), F.col("id")).alias(id_col), "score")
