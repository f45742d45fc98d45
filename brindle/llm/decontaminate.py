"""Benchmark decontamination with one Aho-Corasick automaton over the normalised items.

Letters of the automaton are word numbers, so a text is scanned once, word by word; hits are word
ranges, mapped to character offsets of the original text only where there are any.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F

from brindle.llm.arrowtext import total_bytes

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {b: b + 32 for b in range(65, 91)}
# Bytes of UTF-8: A-Z to a-z; everything in ASCII but digits and letters to a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
# Benchmark bytes of one automaton; its states are about 13 per word, some 100 bytes each.
SHARD_BYTES = 4 << 20


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class ItemIndex:
    """Automaton over the windows of some items."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.owners: list[list[str]] = []
        self.lengths: list[int] = []
        number: dict[tuple[int, ...], int] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            for at in range(max(len(ids) - window, 0) + 1 if ids else 0):
                key = tuple(ids[at : at + window])
                n = number.setdefault(key, len(number))
                if n == len(self.owners):
                    self.owners.append([])
                    self.lengths.append(len(key))
                if not self.owners[n] or self.owners[n][-1] != item:
                    self.owners[n].append(item)
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for key, n in number.items():
            self.automaton.add_word(key, n)
        if number:
            self.automaton.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Maximal ranges ``[start, end)`` of hit words, and the items whose windows occur."""
        if not self.owners:
            return [], set()
        ranges: list[tuple[int, int]] = []
        found: set[int] = set()
        for end, n in self.automaton.iter(tuple(map(self.vocabulary.get, words, repeat(0)))):
            found.add(n)
            start = end + 1 - self.lengths[n]
            while ranges and ranges[-1][1] >= start:
                start = min(start, ranges.pop()[0])
            ranges.append((start, end + 1))
        return ranges, {item for n in found for item in self.owners[n]}


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = 13,
    share: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    shard_bytes: int = SHARD_BYTES,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``(id, *keep, n_words, n_hit, item_ids, spans, contaminated)`` of every row, without a shuffle.

    Words are matches of ``WORD`` in the text with A-Z lower-cased. A window is ``window`` consecutive words of
    an item, or a whole item that is shorter; a word inside any occurrence of a window is hit.
    ``item_ids`` are the items with occurring windows, as strings, sorted; ``spans`` are character
    ranges of the original text, one for each maximal run of hit words. ``contaminated``:
    ``n_hit > 0`` and ``share * n_hit >= n_words``.

    The items go to the tasks in automata of at most about ``shard_bytes`` of text each; a larger
    benchmark becomes a chain of scans over the same rows. A null text has no words; null texts and
    wordless texts of items have no windows; an item whose id is null goes by the name "null";
    items of one id are one. Null or repeated document ids give one row each; empty tables give an
    empty result or no hits. Columns that are not in ``keep`` are dropped.
    """
    own = [F.col(c).alias(f"keep{n}") for n, c in enumerate((id_col, *keep))]
    tests = items.select(F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"), F.col(item_text_col).cast("string").alias("text"))
    shards = max(1, -(-total_bytes(tests, "text") // shard_bytes))
    rows = docs.select(*own, F.col(text_col).cast("string").alias("text"), F.lit(None).cast(f"struct<item_ids: array<string>, hits: {_RANGES_SQL}>").alias("found"))
    for shard in range(shards):
        part = tests.where(F.col("text").isNotNull() & (F.pmod(F.xxhash64("item", "text"), F.lit(shards)) == shard))
        scan = _scanner(part.collect(), window, shard == shards - 1)
        rows = rows.withColumn("found", scan("text", "found"))
    n_hit, n_words = F.col("found.n_hit"), F.col("found.n_words")
    contaminated = (n_hit > 0) & (F.lit(share) * n_hit >= n_words)
    names = [F.col(f"keep{n}").alias(c) for n, c in enumerate((id_col, *keep))]
    return rows.select(*names, "found.n_words", "found.n_hit", "found.item_ids", "found.spans", contaminated.alias("contaminated"))


_RANGES_SQL = "array<struct<start: bigint, end: bigint>>"
_RANGES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _scanner(items: list[Row], window: int, last: bool):
    """One automaton's scan, of the text and the hits of the scans before. The last one counts and
    maps the hits to the text. Texts go to Python alone; the other columns wait in the JVM."""
    shipped = sorted((r["item"], r["text"].encode()) for r in items)
    kind = f"struct<n_words: bigint, n_hit: bigint, item_ids: array<string>, spans: {_RANGES_SQL}>" if last else f"struct<item_ids: array<string>, hits: {_RANGES_SQL}>"

    def scan(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        index = ItemIndex(shipped, window)
        for texts, before in batches:
            names, hits, n_words, n_hit = [], [], [], []
            for text, earlier in zip(texts.cast(pa.binary()), before.to_pylist(), strict=True):
                text, earlier = text.as_py(), earlier or {"item_ids": [], "hits": []}
                words = words_of(text) if text else []
                ranges, found = index.scan(words)
                if earlier["hits"]:
                    ranges = _merged(ranges + [(h["start"], h["end"]) for h in earlier["hits"]])
                names.append(sorted({*earlier["item_ids"], *found}))
                n_words.append(len(words))
                n_hit.append(sum(end - start for start, end in ranges))
                if last and ranges:
                    at = [m.span() for m in WORD.finditer(text.decode().translate(_LOWER))]
                    ranges = [(at[start][0], at[end - 1][1]) for start, end in ranges]
                hits.append([{"start": start, "end": end} for start, end in ranges])
            columns = {"n_words": pa.array(n_words, pa.int64()), "n_hit": pa.array(n_hit, pa.int64())} if last else {}
            columns |= {"item_ids": pa.array(names, pa.list_(pa.string())), "spans" if last else "hits": pa.array(hits, _RANGES)}
            yield pa.StructArray.from_arrays(list(columns.values()), names=list(columns))

    return F.arrow_udf(scan, kind).asNondeterministic()
