"""Exact n-gram Jaccard join with PartEnum signatures.

Two sets with a Jaccard similarity of the threshold differ in at most ``k`` elements, ``k``
following from their sizes. The feature domain is partitioned into groups of cells, as many as are
needed for some group to hold few differences, and signatures are enumerated over the subsets of a
group's cells that leave out that many: sufficiently similar sets of one size band share one. Equal
sets are one class and are never paired. Classes that share a signature are first paired with one of
them only, the one nearest to most. What is then still different components is checked in a second
round, block against block, by sizes and sketches first: no component is lost and no pair inside a
component is made. Links lie inside components; there they are counted, block against block, by
products of 0/1 matrices: every two sets are compared exactly, and only counts are made.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from brindle.llm.arrowtext import batch, bounded, filled, total_bytes
from brindle.llm.components import components
from brindle.llm.repeats import keyed, likely, mix, rolled, unkeyed
from brindle.llm.substring import word_hashes
from brindle.session import settle

BUCKET_BYTES = 8 << 20  # text bytes behind one bucket of signatures
SENT_TOGETHER = 1 << 20  # signatures that a task gathers before it deals them out
MARK = 6  # leading bytes of a class's name, which tell the classes of one signature apart
SKETCH = 128
BLOCK = 512
PAIRS_OF_A_TASK = 256
BLOCK_SHINGLES = 1 << 20  # in one of two blocks of sets between which links are counted
TILE = 512
_SALT = np.uint64(0xA24BAED4963EE407)


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each, and the texts' offsets. A text of
    fewer words than a shingle has its whole word sequence as one; one without words has none."""
    values, offsets = word_hashes(pc.ascii_lower(filled(texts)))
    length = np.diff(offsets)
    owner = np.repeat(np.arange(len(length)), length)
    left = offsets[1:][owner] - np.arange(len(owner))
    whole = left >= words
    hashes = rolled(values, words)
    # Short texts: fold their few words, with their number, into one hash.
    for n in range(1, words):
        at = offsets[:-1][length == n]
        if len(at):
            code = np.full(len(at), n, np.uint64) * _SALT
            for k in range(n):
                code = mix(code ^ values[at + k])
            hashes[at], whole[at] = code, True
    hashes, owner = mix(hashes[whole]), owner[whole]
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.append(True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])) if len(hashes) else np.zeros(0, bool)
    sizes = np.bincount(owner[fresh], minlength=len(length))
    return hashes[fresh], np.concatenate([[0], np.cumsum(sizes)])


@dataclass
class PartEnum:
    """Signature scheme for one threshold, in per cent."""

    percent: int

    def __post_init__(self):
        if not 75 <= self.percent <= 100:
            raise ValueError("the threshold must be between 75 and 100 per cent")
        starts = [1]
        while starts[-1] < 1 << 40:
            starts.append(max(starts[-1] + 1, starts[-1] * 3 // 2))
        self.starts = np.array(starts, np.int64)

    def differences(self, sizes: np.ndarray) -> np.ndarray:
        """The most elements in which a similar set may differ from one of such a size."""
        return (100 - self.percent) * sizes // self.percent

    def layout(self, band: int) -> tuple[int, int, int]:
        """Groups, cells of a group, and cells that a subset leaves out. One group more than the
        pigeonhole needs, and some cells more in small sets, make sets with too few filled ones rare."""
        most = int(self.differences(self.starts[band + 1] - 1))
        if most < 8:
            return 2 * most + 18, 1, 0
        return most // 2 + 2, 3, 1

    def signatures(self, hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Signatures of all sets and the number of the set of each.

        A set signs in its own size band, and in the next if a similar set may lie there. Subsets
        without elements are signed only by sets that cannot be sure of a filled one in common.
        """
        sizes = np.diff(offsets)
        k = self.differences(sizes)
        band = np.searchsorted(self.starts, np.maximum(sizes, 1), side="right") - 1
        found, owners = [], []
        for up in (0, 1):
            able = (sizes > 0) & (k > 0)
            if up:
                able &= 100 * sizes >= self.percent * self.starts[band + 1]
            for b in np.unique(band[able] + up):
                signs, sets = self._of_band(hashes, offsets, np.flatnonzero(able & (band + up == b)), k, int(b))
                found.append(signs)
                owners.append(sets)
        if not found:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return np.concatenate(found), np.concatenate(owners)

    def _of_band(self, hashes, offsets, sets, k, band) -> tuple[np.ndarray, np.ndarray]:
        groups, cells, left_out = self.layout(band)
        sizes = offsets[sets + 1] - offsets[sets]
        owner = np.repeat(np.arange(len(sets)), sizes)
        own = hashes[np.repeat(offsets[sets] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
        place = mix(own ^ _SALT) >> np.uint64(32)
        cell = owner * (groups * cells) + ((place * np.uint64(groups * cells)) >> np.uint64(32)).astype(np.int64)
        total = np.zeros(len(sets) * groups * cells, np.uint64)
        np.add.at(total, cell, mix(own + _SALT))
        filled_cells = np.bincount(cell, minlength=len(total)).reshape(len(sets), groups, cells) > 0
        total = total.reshape(len(sets), groups, cells)
        sure = (filled_cells.sum(axis=2) > left_out).sum(axis=1) > k[sets] // (left_out + 1)
        found, owners = [], []
        for number, subset in enumerate(combinations(range(cells), cells - left_out)):
            where = filled_cells[:, :, subset].any(axis=2) | ~sure[:, None]
            row, group = np.nonzero(where)
            name = np.uint64(((band << 8) + number) << 32) + group.astype(np.uint64)
            found.append(mix(mix(name) + total[:, :, subset].sum(axis=2, dtype=np.uint64)[where]))
            owners.append(sets[row])
        return np.concatenate(found), np.concatenate(owners)


def set_names(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 128-bit name of each set: two independent sums over its elements."""

    def total(values: np.ndarray) -> np.ndarray:
        running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
        return running[offsets[1:]] - running[offsets[:-1]]

    return mix(total(mix(hashes))), mix(total(mix(hashes ^ _SALT)) + np.diff(offsets).astype(np.uint64))


def names(first: np.ndarray, second: np.ndarray) -> pa.Array:
    """Names as binary values of 16 bytes."""
    both = np.stack([first, second], axis=1).astype(">u8")
    return pa.Array.from_buffers(pa.binary(), len(both), [None, pa.py_buffer(np.arange(len(both) + 1, dtype=np.int32) * 16), pa.py_buffer(both.tobytes())])


def sketches(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Elements of each set by coarse cell: the counts of two sets differ in sum by no more than the
    sets differ."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    cell = (mix(hashes + np.uint64(1)) >> np.uint64(57)).astype(np.int64)
    return np.bincount(owner * SKETCH + cell, minlength=(len(offsets) - 1) * SKETCH).reshape(-1, SKETCH)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the threshold."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", row_key: bool = False) -> DataFrame:
    """``(id, n_shingles, n_links, component_id)`` of every row.

    Words are ``[^\\x20\\x09-\\x0D]+`` of the whole text with A-Z lower-cased. The set of a document
    holds its distinct ``words``-word shingles, or its whole word sequence where it is shorter. Two
    documents link when ``100 * intersection >= percent * union``. ``component_id`` is the smallest
    id that links reach, the own one included. ``n_links`` is the number of other rows that the row
    links with, those of an equal set among them.

    Documents without words, or with a null text, have an empty set, link with nothing and are their
    own component. Rows of one id are linked as others are. A null id is never a component's id
    unless all of its ids are null; then it is null. Ids are integers. An empty table gives an empty
    result. Other columns are dropped. Equality of sets is that of 128-bit names, equality of
    shingles that of 64-bit hashes. With ``row_key`` there are also ``hash``, that of the text as
    ``repeats.keyed`` makes it, and ``component``, which names also components without ids; it is null
    for empty sets.
    """
    rows = keyed(docs, id_col, text_col)
    buckets = max(1, -(-total_bytes(docs, text_col) // BUCKET_BYTES))
    scheme = PartEnum(percent)
    signed = settle(_signed(rows, scheme, words, buckets), "signed")
    sets = signed.where("sig is null").select("id", "hash", F.col("member").alias("class"), "n")
    # One representative row of each class, with the class's sketch.
    classes = signed.where("sig is null and n > 0").groupBy(F.col("member").alias("class")).agg(F.min(F.struct("id", "hash")).alias("row"), F.min("n").alias("n"), F.min_by("sketch", F.struct("id", "hash")).alias("sketch"))
    classes = settle(classes, "classes")
    shared = signed.where("sig is not null").select("sig", "leader", "member")
    ends = shared.select("sig", F.col("leader").alias("mark")).unionByName(shared.select("sig", F.col("member").alias("mark"))).distinct()
    # The class of most shared signatures is nearest to the others: it leads where it occurs. Should two
    # classes have one mark, each takes part for both.
    weight = ends.groupBy("mark").agg(F.count("*").alias("weight")).join(classes.select("class", F.substring("class", 1, MARK).alias("mark")), "mark")
    ends = settle(ends.join(weight, "mark").select("sig", "class", "weight"), "ends")
    leads = ends.groupBy("sig").agg(F.max(F.struct("weight", "class")).alias("lead")).select("sig", F.col("lead.class").alias("lead"))
    led = settle(ends.join(leads, "sig").select("sig", "class", "lead"), "led")
    first = settle(led.where("class != lead").select(F.col("lead").alias("a"), F.col("class").alias("b")).distinct(), "pairs")
    links = settle(_verified(first, classes, rows, words, percent), "links")
    labels = settle(components(links), "labels")
    # Signatures whose classes are not yet one component hold the pairs still to be checked. Pairs tell
    # which ones these are, so that signatures meet no labels.
    for end in ("a", "b"):
        own = labels.select(F.col("node").alias(end), F.col("component").alias(f"{end}_component"))
        first = first.join(own, end, "left").withColumn(f"{end}_component", F.coalesce(f"{end}_component", end))
    apart = settle(first.where("a_component != b_component").select(F.col("a").alias("lead"), F.col("b").alias("class")), "apart")
    mixed = settle(led.join(apart, ["lead", "class"], "left_semi").select("sig").distinct(), "mixed")
    open_ = led.join(mixed, "sig", "left_semi").select("lead", "class").distinct()
    across = _across(open_, labels, classes, percent)
    across = across.join(apart.select(F.least("lead", "class").alias("a"), F.greatest("lead", "class").alias("b")), ["a", "b"], "left_anti")
    more = settle(_verified(across, classes, rows, words, percent), "links")
    if not more.isEmpty():
        links = links.unionByName(more)
        labels = settle(components(links), "labels")
    sizes = settle(sets.where("n > 0").groupBy("class").agg(F.count("*").alias("rows")), "sizes")
    degree = settle(_degrees(labels, classes, sizes, rows, words, percent), "degrees")
    degree = sizes.join(degree, "class", "left").select("class", (F.coalesce("linked", "rows") - 1).alias("n_links"))
    known = classes.join(labels.withColumnRenamed("node", "class"), "class", "left").select("class", F.coalesce("component", "class").alias("component"), "row")
    least = known.where(F.col("row.id") != F.lit(-(2**63))).groupBy("component").agg(F.min("row.id").alias("component_id"))
    # The least id of a class may be that of another row than its representative where ids are null.
    least = least.unionByName(_least_of_null(sets, known)).groupBy("component").agg(F.min("component_id").alias("component_id"))
    named = known.join(least, "component", "left").select("class", "component", "component_id").join(degree, "class", "left")
    empty = F.col("n") == 0
    out = sets.join(named, "class", "left")
    own = F.when(F.col("id") != F.lit(-(2**63)), F.col("id"))
    return out.select(
        unkeyed(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.when(empty, own).otherwise(F.col("component_id")).alias("component_id"),
        *(["hash", "component"] if row_key else []),
    )


def _across(regions: DataFrame, labels: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a < b`` of classes of one region (those that share an open signature with one leading
    class) but different components whose sizes and sketches allow a link.

    Regions are cut into blocks of ``BLOCK`` classes, and every two blocks meet in a task of their
    own: what is tested grows with the square of a region, what is sent with its number of blocks,
    and only pairs that pass are ever made.
    """
    blocks = regions.groupBy("lead").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    members = regions.join(blocks, "lead").select("class", F.col("lead").alias("region"), "blocks")
    known = members.join(classes.select("class", "n", "sketch"), "class").join(labels.withColumnRenamed("node", "class"), "class", "left")
    block = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    known = known.select("region", "class", F.coalesce("component", "class").alias("component"), "n", "sketch", block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = known.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))

    def test(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        names_ = np.array(table["class"].to_pylist(), dtype=object)
        component = np.unique(np.array(table["component"].to_pylist(), dtype=object), return_inverse=True)[1]
        n, block = table["n"].to_numpy(), table["block"].to_numpy()
        sketch = np.asarray(table["sketch"].combine_chunks().flatten()).reshape(len(n), SKETCH)
        sketch = np.minimum(sketch, np.iinfo(np.int16).max // 2).astype(np.int16)  # never further apart than the counts
        one = table["low"][0].as_py() == table["high"][0].as_py()
        left, right = [], []
        for k in range(len(n)):
            others = np.flatnonzero((component != component[k]) & (100 * np.minimum(n, n[k]) >= percent * np.maximum(n, n[k])) & ((block > block[k]) | one))
            others = others[others > k] if one else others
            apart = np.abs(sketch[others] - sketch[k]).sum(axis=1, dtype=np.int64)
            others = others[(100 + percent) * apart <= (100 - percent) * (n[others] + n[k])]
            left += [min(names_[k], names_[x]) for x in others]
            right += [max(names_[k], names_[x]) for x in others]
        return pa.table({"a": pa.array(left, pa.binary()), "b": pa.array(right, pa.binary())})

    return dealt.groupBy("region", "low", "high").applyInArrow(test, "a binary, b binary").distinct()


def linked_rows(sets: list[np.ndarray], weight: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """For each set the sum of the weights of the sets that it reaches the threshold with: pairs of a
    set of ``left`` and one of ``right``, which are the same numbers or have none in common."""
    out = np.zeros(len(sets), np.int64)
    sizes = np.array([len(x) for x in sets], np.int64)
    one = left is right

    def tiles(side: np.ndarray) -> list[tuple]:
        side = side[np.argsort(sizes[side], kind="stable")]
        cut = [side[at : at + TILE] for at in range(0, len(side), TILE)]
        return [(own, np.concatenate([sets[k] for k in own]), np.repeat(np.arange(len(own)), sizes[own])) for own in cut]

    first = tiles(left)
    second = first if one else tiles(right)
    values = {id(t): np.unique(t[1]) for t in [*first, *second]}
    for i, a in enumerate(first):
        for b in second[i if one else 0 :]:
            least, most = sorted([(sizes[a[0][0]], sizes[a[0][-1]]), (sizes[b[0][0]], sizes[b[0][-1]])])
            if 100 * least[1] < percent * most[0]:
                continue
            shared = _shared(a, b, np.intersect1d(values[id(a)], values[id(b)], assume_unique=True))
            near = 100 * shared >= percent * (sizes[a[0]][:, None] + sizes[b[0]][None, :] - shared)
            out[a[0]] += near @ weight[b[0]]
            if a is not b:
                out[b[0]] += near.T @ weight[a[0]]
    return out


def _shared(a: tuple, b: tuple, values: np.ndarray, width: int = 4096) -> np.ndarray:
    """How many of the ``values`` each set of one tile has in common with each set of the other."""
    total = np.zeros((len(a[0]), len(b[0])), np.int64)
    if not len(values):
        return total
    places = []
    for _, hashes, owner in (a, b):
        at = np.minimum(np.searchsorted(values, hashes), len(values) - 1)
        held = np.flatnonzero(values[at] == hashes)
        held = held[np.argsort(at[held], kind="stable")]
        places.append((at[held], owner[held]))
    for low in range(0, len(values), width):
        sides = []
        for (at, owner), tile in zip(places, (a, b), strict=True):
            x, y = np.searchsorted(at, [low, low + width])
            side = np.zeros((len(tile[0]), min(width, len(values) - low)), np.float32)
            side[owner[x:y], at[x:y] - low] = 1
            sides.append(side)
        total += (sides[0] @ sides[1].T).astype(np.int64)  # at most ``width``: exact
    return total


def _degrees(labels: DataFrame, classes: DataFrame, sizes: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame:
    """``(class, linked)`` of the classes of components with several: rows that a class's rows link
    with, its own included.

    A component is cut into blocks of some ``BLOCK_SHINGLES`` and every two of them meet in a task;
    components of one block share tasks. What is compared grows with the square of a component, what
    is sent with its number of blocks, and no pair is ever made.
    """
    own = labels.withColumnRenamed("node", "class").join(classes.select("class", "row", "n"), "class")
    blocks = own.groupBy("component").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks"))
    tasks = own.agg(F.ceil(F.coalesce(F.sum("n"), F.lit(0)) / BLOCK_SHINGLES)).first()[0] or 1
    wanted = settle(own.join(blocks, "component").join(sizes, "class").select("class", "component", "blocks", "rows", F.col("row.id").alias("id"), F.col("row.hash").alias("hash")), "members")

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (some for whole in batches for some in bounded(whole, 4 << 20)):
            hashes, offsets = shingle_sets(part.column("text"), words)
            data = pa.Array.from_buffers(pa.binary(), part.num_rows, [None, pa.py_buffer((offsets * 8).astype(np.int32)), pa.py_buffer(hashes.tobytes())])
            yield batch({c: part.column(c) for c in ("class", "component", "blocks", "rows")} | {"data": data})

    texts = likely(rows, wanted).join(wanted, ["id", "hash"]).select("class", "component", "blocks", "rows", "text")
    # Rows equal in id and text come several times.
    sets = settle(texts.mapInArrow(shingled, "class binary, component binary, blocks int, rows long, data binary").dropDuplicates(["class"]), "sets")
    task = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), F.lit(tasks)).cast("string")).otherwise(F.hex("component"))
    block = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    met = sets.select(task.alias("task"), "class", "component", "rows", "data", block.alias("block"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = met.select("task", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "class", "component", "rows", "block", "data")

    def count(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        low, high = table["low"][0].as_py(), table["high"][0].as_py()
        held = [np.frombuffer(x, np.uint64) for x in table["data"].to_pylist()]
        block, weight = table["block"].to_numpy(), table["rows"].to_numpy()
        component = np.unique(np.array(table["component"].to_pylist(), dtype=object), return_inverse=True)[1]
        order = np.argsort(component, kind="stable")
        out = np.zeros(len(held), np.int64)
        for members in np.split(order, np.flatnonzero(np.diff(component[order])) + 1):
            left = np.flatnonzero(block[members] == low)
            right = left if low == high else np.flatnonzero(block[members] == high)
            out[members] = linked_rows([held[k] for k in members], weight[members], left, right, percent)
        return pa.table({"class": table["class"], "linked": pa.array(out)})

    counted = dealt.groupBy("task", "low", "high").applyInArrow(count, "class binary, linked long")
    return counted.groupBy("class").agg(F.sum("linked").alias("linked"))


def _least_of_null(sets: DataFrame, known: DataFrame) -> DataFrame:
    """Least true ids of the classes whose representative row has a null id."""
    lost = known.where(F.col("row.id") == F.lit(-(2**63))).select("class", "component")
    return sets.where(F.col("id") != F.lit(-(2**63))).join(lost, "class").groupBy("component").agg(F.min("id").alias("component_id"))


_SCHEMA = "bucket int, id long, hash long, sig long, leader binary, member binary, n long, sketch array<int>, data binary"


def _rows(rows: int, /, **columns) -> pa.RecordBatch:
    kinds = {"bucket": pa.int32(), "id": pa.int64(), "hash": pa.int64(), "sig": pa.int64(), "leader": pa.binary(), "member": pa.binary(), "n": pa.int64(), "sketch": pa.list_(pa.int32()), "data": pa.binary()}
    return batch({c: columns[c] if c in columns else pa.nulls(rows, kind) for c, kind in kinds.items()})


def _signed(rows: DataFrame, scheme: PartEnum, words: int, buckets: int) -> DataFrame:
    """One row per document with its class, and the marks of classes that share signatures, each with
    the least of them. Of a signature that many documents share, a task sends the least class only,
    once for each portion of its documents.

    A signature travels as 11 bytes beside the number of its bucket, however many buckets there are: 40
    bits of it and the mark of its class. Different signatures that agree in these only make a pair more
    to verify.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = [], 0
        for part in (some for whole in batches for some in bounded(whole, 4 << 20)):
            hashes, offsets = shingle_sets(part.column("text"), words)
            first, second = set_names(hashes, offsets)
            ids = part.column("id")
            # Documents travel as single rows, by class.
            counts = sketches(hashes, offsets).astype(np.int32)
            sketch = pa.ListArray.from_arrays(pa.array(np.arange(len(first) + 1) * SKETCH, pa.int32()), pa.array(counts.ravel()))
            yield _rows(len(first), bucket=pa.array(np.full(len(first), -1), pa.int32()), id=ids, hash=part.column("hash"), member=names(first, second), n=pa.array(np.diff(offsets)), sketch=sketch)
            chosen = np.unique(np.stack([first, second], axis=1), axis=0, return_index=True)[1]
            sigs, owner = scheme.signatures(*_subset(hashes, offsets, chosen))
            held.append((_placed(sigs, buckets), (first >> np.uint64(64 - 8 * MARK))[chosen[owner]]))
            number += len(sigs)
            if number >= SENT_TOGETHER:
                yield from _dealt(held)
                held, number = [], 0
        yield from _dealt(held)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held = -1, []
        for part in batches:
            bucket = np.asarray(part.column("bucket"))
            ready = np.flatnonzero(bucket < 0)
            if len(ready):
                yield part.take(pa.array(ready))
            for k in np.flatnonzero(bucket >= 0):
                if bucket[k] != current:
                    yield from _by_signature(held)[0]
                    current, held = bucket[k], []
                held.append(_unpacked(current, part.column("data")[k].as_py()))
        yield from _by_signature(held)[0]

    by = F.when(F.col("bucket") >= 0, F.col("bucket")).otherwise(F.pmod(F.xxhash64("id", "hash", "sig", "member"), F.lit(2**30)).cast("int"))
    sent = rows.select("id", "hash", "text").mapInArrow(sign, _SCHEMA)
    dealt = sent.withColumn("by", by).repartition("by").sortWithinPartitions("bucket").drop("by")
    return dealt.mapInArrow(meet, _SCHEMA).drop("bucket", "data")


def _subset(hashes: np.ndarray, offsets: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(offsets)[chosen]
    ends = np.cumsum(sizes)
    return hashes[np.repeat(offsets[chosen] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)], np.concatenate([[0], ends])


def _placed(sigs: np.ndarray, buckets: int) -> np.ndarray:
    """Signatures as the number of their bucket, followed by 40 other bits of them."""
    return (sigs & np.uint64(0xFFFFFF)) % np.uint64(buckets) << np.uint64(40) | sigs >> np.uint64(24)


def _dealt(held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Rows of the classes that share a signature here, and one of each bucket with all its signatures."""
    found, sigs, marks = _by_signature(held)
    yield from found
    if not len(sigs):
        return
    bucket = (sigs >> np.uint64(40)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    # Each column by itself, as few bytes as it takes.
    columns = [(sigs >> np.uint64(32)).astype(np.uint8), sigs.astype(np.uint32), (marks >> np.uint64(16)).astype(np.uint32), marks.astype(np.uint16)]
    data = [b"".join(c[a:b].tobytes() for c in columns) for a, b in zip(cuts, [*cuts[1:], len(sigs)], strict=True)]
    yield _rows(len(data), bucket=pa.array(bucket[cuts], pa.int32()), data=pa.array(data, pa.binary()))


def _unpacked(bucket: int, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(data) // 11
    column = lambda kind, at: np.frombuffer(data, kind, n, at * n).astype(np.uint64)
    sigs = np.uint64(bucket) << np.uint64(40) | column(np.uint8, 0) << np.uint64(32) | column(np.uint32, 1)
    return sigs, column(np.uint32, 5) << np.uint64(16) | column(np.uint16, 9)


def _by_signature(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[list[pa.RecordBatch], np.ndarray, np.ndarray]:
    """Rows (least class, other class) of each signature, and each signature in order with the mark of
    its least class."""
    sigs, marks = (np.concatenate([np.zeros(0, np.uint64), *side]) for side in (zip(*held, strict=True) if held else ((), ())))
    order = np.argsort(sigs, kind="stable")
    sigs, marks = sigs[order], marks[order]
    same = np.append(False, sigs[1:] == sigs[:-1])[: len(sigs)]
    many = np.flatnonzero(same | np.append(same[1:], False)[: len(sigs)])
    marks[many] = marks[many][np.lexsort((marks[many], sigs[many]))]
    lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(sigs))))
    at = many[same[many] & (marks[many] != marks[many - 1])]
    found = []
    if len(at):
        found = [_rows(len(at), bucket=pa.array(np.full(len(at), -1), pa.int32()), sig=pa.array(sigs[at].view(np.int64)), leader=_as_marks(marks[lead[at]]), member=_as_marks(marks[at]))]
    return found, sigs[~same], marks[~same]


def _as_marks(marks: np.ndarray) -> pa.Array:
    """Marks as binary values, the leading bytes of names."""
    data = np.ascontiguousarray((marks << np.uint64(64 - 8 * MARK)).astype(">u8").view(np.uint8).reshape(-1, 8)[:, :MARK])
    return pa.Array.from_buffers(pa.binary(), len(marks), [None, pa.py_buffer(np.arange(len(marks) + 1, dtype=np.int32) * MARK), pa.py_buffer(data.tobytes())])


def _verified(pairs: DataFrame, classes: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs of classes whose sets reach the threshold.

    Sizes and sketches rule out most wrong pairs. The rest are dealt out by their first class, in
    portions of bounded size, with that class's text once per portion; few other texts are shuffled.
    """
    side = lambda c: classes.select(F.col("class").alias(c), F.struct("n", "sketch").alias(f"s_{c}"))
    near = pairs.join(side("a"), "a").join(side("b"), "b")
    apart = F.aggregate(F.zip_with("s_a.sketch", "s_b.sketch", lambda x, y: F.abs(x - y)), F.lit(0), lambda s, x: s + x)
    total = F.col("s_a.n") + F.col("s_b.n")
    near = near.where((100 * F.least("s_a.n", "s_b.n") >= percent * F.greatest("s_a.n", "s_b.n")) & ((100 + percent) * apart <= (100 - percent) * total))
    near = settle(near.select("a", "b"), "near")
    portions = near.groupBy("a").agg(F.ceil(F.count("*") / PAIRS_OF_A_TASK).alias("portions"))
    dealt = near.join(portions, "a").select("a", F.pmod(F.xxhash64("b"), F.col("portions")).alias("portion"), "b")
    wanted = dealt.unionByName(dealt.select("a", "portion", F.col("a").alias("b")).distinct())
    placed = wanted.join(classes.select(F.col("class").alias("b"), F.col("row.id").alias("id"), F.col("row.hash").alias("hash")), "b")
    placed = settle(placed, "placed")
    gathered = placed.join(likely(rows, placed), ["id", "hash"]).select("a", "portion", "b", (F.col("a") == F.col("b")).alias("lead"), "text")
    ordered = gathered.repartition("a", "portion").sortWithinPartitions("a", "portion", F.desc("lead"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, leader = None, None
        for part in batches:
            hashes, offsets = shingle_sets(part.column("text"), words)
            out: list[tuple[bytes, bytes]] = []
            for k, (a, portion, b, lead) in enumerate(zip(*(part.column(c).to_pylist() for c in ("a", "portion", "b", "lead")), strict=True)):
                own = hashes[offsets[k] : offsets[k + 1]]
                if lead:
                    key, leader = (a, portion), own.copy()
                elif key == (a, portion) and similar(leader, own, percent):
                    out.append((a, b))
            yield batch({"a": pa.array([a for a, _ in out], pa.binary()), "b": pa.array([b for _, b in out], pa.binary())})

    return ordered.mapInArrow(verify, "a binary, b binary").distinct()
