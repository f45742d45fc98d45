"""The trie of conversation prefixes, with subtree totals by parallel tree contraction.

Turns travel as 128-bit digests with their number of words, never as texts. They are numbered and
their prefixes named in one scan over a table that is sorted by ranges of (conversation, turn): names
are polynomial hashes modulo a prime, so what a conversation has in earlier ranges is put in front
afterwards, and a conversation of any length is spread over many tasks. Equal prefixes are one node by
one aggregation; no conversation, node or level is gathered in a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from brindle.llm.arrowtext import batch
from brindle.llm.contraction import subtree_sums
from brindle.llm.hubs import join_hubs
from brindle.session import settle

PRIME = (1 << 127) - 1
BASE = pow(3, 101, PRIME)
ROOT = bytes(16)
WORDS = r"[^\x20\x09-\x0D]+"
ENDS_OF_A_ROW = 4096

_SCANNED = "part int, conv long, pos long, node binary, parent binary, digest binary, words long, first boolean, summary boolean"


def named(value: int) -> bytes:
    return value.to_bytes(16, "big")


def after(before: int, value: int, length: int) -> int:
    """The name of a sequence that follows another, from both names and its own length."""
    return (before * pow(BASE, length, PRIME) + value) % PRIME


def digest(role: Column, text: Column) -> Column:
    """A 128-bit name of a turn; null is empty."""
    role, text = F.coalesce(role.cast("string"), F.lit("")), F.coalesce(text.cast("string"), F.lit(""))
    return F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))


def digested(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``(conv, turn, digest, words)`` of every row with a conversation id."""
    words = F.regexp_count(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit(WORDS)).cast("long")
    return conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"), digest(F.col(role_col), F.col(text_col)).alias("digest"), words.alias("words")
    )


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Positions and prefix names within a range, and two summary rows: its first and last conversation."""
    part = TaskContext.get().partitionId()
    now, pos, value, first, opening = None, 0, 0, True, None

    def rows(found: list[tuple], summary: bool) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) if found else [()] * 7
        kinds = (("conv", pa.int64()), ("pos", pa.int64()), ("node", pa.binary()), ("parent", pa.binary()), ("digest", pa.binary()), ("words", pa.int64()), ("first", pa.bool_()))
        named_columns = {name: pa.array(list(c), kind) for (name, kind), c in zip(kinds, columns, strict=True)}
        return batch({"part": pa.array([part] * len(found), pa.int32())} | named_columns | {"summary": pa.array([summary] * len(found), pa.bool_())})

    for some in batches:
        found = []
        for conv, own, words in zip(*(some.column(c).to_pylist() for c in ("conv", "digest", "words")), strict=True):
            if conv != now:
                if now is not None and first:
                    opening, first = (now, pos, named(value), None, None, None, True), False
                now, pos, value = conv, 0, 0
            before, pos = value, pos + 1
            value = (value * BASE + int.from_bytes(own, "big") + 1) % PRIME
            found.append((conv, pos, named(value), named(before), own, words, first))
        yield rows(found, False)
    if now is not None:
        last = (now, pos, named(value), None, None, None, False)
        yield rows([opening or (*last[:6], True), last], True)


def numbered(turns: DataFrame, *order: str) -> DataFrame:
    """``(conv, pos, node, parent, digest, words)``: turns by conversation and ``order``, counted from 1,
    with the names of the prefix that ends with the turn and of the one before it.

    Only two rows per range reach the driver.
    """
    keys = ["conv", *order]
    scanned = turns.repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv", "digest", "words").mapInArrow(_scan, _SCANNED)
    scanned = settle(scanned, "scanned")
    ends: dict[int, dict[bool, tuple]] = {}
    for row in scanned.where("summary").select("part", "first", "conv", "pos", "node").collect():
        ends.setdefault(row["part"], {})[row["first"]] = (row["conv"], row["pos"], int.from_bytes(row["node"], "big"))
    carried: dict[int, tuple[int, int]] = {}
    running = None
    for part in sorted(ends):
        opening, last = ends[part][True], ends[part][False]
        alone = opening[0] == last[0]
        if running is not None and running[0] == opening[0]:
            carried[part] = running[1:]
            opening = (opening[0], running[1] + opening[1], after(running[2], opening[2], opening[1]))
        running = opening if alone else last
    rows = scanned.where("not summary")
    columns = ["conv", "pos", "node", "parent", "digest", "words"]
    if not carried:
        return rows.select(columns)

    def put_in_front(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in batches:
            found = []
            for part, pos, node, parent in zip(*(some.column(c).to_pylist() for c in ("part", "pos", "node", "parent")), strict=True):
                count, value = carried[part]
                name = lambda own, length: named(after(value, int.from_bytes(own, "big"), length))  # noqa: E731,B023
                found.append((pos + count, name(node, pos), name(parent, pos - 1)))
            columns = list(zip(*found, strict=True)) if found else [()] * 3
            own = {c: some.column(c) for c in ("conv", "digest", "words")}
            yield batch({"conv": own["conv"], "pos": pa.array(columns[0], pa.int64()), "node": pa.array(columns[1], pa.binary()), "parent": pa.array(columns[2], pa.binary()), "digest": own["digest"], "words": own["words"]})

    late = F.col("first") & F.col("part").isin(sorted(carried))
    mended = rows.where(late).mapInArrow(put_in_front, "conv long, pos long, node binary, parent binary, digest binary, words long")
    return rows.where(~late).select(columns).unionByName(mended)


def _end_hashes(ends: DataFrame) -> DataFrame:
    """``(node, n_ends, ends_sha256)``: a hash over ids in ascending order, fed as they come."""
    at = F.floor(F.col("conv") / F.lit(ENDS_OF_A_ROW).cast("decimal(20,0)")).cast("long")
    some = ends.groupBy("node", at.alias("at")).agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda x: x.cast("string")), ",").alias("ids"))

    def feed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, count, sha = None, 0, None

        def row() -> pa.RecordBatch:
            return batch({"node": pa.array([now], pa.binary()), "n_ends": pa.array([count], pa.int64()), "ends_sha256": pa.array([sha.hexdigest()])})

        for part in batches:
            for node, n, ids in zip(*(part.column(c).to_pylist() for c in ("node", "n", "ids")), strict=True):
                if node != now:
                    if now is not None:
                        yield row()
                    now, count, sha = node, 0, hashlib.sha256()
                elif count:
                    sha.update(b",")
                sha.update(ids.encode())
                count += n
        if now is not None:
            yield row()

    dealt = some.repartition("node").sortWithinPartitions("node", "at").select("node", "n", "ids")
    return dealt.mapInArrow(feed, "node binary, n_ends long, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    rebuild: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One row per distinct prefix of the conversations' turns, and one for the empty prefix.

    ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id``, ``n_convs`` (conversations that
    start with the prefix), ``n_children``, ``n_leaves`` (childless nodes of its subtree),
    ``saved_tokens`` (over its subtree, ``n_convs - 1`` times the words of the last turn), ``n_ends``
    (members that end there), ``ends_sha256`` (of their ids in ascending order, comma-joined), and
    ``node``, ``parent`` and ``turn_digest``, 128-bit names.

    Turns are ordered by ``turn``, null first, equal ones by a digest of role and text. Null roles and
    texts are empty. Rows without an id take no part; repeated rows are turns like others. An empty
    table gives no row. Other columns are dropped. Equality of turns and prefixes is that of 128-bit
    names. ``rebuild(turns, members)`` may make other sequences out of ``(conv, pos, digest, words)``
    and ``(conv)``: it returns ``(conv, turn, digest, words)``; members without turns end at the root.
    """
    light = settle(digested(conversations, conv_col, turn_col, role_col, text_col), "turns")
    members = settle(light.select("conv").distinct(), "members")
    turns = numbered(light, "turn", "digest")
    if rebuild is not None:
        turns = numbered(rebuild(turns.select("conv", "pos", "digest", "words"), members), "turn", "digest")
    turns = settle(turns, "prefixes")
    root = members.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    binary = lambda x: F.lit(x).cast("binary")
    zero = F.lit(0).cast("long")
    root = root.select(binary(bytearray(ROOT)).alias("node"), binary(None).alias("parent"), zero.alias("depth"), "conv_id", "n_convs", zero.alias("words"), binary(None).alias("turn_digest"))
    nodes = turns.groupBy("node").agg(F.min("parent").alias("parent"), F.min("pos").alias("depth"), F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.min("words").alias("words"), F.min("digest").alias("turn_digest"))
    nodes = settle(root.unionByName(nodes), "nodes")
    kids = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = settle(nodes.join(kids, "node", "left").withColumn("n_children", F.coalesce("n_children", zero)), "nodes")
    saved = ((F.col("n_convs") - 1) * F.col("words")).alias("s")
    totals = subtree_sums(nodes.select("node", "parent", "depth", "n_children", saved, F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("l")))
    last = turns.groupBy("conv").agg(F.max(F.struct("pos", "node")).alias("last"))
    ends = members.join(last, "conv", "left").select("conv", F.coalesce("last.node", binary(bytearray(ROOT))).alias("node"))
    whole = nodes.join(totals.select("node", F.col("s").alias("saved_tokens"), F.col("l").alias("n_leaves")), "node").join(_end_hashes(ends), "node", "left")
    whole = settle(whole, "totals")
    above = nodes.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("children"))
    return join_hubs(whole, above, "parent", "children").select(
        F.col("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("n_ends", zero).alias("n_ends"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "node", "parent", "turn_digest"
    )


def branched(every: int = 20, most: int = 3, modulus: int = 4) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Rebuilds each conversation ``c`` on the start of another: the first ``h`` turns of conversation
    ``c - c % every``, then its own turns after the first ``h``; ``h`` is the unsigned crc32 of the
    decimal id modulo ``modulus``, at most ``most``."""
    share = lambda c: F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(modulus))

    def rebuild(turns: DataFrame, members: DataFrame) -> DataFrame:
        own = turns.where(F.col("pos") > share(F.col("conv"))).select("conv", (F.col("pos") + most).alias("turn"), "digest", "words")
        heads = turns.where((F.col("pos") <= most) & (F.col("conv") % every == 0))
        users = members.select("conv", (F.col("conv") - F.col("conv") % every).alias("base"), share(F.col("conv")).alias("h")).where("h > 0")
        taken = users.join(heads.withColumnRenamed("conv", "base"), "base").where("pos <= h")
        return own.unionByName(taken.select("conv", F.col("pos").alias("turn"), "digest", "words"))

    return rebuild
