"""Line deduplication: an exact set-similarity join in DataFrame operations only.

A line's tokens are its distinct lower-cased words. Lines of equal sets are found by one hash
aggregation. Others meet where they share a key, and the pairs that meet are verified. There are two
kinds of keys, and with either all sets that reach the threshold meet:

* High thresholds: sets that reach one differ in ``d`` tokens at most, so if the hashes of the tokens
  are dealt out to more than ``d`` ranges, one range at least holds the same tokens of both. A key is
  what a range holds. Only keys of different sets travel with their lines.
* Others: with the tokens ordered from rare to frequent, the sets share one of the first few (prefix
  filter), at places (positional filter) that leave enough in common.

A line only has to meet one earlier match, so each is first compared with the earliest lines of its
keys; the join with all earlier lines is left to the lines for which that finds nothing.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from brindle.llm.repeats import among, keyed, likely, unkeyed
from brindle.session import settle

BUCKETS = 1 << 16  # of the word counts that tokens are ordered by; fixed, whatever the corpus
HASH_BITS = 55
# A key with 2**PART_SHIFT lines or more has them dealt out to several parts.
PART_SHIFT = 16
RANGES_FROM = 85  # percent; below, ranges hold too few tokens to be rare
LONG_LINE = 4096  # tokens
LAGS = 3
_ADDRESS = ("id", "hash", "pos")
_SET = ("key", "n", "t0")


_OTHER_BLANKS = ("\t", "\r", "\x0b", "\x0c")


def line_words(line: Column) -> Column:
    """Lower-cased words of a line, ``[^\\x20\\x09-\\x0D]+``; may hold empty strings."""
    other = reduce(or_, (F.contains(line, F.lit(c)) for c in _OTHER_BLANKS))
    return F.when(other, F.split(F.lower(line), "[ \\t\\r\\f\\x0B]+")).otherwise(F.split(F.lower(line), " "))


def _exploded(rows: DataFrame) -> DataFrame:
    return rows.select("id", "hash", F.posexplode(F.split("text", "\n")).alias("pos", "line"))


def word_counts(rows: DataFrame) -> DataFrame:
    """One row with an array: how often the words of each hash bucket occur."""
    blanks = "".join(("\n", *_OTHER_BLANKS))
    words = rows.select(F.explode(F.split(F.translate(F.lower("text"), blanks, " " * len(blanks)), " ")).alias("w"))
    counts = words.groupBy(F.pmod(F.xxhash64("w"), F.lit(BUCKETS)).cast("int").alias("bucket")).agg(F.count("*").alias("n"))
    every = rows.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    whole = every.join(counts, "bucket", "left").select("bucket", F.coalesce("n", F.lit(1).cast("long")).alias("n"))
    # A fixed number of numbers, whatever the corpus.
    return whole.agg(F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("c")).select(F.transform("c", lambda x: (2 * F.log2(x["n"])).cast("long")).alias("rarity"))


def ordered_tokens(line: Column, rarity: Column) -> Column:
    """The tokens as numbers, rare ones first: two steps per doubling of the count, then the hash."""

    def place(word: Column) -> Column:
        seldom = F.get(rarity, F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int"))
        return F.shiftleft(seldom, HASH_BITS).bitwiseOR(F.xxhash64(word).bitwiseAND(F.lit((1 << HASH_BITS) - 1)))

    # The empty string stands between two blanks; it is no word.
    return F.sort_array(F.array_remove(F.array_distinct(F.transform(line_words(line), place)), place(F.lit(""))))


def _needed(n: Column, m: Column, percent: int) -> Column:
    """Least number of common tokens with which sets of these sizes reach the threshold."""
    return F.ceil(F.lit(percent) * (n + m) / F.lit(100 + percent))


def _has_words(line: Column) -> Column:
    """Cheap, as a filter on the tokens would have them made twice."""
    return F.length(F.ltrim(line, F.lit(" \n" + "".join(_OTHER_BLANKS)))) > 0


def hashed_tokens(line: Column) -> Column:
    """The tokens as odd numbers of 63 bits, in no order."""
    place = lambda word: F.shiftright(F.xxhash64(word), 1).bitwiseOR(F.lit(1))
    return F.array_remove(F.array_distinct(F.transform(line_words(line), place)), place(F.lit("")))


def _ranges(n: Column, percent: int) -> Column:
    """Numbers of ranges by which a set of this size is dealt out: more, for each size that a match may
    have, than tokens in which the two can differ. Few numbers stand for all, those of two binary digits."""

    def least(both: Column) -> Column:
        return F.floor(both * (100 - percent) / F.lit(100 + percent)).cast("int") + 1

    def rounded(k: Column) -> Column:
        low = F.greatest(F.length(F.bin(k.cast("long"))) - 2, F.lit(0))
        step = F.call_function("shiftleft", F.lit(1), low)
        return F.call_function("shiftleft", F.call_function("shiftright", k + step - 1, low), low)

    # Sets that can differ in no token are equal and found as such.
    first, last = F.greatest(least(n + F.ceil(percent * n / F.lit(100))), F.lit(2)), least(n + F.floor(100 * n / F.lit(percent)))
    # From RANGES_FROM on no third number lies between them.
    return F.when(last >= first, F.array_distinct(F.array(rounded(first), rounded(last))))


def _by_ranges(rows: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The lines with words as ``(id, hash, pos, key, n, t0)``, their sets as ``(key, n, t0, first, c)``, and
    the first lines of those that may match another as ``(t, part, parts, x)``, one row per key that
    different sets share."""
    lines = _exploded(rows).where(_has_words(F.col("line"))).select(*_ADDRESS, F.sort_array(hashed_tokens(F.col("line"))).alias("tokens"))
    lines = lines.select(*_ADDRESS, "tokens", F.size("tokens").alias("n"), F.xxhash64("tokens").alias("key"), F.get("tokens", F.lit(0)).alias("t0"))
    dealt = lines.select("*", F.posexplode_outer(_ranges(F.col("n"), percent)).alias("r", "k"))
    # Even numbers among the odd ones are where the ranges begin.
    low, width = F.lit(-(2**62)), 2 * F.expr(f"{2**62}L div k")
    dealt = dealt.withColumn("width", width)
    begin = lambda j: low + j * F.col("width")
    dealt = dealt.withColumn("tokens", F.sort_array(F.concat("tokens", F.sequence(low, begin(F.col("k") - 1), F.col("width")))))
    # A search per range is faster in short lines, but grows with the square.
    ats = F.when(F.col("n") > LONG_LINE, F.filter(F.sequence(F.lit(1), F.size("tokens")), lambda i: F.get("tokens", i - 1).bitwiseAND(F.lit(1)) == 0))
    dealt = dealt.withColumn("ats", ats).select("*", F.explode_outer(F.sequence(F.lit(0), F.col("k") - 1)).alias("j"))
    at = lambda j: F.coalesce(F.get("ats", j), F.array_position("tokens", begin(j))).cast("int")
    end = F.when(F.col("j") + 1 < F.col("k"), at(F.col("j") + 1)).otherwise(F.size("tokens") + 1)
    dealt = dealt.select("*", at(F.col("j")).alias("at"), end.alias("end"))
    range_key = F.when(F.col("j").isNotNull(), F.xxhash64("k", "j", F.slice("tokens", F.col("at") + 1, F.col("end") - F.col("at") - 1)))
    # What belongs to the line stands in its first row alone.
    first_row = (F.coalesce("r", F.lit(0)) == 0) & (F.coalesce("j", F.lit(0)) == 0)
    keys = settle(dealt.select("key", range_key.alias("t"), *[F.when(first_row, F.col(c)).alias(c) for c in (*_ADDRESS, "n", "t0")]), "lines")
    lines = keys.where("id is not null")
    sets = settle(_sets(lines), "sets")
    # Most keys belong to one set and need not travel with it.
    keys = keys.where("t is not null").select("t", "key")
    shared = keys.groupBy("t").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low != high").select("t")
    pairs = settle(keys.join(settle(shared, "shared").hint("shuffle_hash"), "t").distinct(), "pairs")
    sizes = pairs.groupBy("t").count().select("t", F.shiftright("count", PART_SHIFT).cast("int").alias("parts")).where("parts > 1")
    held = pairs.join(settle(sizes, "sizes"), "t", "left").join(sets, "key").withColumn("parts", F.coalesce("parts", F.lit(1)))
    x = F.struct(*[F.col(f"first.{c}") for c in _ADDRESS], "n", F.lit(0).cast("long").alias("p"), F.lit(0).alias("i"))
    held = held.select("t", F.pmod("key", F.col("parts")).cast("int").alias("part"), "parts", x.alias("x"))
    return lines, sets, held.repartition("t", "part")


def _sets(lines: DataFrame) -> DataFrame:
    return lines.groupBy(*_SET).agg(F.min(F.struct(*_ADDRESS)).alias("first"), F.count("*").alias("c"))


def _by_prefix(rows: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """As ``_by_ranges``; the keys are the first tokens."""
    rarity = settle(word_counts(rows), "rarity").scalar()
    lines = _exploded(rows).where(_has_words(F.col("line"))).withColumn("rarity", rarity)
    lines = lines.select(*_ADDRESS, ordered_tokens(F.col("line"), F.col("rarity")).alias("tokens"))
    n = F.size("tokens")
    prefix = n - F.ceil(F.lit(percent) * n / 100).cast("int") + 1
    lines = lines.select(*_ADDRESS, F.xxhash64("tokens").alias("key"), n.alias("n"), F.get("tokens", F.lit(0)).alias("t0"), _parity("tokens").alias("p"), F.slice("tokens", 1, prefix).alias("prefix"))
    lines = settle(lines, "lines")
    # One row per line and prefix token; lines of a frequent token lie in several parts.
    parts = F.greatest(F.lit(1), F.shiftright(F.expr(f"shiftleft(1L, cast(shiftright(t, {HASH_BITS}) / 2 as int))"), PART_SHIFT)).cast("int")
    sets = settle(_sets(lines), "sets")
    marked = lines.join(sets.where("c > 1").drop("c"), [*_SET], "left")
    firsts = marked.where(F.col("first").isNull() | (F.col("first") == F.struct(*_ADDRESS)))
    spread = firsts.select(*_ADDRESS, "n", "p", F.posexplode("prefix").alias("i", "t")).withColumn("parts", parts)
    held = spread.select("t", F.pmod("hash", F.col("parts")).cast("int").alias("part"), "parts", F.struct(*_ADDRESS, "n", "p", "i").alias("x"))
    return lines, sets, held.repartition("t", "part")


def dedup_lines(docs: DataFrame, percent: int = 90, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``(id, *keep, n_lines, n_removed, kept)`` of every row: the text without lines that match an earlier
    line of the corpus.

    Lines end at ``\\n``. Two lines match when the Jaccard similarity of their sets of lower-cased
    words is ``percent`` or more. A line goes if an earlier line of the input matches it, whether
    that one stays or not; earlier is: smaller id, or higher up in the same document. Lines without
    words stay. ``kept`` is the remaining lines joined by ``\\n``.

    Ids are integers; a null id is smaller than all others. Rows equal in id and text are one
    document: each gets the document's result. Rows of one id and different texts are ordered by
    the hash of their text. A null text is one empty line and gives an empty ``kept``. An empty
    table gives an empty result. Columns that are not in ``keep`` are dropped; with ``keep`` there is also
    ``was_text``, false where the text is null. Words are compared by hashes of 55 bits or more.
    """
    rows = keyed(docs, id_col, text_col)
    lines, sets, held = (_by_ranges if percent >= RANGES_FROM else _by_prefix)(rows, percent)
    # Equal sets: the first line stays for now, the others go.
    copies = lines.join(sets.where("c > 1"), [*_SET]).where(F.col("first") != F.struct(*_ADDRESS)).select(*_ADDRESS)
    parts = F.col("parts")
    # Each line meets the earliest of its part and, as that may be none of the common ones, those just before.
    by_line = Window.partitionBy("t", "part").orderBy("x")
    all_lines = by_line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = {"y": F.first("x").over(by_line)} | {f"y{k}": F.lag("x", k).over(by_line) for k in range(1, LAGS + 1)}
    ranked = held.withColumns({"rank": F.row_number().over(by_line), "c": F.count("*").over(all_lines)} | before)
    # Rows equal in id and text have equal lines.
    ranked = ranked.where(((F.col("c") > 1) | (parts > 1)) & (F.col("y1").isNull() | (F.col("y1") != F.col("x"))))
    earlier_match = lambda y: _may_match(F.col("x"), F.col(y), percent) & (_address_of(y) < _address_of("x"))
    ys = F.array_compact(F.array(*[F.when(earlier_match(y), _address_of(y)) for y in before]))
    met = settle(ranked.select("t", "part", "parts", "x", "rank", "c", ys.alias("ys")), "met")
    # Earliest lines of the parts of one token meet in a second star.
    heads = met.where((F.col("rank") == 1) & (parts > 1)).select("t", "part", "x")
    tops = heads.groupBy("t").agg(F.min("x").alias("y"))
    star = met.where(F.size("ys") > 0).select(_at("x"), F.explode("ys").alias("y"))
    star = star.unionByName(heads.join(tops, "t").where(earlier_match("y")).select(_at("x"), _at("y")))
    close = settle(star.distinct(), "close")
    near = settle(_verified(close, rows, percent), "near")
    # What is left meets all earlier lines of its tokens, part by part; the first few of a token's only
    # part have met theirs. Few lines may be among those with a match, so few are dealt out to see.
    few = LAGS + 2
    left = met.where((F.col("rank") > few) | (parts > 1)).select("t", "part", "parts", "x")
    matched = among(near.select("x.*"), *_ADDRESS, of="x")
    doubtful = left.where(matched).select("t", "part", "parts", "x", _at("x").alias("at")).join(near.select(F.col("x").alias("at")), "at", "left_anti")
    open_ = left.where(~matched).unionByName(doubtful.drop("at"))
    everywhere = open_.select("t", "x", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    earlier = met.where((F.col("c") > few) | (parts > 1)).select("t", "part", F.col("x").alias("y"))
    rest = everywhere.join(earlier, ["t", "part"]).where(earlier_match("y")).select(_at("x"), _at("y")).distinct()
    rest = settle(rest.join(close, ["x", "y"], "left_anti"), "rest")
    removed = near.select("x.*").unionByName(_verified(rest, rows, percent).select("x.*")).unionByName(copies)
    gone = removed.groupBy("id", "hash").agg(F.collect_set("pos").alias("gone"))
    # The texts are dealt out by document for the verification and here: without carried columns
    # that is one shuffle.
    whole = rows
    if keep:
        carried = F.struct(F.col(text_col).isNotNull().alias("was_text"), *[F.col(c).alias(f"k{n}") for n, c in enumerate(keep)])
        whole = keyed(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), carried.alias("carried")), "id", "text", "carried")
    out = whole.join(gone, ["id", "hash"], "left")
    split = F.split("text", "\n")
    kept = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.filter(split, lambda _, k: ~F.array_contains("gone", k)), "\n"))
    others = [F.col(f"carried.k{n}").alias(c) for n, c in enumerate(keep)]
    was_text = ["carried.was_text"] if keep else []
    return out.select(unkeyed(id_col), *others, F.size(split).cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"), kept.alias("kept"), *was_text)


def _address_of(side: str) -> Column:
    return F.struct(*[F.col(f"{side}.{c}") for c in _ADDRESS])


def _at(side: str) -> Column:
    return _address_of(side).alias(side)


def _may_match(x: Column, y: Column, percent: int) -> Column:
    """Length and positional filter for a common prefix token at the places ``i``, and the parities:
    sets differ in no fewer tokens than their parities differ in bits."""
    n, m = x["n"], y["n"]
    longest = F.least(x["i"], y["i"]) + F.least(n - x["i"], m - y["i"])
    needed = _needed(n, m, percent)
    apart = F.bit_count(x["p"].bitwiseXOR(y["p"]))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (longest >= needed) & (apart <= n + m - 2 * needed)


def _parity(tokens: str) -> Column:
    """64 bits: of each bucket of tokens, whether the set holds an odd number."""
    return F.aggregate(tokens, F.lit(0).cast("long"), lambda bits, t: bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), t.bitwiseAND(F.lit(63)).cast("int"))))


def _verified(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """The pairs of lines whose token sets reach the threshold."""
    wanted = pairs.select("x.*").unionByName(pairs.select("y.*")).groupBy("id", "hash").agg(F.collect_set("pos").alias("wanted"))
    lines = likely(rows, wanted).join(wanted, ["id", "hash"]).select("id", "hash", "wanted", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    lines = lines.where(F.array_contains("wanted", F.col("pos"))).select(F.struct(*_ADDRESS).alias("at"), hashed_tokens(F.col("line")).alias("set"))
    # Rows equal in id and text have equal lines.
    sets = lines.groupBy("at").agg(F.first("set").alias("set"))
    both = pairs.join(sets.select(F.col("at").alias("x"), F.col("set").alias("a")), "x").join(sets.select(F.col("at").alias("y"), F.col("set").alias("b")), "y")
    # As shared / (a + b - shared), with the intersection made once.
    return both.where((100 + percent) * F.size(F.array_intersect("a", "b")) >= percent * (F.size("a") + F.size("b"))).select("x", "y").distinct()
