"""Line deduplication against all pairs of lines."""

import random
import re
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from brindle.llm import lines
from brindle.llm.lines import dedup_lines


def brute(rows, percent):
    """rows in document order."""
    seen, out = [], {}
    for key, text in rows:
        kept, own = [], (text or "").split("\n")
        for line in own:
            tokens = frozenset(w for w in re.split(r"[ \t\r\f\x0B]+", line.lower()) if w)
            if tokens and any(100 * len(tokens & s) >= percent * len(tokens | s) for s in seen):
                pass
            else:
                kept.append(line)
            if tokens:
                seen.append(tokens)
        out[key] = (len(own), len(own) - len(kept), "\n".join(kept))
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "a"] * 6 + [f"w{k}" for k in range(60)]
    base = [[rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 5, 9, 14, 30, 60]))] for _ in range(40)]
    docs = []
    for k in range(60):
        own = []
        for _ in range(rng.randrange(0, 8)):
            line = list(rng.choice(base))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                line[rng.randrange(len(line))] = rng.choice(["new", "The", "x" + str(rng.randrange(50))])
            own.append(rng.choice([" ", "\t", "  "]).join(line) + rng.choice(["", " ", "\r"]))
        docs.append((k, "\n".join(own)))
    return docs + [(60, None), (61, ""), (62, "\n\n \n"), (-3, docs[5][1])]


@pytest.mark.parametrize("seed,percent", [(1, 90), (2, 80), (3, 60)])
def test_matches_brute_force(spark, seed, percent):
    docs = corpus(seed)
    df = spark.createDataFrame([(k, t, 0) for k, t in docs], "doc_id long, text string, pos int")
    got = {r.doc_id: (r.n_lines, r.n_removed, r.kept) for r in dedup_lines(df.repartition(4), percent).collect()}
    assert got == brute(sorted(docs), percent)


def test_frequent_tokens_in_parts(spark, monkeypatch):
    monkeypatch.setattr(lines, "PART_SHIFT", 2)
    docs = corpus(7)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: (r.n_lines, r.n_removed, r.kept) for r in dedup_lines(df, 80).collect()} == brute(sorted(docs), 80)


def test_repeated_rows_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b\nc d"), (1, "a b\nc d"), (None, "c d"), (2, "c d\nA B")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.kept) for r in dedup_lines(df).collect()), key=str)
    assert got == sorted([(1, "a b"), (1, "a b"), (None, "c d"), (2, "")], key=str)
    assert dedup_lines(df.limit(0)).count() == 0


def test_small_table_digests_without_python(spark):
    from brindle.llm.queries import catalog

    path = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    want = {k: (n, gone, sha256(kept.encode()).hexdigest()) for k, (n, gone, kept) in brute(sorted(rows), 90).items()}
    out = catalog.plans["op8_line_dedup"](spark, path)
    assert {r.doc_id: tuple(r)[1:] for r in out.collect()} == want
    assert "Python" not in out._jdf.queryExecution().toString() and "Arrow" not in out._jdf.queryExecution().toString()


def test_all_blanks_end_counted_words(spark):
    text = "\t".join(["Hot"] * 20) + "\r" + "\x0b".join(["hot"] * 20) + "\n" + "\x0c".join(["hot"] * 24)
    rows = lines.keyed(spark.createDataFrame([(1, text)], "doc_id long, text string"), "doc_id", "text")
    bucket = F.pmod(F.xxhash64(F.lit("hot")), F.lit(lines.BUCKETS)).cast("int")
    assert lines.word_counts(rows).select(F.get("rarity", bucket)).first()[0] == 12  # 2 * log2(64)


def test_met_lines_are_dealt_out_once(spark, monkeypatch):
    settled = {}

    def kept(df, label, settle=lines.settle):
        settled.setdefault(label, df._jdf.queryExecution().optimizedPlan().toString())
        return settle(df, label)

    monkeypatch.setattr(lines, "settle", kept)
    docs = corpus(11)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: (r.n_lines, r.n_removed, r.kept) for r in dedup_lines(df).collect()} == brute(sorted(docs), 90)
    # Neighbours are found where the lines meet; what is left is neither deduplicated nor looked up whole.
    assert "Window" in settled["met"] and "Window" not in settled["close"]
    assert settled["rest"].count("Aggregate") == 1


@pytest.mark.parametrize("seed", [5, 13])
def test_lines_meet_by_ranges(spark, monkeypatch, seed):
    settled = {}

    def kept(df, label, settle=lines.settle):
        settled.setdefault(label, df._jdf.queryExecution().optimizedPlan().toString())
        return settle(df, label)

    monkeypatch.setattr(lines, "settle", kept)
    monkeypatch.setattr(lines, "PART_SHIFT", 1)
    monkeypatch.setattr(lines, "LONG_LINE", 20)
    docs = corpus(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: (r.n_lines, r.n_removed, r.kept) for r in dedup_lines(df).collect()} == brute(sorted(docs), 90)
    # The words of the corpus are not counted, and those of a line made once (two kinds of blanks), not in a filter too.
    assert "rarity" not in settled and settled["lines"].count("split(lower(") == 2
