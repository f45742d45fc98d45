"""Word and byte substring deduplication against brute force."""

import random
import re
from hashlib import sha256

import pytest

from brindle.llm.substring import Prefixes, dedup_substrings

import numpy as np


def brute_words(rows, window):
    """First occurrences by (id, text hash order given by the caller), windows as tuples."""
    seen, out = set(), []
    for key, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        hit = [False] * len(words)
        for s in range(len(words) - window + 1):
            w = tuple(words[s : s + window])
            if w in seen:
                hit[s : s + window] = [True] * window
            seen.add(w)
        out.append((key, len(words), sum(hit), " ".join(w for w, h in zip(words, hit) if not h)))
    return out


def noisy_corpus(seed=3):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "be", "sea", "dé", "ox", "über", "zz"]) + rng.choice(["", "n", "st", "."])
    base = [[word() for _ in range(rng.choice([3, 19, 20, 21, 60, 300]))] for _ in range(30)]
    docs = []
    for k in range(120):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 3])):
            if words:
                words[rng.randrange(len(words))] = word() * 2
        if rng.random() < 0.3:
            words = words + rng.choice(base)[:40]
        docs.append((k, rng.choice([" ", "\n", "\t ", "  "]).join(words)))
    docs += [(120, ""), (121, None), (122, "Ouen " * 500), (123, "Ouen " * 90 + "x"), (124, "\x1c \x0b    a"), (-5, docs[0][1])]
    return docs


def test_matches_brute_force(spark):
    docs = noisy_corpus()
    df = spark.createDataFrame([(k, t, "x") for k, t in docs], "doc_id long, text string, n_words string")
    got = {r.doc_id: tuple(r)[1:] for r in dedup_substrings(df.repartition(5)).collect()}
    want = {r[0]: r[1:] for r in brute_words(sorted(docs), 20)}
    assert got == want


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = " ".join(f"w{k}" for k in range(25))
    df = spark.createDataFrame([(1, text), (1, text), (None, text), (2, text)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_removed) for r in dedup_substrings(df).collect()), key=str)
    assert got == [(1, 25), (1, 25), (2, 25), (None, 0)]
    assert dedup_substrings(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        dedup_substrings(df, window=18)


def test_long_prefixes_are_split():
    counts = np.array([0, 10, 5000, 3, 4])
    groups = Prefixes(counts, size=100)
    assert groups.bits[2] == 6 and groups.first[3] == groups.first[4] == groups.first[2] + 64 and groups.groups == groups.first[3] + 1


def test_small_table_digests(spark):
    from brindle.llm.queries import catalog

    path = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    want = {k: (n, gone, sha256(kept.encode()).hexdigest()) for k, n, gone, kept in brute_words(sorted(rows), 20)}
    got = {r.doc_id: tuple(r)[1:] for r in catalog.plans["op7_substring_dedup"](spark, path).collect()}
    assert got == want


def brute_bytes(rows, window):
    from collections import Counter

    texts = [(k, (t or "").encode()) for k, t in rows]
    count = Counter(t[s : s + window] for _, t in texts for s in range(len(t) - window + 1))
    out = {}
    for k, t in texts:
        hit = bytearray(len(t))
        for s in range(len(t) - window + 1):
            if count[t[s : s + window]] > 1:
                hit[s : s + window] = b"\1" * window
        kept = bytes(c for c, h in zip(t, hit) if not h)
        n_spans = sum(h and not (i and hit[i - 1]) for i, h in enumerate(hit))
        out[k] = (len(t), sum(hit), n_spans, kept)
    return out


def test_bytes_match_brute_force(spark):
    from brindle.llm.byte_repeats import remove_repeats

    docs = noisy_corpus(8)
    df = spark.createDataFrame([(k, t, 1) for k, t in docs], "doc_id long, text string, spans int")
    for window, gram in ((60, 16), (40, 40), (33, 7)):
        got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in remove_repeats(df.repartition(4), window, gram).collect()}
        assert got == brute_bytes(docs, window)


def test_bytes_of_equal_rows_and_empty_table(spark):
    from brindle.llm.byte_repeats import remove_repeats

    text = "".join(f"{k:04d}" for k in range(200))
    df = spark.createDataFrame([(1, text), (1, text), (None, "x" * 500), (2, text[:500])], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_removed) for r in remove_repeats(df).collect()), key=str)
    assert got == [(1, 500), (1, 500), (2, 500), (None, 500)]
    assert remove_repeats(df.where("doc_id = 1")).agg({"n_removed": "sum"}).first()[0] == 0
    assert remove_repeats(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_run_index_matches(seed):
    from brindle.llm.byte_repeats import RunIndex, suffix_array

    rng = np.random.default_rng(seed)
    text = np.concatenate([rng.integers(0, 3, 60), np.tile(rng.integers(0, 3, 5), 12), rng.integers(0, 2, 80)]).astype(np.int16)
    text = np.concatenate([text, text[20:90]])
    n = len(text)
    whole = text.tolist()
    assert suffix_array(text).tolist() == sorted(range(n), key=lambda i: whole[i:])

    def lcp(i, j):
        k = 0
        while max(i, j) + k < n and whole[i + k] == whole[j + k]:
            k += 1
        return k

    assert RunIndex(text).matches().tolist() == [max(lcp(i, j) for j in range(n) if j != i) for i in range(n)]


def test_small_table_byte_digests(spark):
    from brindle.llm.queries import catalog

    path = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    want = {k: (n, gone, spans, sha256(kept).hexdigest()) for k, (n, gone, spans, kept) in brute_bytes(rows, 400).items()}
    assert {r.doc_id: tuple(r)[1:] for r in catalog.plans["op10_byte_repeats"](spark, path).collect()} == want
