"""Decontamination against brute force."""

import random
import re

from brindle.llm.decontaminate import find_contamination


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, window):
    windows = {}
    for item, text in items:
        w = words(text)
        for k in range(max(len(w) - window, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[k : k + window]), set()).add("null" if item is None else str(item))
    out = {}
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out[doc] = (len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w))
    return out


def corpus():
    rng = random.Random(2)
    some = lambda n: " ".join(rng.choice(["Le", "chat", "ÉTÉ", "x1", "dog", "a"]) for _ in range(n))
    items = [(k, some(n)) for k, n in enumerate([1, 3, 4, 5, 9, 14, 20])] + [(7, None), (8, " -- "), (None, some(6)), (2, "Once more"), (9, some(5))]
    docs = []
    for k in range(60):
        parts = [some(rng.randrange(30))] + [rng.choice(["", (rng.choice(items)[1] or "").upper()]) for _ in range(2)] + [some(4)]
        docs.append((k, rng.choice([" ", "-", "\n", ", "]).join(parts)))
    return [*docs, (60, None), (61, ""), (62, "?!")], items


def test_matches_brute_force_and_offsets(spark):
    docs, items = corpus()
    df = spark.createDataFrame([(k, t, "h") for k, t in docs], "doc_id long, text string, hits string").repartition(3)
    tests = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items, 4)
    text_of = dict(docs)
    for shard_bytes in (1 << 20, 60):
        rows = find_contamination(df, tests, window=4, shard_bytes=shard_bytes, keep=("hits",)).collect()
        assert {r.doc_id: (r.n_words, r.n_hit, r.item_ids, r.contaminated) for r in rows} == want
        for r in rows:
            assert r.hits == "h"
            assert sum(len(words(text_of[r.doc_id][s.start : s.end])) for s in r.spans) == r.n_hit


def test_repeated_rows_and_empty_tables(spark):
    docs, items = corpus()
    df = spark.createDataFrame([(1, items[6][1]), (1, items[6][1]), (None, "a b")], "doc_id long, text string")
    tests = spark.createDataFrame(items, "item_id long, text string")
    assert sorted((str(r.doc_id), r.n_hit) for r in find_contamination(df, tests.where("item_id = 6"), 13).collect()) == [("1", 20), ("1", 20), ("None", 0)]
    assert find_contamination(df.limit(0), tests).count() == 0
    assert [r.n_hit for r in find_contamination(df, tests.limit(0)).collect()] == [0, 0, 0]
