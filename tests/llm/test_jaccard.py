"""The Jaccard join and connected components against brute force."""

import random
import re
from pathlib import Path
from time import sleep
from unittest.mock import MagicMock

import numpy as np
import pyarrow as pa
import pytest

from brindle.llm import jaccard
from brindle.llm.components import components
from brindle.llm.jaccard import PartEnum, jaccard_components
from brindle.session import REMOVE_SHUFFLES, settle


def shingles(text, words):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set())


def closure(keys, linked):
    root = {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def brute(rows, words, percent):
    sets = {k: shingles(t, words) for k, t in rows}
    keys = sorted(sets)
    links = [(a, b) for i, a in enumerate(keys) for b in keys[i + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {k: (len(sets[k]), c) for k, c in closure(keys, links).items()}


def near_copies(seed):
    rng = random.Random(seed)
    docs = []
    for _ in range(25):
        base = [rng.choice("abcdefghijklmnop") + rng.choice(["", "x", "é", "Q"]) for _ in range(rng.choice([1, 2, 4, 6, 9, 12, 15, 30, 80, 400]))]
        for _ in range(rng.randrange(1, 9)):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, len(base) // 25])):
                at = rng.randrange(len(copy))
                copy[at : at + 1] = rng.choice([[], ["new" + str(rng.randrange(99))], [copy[at], "in"]])
                copy = copy or ["z"]
            base = copy if rng.random() < 0.5 else base
            docs.append((len(docs), " ".join(copy)))
    return docs + [(len(docs) + k, t) for k, t in enumerate(["", None, " \n", "a", "A", "a b", "b a"])]


@pytest.mark.parametrize("words,percent,seed", [(3, 90, 1), (5, 80, 2), (1, 80, 3), (3, 75, 4), (2, 100, 5)])
def test_matches_brute_force(spark, words, percent, seed):
    docs = near_copies(seed)
    df = spark.createDataFrame([(k, t, "c") for k, t in docs], "doc_id long, text string, component_id string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df.repartition(4), words, percent).collect()}
    assert got == brute(docs, words, percent)


def test_slices_of_a_batch_are_read_as_they_are():
    texts = ["A b c d", "", "one Two three four five", "\x00", "É f", "g", "h I j"]
    for kind in (pa.string(), pa.large_string()):
        for first in range(len(texts) + 1):
            hashes, offsets = jaccard.shingle_sets(pa.array(texts, kind).slice(first), 3)
            for k, text in enumerate(texts[first:]):
                own, _ = jaccard.shingle_sets(pa.array([text]), 3)
                assert hashes[offsets[k] : offsets[k + 1]].tolist() == own.tolist()


def test_batches_of_several_slices(spark):
    # More text than a slice holds, in one batch: copies and near copies lie in different slices.
    body = [f"w{k}" * 200 for k in range(120)]
    docs = [(k, " ".join([f"Head{k % 40}", *body[k % 40 : k % 40 + 60]])) for k in range(120)] + [(500, "a B c"), (501, "A b C"), (502, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df, 3, 90).collect()}
    assert got == brute(docs, 3, 90)


def test_many_buckets_and_portions(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BUCKET_BYTES", 500)
    monkeypatch.setattr(jaccard, "SENT_TOGETHER", 300)
    docs = near_copies(7)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(df.repartition(3), 3, 80).collect()}
    assert got == brute(docs, 3, 80)


def test_signatures_take_no_more_bytes_in_more_buckets(spark):
    docs = [" ".join(f"w{k}x{j}" for j in range(300)) for k in range(400)]
    part = pa.record_batch({"id": pa.array(range(400), pa.int64()), "hash": pa.array(range(400), pa.int64()), "text": docs})
    sent = {}
    for buckets in (1, 3000):
        rows = MagicMock()
        jaccard._signed(rows, PartEnum(80), 5, buckets)
        sign = rows.select().mapInArrow.call_args.args[0]
        sent[buckets] = sum(len(x) for found in sign(iter([part])) for x in found.column("data").to_pylist() if x)
    assert 0 < sent[3000] < 1.1 * sent[1]


def test_marks_of_signatures_are_kept():
    rng = np.random.default_rng(3)
    sigs, marks = rng.integers(0, 2**64, 500, dtype=np.uint64), rng.integers(0, 2**48, 500, dtype=np.uint64)
    sigs[100:200], marks[150:200] = sigs[:100], marks[50:100]  # 50 signatures of two classes, 50 of one class twice
    keys = jaccard._placed(sigs, 70)
    found, *own = jaccard._by_signature([(keys[:180], marks[:180]), (keys[180:], marks[180:])])
    pairs = {(s, *sorted([a, b])) for row in found for s, a, b in zip(*(row.column(c).to_pylist() for c in ("sig", "leader", "member")), strict=True)}
    as_mark = lambda m: int(m).to_bytes(6, "big")
    assert pairs == {(int(keys[k].view(np.int64)), *sorted([as_mark(marks[k]), as_mark(marks[100 + k])])) for k in range(50)}
    sent = [jaccard._unpacked(b, x) for row in jaccard._dealt([(keys, marks)]) for b, x in zip(row.column("bucket").to_pylist(), row.column("data").to_pylist(), strict=True) if b >= 0]
    for side, whole in zip(zip(*sent, strict=True), own, strict=True):
        assert np.concatenate(side).tolist() == whole.tolist()


def test_settled_tables_leave_no_shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for d in folders for f in Path(d).rglob("shuffle_*.data")}
    before = files()
    kept = settle(spark.range(5000).repartition(3, "id").groupBy("id").count(), "kept")
    for _ in range(50):
        if files() <= before:
            break
        sleep(0.1)
    assert files() <= before and kept.count() == 5000
    assert spark.conf.get(REMOVE_SHUFFLES, "false") == "false"


def brute_links(rows, words, percent):
    sets = [shingles(t, words) for _, t in rows]
    near = lambda x, y: bool(x and y) and 100 * len(x & y) >= percent * len(x | y)
    return sorted(((k, sum(near(x, y) for y in sets) - bool(x)) for (k, _), x in zip(rows, sets, strict=True)), key=str)


@pytest.mark.parametrize("block,tile", [(1 << 20, 512), (60, 2)])
def test_links_are_counted_exactly(spark, monkeypatch, block, tile):
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(jaccard, "TILE", tile)
    base = [f"w{k}" for k in range(60)]
    # Texts that all link with each other, a chain in which only near ones do, and copies.
    docs = [(k, " ".join([*base[:-1], f"x{k}"])) for k in range(12)]
    docs += [(100 + k, " ".join(f"v{j}" for j in range(3 * k, 3 * k + 60))) for k in range(12)]
    docs += [(200 + k, "all three are the same") for k in range(3)] + [(5, docs[5][1]), (5, docs[5][1]), (None, docs[7][1])]
    docs += [(1000 + k, t) for k, t in near_copies(6)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_links) for r in jaccard_components(df.repartition(3), 3, 80).collect()), key=str)
    assert got == brute_links(docs, 3, 80)


def test_tiles_of_a_large_component(monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 3)
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 50, dtype=np.uint64)
    sets = [np.unique(np.concatenate([base[rng.integers(0, 12) :], rng.integers(0, 2**63, int(rng.integers(0, 5)), dtype=np.uint64)])) for _ in range(40)]
    weight = rng.integers(1, 4, 40)
    near = np.array([[jaccard.similar(x, y, 80) for y in sets] for x in sets])
    every, even, odd = np.arange(40), np.arange(0, 40, 2), np.arange(1, 40, 2)
    parts = [jaccard.linked_rows(sets, weight, *sides, 80) for sides in ((even, even), (odd, odd), (even, odd))]
    assert sum(parts).tolist() == jaccard.linked_rows(sets, weight, every, every, 80).tolist() == (near @ weight).tolist()


@pytest.mark.parametrize("percent", [75, 80, 90])
def test_similar_sets_share_a_signature(percent):
    scheme, rng = PartEnum(percent), np.random.default_rng(percent)
    for size in [4, 5, 8, 9, 10, 12, 17, 20, 33, 50, 77, 120, 400]:
        for _ in range(25):
            a = rng.integers(0, 2**63, size, dtype=np.uint64)
            most = int(scheme.differences(np.array(size)))
            lost = int(rng.integers(0, most + 1))
            b = np.concatenate([a[lost:], rng.integers(0, 2**63, int(rng.integers(0, most + 1)), dtype=np.uint64)])
            shared = size - lost
            if 100 * shared < percent * (size + len(b) - shared) or lost + len(b) - shared == 0:
                continue
            a, b = np.unique(a), np.unique(b)
            sigs, owner = scheme.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
            assert set(sigs[owner == 0].tolist()) & set(sigs[owner == 1].tolist()), (size, lost, len(b))


def test_texts_of_unlinked_documents_are_not_shuffled(spark, monkeypatch):
    read = []

    def counted(rows, wanted, likely=jaccard.likely):
        found = likely(rows, wanted)
        assert wanted.join(found, ["id", "hash"], "left_anti").isEmpty()
        read.append(found.count())
        return found

    monkeypatch.setattr(jaccard, "likely", counted)
    docs = [(k, " ".join(f"w{k}x{j}" for j in range(40))) for k in range(300)]
    docs += [(1000 + k, docs[k][1] + " tail") for k in range(5)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_components(df.repartition(3), 3, 90).collect()}
    assert got == {k: k % 1000 for k, _ in docs}
    assert len(read) >= 2 and 10 <= max(read) < 20


def test_null_and_repeated_ids_and_empty_table(spark):
    text = " ".join(f"w{k}" for k in range(40))
    df = spark.createDataFrame([(7, text), (7, text), (None, text), (9, text + " tail"), (None, "alone here now"), (3, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in jaccard_components(df, 3, 90).collect()), key=str)
    assert got == sorted([(7, 7), (7, 7), (None, 7), (9, 7), (None, None), (3, 3)], key=str)
    assert jaccard_components(df.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1060)] + [(5000, k) for k in range(5001, 5100)] + [(4, 4)]
    df = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert got == closure(nodes, [e for e in edges if e[0] != e[1]])
    assert components(df.limit(0)).count() == 0
