"""The corpus pipeline against a brute-force version of its stages."""

import random

import pytest

import corpus_pipeline as pipeline
from test_jaccard import brute as groups
from test_lines import brute as line_dedup


def test_stages_keep_columns_and_only_remove(spark):
    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet")
    assert 4 <= len(pipeline.STAGES) <= 5
    seen = docs
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, seen, path)
        assert out.columns == docs.columns and out.schema == docs.schema, name
        rows = {r.doc_id: r.text for r in out.collect()}
        assert set(rows) <= {r.doc_id for r in seen.select("doc_id").collect()}
        seen = spark.createDataFrame(out.collect(), docs.schema)
    assert len(rows) > 100


def test_run_equals_brute_force(spark):
    path = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    # Every text of this table has letters of its language, so the first stage keeps all of them.
    lines = line_dedup(sorted(docs.items()), 90)
    texts = {k: kept for k, (_, gone, kept) in lines.items() if not gone or kept.split()}
    group = {k: c for k, (_, c) in groups(sorted(texts.items()), 5, 80).items()}
    stay = {k: t for k, t in texts.items() if group[k] == k}
    want = {k: t for k, t in stay.items() if not contaminated(spark, path, t)}
    got = {r.doc_id: r.text for r in pipeline.run(spark, path).collect()}
    assert got == want


_MEMO = {}


def contaminated(spark, path, text):
    if "windows" not in _MEMO:
        items = [words(r.text) for r in spark.read.parquet(f"{path}/benchmark.parquet").collect()]
        _MEMO["windows"] = {tuple(w[k : k + 13]) for w in items if w for k in range(max(len(w) - 13, 0) + 1)}
    own, windows = words(text), _MEMO["windows"]
    hit = set()
    for n in {len(w) for w in windows}:
        for k in range(len(own) - n + 1):
            if tuple(own[k : k + n]) in windows:
                hit.update(range(k, k + n))
    return bool(hit) and 20 * len(hit) >= len(own)


def words(text):
    import re

    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_empty_and_null_rows_pass(spark):
    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet")
    rng = random.Random(1)
    some = [r for r in docs.limit(30).collect()]
    odd = [(None, "the theon anding", "en", None, None), (1000, None, "en", "s", 0), (1001, "", None, "s", 0), (some[0].doc_id, some[0].text, "en", "s", 1)]
    rng.shuffle(odd)
    mixed = spark.createDataFrame([tuple(r) for r in some] + odd, docs.schema)
    for table in (mixed, docs.limit(0)):
        seen = table
        for _, stage in pipeline.STAGES:
            out = stage(spark, seen, path)
            rows = out.collect()
            seen = spark.createDataFrame(rows, out.schema)
        assert "ids" in out.columns
    assert rows == []


def test_one_row_of_each_group_stays_and_no_text_is_lost(spark):
    text = {c: " ".join(f"{c}{k}" for k in range(20)) for c in "ab"}
    rows = [(1, "a"), (2, "a"), (2, "b"), (None, "a"), (3, "b"), (3, "b"), (None, "b"), (9, "a")]
    docs = spark.createDataFrame([(k, text[c], n) for n, (k, c) in enumerate(rows)] + [(5, None, 90), (5, None, 91), (6, "", 92), (None, "", 93)], "doc_id long, text string, n long")
    got = pipeline.one_of_each_group(spark, docs, "").collect()
    assert sorted((r.doc_id, r.text[0]) for r in got if r.text) == [(1, "a"), (2, "b")]
    assert sorted(((r.doc_id, r.text) for r in got if not r.text), key=str) == sorted([(5, None), (6, ""), (None, "")], key=str)


def test_columns_of_any_name_pass(spark):
    path = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(40)
    names = ["lang_pred", "score", "accepted", "n_lines", "n_removed", "kept", "was_text", "n_words", "n_hit", "item_ids", "spans", "contaminated", "row", "hash", "component", "component_id", "n_links", "others", "keep0", "id", "n", "found"]
    wide = docs.select("*", *[docs.doc_id.cast("string").alias(c) for c in names])
    for name, stage in pipeline.STAGES:
        out = stage(spark, wide, path)
        rows = out.collect()
        if name != pipeline.STAGES[-1][0]:
            assert out.columns == wide.columns, name
            assert rows and all(r[c] == str(r.doc_id) for r in rows for c in names), name


@pytest.mark.parametrize("name", ["pipeline", *(f"op{n}_" for n in range(1, 14))])
def test_queries_are_registered(name):
    import __spark_entry__ as entry

    assert sum(q.startswith(name) for q in entry.queries()) == 1
