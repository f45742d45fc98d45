import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from brindle.functions import text as tx
from brindle.functions.splitting import CODE_BREAK, packed_spans, split_code, split_document, whitespace_tokens

RELAXED = dict(deadline=None, suppress_health_check=list(HealthCheck))


def value(spark, column, *rows):
    df = spark.createDataFrame([(r,) for r in rows], "x string")
    return [r[0] for r in df.select(column).collect()]


def test_outline(spark):
    col = F.col("x")
    sample = "1. Intro 1a. Foo 2. Bar"
    assert value(spark, tx.parse_outline(col), sample) == [["Intro", "Foo", "Bar"]]
    assert value(spark, tx.parse_outline(col, prefix="a. "), sample) == [["a. Intro", "a. Foo", "a. Bar"]]
    assert value(spark, tx.parse_outline(col, min_len=3), sample) == [["Intro"]]
    assert value(spark, tx.parse_outline(col), "", " \n\t") == [[], []]


def test_body_paragraphs(spark):
    text = "first line is dropped\nshort\na long enough paragraph\nlast line is dropped"
    assert value(spark, tx.body_paragraphs(F.col("x")), text, "one", "one\ntwo") == [["a long enough paragraph"], [], []]


def test_label_leak_with_pattern_characters(spark):
    df = spark.createDataFrame([("Belt (old): the belt (OLD) slips", "Belt (old)")], "t string, l string")
    assert df.select(tx.scrub_label_leak(F.col("t"), F.col("l"))).first()[0] == " the  slips"


def test_short_ids_are_stable(spark):
    first = value(spark, tx.short_id(F.col("x")), "a", "b")
    assert first == value(spark, tx.short_id(F.col("x")), "a", "b") and all(re.fullmatch("[0-9a-f]{7}", i) for i in first)
    assert first != value(spark, tx.short_id(F.col("x"), seed=1), "a", "b")


def test_comments(spark):
    code = "a/* x\ny */b // c\nd/**/e"
    assert value(spark, tx.strip_c_comments(F.col("x")), code) == ["ab \nde"]


def strip_until_stable(text):
    pattern = r"<tool_call>[\s\S]*?</tool_call>|<tool_call_result>[\s\S]*?</tool_call_result>"
    while (after := re.sub(pattern, "", text)) != text:
        text = after
    return text.strip(tx.WHITESPACE)


@settings(max_examples=15, **RELAXED)
@given(st.lists(st.lists(st.sampled_from(["<tool_call>", "</tool_call>", "<tool_", "call>", "<tool_call_result>", "</tool_call_result>", "a", "\n", " "]), max_size=14), min_size=1, max_size=30))
def test_tool_calls_until_stable(spark, pieces):
    texts = ["".join(p) for p in pieces]
    got = value(spark, tx.strip_tool_calls(F.col("x")), *texts)
    assert got == [strip_until_stable(t) for t in texts]
    assert value(spark, tx.strip_tool_calls(F.col("x")), *got) == got


def test_prompts_and_messages(spark):
    prompt = tx.render_prompt("{x} and {x}{y}!", {"x": F.col("x"), "y": F.lit("z")})
    assert value(spark, prompt, "a") == ["a and az!"]
    with pytest.raises(KeyError):
        tx.render_prompt("{missing}", {})
    df = spark.createDataFrame([([("user", "a"), ("user", "b")],), ([],)], "m array<struct<role: string, content: string>>")
    rows = df.select(tx.last_content(F.col("m")).alias("last"), tx.history(F.col("m")).alias("before")).collect()
    assert [(r.last, [m.content for m in r.before]) for r in rows] == [("b", ["a"]), (None, [])]
    context = df.select(tx.format_context(F.transform("m", lambda m: m["content"])))
    assert [r[0] for r in context.collect()] == ["`a``b`", ""]


# Splitting


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), min_size=1, max_size=40), st.integers(1, 60), st.data())
def test_spans_cover_everything_in_order(lengths, size, data):
    overlap = data.draw(st.integers(0, size))
    spans = packed_spans(lengths, size, overlap)
    assert spans[0][0] == 0 and spans[-1][1] == len(lengths)
    for start, stop in spans:
        assert sum(lengths[start:stop]) <= size or stop - start == 1
    for (_, before), (start, stop) in zip(spans, spans[1:]):
        assert start <= before < stop
        assert sum(lengths[start:before]) <= overlap
        # One more piece in front would not have been allowed.
        if start > 0 and start - 1 >= 0:
            longer = sum(lengths[start - 1 : before])
            assert longer > overlap or longer + lengths[before] > size


def greedy_reference(pieces, size, overlap):
    chunks, current = [], []
    total = lambda: sum(whitespace_tokens(p) for p in current)
    for piece in pieces:
        n = whitespace_tokens(piece)
        if current and total() + n > size:
            chunks.append("\n\n".join(current))
            while total() > overlap or (total() > 0 and total() + n > size):
                current.pop(0)
        current.append(piece)
    return chunks + ["\n\n".join(current)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=30), st.integers(1, 20), st.integers(0, 20))
def test_documents_are_packed_greedily(counts, size, overlap):
    overlap = min(size, overlap)
    pieces = [" ".join(f"w{i}" for _ in range(n)) for i, n in enumerate(counts)]
    assert split_document("\n\n".join(pieces), size, overlap) == greedy_reference(pieces, size, overlap)


def test_empty_documents():
    assert split_document("") == [] and split_document(" \n\n ") == [] and split_code("") == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["int f(int a) {", "x = 1;", "\n", "\n\n", "}", "long line of code "]), max_size=60), st.integers(5, 60), st.integers(0, 20))
def test_code_chunks(parts, size, overlap):
    text = "".join(parts)
    chunks = split_code(text, size, overlap)
    segments = [s for s in re.split(f"({CODE_BREAK.pattern})", text) if s]
    want, current = [], ""
    for segment in segments:
        if current and len(current) + len(segment) > size:
            want.append(current)
            current = (current[-overlap:] if overlap else "") + segment
        else:
            current += segment
    assert chunks == want + ([current] if current else [])


def test_texts_are_cut_in_bounded_slices(spark):
    import pyarrow as pa
    from brindle.operators import chunking

    texts = pa.array(["a" * 10, None, "b" * 25, "", "c" * 3])
    cut = [s.to_pylist() for s in chunking.text_slices(texts, 12)]
    assert [t for s in cut for t in s] == texts.to_pylist() and len(cut) == 3
    assert [s.to_pylist() for s in chunking.text_slices(pa.array([], pa.string()), 12)] == []
    df = spark.createDataFrame([(k, "\n".join(["w " * 150] * 5) if k % 3 else None) for k in range(9)], "k int, text string").coalesce(1)
    whole = {(r.k, r.text_chunk) for r in chunking.chunk_documents(df, "text", separator="\n").collect()}
    assert {k for k, _ in whole} == {1, 2, 4, 5, 7, 8} and all(len(t.split()) <= 300 for _, t in whole)
