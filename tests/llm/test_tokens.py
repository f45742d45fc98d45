"""Token counts, token files and sampled pieces against their libraries and brute force."""

import itertools
import math
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from brindle.llm import token_files
from brindle.llm.arrowtext import pieces, sums
from brindle.llm.sampled_pieces import decode_sampled, encode_sampled, piece_model, sample_texts
from brindle.llm.token_counts import count_tokens, merge_table, text_counts
from brindle.llm.token_files import WaveletMatrix, read_token_files, write_token_files

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

ODD = [
    "",
    " ",
    "   ",
    "a",
    " a  b   c ",
    "a \n b\n\n  c \t d",
    "don't we'll I'M x's  's",
    "<|endoftext|>",
    "a <|endoftext|> b<|endoftext|><|endoftext|>  c",
    "<|endoftext",
    "aaaaaaaaaaaaaaaaaaaaaaa" * 40,
    "ababababa" * 30,
    "über 123456 ½ ²³ 漢字かな 한국어 🙂🙂 é",
    " x y　 z\u0085\x1c\x1d w",
    "\x00\x01\x7f",
    "▁ ▁▁ a▁b",
    "tabs\t\tand\r\nlines\r\n\r\n",
    "word." * 200 + "\n",
]
TEXTS = st.lists(st.sampled_from([" ", "  ", "\n", "\t", "a", "B", "é", "漢", "1", ".", "'s", "the", "ing", "🙂", "▁", "　", "<|endoftext|>"]), max_size=30).map("".join)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE)


def counted(texts):
    return text_counts(merge_table(BPE), pa.array(texts, pa.large_string())).tolist()


def test_counts_of_odd_texts(library):
    assert counted(ODD) == [len(library.encode(t, add_special_tokens=False).ids) for t in ODD]


def test_counts_of_all_characters(library):
    letters = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts = ["x" + "".join(f"{c}y {c} {c}{c}1" for c in letters[k : k + 64]) for k in range(0, len(letters), 64)]
    assert counted(texts) == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS | st.text(max_size=20), min_size=1, max_size=4))
def test_counts_and_pieces_of_any_text(texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BPE)
    assert counted(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    cut = pieces(pa.array(texts, pa.large_string()))
    for k, text in enumerate(texts):
        assert "".join(cut.distinct[c] for c in cut.codes[cut.offsets[k] : cut.offsets[k + 1]]) == text


def test_count_rows(spark):
    df = spark.createDataFrame([(1, "a b", 7), (1, "a b", 7), (None, None, 7), (2, "x " * 600, 7)], "doc_id long, text string, n_tokens int")
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(df, BPE).collect())
    assert got == [("1", 3, 2, False), ("1", 3, 2, False), ("2", 1200, 601, True), ("None", 0, 0, False)]
    assert count_tokens(df.limit(0), BPE).count() == 0


@pytest.mark.parametrize("n,symbols", [(0, 1), (1, 1), (5, 1), (1000, 2), (70_000, 300), (3000, 3000)])
def test_wavelet_queries(n, symbols):
    ids = (np.random.default_rng(n).zipf(1.3, n) % symbols * 7 + 3).astype(np.uint32)
    shard = WaveletMatrix(WaveletMatrix.build(ids))
    assert shard.decode().tolist() == ids.tolist()
    for at in range(0, n, max(1, n // 20)):
        assert shard.access(at) == ids[at]
    for token in [*np.unique(ids)[:5].tolist(), 1, 10**6]:
        where = np.flatnonzero(ids == token)
        assert shard.count(token) == len(where)
        assert shard.count(token, n // 3, n // 2) == ((where >= n // 3) & (where < n // 2)).sum()
        for nth in range(0, len(where), max(1, len(where) // 5)):
            assert shard.select(token, nth) == where[nth]
        with pytest.raises(IndexError):
            shard.select(token, len(where))
    with pytest.raises(IndexError):
        shard.access(n)


def test_token_files_round_trip(spark, tmp_path, library, monkeypatch):
    monkeypatch.setattr(token_files, "MEMO_PIECES", 3)
    rows = [(k * 3 % 101, t) for k, t in enumerate(ODD * 5)] + [(200, None), (None, "first"), (300, ODD[3]), (300, ODD[3])]
    df = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, start int").repartition(4)
    write_token_files(df, str(tmp_path / "files"), BPE, partitions=7, shard_tokens=50)
    got = read_token_files(spark, str(tmp_path / "files")).collect()
    ids = {}
    for k, t in rows:
        ids.setdefault(k, []).append(library.encode(t or "", add_special_tokens=False).ids + [2])
    place = 0
    for r in sorted(got, key=lambda r: r.start):
        own = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == place and r.n_tokens == len(own)
        ids[r.doc_id].remove(own)
        place += len(own)
    assert not any(ids.values())
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda k: (k is not None, k))
    write_token_files(df.limit(0), str(tmp_path / "none"), BPE)
    assert read_token_files(spark, str(tmp_path / "none")).count() == 0


def test_sampled_pieces_decode_to_the_text(spark):
    import sentencepiece

    texts = [*ODD, None, "▁▁ x ￿\U0010ffff"]
    df = spark.createDataFrame(list(enumerate(texts)) + [(None, "ab cd")], "doc_id long, text string")
    encoded = encode_sampled(df.repartition(3), PIECES, seed=5)
    rows = {r.doc_id: r for r in decode_sampled(encoded, PIECES, keep=("ids",)).collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for k, text in [*enumerate(texts), (None, "ab cd")]:
        assert rows[k].text == (text or "")
        assert library.decode(rows[k].ids) == (text or "")
    # The segmentation belongs to the row, not to its partition; another seed gives another one.
    again = {r.doc_id: r.ids for r in encode_sampled(df.coalesce(1), PIECES, seed=5).collect()}
    assert again == {k: r.ids for k, r in rows.items()}
    assert {r.doc_id: r.ids for r in encode_sampled(df, PIECES, seed=6).collect()} != again
    assert encode_sampled(df.limit(0), PIECES).count() == 0


def segmentations(model, text):
    known = {model.processor.id_to_piece(k): k for k in range(model.processor.get_piece_size())}
    found = {}
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        parts, at = [], 0
        for k, cut in enumerate([*cuts, 1]):
            if cut:
                parts.append(text[at : k + 1])
                at = k + 1
        if all(p in known for p in parts):
            ids = tuple(known[p] for p in parts)
            found[ids] = math.exp(sum(model.weights[k] for k in ids))
    total = sum(found.values())
    return {ids: w / total for ids, w in found.items()}


def test_samples_follow_the_lattice():
    model = piece_model(PIECES)
    n = 40_000
    texts = pa.array(["there"] * n, pa.large_string())
    ids, lengths = sample_texts(model, texts, np.arange(n, dtype=np.uint64) * np.uint64(7919), 1.0)
    ends = np.cumsum(lengths)
    seen = Counter(tuple(ids[a:b].tolist()) for a, b in zip(ends - lengths, ends))
    want = segmentations(model, "▁there")
    assert set(seen) <= set(want)
    for segmentation, p in want.items():
        assert abs(seen[segmentation] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


def test_sums_of_empty_ranges():
    assert sums(np.array([1, 2, 3]), np.array([0, 0, 2, 3, 3])).tolist() == [0, 3, 3, 0]
