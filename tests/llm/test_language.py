"""Language identification: held-out accuracy and defined cases."""

from zlib import crc32

from brindle.llm.language import fit_languages, identify_languages, subwords


def test_held_out_accuracy(spark):
    from brindle.llm.queries import catalog

    path = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "lang").collect()}
    rows = catalog.plans["op6_language"](spark, path).collect()
    assert len(rows) == len(langs)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.98 * len(held)
    assert sum(r.accepted for r in rows) >= 0.98 * len(rows)


def test_defined_cases(spark):
    known = [(k, ("the theon anding " if k % 2 else "und einlich vergeit ") * 5, "en" if k % 2 else "de") for k in range(60)]
    df = spark.createDataFrame([*known, (None, "the theon", None), (100, None, "en"), (101, "", "de"), (102, "12 ..  ", "de"), (5, known[5][1], "en")], "doc_id long, text string, lang string")
    model = fit_languages(df)
    assert model.labels == ["de", "en"]
    rows = identify_languages(df, model, keep=("lang",)).collect()
    assert len(rows) == 65
    for r in rows:
        if r.doc_id in (100, 101, 102):
            assert (r.lang_pred, r.score, r.accepted) == ("und", 0.0, False)
        else:
            assert r.lang_pred == (r.lang or "en") and r.accepted
    assert identify_languages(df.limit(0), model).count() == 0
    nothing = fit_languages(df.where("lang is null"))
    assert {r.lang_pred for r in identify_languages(df, nothing).collect()} == {"und"}


def test_fit_does_not_depend_on_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    one, two = fit_languages(docs.coalesce(1)), fit_languages(docs.repartition(7))
    assert (one.scores == two.scores).all() and one.threshold == two.threshold


def test_subwords_lie_in_words():
    buckets, offsets = subwords(["ab, cd", "", "..", "é"])
    assert (offsets[1:] - offsets[:-1]).tolist()[1:3] == [0, 0]
    # Words alone and together have the same grams.
    apart, _ = subwords(["ab", "cd"])
    assert sorted(buckets[: offsets[1]].tolist()) == sorted(apart.tolist())


def test_the_sample_is_bounded_where_an_id_repeats(spark):
    from brindle.llm.language import labelled_sample

    rows = [(1, f"text number {k}", "en") for k in range(2000)] + [(k, "autre texte", "fr") for k in range(2, 90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = labelled_sample(docs, "lang", 30, 50, "doc_id", "text")
    assert sample.count() == 50
    assert {r.label for r in sample.collect()} == {"en", "fr"}


def test_predictions_equal_a_plain_evaluation(spark):
    """Every text by itself: mean of its subword scores, softmax, threshold."""
    import numpy as np

    from brindle.llm.arrowtext import pieces
    from brindle.llm.language import fit_languages, identify_languages, subwords
    import pyarrow as pa

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = fit_languages(docs)
    for r in identify_languages(docs, model, keep=("text",)).collect():
        logits, n = np.array(model.bias, float), 0
        cut = pieces(pa.array([r.text or ""], pa.large_string()))
        buckets, offsets = subwords(cut.distinct)
        own = [b for c in cut.codes for b in buckets[offsets[c] : offsets[c + 1]]]
        n = len(own)
        p = model.probabilities((model.scores[own].sum(axis=0) / max(n, 1) + logits)[None, :])[0]
        want = ("und", 0.0, False) if not n else (model.labels[int(p.argmax())], p.max(), p.max() >= model.threshold)
        assert (r.lang_pred, r.accepted) == (want[0], want[2]) and abs(r.score - want[1]) < 1e-6


def test_small_slices_give_the_predictions_of_the_whole():
    import numpy as np
    import pyarrow as pa
    from brindle.llm import language
    from brindle.llm.arrowtext import batch, bounded

    random = np.random.default_rng(3)
    model = language.LanguageModel(["a", "b"], random.normal(size=(language.BUCKETS, 2)), np.zeros(2), 1.0, 0.5)
    texts = pa.array([" ".join(random.choice(["one", "zwei", "tres", "quatre", "7"], 2000).tolist()) for _ in range(400)] + [None, ""])
    slices = [part.column("text") for part in bounded(batch({"text": texts}), language.SLICE_BYTES)]
    assert len(slices) > 2 and max(s.nbytes for s in slices) < 2 << 20
    whole, cut = language._predicted(model, texts).to_pylist(), [r for s in slices for r in language._predicted(model, s).to_pylist()]
    assert [r["lang_pred"] for r in whole] == [r["lang_pred"] for r in cut]
    np.testing.assert_allclose([r["score"] for r in whole], [r["score"] for r in cut], atol=1e-8)
