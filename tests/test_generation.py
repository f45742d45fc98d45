import pytest
from pyspark.sql import functions as F

from brindle.operators import generation as gen, rubric as r


def test_failures_stay_in_their_row(spark):
    def picky(prompts):
        if any(p == "bad" for p in prompts):
            raise ValueError("no")
        return [p.upper() for p in prompts]

    df = spark.createDataFrame([("a",), ("bad",), (None,), ("b",)], "p string").coalesce(1)
    got = {x.p: (x.completion, x.error) for x in gen.generate_batch(df, "p", picky).collect()}
    assert got["a"] == ("A", None) and got["b"] == ("B", None) and got[None] == (None, None)
    assert got["bad"] == (None, "ValueError: no")


def test_retry_until_accepted(spark):
    import itertools

    def flaky():
        counter = itertools.count()
        return lambda prompts: [f"{p}{next(counter)}" for p in prompts]

    df = spark.createDataFrame([("x",)], "p string")
    done = gen.generate_batch(df, "p", flaky(), retries=5, accept=lambda t: t.endswith("3"))
    assert done.first().completion == "x3"


def test_calls_are_not_repeated(spark):
    calls = spark.sparkContext.accumulator(0)

    def counting(prompts):
        calls.add(len(prompts))
        return list(prompts)

    df = spark.range(30).select(F.col("id").cast("string").alias("p"))
    done = gen.generate_batch(df, "p", counting, concurrency=3).filter("completion IS NOT NULL AND error IS NULL")
    assert done.select("completion", "error").count() == 30
    assert calls.value == 30


def test_drafts(spark):
    df = spark.createDataFrame([(1, "topic"), (2, "none")], "article_id int, abstract string")

    def outliner(prompts):
        return ["1. First section 1a. tiny 2. Second section 3. Third section" if "topic" in p else "" for p in prompts]

    writer = lambda prompts: ["paragraph for " + p[len("Write a paragraph on "):].split(" for:")[0] for p in prompts]
    drafts = gen.draft_articles(df, outliner, writer, coder=lambda ps: [f"code {len(p)}" for p in ps])
    got = {x.article_id: x for x in drafts.collect()}
    assert got[1].paragraphs == [f"paragraph for {s} section" for s in ("First", "Second", "Third")]
    assert len(got[1].code_examples) == 1
    assert got[2].paragraphs == [] and got[2].code_examples == []


def test_refine_keeps_the_last_call(spark):
    df = spark.createDataFrame([("s", "a", "ctx")], "section string, abstract string, context string")
    seen = lambda prompts: ["with" if p.endswith("Context: ctx") else "without" for p in prompts]
    assert gen.refine(df, seen, 2).first().paragraph == "with"
    assert gen.refine(df, seen, 0).first().paragraph == "without"


def test_corpus_does_not_leak_categories(spark):
    domains = spark.createDataFrame([("notes",)], "domain string")

    def model(prompts):
        out = []
        for p in prompts:
            if p.startswith("Name category"):
                out.append(f"Fuel: kind{'abc'[int(p.split()[3]) % 3]}!")
            elif p.startswith("Name issue"):
                out.append("leak " + "abcdefghijkl"[int(p.split()[3]) - 1])
            else:
                out.append("Report: " + p.rpartition("naming ")[2] + " leaks")
        return out

    rows = gen.synth_corpus(domains, model, n_categories=6).collect()
    categories = {x.category for x in rows}
    assert categories == {"Fuel kinda", "Fuel kindb", "Fuel kindc"}
    assert all(7 <= sum(x.category == c for x in rows) <= 12 for c in categories)
    assert all("fuel kind" not in x.issue_description and ":" not in x.issue_description for x in rows)


# Rubric


@pytest.fixture
def judged(spark):
    rows = [("e1", "t" * 10, "YES, it does"), ("e1", "t" * 10, "no"), ("e2", "t" * 60, "yes"), ("e2", "t" * 60, None)]
    return spark.createDataFrame(rows, "example_id string, title string, assessment_answer string")


def scores(df):
    return {x.example_id: x.score for x in df.collect()}


def test_rubric_variants(judged):
    assert scores(r.rubric_score(judged, ["example_id"])) == {"e1": 0.5, "e2": 0.5}
    titled = scores(r.rubric_score(judged, ["example_id"], title="title"))
    assert titled == pytest.approx({"e1": 2 / 3, "e2": 1 / 3})


def test_length_reward_and_pass_mark(spark, judged):
    df = spark.createDataFrame([(0,), (300,), (600,), (900,)], "n int")
    assert [x[0] for x in df.select(r.length_reward(F.col("n"))).collect()] == [3.0, 1.5, 0.0, 0.0]
    got = {x.example_id: x for x in r.response_score(judged, ["example_id"], "title").collect()}
    assert got["e1"].score == pytest.approx((1 + 590 / 200) / 5) and got["e1"].passes


def test_improvement_and_empty_baseline(spark):
    df = spark.createDataFrame([("a", 0.5), ("a", 0.7), ("b", 0.9)], "run string, score double")
    assert r.improvement(df, "a", "b").first().improvement_percent == pytest.approx(50)
    assert r.improvement(df, "none", "b").first().improvement_percent is None


def test_gold_quotes_in_questions(spark):
    df = spark.createDataFrame([("a", "the cat", "Cat"), ("b", "the cat", "dog")], "id string, text string, gold string")
    rows = r.judge(df, [F.concat(F.lit("similar to: "), "gold")], "text").collect()
    assert {x.id: x.assessment_answer for x in rows} == {"a": "Yes", "b": "No"}


def test_demos_fill_up(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate([0.1, 0.9, 0.8, 0.2, 0.3])], "id int, score double")
    got = sorted((x.kind, x.id) for x in r.select_demos(df, "id").collect())
    assert got == [("bootstrapped", 1), ("labeled", 0), ("labeled", 2)]
    none = df.withColumn("score", F.lit(0.0))
    assert sorted(x.id for x in r.select_demos(none, "id").collect()) == [0, 1, 2]
