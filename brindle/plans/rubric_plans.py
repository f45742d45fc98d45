"""Judgements and scores over documents, with the rule-based judge."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.operators import rubric as r
from brindle.plans.base import Catalog, table

catalog = Catalog()

_WORDS = ["the", "de", "und"]
_QUESTIONS = [f"Does the text contain: {w}" for w in _WORDS]
_JUDGED = """
SELECT doc_id, source, lang, text, q.i::INTEGER AS question_id, 'Does the text contain: ' || q.w AS assessment_question,
       CASE WHEN contains(lower(text), q.w) THEN 'Yes' ELSE 'No' END AS assessment_answer
FROM documents, (VALUES (0, 'the'), (1, 'de'), (2, 'und')) q(i, w)
"""
_YES = "sum(CASE WHEN assessment_answer = 'Yes' THEN 1 ELSE 0 END)"


def _judged(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", spread=True).select("doc_id", "source", "lang", "text")
    return r.judge(docs, _QUESTIONS, "text")


@catalog.add("judge", f"SELECT doc_id, question_id, assessment_question, assessment_answer FROM ({_JUDGED})")
def _(spark, sf_dir):
    return _judged(spark, sf_dir).select("doc_id", "question_id", "assessment_question", "assessment_answer")


@catalog.add("rubric_score", f"SELECT doc_id, round({_YES} / 3.0, 6)::DOUBLE AS score FROM ({_JUDGED}) GROUP BY doc_id")
def _(spark, sf_dir):
    return r.rubric_score(_judged(spark, sf_dir), ["doc_id"]).withColumn("score", F.round("score", 6))


@catalog.add(
    "rubric_score_titled",
    f"""SELECT doc_id, round(({_YES} + max(CASE WHEN length(source) < 5 THEN 1 ELSE 0 END)) / 4.0, 6)::DOUBLE AS score
        FROM ({_JUDGED}) GROUP BY doc_id""",
)
def _(spark, sf_dir):
    return r.rubric_score(_judged(spark, sf_dir), ["doc_id"], title="source", short_title=5).withColumn("score", F.round("score", 6))


@catalog.add(
    "rubric_score_per_part",
    f"""SELECT source, round({_YES}::DOUBLE / count(DISTINCT doc_id), 6) AS score FROM ({_JUDGED}) GROUP BY source""",
)
def _(spark, sf_dir):
    return r.rubric_score(_judged(spark, sf_dir), ["source"], per_part="doc_id").withColumn("score", F.round("score", 6))


_RESPONSES = f"""
SELECT doc_id, lang AS run, source, ({_YES} + greatest((600 - max(length(text))) / 200.0, 0)) / 6.0::DOUBLE AS score
FROM ({_JUDGED}) GROUP BY doc_id, lang, source
"""


def _responses(spark, sf_dir):
    scored = r.response_score(_judged(spark, sf_dir), ["doc_id", "lang", "source"], "text")
    return scored.withColumnRenamed("lang", "run")


@catalog.add("response_score", f"SELECT doc_id, round(score, 6) AS score, score > 0.5 AS passes FROM ({_RESPONSES})")
def _(spark, sf_dir):
    return _responses(spark, sf_dir).select("doc_id", F.round("score", 6).alias("score"), "passes")


@catalog.add(
    "length_reward",
    "SELECT conv_id, turn, round(greatest((600 - length(text)) / 200.0::DOUBLE, 0), 6) AS reward FROM conversations",
)
def _(spark, sf_dir):
    reward = F.round(r.length_reward(F.length("text")), 6)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", reward.alias("reward"))


@catalog.add("evaluate_run", f"SELECT run, round(avg(score), 6) AS mean_score, count(*) AS examples FROM ({_RESPONSES}) GROUP BY run")
def _(spark, sf_dir):
    return r.evaluate_run(_responses(spark, sf_dir)).withColumn("mean_score", F.round("mean_score", 6))


@catalog.add(
    "improvement",
    f"""SELECT round(b, 6) AS baseline_score, round(c, 6) AS candidate_score, round((c / b - 1) * 100, 6) AS improvement_percent
        FROM (SELECT avg(score) FILTER (run = 'en') AS b, avg(score) FILTER (run = 'de') AS c FROM ({_RESPONSES}))""",
)
def _(spark, sf_dir):
    gain = r.improvement(_responses(spark, sf_dir), "en", "de")
    return gain.select(*[F.round(c, 6).alias(c) for c in gain.columns])


@catalog.add(
    "judge_metrics",
    """SELECT metric, round(avg(CASE WHEN rating = 'yes' THEN 1.0 ELSE 0.0 END), 6)::DOUBLE AS yes_share, count(*) AS rated FROM (
         SELECT 'quality' AS metric, CASE WHEN quality = 1 THEN 'yes' ELSE 'no' END AS rating FROM labels
         UNION ALL SELECT 'safety', CASE WHEN toxic = 0 THEN 'yes' ELSE 'no' END FROM labels) GROUP BY metric""",
)
def _(spark, sf_dir):
    yes = lambda c: F.when(c, "yes").otherwise("no")
    rated = table(spark, sf_dir, "labels").select(yes(F.col("quality") == 1).alias("quality"), yes(F.col("toxic") == 0).alias("safety"))
    return r.judge_metrics(rated, ["quality", "safety"]).withColumn("yes_share", F.round("yes_share", 6))


@catalog.add(
    "score_against_gold",
    """SELECT doc_id, (quality = 1) = (lang = 'en') AS agrees, n_chars - quality AS gap FROM documents JOIN labels USING (doc_id)""",
)
def _(spark, sf_dir):
    predicted = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    gold = table(spark, sf_dir, "labels").select("doc_id", "quality")
    scores = {"agrees": (F.col("quality") == 1) == (F.col("lang") == "en"), "gap": F.col("n_chars") - F.col("quality")}
    return r.score_against_gold(predicted, gold, scores, "doc_id")


@catalog.add(
    "select_demos",
    f"""WITH scored AS ({_RESPONSES}), boot AS (SELECT doc_id FROM scored WHERE score > 0.5 ORDER BY doc_id LIMIT 1),
             labeled AS (SELECT doc_id FROM scored WHERE doc_id NOT IN (SELECT doc_id FROM boot) ORDER BY doc_id LIMIT 2)
        SELECT doc_id, 'bootstrapped' AS kind FROM boot UNION ALL SELECT doc_id, 'labeled' FROM labeled""",
)
def _(spark, sf_dir):
    return r.select_demos(_responses(spark, sf_dir), "doc_id").select("doc_id", "kind")
