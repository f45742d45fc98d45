"""Yes/no judgements to scores, and the comparison of runs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from brindle.functions.text import says_yes
from brindle.session import settle

Judge = Callable[[Sequence[str], Sequence[str]], Sequence[str]]


def keyword_judge(texts: Sequence[str], questions: Sequence[str]) -> list[str]:
    """Offline default: "Yes" when the text holds what follows the question's last colon."""
    wanted = [q.rpartition(":")[2].strip().lower() for q in questions]
    return ["Yes" if w in t.lower() else "No" for t, w in zip(texts, wanted)]


def judge(
    df: DataFrame,
    questions: Sequence[str | Column],
    text: str,
    judge: Judge = keyword_judge,
) -> DataFrame:
    """One row per example and question: ``question_id, assessment_question, assessment_answer``.

    A question may be a column, when it quotes a gold text of the row. The rubric is a literal
    array of the row: no join, and a text crosses to Python once for all its questions.
    """
    asked = F.array(*[F.lit(q) if isinstance(q, str) else q for q in questions])

    @F.pandas_udf("array<string>")
    def answer(texts: pd.Series, asked: pd.Series) -> pd.Series:
        pairs = [(i, j, t, q) for i, (t, qs) in enumerate(zip(texts, asked)) for j, q in enumerate(qs) if t is not None and q is not None]
        answers: list[list[str | None]] = [[None] * len(qs) for qs in asked]
        replies = judge([t for *_, t, _ in pairs], [q for *_, q in pairs]) if pairs else []
        for (i, j, *_), reply in zip(pairs, replies):
            answers[i][j] = reply
        return pd.Series(answers, index=texts.index)

    answered = df.select("*", asked.alias("__asked")).withColumn("__answers", answer.asNondeterministic()(text, "__asked"))
    both = F.arrays_zip(F.col("__asked").alias("q"), F.col("__answers").alias("a"))
    rows = answered.select(*df.columns, F.posexplode(both).alias("question_id", "__pair"))
    return rows.select(
        *df.columns, "question_id", F.col("__pair.q").alias("assessment_question"), F.col("__pair.a").alias("assessment_answer")
    )


def rubric_score(
    judgements: DataFrame,
    keys: Sequence[str],
    title: str | None = None,
    short_title: int = 50,
    per_part: str | None = None,
) -> DataFrame:
    """``score`` per example: yes answers over questions.

    With ``title``, a title below ``short_title`` characters earns a point and the maximum grows by
    one. With ``per_part`` (say a paragraph id) the sum of yes answers is divided by the number of
    parts instead of the number of questions.
    """
    yes = F.sum(says_yes(F.col("assessment_answer")))
    if per_part is not None:
        return judgements.groupBy(*keys).agg(F.try_divide(yes, F.count_distinct(per_part)).alias("score"))
    if title is None:
        return judgements.groupBy(*keys).agg(F.try_divide(yes, F.count(F.lit(1))).alias("score"))
    bonus = F.max((F.length(title) < short_title).cast("int"))
    return judgements.groupBy(*keys).agg(
        F.try_divide(yes + F.coalesce(bonus, F.lit(0)), F.count(F.lit(1)) + 1).alias("score")
    )


def length_reward(length: Column, target: int = 600, most: float = 3) -> Column:
    """``most`` points for an empty answer, falling to 0 at ``target`` characters."""
    return F.greatest((F.lit(target) - length) / F.lit(target / most), F.lit(0.0))


def response_score(judgements: DataFrame, keys: Sequence[str], text: str, target: int = 600, most: float = 3) -> DataFrame:
    """``score`` of yes answers plus length reward over the possible total, and ``passes`` above one half."""
    scored = judgements.groupBy(*keys).agg(
        F.sum(says_yes(F.col("assessment_answer"))).alias("yes"),
        F.count(F.lit(1)).alias("questions"),
        F.max(F.length(text)).alias("length"),
    )
    score = (F.col("yes") + length_reward(F.col("length"), target, most)) / (F.col("questions") + F.lit(most))
    return scored.select(*keys, score.alias("score")).withColumn("passes", F.col("score") > 0.5)


def evaluate_run(scored: DataFrame, run: str = "run", score: str = "score") -> DataFrame:
    """Mean score per run."""
    return scored.groupBy(run).agg(F.avg(score).alias("mean_score"), F.count(F.lit(1)).alias("examples"))


def improvement(scored: DataFrame, baseline: str, candidate: str, run: str = "run", score: str = "score") -> DataFrame:
    """Mean scores of two runs and the candidate's gain in percent."""
    means = scored.filter(F.col(run).isin(baseline, candidate)).agg(
        F.avg(F.when(F.col(run) == baseline, F.col(score))).alias("baseline_score"),
        F.avg(F.when(F.col(run) == candidate, F.col(score))).alias("candidate_score"),
    )
    gain = (F.try_divide("candidate_score", "baseline_score") - 1) * 100
    return means.withColumn("improvement_percent", gain)


def judge_metrics(evaluated: DataFrame, ratings: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Share of "yes" per rating column: ``metric, yes_share, rated``. Unrated rows do not count."""
    long = evaluated.select(*keys, *ratings).unpivot(list(keys), list(ratings), "metric", "rating")
    share = F.avg((F.lower("rating") == "yes").cast("int"))
    return long.groupBy(*keys, "metric").agg(share.alias("yes_share"), F.count("rating").alias("rated"))


def score_against_gold(predicted: DataFrame, gold: DataFrame, scores: Mapping[str, Column], on: str = "example_id") -> DataFrame:
    """Join predictions with gold rows and compute ``scores`` from the columns of both."""
    return predicted.join(gold, on).select(on, *[c.alias(name) for name, c in scores.items()])


def select_demos(
    scored: DataFrame, order: str, n_boot: int = 1, n_labeled: int = 3, threshold: float = 0.5, score: str = "score"
) -> DataFrame:
    """Few-shot examples: up to ``n_boot`` that pass, the rest of ``n_labeled`` from the others.

    ``order`` identifies the rows and decides which come first.
    """
    scored = settle(scored, "scored")  # read twice; a model's scores must not change in between
    passing = scored.filter(F.col(score) > threshold).orderBy(order).limit(n_boot).withColumn("kind", F.lit("bootstrapped"))
    labeled = scored.join(passing.select(order), order, "left_anti").orderBy(order).limit(n_labeled)
    both = passing.unionByName(labeled.withColumn("kind", F.lit("labeled")))
    return both.orderBy(F.col("kind"), order).limit(max(n_boot, n_labeled))

