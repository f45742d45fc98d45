"""Multi-class training and top-N class scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from brindle.operators.boosting import BoostedTrees, fit_boosted_trees
from brindle.operators.ranking import topn_classes


def train_classifier(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    test: float = 0.3,
    seed: int = 42,
    kind: str = "boosted",
    key: str | None = None,
    **settings,
) -> tuple[PipelineModel | BoostedTrees, DataFrame]:
    """``(model, test rows)`` of a multi-class fit on a split by a hash of ``key`` (default: of the
    features), so that it depends on the rows alone and not on their partitions.

    ``kind`` is ``boosted`` (:func:`brindle.operators.boosting.fit_boosted_trees`), ``forest`` or
    ``logistic`` (multinomial, both of Spark ML); each gives a probability per class.
    """
    own = [F.col(key).cast("string")] if key else [F.col(c).cast("string") for c in features]
    part = F.pmod(F.crc32(F.concat_ws(",", F.lit(str(seed)), *own).cast("binary")), F.lit(1000))
    columns = [*([key] if key else []), *features, label]
    train, held_out = (df.where(side).select(*columns) for side in (part >= round(1000 * test), part < round(1000 * test)))
    if kind == "boosted":
        return fit_boosted_trees(train, features, label, **settings), held_out
    if kind == "forest":
        fit = RandomForestClassifier(seed=seed, labelCol="__label", featuresCol="__features", **settings)
    elif kind == "logistic":
        fit = LogisticRegression(family="multinomial", labelCol="__label", featuresCol="__features", **settings)
    else:
        raise ValueError(f"kind must be 'boosted', 'forest' or 'logistic', not {kind!r}")
    stages = [
        StringIndexer(inputCol=label, outputCol="__label", stringOrderType="alphabetAsc"),
        VectorAssembler(inputCols=list(features), outputCol="__features"),
        fit.setProbabilityCol("__probability").setRawPredictionCol("__raw").setPredictionCol("__prediction"),
    ]
    return Pipeline(stages=stages).fit(train), held_out


def score_topn(df: DataFrame, model: PipelineModel | BoostedTrees, n: int = 3) -> DataFrame:
    """All columns plus the n most probable classes; for models of Spark ML without a Python stage."""
    if isinstance(model, BoostedTrees):
        return topn_classes(model.add_probabilities(df, "__p"), "__p", model.labels, n).drop("__p")
    indexer, *rest = model.stages
    scored = df
    for stage in rest:
        scored = stage.transform(scored)
    scored = scored.select(*df.columns, vector_to_array("__probability").alias("__p"))
    return topn_classes(scored, "__p", indexer.labels, n).drop("__p")
