"""Forecasts over events and class scoring over embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.operators import forecast as fc, scoring
from brindle.plans.base import Catalog, table

catalog = Catalog()


def _series(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")


_OVER = "OVER (PARTITION BY user_id ORDER BY ts, event_id)"
_NAIVE = f"SELECT event_id, round(lag(value) {_OVER}, 6) AS predicted FROM events"


def _predicted(df):
    return df.select("event_id", F.round("predicted", 6).alias("predicted"))


@catalog.add("forecast_last_value", _NAIVE)
def _(spark, sf_dir):
    return _predicted(fc.forecast_by_series(_series(spark, sf_dir), ["user_id"], ["ts", "event_id"], "value", (0, 1, 0)))


@catalog.add("forecast_last_value_indexed", _NAIVE)
def _(spark, sf_dir):
    """The same through positions instead of windows, as for series too long for one task."""
    series = _series(spark, sf_dir)
    return _predicted(fc.forecast_by_series(series, ["user_id"], ["ts", "event_id"], "value", (0, 1, 0), max_series_rows=0))


@catalog.add(
    "forecast_ar1",
    f"""WITH d AS (SELECT event_id, user_id, ts, value, value - lag(value) {_OVER} AS w, lag(value) {_OVER} AS y1 FROM events),
             e AS (SELECT *, lag(w) {_OVER} AS w1 FROM d),
             b AS (SELECT user_id, sum(w * w1) / nullif(sum(w1 * w1), 0) AS phi FROM e WHERE w IS NOT NULL AND w1 IS NOT NULL GROUP BY user_id)
        SELECT event_id, round(phi * w1 + y1, 4) AS predicted FROM e LEFT JOIN b USING (user_id)""",
)
def _(spark, sf_dir):
    fitted = fc.forecast_by_series(_series(spark, sf_dir), ["user_id"], ["ts", "event_id"], "value", (1, 1, 0))
    return fitted.select("event_id", F.round("predicted", 4).alias("predicted"))


@catalog.add("forecast_arima")
def _(spark, sf_dir):
    return _predicted(fc.forecast_by_series(_series(spark, sf_dir), ["user_id"], ["ts", "event_id"], "value", (1, 2, 3)))


@catalog.add(
    "grid_search_differences",
    f"""WITH d AS (SELECT value, lag(value) {_OVER} AS y1, lag(value, 2) {_OVER} AS y2, lag(value, 3) {_OVER} AS y3 FROM events)
        SELECT 0::INTEGER AS p, 1::INTEGER AS d, 0::INTEGER AS q, round(sqrt(avg(pow(y1 - value, 2))), 6) AS rmse FROM d
        UNION ALL SELECT 0, 2, 0, round(sqrt(avg(pow(2 * y1 - y2 - value, 2))), 6) FROM d
        UNION ALL SELECT 0, 3, 0, round(sqrt(avg(pow(3 * y1 - 3 * y2 + y3 - value, 2))), 6) FROM d""",
)
def _(spark, sf_dir):
    space = {"p": (0,), "d": (1, 2, 3), "q": (0,)}
    scores = fc.grid_search(_series(spark, sf_dir), ["user_id"], ["ts", "event_id"], "value", space)[1]
    return scores.withColumn("rmse", F.round("rmse", 6))


@catalog.add("grid_search")
def _(spark, sf_dir):
    return fc.grid_search(_series(spark, sf_dir), ["user_id"], ["ts", "event_id"], "value")[0]


_SENSORS = [f"sensor{i + 1}" for i in range(64)]


def _features(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    sensors = [F.col("embedding")[i].alias(name) for i, name in enumerate(_SENSORS)]
    return vectors.select("vec_id", *sensors, F.concat(F.lit("class"), "label").alias("result"))


@catalog.add("train_classifier")
def _(spark, sf_dir):
    """Held-out accuracy of boosted trees."""
    model, held_out = scoring.train_classifier(_features(spark, sf_dir), _SENSORS, "result", key="vec_id")
    top = scoring.score_topn(held_out, model, 1)
    return top.agg(F.count(F.lit(1)).alias("rows"), F.avg((F.col("result") == F.col("predicted_class_1")).cast("int")).alias("accuracy"))


@catalog.add("score_topn")
def _(spark, sf_dir):
    features = _features(spark, sf_dir)
    model, _ = scoring.train_classifier(features, _SENSORS, "result", key="vec_id", kind="logistic", maxIter=100)
    return scoring.score_topn(features, model, 3)


@catalog.add("score_topn_boosted")
def _(spark, sf_dir):
    features = _features(spark, sf_dir)
    model, _ = scoring.train_classifier(features, _SENSORS, "result", key="vec_id")
    return scoring.score_topn(features, model, 3)
