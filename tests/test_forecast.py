import numpy as np
import pytest
from pyspark.sql import functions as F

from brindle.operators import forecast as fc


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(2)
    rows = []
    for name, n in (("long", 400), ("short", 40), ("tiny", 3)):
        x = np.cumsum(rng.normal(size=n)) + 5
        rows += [(name, i, float(v)) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "s string, t int, v double").repartition(6)


def two_rounds(x, p, d, q):
    """The same scheme with numpy on one series."""
    w = [np.array(x)]
    for _ in range(d):
        w.append(np.concatenate([[np.nan], w[-1][1:] - w[-1][:-1]]))
    z, n = w[d], len(x)
    lag = lambda a, i: np.concatenate([np.full(min(i, n), np.nan), a[: max(n - i, 0)]])
    mean = [np.ones(n)] if d == 0 else []

    def fit(features):
        if not features:
            return np.zeros(n)
        m = np.column_stack(features)
        ok = ~np.isnan(m).any(axis=1) & ~np.isnan(z)
        out = np.full(n, np.nan)
        if ok.any():
            beta = np.linalg.lstsq(m[ok].T @ m[ok], m[ok].T @ z[ok], rcond=None)[0]
            out[ok] = m[ok] @ beta
        return out

    errors = []
    if q:
        e = z - fit(mean + [lag(z, i) for i in range(1, max(p, q) + 2)])
        errors = [lag(e, i) for i in range(1, q + 1)]
    return fit(mean + [lag(z, i) for i in range(1, p + 1)] + errors) + (np.array(x) - z)


def values(df, name, col):
    return np.array([np.nan if r[col] is None else r[col] for r in df.filter(F.col("s") == name).orderBy("t").collect()], dtype=float)


@pytest.mark.parametrize("point", [(0, 0, 0), (0, 1, 0), (2, 0, 0), (1, 1, 1), (1, 2, 3)])
@pytest.mark.parametrize("limit", [10**6, 10])
def test_equals_numpy(series, point, limit):
    got = fc.forecast_by_series(series, ["s"], ["t"], "v", point, max_series_rows=limit)
    for name in ("long", "short"):
        x = values(series, name, "v")
        np.testing.assert_allclose(values(got, name, "predicted"), two_rounds(x, *point), rtol=1e-5, atol=1e-5)
    assert got.count() == series.count()


def test_grid_is_fitted_like_single_points(series):
    best, scores = fc.grid_search(series, ["s"], ["t"], "v")
    assert scores.count() == 6
    single = fc.forecast_by_series(series, ["s"], ["t"], "v", (1, 2, 3))
    rmse = single.agg(F.sqrt(F.avg((F.col("predicted") - F.col("v")) ** 2))).first()[0]
    assert scores.filter("p = 1 AND d = 2 AND q = 3").first().rmse == pytest.approx(rmse)
    assert best.first().rmse == pytest.approx(min(r.rmse for r in scores.collect()))
    per, _ = fc.grid_search(series, ["s"], ["t"], "v", {"p": (0, 1), "d": (0, 1), "q": (0,)}, per_series=True)
    assert {r.s for r in per.collect()} == {"long", "short", "tiny"}


def test_own_fitter_and_its_limit(series):
    got = fc.forecast_by_series(series, ["s"], ["t"], "v", (0, 1, 0), fit_fn=lambda x, order: x * 0 + order[1])
    assert got.select("predicted").distinct().first()[0] == 1.0
    with pytest.raises(ValueError):
        fc.forecast_by_series(series, ["s"], ["t"], "v", (0, 1, 0), fit_fn=lambda x, order: x, max_series_rows=100)


def test_index_is_dense_and_ordered(series):
    rows = sorted((r.t_all, r.s, r.t) for r in fc.indexed_series(series, ["s"], ["t"], "t_all").collect())
    assert [r[0] for r in rows] == list(range(443)) and [r[1:] for r in rows] == sorted(r[1:] for r in rows)


def test_rows_are_not_multiplied_by_the_grid(spark, series):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fitted = fc._fit(series, ["s"], ["t"], "v", [(1, d, q) for d in (2, 3) for q in (2, 3, 4)], 10**6)
        assert fitted.count() == series.count()
        # The rows are dealt out once; the others are the coefficients of both rounds.
        assert fitted._jdf.queryExecution().sparkPlan().toString().count("SortMergeJoin") == 2
        assert fitted._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_series_without_a_key_is_fitted(spark):
    rows = [(None, t, float(t * t % 7)) for t in range(30)] + [("a", t, float(t * t % 5)) for t in range(30)]
    df = spark.createDataFrame(rows, "s string, t int, v double")
    got = fc.forecast_by_series(df, ["s"], ["t"], "v", (1, 1, 1))
    x = np.array([r.predicted if r.predicted is not None else np.nan for r in got.filter("s is null").orderBy("t").collect()])
    np.testing.assert_allclose(x, two_rounds([r[2] for r in rows[:30]], 1, 1, 1), rtol=1e-5, atol=1e-5)
