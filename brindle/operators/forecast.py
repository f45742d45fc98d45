"""ARIMA-style forecasts per series, fitted by two rounds of distributed least squares.

The Hannan-Rissanen scheme needs only lags, sums of products and one small linear system per
series: a long autoregression gives residuals, then the differenced value is regressed on its own
lags and the residuals' lags. All points of a parameter grid are fitted in the same two passes.
Predictions are in-sample, one step ahead, and NULL while the lags of a row are incomplete. This
is least squares, not maximum likelihood; ``fit_fn`` plugs in another fitter.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from itertools import product
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from brindle.operators.grouped import MAX_GROUP_ROWS, grouped_map
from brindle.operators.joins import attach
from brindle.session import settle

Order = tuple[int, int, int]
FitFn = Callable[[np.ndarray, Order], np.ndarray]
POINT = ["p", "d", "q"]
SERIES = "__series"  # the keys of a row's series in one column


def indexed_series(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "t") -> DataFrame:
    """Add the row's 0-based place in the table sorted by ``keys`` and ``order`` (unique).

    Range partitions are written once with their number, counted, and numbered on from the count of
    the partitions before; a series of any length spreads over as many partitions as it needs.
    """
    ranged = df.repartitionByRange(*keys, *order).withColumn("__range", F.spark_partition_id())
    ranged = settle(ranged, "ranges")
    counts = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = settle(counts.select("__range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset")), "offsets")
    inside = Window.partitionBy("__range").orderBy(*keys, *order)
    numbered = ranged.join(offsets, "__range").withColumn(out, F.col("__offset") + F.row_number().over(inside) - 1)
    return numbered.drop("__range", "__offset")


def _window_lags(order: Sequence[str]):
    """Lags by a window per series."""

    def lags(df: DataFrame, wanted: dict[str, int]) -> DataFrame:
        window = Window.partitionBy(SERIES).orderBy(*order)
        return df.select("*", *[F.lag(col, i).over(window).alias(f"{col}_{i}") for col, n in wanted.items() for i in range(1, n + 1)])

    return lags


def _index_lags(index: str):
    """Lags by position: every row's values are sent to the rows after it. No task holds a series."""

    def lags(df: DataFrame, wanted: dict[str, int]) -> DataFrame:
        most = max(wanted.values(), default=0)
        if most == 0:
            return df
        place = [SERIES, index]
        sent = df.select(*place, *wanted, F.explode(F.sequence(F.lit(1), F.lit(most))).alias("__i"))
        sent = sent.withColumn(index, F.col(index) + F.col("__i"))
        values = sent.groupBy(*place).agg(
            *[F.max(F.when(F.col("__i") == i, F.col(col))).alias(f"{col}_{i}") for col, n in wanted.items() for i in range(1, n + 1)]
        )
        return attach(df, values, place)

    return lags


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _solve(gram: pd.Series, moments: pd.Series) -> pd.Series:
    """Least-norm solution of the normal equations of one series."""

    def one(g, m):
        m = np.asarray(m, dtype=float)
        matrix = np.asarray(g, dtype=float).reshape(len(m), len(m))
        return np.linalg.lstsq(matrix, m, rcond=None)[0]

    return pd.Series([None if g is None else one(g, m) for g, m in zip(gram, moments)])


def _dot(coefficients: str, features: Sequence[Column]) -> Column:
    total = F.lit(0.0)
    for i, feature in enumerate(features):
        total = total + F.col(coefficients)[i] * feature
    return total


def _regress(df: DataFrame, fits: dict[str, tuple[Sequence[Column], Column]]) -> DataFrame:
    """Add the least-squares fit of each target on its features per series, from complete rows.

    The products of all fits are summed map-side in one pass; the shuffle carries one row per series
    and task. Coefficients meet the rows where the lags have put them already.
    """
    plain = {out: F.lit(0.0) for out, (features, _) in fits.items() if not features}
    fits = {out: fit for out, fit in fits.items() if fit[0]}
    if not fits:
        return df.withColumns(plain)
    complete, sums, solved = {}, [], []
    for n, (out, (features, target)) in enumerate(fits.items()):
        complete[out] = reduce(lambda a, b: a & b, [c.isNotNull() for c in (target, *features)])
        k = len(features)
        used = lambda product: F.sum(F.when(complete[out], product))  # noqa: B023, E731
        sums += [used(features[i] * features[j]).alias(f"g{n}_{i}_{j}") for i in range(k) for j in range(i, k)]
        sums += [used(features[i] * target).alias(f"m{n}_{i}") for i in range(k)]
        gram = F.array(*[F.col(f"g{n}_{min(i, j)}_{max(i, j)}") for i in range(k) for j in range(k)])
        some = F.col(f"m{n}_0").isNotNull()  # else no row is complete
        solved.append(_solve(F.when(some, gram), F.when(some, F.array(*[F.col(f"m{n}_{i}") for i in range(k)]))).alias(f"__beta{n}"))
    coefficients = settle(df.groupBy(SERIES).agg(*sums).select(SERIES, *solved), "coefficients")
    fitted = df.join(coefficients, SERIES, "left")
    found = {out: F.when(complete[out], _dot(f"__beta{n}", features)) for n, (out, (features, _)) in enumerate(fits.items())}
    return fitted.withColumns(found | plain).drop(*[f"__beta{n}" for n in range(len(fits))])


def _fit(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, points: Sequence[Order], max_series_rows: int
) -> DataFrame:
    """The rows with a column ``__predicted{k}`` for each grid point. Points stand beside each other: a
    row is never multiplied, and all windows and joins share the partitions of the first."""
    long_ar = [max(p, q) + 1 if q else 0 for p, _, q in points]
    depth = max(max(p, m) + d for (p, d, _), m in zip(points, long_ar, strict=True))

    series_rows = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    # A struct is never null and equals one of the same nulls, so it is joined by plain equality.
    if series_rows <= max_series_rows:
        df = df.withColumn(SERIES, F.struct(*keys))
        lags = _window_lags(order)
    else:
        df = settle(indexed_series(df, keys, order, "__t").withColumn(SERIES, F.struct(*keys)), "indexed")
        lags = _index_lags("__t")
    rows = lags(df.withColumn("__y", F.col(value).cast("double")), {"__y": depth})

    def differenced(d: int, lag: int) -> Column:
        """The d-th difference ``lag`` rows back."""
        terms = F.lit(0.0)
        for j in range(d + 1):
            terms = terms + F.lit(float((-1) ** j * comb(d, j))) * F.col(f"__y_{lag + j}" if lag + j else "__y")
        return terms

    def autoregression(k: int, n: int) -> list[Column]:
        d = points[k][1]
        return ([F.lit(1.0)] if d == 0 else []) + [differenced(d, i) for i in range(1, n + 1)]

    target = [differenced(d, 0) for _, d, _ in points]
    moving = [k for k, (_, _, q) in enumerate(points) if q]
    if moving:
        rows = _regress(rows, {f"__long{k}": (autoregression(k, long_ar[k]), target[k]) for k in moving})
        rows = rows.withColumns({f"__e{k}": target[k] - F.col(f"__long{k}") for k in moving}).drop(*[f"__long{k}" for k in moving])
        rows = lags(rows, {f"__e{k}": points[k][2] for k in moving})
    errors = [[F.col(f"__e{k}_{i}") for i in range(1, q + 1)] for k, (_, _, q) in enumerate(points)]
    rows = _regress(rows, {f"__fit{k}": (autoregression(k, p) + errors[k], target[k]) for k, (p, _, _) in enumerate(points)})
    # Undo the differencing: value = difference - the older terms of the difference. The rest is a
    # lagged expression, so the current value enters with weight one and cancels.
    return rows.withColumns({f"__predicted{k}": F.col(f"__fit{k}") + (F.col("__y") - target[k]) for k in range(len(points))})


def forecast_by_series(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    point: Order = (1, 2, 3),
    out: str = "predicted",
    fit_fn: FitFn | None = None,
    max_series_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add the in-sample one-step prediction of every row. ``order`` is unique within a series.

    ``fit_fn(values, (p, d, q))`` replaces the built-in fit by a function of one whole series; it
    refuses series above ``max_series_rows``.
    """
    if fit_fn is not None:
        schema = T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())])

        def fit(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(list(order), kind="stable")
            return pdf.assign(**{out: np.asarray(fit_fn(pdf[value].to_numpy(dtype=float), point), dtype=float)})

        return grouped_map(df, keys, fit, schema, max_series_rows)
    fitted = _fit(df, keys, order, value, [tuple(point)], max_series_rows)
    return fitted.select(*df.columns, F.col("__predicted0").alias(out))


# The default search space: p is fixed, d and q run over their ranges.
SPACE = {"p": (1,), "d": (2, 3), "q": (2, 3, 4)}


def grid_search(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    space: dict[str, Sequence[int]] = SPACE,
    per_series: bool = False,
    max_series_rows: int = MAX_GROUP_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """``(best, all points)``: p, d, q and ``rmse`` over the table, or per series.

    All points are fitted in the same passes over the data; equal errors go to the smaller point.
    """
    points = [tuple(point) for point in product(*[space[n] for n in POINT])]
    fitted = _fit(df.select(*keys, *order, value), keys, order, value, points, max_series_rows)
    errors = [F.struct(*[F.lit(v).alias(n) for n, v in zip(POINT, point)], (F.col(f"__predicted{k}") - F.col(value)).alias("error")) for k, point in enumerate(points)]
    groups = [*keys] if per_series else []
    error = F.col("error")
    scores = settle(
        fitted.select(*groups, F.explode(F.array(*errors)).alias("__point")).select(*groups, "__point.*").groupBy(*groups, *POINT).agg(F.sqrt(F.avg(error * error)).alias("rmse")), "grid-scores"
    )
    smallest = F.min_by(F.struct(*POINT, "rmse"), F.struct(F.round("rmse", 9), *POINT)).alias("best")
    best = scores.filter("rmse IS NOT NULL").groupBy(*groups).agg(smallest).select(*groups, "best.*")
    return best, scores
