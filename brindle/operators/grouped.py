"""Per-group statistics and grouped pandas functions.

The native forms aggregate first (map-side combine, one row per group in the shuffle) and join
the statistics back, so no task ever holds a whole group. The pandas forms hand whole groups to
Python only below a measured number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from brindle.operators.joins import attach
from brindle.session import settle

PandasFn = Callable[[pd.DataFrame], pd.DataFrame]

# Rows of one group that a Python worker may hold at once.
MAX_GROUP_ROWS = 2_000_000
# Rows that one portion of exploded lists holds.
RELISTED_AT_ONCE = 1 << 17


def with_params(factory: Callable[..., Callable], **params) -> Callable:
    """Bind ``params`` to a function factory; the bound function travels as a closure."""
    return factory(**params)


def sqrt_reading(df: DataFrame, col: str, out: str = "sqrt_reading") -> DataFrame:
    return df.withColumn(out, F.sqrt(col))


@F.pandas_udf(T.DoubleType())
def sqrt_series(values: pd.Series) -> pd.Series:
    return np.sqrt(values)


def sqrt_reading_pandas(df: DataFrame, col: str, out: str = "sqrt_reading") -> DataFrame:
    """The scalar pandas UDF form of :func:`sqrt_reading`."""
    return df.withColumn(out, sqrt_series(F.col(col).cast("double")))


def mean_over_std(col: str | Column) -> Column:
    """``mean / sample std``; NULL for one-row and zero-spread groups."""
    return F.try_divide(F.avg(col), F.stddev_samp(col))


def _normalizer(col: str, out: str, value: float | None, sign: int) -> PandasFn:
    def normalize(pdf: pd.DataFrame) -> pd.DataFrame:
        spread = pdf[col].std()
        ratio = pdf[col].mean() / spread if spread else None
        if value is not None and ratio is not None:
            ratio = value + sign * ratio
        return pdf.assign(**{out: ratio})

    return normalize


def normalize_group(
    df: DataFrame,
    keys: Sequence[str],
    col: str,
    out: str = "normalized",
    engine: str = "native",
    value: float | Column | None = None,
    sign: int = -1,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add the group's ``mean / std`` to every row, or ``value + sign * mean / std``.

    ``engine="pandas"`` runs the same computation as a grouped-map pandas function with the
    parameters bound by closure; groups above ``max_group_rows`` take the native form.
    """
    if engine == "pandas":
        if isinstance(value, Column):
            raise TypeError("the pandas form takes a plain number as value")
        schema = T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())])
        return grouped_map(
            df,
            keys,
            with_params(_normalizer, col=col, out=out, value=value, sign=sign),
            schema,
            max_group_rows=max_group_rows,
            beyond=lambda hot: normalize_group(hot, keys, col, out, value=value, sign=sign),
        )
    ratio = mean_over_std(col)
    stats = settle(df.groupBy(*keys).agg(ratio.alias(out)), "group-stats")
    result = attach(df, stats, keys)
    if value is None:
        return result
    base = value if isinstance(value, Column) else F.lit(float(value))
    return result.withColumn(out, base + F.lit(sign) * F.col(out))


def normalize_with_value(df: DataFrame, keys: Sequence[str], col: str, value, sign: int = -1, **kwargs) -> DataFrame:
    """``value - mean/std`` per group (``sign=1`` adds instead)."""
    return normalize_group(df, keys, col, value=value, sign=sign, **kwargs)


def global_average(df: DataFrame, col: str) -> Column:
    """The table mean as a scalar subquery, usable as a column of the same or another query."""
    return df.select(F.avg(col)).scalar()


def group_sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_rows"))


def grouped_map(
    df: DataFrame,
    keys: Sequence[str],
    fn: PandasFn,
    schema: T.StructType | str,
    max_group_rows: int = MAX_GROUP_ROWS,
    beyond: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``groupBy(keys).applyInPandas(fn)`` behind a check of the largest group.

    Rows of groups above ``max_group_rows`` go to ``beyond``, a DataFrame function with the same
    result; without one, such data is refused rather than loaded into a single worker. A function
    that can be computed in pieces has no such limit in :func:`grouped_reduce`.
    """
    sizes = group_sizes(df, keys)
    hot = settle(sizes.filter(F.col("group_rows") > max_group_rows).drop("group_rows"), "hot-groups")
    if hot.isEmpty():
        return df.groupBy(*keys).applyInPandas(fn, schema)
    if beyond is None:
        raise ValueError(f"a group of {list(keys)} has more than {max_group_rows} rows; pass beyond=")
    small = attach(df, hot, keys, "left_anti").groupBy(*keys).applyInPandas(fn, schema)
    return small.unionByName(beyond(attach(df, hot, keys, "left_semi")))


def grouped_reduce(
    df: DataFrame,
    keys: Sequence[str],
    partial: PandasFn,
    merge: PandasFn,
    partial_schema: T.StructType | str,
    schema: T.StructType | str,
) -> DataFrame:
    """A grouped pandas function for groups of any size, computed in pieces.

    ``partial`` sees the rows of one key in one batch and returns few rows of ``partial_schema``,
    the keys among them; ``merge`` sees the partial rows of a key, of all batches, and returns its
    result. No worker holds a whole group, none is refused, and only partial rows are shuffled.
    """

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [partial(own) for _, own in pdf.groupby(list(keys), sort=False, dropna=False)]
            if found:
                yield pd.concat(found, ignore_index=True)

    return df.mapInPandas(pieces, partial_schema).groupBy(*keys).applyInPandas(merge, schema)


def coarse_grouped_map(
    df: DataFrame,
    outer: Sequence[str],
    inner: Sequence[str],
    fn: PandasFn,
    schema: T.StructType | str,
    max_group_rows: int = MAX_GROUP_ROWS,
    beyond: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``fn`` per ``outer + inner`` group with one Python call per ``outer`` group.

    The shuffle key is ``outer``, split into as many slices of whole inner groups as
    ``max_group_rows`` asks for, so a dominant outer key still spreads over the cluster.
    """
    keys = [*outer, *inner]
    fine = settle(group_sizes(df, keys), "group-sizes")
    hot = settle(fine.filter(F.col("group_rows") > max_group_rows).select(*keys), "hot-groups")
    if not hot.isEmpty():
        if beyond is None:
            raise ValueError(f"a group of {keys} has more than {max_group_rows} rows; pass beyond=")
        rest = attach(df, hot, keys, "left_anti")
        bulk = beyond(attach(df, hot, keys, "left_semi"))
        return coarse_grouped_map(rest, outer, inner, fn, schema, max_group_rows).unionByName(bulk)

    slices = settle(
        fine.groupBy(*outer).agg(F.ceil(2 * F.sum("group_rows") / max_group_rows).cast("int").alias("__slices")),
        "slices",
    )
    names = df.columns

    def per_slice(pdf: pd.DataFrame) -> pd.DataFrame:
        groups = pdf[names].groupby(list(inner), sort=False, dropna=False)
        return pd.concat([fn(group) for _, group in groups], ignore_index=True)

    sliced = attach(df, slices, outer).withColumn(
        "__slice", F.pmod(F.xxhash64(*inner), F.greatest("__slices", F.lit(1)))
    )
    return sliced.drop("__slices").groupBy(*outer, "__slice").applyInPandas(per_slice, schema)


def normalize_coarse(
    df: DataFrame,
    outer: Sequence[str],
    inner: Sequence[str],
    col: str,
    out: str = "normalized",
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """:func:`normalize_group` on ``outer + inner`` through :func:`coarse_grouped_map`."""
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.DoubleType())])
    return coarse_grouped_map(
        df,
        outer,
        inner,
        with_params(_normalizer, col=col, out=out, value=None, sign=1),
        schema,
        max_group_rows=max_group_rows,
        beyond=lambda hot: normalize_group(hot, [*outer, *inner], col, out),
    )


def denormalize(
    df: DataFrame,
    key: str,
    list_col: str,
    means: Sequence[str],
    max_list: int | None = None,
) -> DataFrame:
    """One row per key: sorted list of ``list_col`` and the mean of every column in ``means``.

    With ``max_list`` the sorted list of every key is cut into ranges of that many entries, the last
    one shorter: one row for each, numbered by ``part`` and with the same means. Without, ``part`` is
    0 and the list is whole, however long. The number of rows never decides between the two.
    """
    averages = [F.avg(m).alias(m) for m in means]
    if max_list is None:
        return df.groupBy(key).agg(F.lit(0).alias("part"), F.sort_array(F.collect_list(list_col)).alias(list_col), *averages)
    pieces = F.transform(F.array_sort(F.collect_list(F.struct(F.col(list_col).alias("v"), "n"))), lambda x: F.array_repeat(x["v"], x["n"]))
    lists = _part_counts(df, key, list_col, max_list).groupBy(key, "part").agg(F.flatten(pieces).alias(list_col))
    # Keys without entries have one part with an empty list.
    result = attach(settle(df.groupBy(key).agg(*averages), "key-means"), settle(lists, "lists"), [key])
    none = F.array().cast(T.ArrayType(df.schema[list_col].dataType))
    return result.select(key, F.coalesce("part", F.lit(0)).alias("part"), F.coalesce(list_col, none).alias(list_col), *means)


def _part_counts(df: DataFrame, key: str, list_col: str, max_list: int) -> DataFrame:
    """``(key, value, part, n)``: how often a value stands in a part of its key's sorted list.

    Positions are running sums of the values' counts over range partitions: neither a key nor a value
    with many rows gathers in a task.
    """
    counts = df.where(F.col(list_col).isNotNull()).groupBy(key, list_col).agg(F.count(F.lit(1)).alias("__n"))
    ranged = settle(counts.repartitionByRange(key, list_col).withColumn("__range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    sums = ranged.groupBy("__range").agg(F.sum("__n").alias("n"))
    offsets = settle(sums.select("__range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset")), "offsets")
    inside = Window.partitionBy("__range").orderBy(key, list_col).rowsBetween(Window.unboundedPreceding, 0)
    placed = settle(ranged.join(offsets, "__range").withColumn("__at", F.col("__offset") + F.sum("__n").over(inside) - F.col("__n")), "placed")
    first = settle(placed.groupBy(key).agg(F.min("__at").alias("__first")), "first")
    own = attach(placed, first, [key]).withColumn("__at", F.col("__at") - F.col("__first"))
    part = lambda at: F.floor(at / max_list).cast("int")
    parts = own.withColumn("part", F.explode(F.sequence(part(F.col("__at")), part(F.col("__at") + F.col("__n") - 1))))
    begin = F.col("part").cast("long") * max_list
    inside_part = F.least(F.col("__at") + F.col("__n"), begin + max_list) - F.greatest(F.col("__at"), begin)
    return parts.select(key, list_col, "part", inside_part.cast("int").alias("n"))


def denormalize_pandas(
    df: DataFrame,
    key: str,
    list_col: str,
    means: Sequence[str],
    max_list: int | None = None,
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """The grouped-map pandas form of :func:`denormalize`; groups above ``max_group_rows`` take the
    native form, with the same rows."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    schema = (
        T.StructType()
        .add(key, fields[key])
        .add("part", T.IntegerType(), False)
        .add(list_col, T.ArrayType(fields[list_col]))
    )
    for m in means:
        schema = schema.add(m, T.DoubleType())

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        entries = sorted(pdf[list_col].dropna())
        size = max_list or max(len(entries), 1)
        parts = [entries[at : at + size] for at in range(0, max(len(entries), 1), size)]
        averages = {m: pdf[m].mean() for m in means}
        return pd.DataFrame([{key: pdf[key].iloc[0], "part": k, list_col: own} | averages for k, own in enumerate(parts)])

    def native(hot: DataFrame) -> DataFrame:
        return denormalize(hot, key, list_col, means, max_list)

    return grouped_map(df.select(key, list_col, *means), [key], gather, schema, max_group_rows, native)


def relist(df: DataFrame, list_col: str) -> DataFrame:
    """One row per list entry, other columns repeated; an empty list gives one NULL row."""
    return df.select(*[F.explode_outer(c).alias(c) if c == list_col else F.col(c) for c in df.columns])


def relist_pandas(df: DataFrame, list_col: str) -> DataFrame:
    """The iterator-map pandas form of :func:`relist`."""
    fields = [
        T.StructField(f.name, f.dataType.elementType) if f.name == list_col else f for f in df.schema.fields
    ]

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield from relisted(pdf, list_col)

    return df.mapInPandas(explode, T.StructType(fields))


def relisted(pdf: pd.DataFrame, list_col: str, most: int | None = None) -> Iterator[pd.DataFrame]:
    """The exploded rows of a batch, in portions of whole lists with some ``most`` entries: a batch has a
    bounded number of lists, but their entries together have no bound."""
    sizes = np.array([1 if x is None else max(len(x), 1) for x in pdf[list_col]], np.int64)
    portion = (np.cumsum(sizes) - sizes) // (most or RELISTED_AT_ONCE)
    for first, last in zip(edges := [0, *np.flatnonzero(np.diff(portion)) + 1, len(pdf)], edges[1:], strict=False):
        yield pdf.iloc[first:last].explode(list_col, ignore_index=True)


def group_size_stats(df: DataFrame, keys: Sequence[str], approximate: bool = False) -> DataFrame:
    """Rows, distinct keys and rows per key: the numbers behind the choice of a shuffle key."""
    key = F.struct(*keys)
    distinct = F.approx_count_distinct(key) if approximate else F.count_distinct(key)
    counts = df.agg(F.count(F.lit(1)).alias("row_count"), distinct.alias("key_count"))
    return counts.withColumn("rows_per_key", F.try_divide(F.col("row_count"), F.col("key_count")))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def rmse(df: DataFrame, predicted: str, actual: str, keys: Sequence[str] = ()) -> DataFrame:
    """Root mean squared error, over the table or per key."""
    error = F.col(predicted) - F.col(actual)
    return df.groupBy(*keys).agg(F.sqrt(F.avg(error * error)).alias("rmse"))
