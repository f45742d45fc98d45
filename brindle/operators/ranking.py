"""Latest-wins deduplication, top-k and splits by position."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Up to this many rows a sorted limit stays in memory on every task.
SMALL_LIMIT = 100_000


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str | Column],
    order: str,
    tie_break: Sequence[Column] = (),
    granularity: str | None = None,
) -> DataFrame:
    """The newest row per key (NULL is a key value), optionally per key and hour.

    Plans as a partial and a final ``WindowGroupLimit``: each task ships at most one row per key,
    whatever the size of the key.
    """
    if granularity not in (None, "hour"):
        raise ValueError(f"granularity must be 'hour' or None, not {granularity!r}")
    parts = [F.col(k) if isinstance(k, str) else k for k in keys]
    if granularity:
        parts.append(F.date_trunc(granularity, order))
    window = Window.partitionBy(*parts).orderBy(F.desc(order), *tie_break)
    return df.withColumn("__rank", F.row_number().over(window)).filter("__rank = 1").drop("__rank")


def dedup_assessment_logs(df: DataFrame, granularity: str | None = None) -> DataFrame:
    """Newest assessment per request, step, source and retrieval position."""
    keys = [F.col("request_id"), F.col("step_id"), F.col("source.id"), F.col("retrieval_assessment.position")]
    content = F.to_json(F.struct("text_assessment", "retrieval_assessment"))
    return latest_per_key(df, keys, "timestamp", [content], granularity)


def latest_suggestion(payloads: DataFrame) -> DataFrame:
    """The newest human edit per initially assessed request, with its suggested output."""
    record = "$.dataframe_records[0]"
    edits = payloads.select(
        F.get_json_object("request", f"{record}.request_id").alias("initial_request_id"),
        F.get_json_object("request", f"{record}.text_assessments[0].suggested_output").alias("suggested_output"),
        "timestamp_ms",
    )
    return latest_per_key(edits, ["initial_request_id"], "timestamp_ms", [F.col("suggested_output")])


def topn_classes(df: DataFrame, probs: str, classes: Sequence[str], n: int = 3) -> DataFrame:
    """``predicted_class_i`` and ``predicted_probability_i`` for the n most probable classes.

    ``probs`` is an array column in the order of ``classes``; ties go to the earlier class.
    """
    if not 0 < n <= len(classes):
        raise ValueError(f"n must be between 1 and {len(classes)}")
    ranked = F.array_sort(
        F.transform(F.col(probs), lambda p, i: F.struct((-p).cast("double").alias("minus_p"), i.alias("i")))
    )
    names = F.array(*[F.lit(c) for c in classes])
    wide = df.withColumn("__ranked", ranked)
    columns = []
    for i in range(n):
        hit = F.col("__ranked")[i]
        columns.append(F.get(names, hit["i"]).alias(f"predicted_class_{i + 1}"))
        columns.append((-hit["minus_p"]).alias(f"predicted_probability_{i + 1}"))
    return wide.select(*df.columns, *columns)


def expand_struct(df: DataFrame, col: str) -> DataFrame:
    """Turn the fields of a struct column into top-level columns."""
    return df.select(*[c for c in df.columns if c != col], f"{col}.*")


def _key_struct(order: Sequence[Column]) -> Column:
    return F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])


def _row_at(keys: DataFrame, k: int, rows: int):
    """The k-th (1-based) smallest value of the struct column ``key``.

    Each round range-partitions only the keys, counts the rows per range and keeps the range that
    holds position k, until that range is small. Nothing but one row per range and the final
    small range reaches the driver.
    """
    while rows > SMALL_LIMIT:
        ranges = (
            keys.repartitionByRange("key")
            .groupBy(F.spark_partition_id().alias("range"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("low"), F.max("key").alias("high"))
            .orderBy("range")
            .collect()
        )
        for r in ranges:
            if k <= r.n:
                break
            k -= r.n
        if r.n == rows:
            # A single range: either one key value only, or one partition to sort in.
            if r.low == r.high:
                return r.low
            break
        low, high = (F.struct(*[F.lit(v).alias(n) for n, v in b.asDict().items()]) for b in (r.low, r.high))
        kind = keys.schema["key"].dataType
        keys = keys.filter(F.col("key").between(low.cast(kind), high.cast(kind)))
        rows = r.n
    return keys.orderBy("key").offset(k - 1).limit(1).collect()[0].key


def first_rows(df: DataFrame, order: Sequence[str | Column], k: int, total: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(first k rows, the rest)`` in the given order, which must identify rows uniquely.

    Both parts are filters against the key at position k: no global sort and no
    single-partition window.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    key = _key_struct(columns)
    keys = df.select(key.alias("key"))
    total = keys.count() if total is None else total
    if k <= 0:
        return df.limit(0), df
    if k >= total:
        return df, df.limit(0)
    cut = _row_at(keys, k, total)
    kind = keys.schema["key"].dataType
    bound = F.struct(*[F.lit(v).alias(n) for n, v in cut.asDict().items()]).cast(kind)
    return df.filter(key <= bound), df.filter(key > bound)


def shortest(df: DataFrame, col: str, n: int, key: str) -> DataFrame:
    """The n rows with the shortest text, in order; ties by ``key``. A limit larger than
    ``SMALL_LIMIT`` is not kept in one task; the rows are the same."""
    order = [F.length(col), F.col(key)]
    if n <= SMALL_LIMIT:
        return df.orderBy(*order).limit(n)
    return first_rows(df, order, n)[0].orderBy(*order)


def all_but_longest(df: DataFrame, col: str, n: int, key: str, drop: str = "longest") -> DataFrame:
    """All rows except the n longest texts, or with ``drop="shortest"`` except the n shortest."""
    if drop not in ("longest", "shortest"):
        raise ValueError(f"drop must be 'longest' or 'shortest', not {drop!r}")
    total = df.count()
    head, tail = first_rows(df, [F.length(col), key], total - n if drop == "longest" else n, total)
    return head if drop == "longest" else tail


def positional_split(df: DataFrame, order: Sequence[str | Column], fraction: float = 0.6) -> tuple[DataFrame, DataFrame]:
    """The first ``int(rows * fraction)`` rows in order, and the rest."""
    total = df.count()
    return first_rows(df, order, int(total * fraction), total)


def eval_holdout(df: DataFrame, col: str, key: str, n: int = 100, fraction: float = 0.6) -> DataFrame:
    """The last part of the n shortest rows: with 100 and 0.6, the longest 40 of them."""
    small = shortest(df, col, n, key)
    return positional_split(small, [F.length(col), key], fraction)[1]


def top_ranked(df: DataFrame, groups: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first n rows per group, numbered by ``rank``."""
    window = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= n)
