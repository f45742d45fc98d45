"""Joins on keys of which a few may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

MOST_HUBS = 10_000


def join_hubs(rows: DataFrame, values: DataFrame, key: str, count: str, least: int = 1000) -> DataFrame:
    """``rows`` left-joined with ``values``, which holds each key once and, in ``count``, how many of
    the rows have it.

    Keys of at least ``least`` rows, and of at least a ``1 / MOST_HUBS`` share of all, are at most
    ``MOST_HUBS`` in number, whatever the size of the tables: these are broadcast. The others are
    joined by key, and none of them can fill a task. ``count`` does not come out. Both sides are read
    twice, so they should be settled.
    """
    total = values.agg(F.sum(count)).first()[0] or 0
    hub = F.col(count) >= max(least, -(-total // MOST_HUBS))
    hubs = F.broadcast(values.where(hub).drop(count))
    plain = rows.join(F.broadcast(values.where(hub).select(key)), key, "left_anti").join(values.where(~hub).drop(count), key, "left")
    return plain.unionByName(rows.join(hubs, key))
