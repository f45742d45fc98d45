"""Join helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

_SIDE = "__side_"


def attach(df: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join ``side`` to ``df`` on ``keys``, with NULL equal to NULL as in ``groupBy``.

    ``side`` should be settled (see :func:`brindle.session.settle`), so that its size decides
    between a broadcast and a sort-merge join.
    """
    renamed = side.withColumnsRenamed({k: _SIDE + k for k in keys})
    same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(renamed[_SIDE + k]) for k in keys])
    return df.join(renamed, same, how).drop(*[_SIDE + k for k in keys])
