"""Joins that keep NULL keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a NULL key matches a NULL key; still a hash or sort-merge join."""
    if not keys:
        raise ValueError("null_safe_join needs at least one key")
    mark = "__right_"
    renamed = right.select(*[F.col(c).alias(mark + c) if c in keys else F.col(c) for c in right.columns])
    condition = None
    for k in keys:
        same = F.col(k).eqNullSafe(F.col(mark + k))
        condition = same if condition is None else condition & same
    return left.join(renamed, condition, how).drop(*[mark + k for k in keys])
