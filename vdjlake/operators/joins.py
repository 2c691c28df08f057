"""Joins in which nulls are values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """``left`` joined with ``right`` on ``keys``, a null being equal to a null; the keys come out once, as on the left."""
    named = right.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys))
    joined = left.join(named, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*(f"__right_{k}" for k in keys))
