"""Samples of rows and units that are the same in every run, and shards of work."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from vdjlake.schema import UNIT_KEY


def sample_rows(df: DataFrame, n: int, unit: Sequence[str] = UNIT_KEY, key: Sequence[str] = ("index_in_unit", "chain"), seed: int = 19) -> DataFrame:
    """Exactly min(n, rows) rows of each unit, in the order of a hash of ``key``; negative ``n`` keeps all.

    Ranking to a limit is cut down in each task before the shuffle, so a large unit sends n rows a task.
    """
    if n < 0:
        return df
    chance = F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in key)))
    w = Window.partitionBy(*unit).orderBy(chance, *key)
    return df.withColumn("__rank", F.row_number().over(w)).filter(F.col("__rank") <= n).drop("__rank")


@F.pandas_udf(T.DoubleType())
def unit_chance(ids: pd.Series) -> pd.Series:
    """The first uniform number of a NumPy generator seeded by xxh32 of the id: what others draw for the same unit."""
    import numpy as np
    import xxhash

    return pd.Series([None if i is None else np.random.RandomState(xxhash.xxh32_intdigest(i)).uniform() for i in ids], dtype="float64")


def sample_units(units: DataFrame, probability: float, key: Sequence[str] = UNIT_KEY) -> DataFrame:
    """Units kept with ``probability``, by their ids alone. Outside of (0, 1) all units are kept."""
    if not 0 < probability < 1:
        return units
    return units.filter(unit_chance(F.concat_ws(",", *key)) <= probability)


def portable_unit_sample(units: DataFrame, percent: int, key: Sequence[str] = UNIT_KEY) -> DataFrame:
    """As ``sample_units``, by md5, which any engine can repeat."""
    return units.filter(F.conv(F.substring(F.md5(F.concat_ws(",", *key)), 1, 8), 16, 10).cast("bigint") % 100 < percent)


def shard_of(units: DataFrame, size: str, shards: int, key: Sequence[str] = UNIT_KEY) -> DataFrame:
    """``units`` with a shard: the largest first, dealt out in turn. For a unit table, which is small."""
    w = Window.orderBy(F.col(size).desc_nulls_last(), *key)
    return units.withColumn("shard", F.pmod(F.row_number().over(w) - 1, F.lit(shards)).cast("int"))


def top_rows(df: DataFrame, n: int, *order) -> DataFrame:
    return df.orderBy(*order).limit(n)
