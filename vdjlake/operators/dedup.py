"""Merging redundant records, removing duplicates over all units, and the index of unique sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vdjlake.operators.joins import join_null_safe
from vdjlake.schema import SUBSETS, UNIT_KEY


def processing_order(df: DataFrame) -> list[Column]:
    """The order in which units and their records are processed: paired before unpaired, then by name and position."""
    rank = F.array_position(F.array(*map(F.lit, SUBSETS)), F.col("oas_subset"))
    return [rank, F.col("study_id"), F.col("unit_id"), *(F.col(c) for c in ("index_in_unit", "chain") if c in df.columns)]


def _first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], extra: dict[str, Column], unique_order: bool) -> DataFrame:
    """The first row of each key by ``order``, with aggregates ``extra`` of the key's rows. Null keys are keys.

    Where the keys, plain columns of the order and ``extra`` are all the columns there are, one aggregation of narrow
    rows does; others come from a ranking to one row, which the planner cuts down in each task before the shuffle and
    which reads only the columns that are used later. Either way a value in a third of all rows reaches its task once
    from each other task. ``unique_order``: no two rows of a key are equal in ``order``; otherwise such rows are told
    apart by a hash of all columns, which then have to be read.
    """
    ranks = [F.col(c) if isinstance(c, str) else c for c in order]
    tie = [] if unique_order else [F.xxhash64(*df.columns)]
    names = [c if isinstance(c, str) else None for c in order]
    known = {*keys, *filter(None, names), *extra}
    totals = [c.alias(f"__x_{n}") for n, c in extra.items()]
    if set(df.columns) <= known:
        once = df.groupBy(*keys).agg(F.min(F.struct(*(c.alias(f"o{i}") for i, c in enumerate(ranks)))).alias("__o"), *totals)
        place = {n: i for i, n in enumerate(names) if n}
        value = lambda c: F.col(f"__x_{c}") if c in extra else F.col(c) if c in keys else F.col(f"__o.o{place[c]}")
        return once.select(*(value(c).alias(c) for c in df.columns))
    first = df.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*ranks, *tie))).filter(F.col("__rank") == 1).drop("__rank")
    if not extra:
        return first
    joined = join_null_safe(first, df.groupBy(*keys).agg(*totals), keys, "inner")
    return joined.select(*(F.col(f"__x_{c}" if c in extra else c).alias(c) for c in df.columns))


def merge_redundant(
    df: DataFrame, unit: Sequence[str] = UNIT_KEY, value: str = "sequence_aa", order: Sequence[str] = ("index_in_unit", "chain"), redundancy: str = "redundancy", unique_order: bool = False
) -> DataFrame:
    """One row for each value within a unit: the first by ``order``, with the redundancies added up.

    A null redundancy counts as 1; null values are one value. Rows equal in ``order`` are told apart by their content.
    """
    total = F.sum(F.coalesce(F.col(redundancy), F.lit(1))).cast(df.schema[redundancy].dataType)
    return _first_rows(df, [*unit, value], order, {redundancy: total}, unique_order)


def no_duplicates(df: DataFrame, value: str = "sequence_aa", order: Sequence[Column | str] | None = None, unique_order: bool = False) -> DataFrame:
    """The first row of each value over all units, by processing order; rows with a null or empty value all stay.

    The latter are each a key of their own, so that the input is run once.
    """
    named = F.coalesce(F.col(value) != "", F.lit(False))
    keyed = df.withColumn("__alone", F.when(named, F.lit(-1).cast("bigint")).otherwise(F.monotonically_increasing_id()))
    return _first_rows(keyed, [value, "__alone"], list(order) if order else processing_order(df), {}, unique_order).drop("__alone")


def unique_index(df: DataFrame, value: str = "sequence_aa", unit: Sequence[str] = UNIT_KEY, shards: int = 256) -> DataFrame:
    """value, shard, units (sorted ids) and number of units for each distinct value that isn't null or empty.

    Values are distinct within units first, so what is gathered for a value is bounded by the number of units.
    """
    once = df.filter(F.col(value).isNotNull() & (F.col(value) != "")).select(F.col(value), F.concat_ws(",", *unit).alias("unit")).distinct()
    index = once.groupBy(value).agg(F.array_sort(F.collect_list("unit")).alias("units"))
    return index.select(value, F.pmod(F.xxhash64(value), F.lit(shards)).cast("int").alias("shard"), "units", F.size("units").alias("num_units"))


def index_totals(df: DataFrame, value: str = "sequence_aa") -> DataFrame:
    """How many rows there are in all and how many distinct values that aren't null or empty."""
    return df.agg(F.count(F.lit(1)).alias("num_sequences"), F.count_distinct(F.nullif(F.col(value), F.lit(""))).alias("num_unique"))


def distinct_on(df: DataFrame, ignored_prefixes: Sequence[str] = ("imgt_", "redundancy", "anarci_deletions", "anarci_insertions"), order: Sequence[str] = ("index_in_unit", "chain")) -> DataFrame:
    """Rows that differ in a column whose name has none of the prefixes; of equal ones the first by ``order``."""
    keys = [c for c in df.columns if not c.startswith(tuple(ignored_prefixes)) and c not in order]
    return _first_rows(df, keys, list(order), {}, False)
