"""Differences between consecutive full snapshots of a table.

A snapshot is reduced to one row a key (the latest delivery wins), each row to hashes of its canonical values, and
neighbouring snapshots meet in a full outer join on the key: a missing side is an addition or removal, unequal hashes a
change.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE_SPACE = r"[\s\p{Z}]+"  # also what Java's \s leaves out, as the no-break space


def strip(column: Column | str) -> Column:
    """``column`` without white space around it, of any kind."""
    return F.regexp_replace(column, rf"^{WHITE_SPACE}|{WHITE_SPACE}$", "")


def value_hash(value: Column) -> Column:
    """A hash under which null differs from every value and equals null."""
    return F.xxhash64(value.isNull().cast("int"), value)


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], values: Mapping[str, Column]) -> DataFrame:
    """One row a key with the hashes of ``values``, of the row that is last by ``order``.

    Rows equal in ``order`` are told apart by their hashes, so that the choice doesn't depend on partitions. It is one
    aggregation with partial results before the shuffle; a key delivered very often costs no more than others.
    """
    hashes = [value_hash(v).alias(f"__h_{n}") for n, v in values.items()]
    rank = [F.col(c) if isinstance(c, str) else c for c in order]
    row = F.struct(*(c.alias(f"__o_{i}") for i, c in enumerate(rank)), *hashes)
    best = df.groupBy(*keys).agg(F.max(row).alias("__row"))
    return best.select(*keys, *(F.col(f"__row.__h_{n}").alias(f"__h_{n}") for n in values))


def snapshot_changes(
    df: DataFrame,
    snapshot: str,
    keys: Mapping[str, Column],
    values: Mapping[str, Column],
    order: Sequence[Column | str],
) -> DataFrame:
    """Columns ``snapshot``, the keys, ``change_kind`` (added, removed, changed) and ``changed_columns``.

    Each snapshot is held against the one numbered one less; the first has nothing before it and yields no rows, and a
    number that is absent altogether counts as an empty snapshot between the first and the last. Null keys are keys
    like others and match each other. Rows with a null snapshot number belong to none and are left out. An empty table
    gives an empty result. Further columns of ``df`` are ignored, also when they are named like a key.
    """
    base = df.filter(F.col(snapshot).isNotNull()).withColumn("__no", F.col(snapshot))
    base = base.withColumns({f"__k_{n}": c for n, c in keys.items()})
    names = [f"__k_{n}" for n in keys]
    hashes = [f"__h_{n}" for n in values]
    rows = latest_rows(base, ["__no", *names], order, values)
    first, last = base.agg(F.min("__no"), F.max("__no")).first() or (None, None)
    if first is None:
        first, last = 0, -1
    now = rows.filter(F.col("__no") > first).select("*", F.xxhash64(*hashes).alias("__row_hash"))
    before = rows.filter(F.col("__no") < last).select(
        (F.col("__no") + 1).cast(base.schema["__no"].dataType).alias("__no_b"),
        *(F.col(n).alias(f"{n}_b") for n in names),
        *(F.col(h).alias(f"{h}_b") for h in hashes),
        F.xxhash64(*hashes).alias("__row_hash_b"),
    )
    on = (F.col("__no") == F.col("__no_b")) & F.lit(True)
    for n in names:
        on = on & F.col(n).eqNullSafe(F.col(f"{n}_b"))
    both = now.join(before, on, "full_outer")
    kind = (
        F.when(F.col("__row_hash_b").isNull(), "added")
        .when(F.col("__row_hash").isNull(), "removed")
        .when(F.col("__row_hash") != F.col("__row_hash_b"), "changed")
    )
    changed = F.array_compact(F.array(*(F.when(F.col(f"__h_{n}") != F.col(f"__h_{n}_b"), F.lit(n)) for n in values)))
    here = F.col("__row_hash").isNotNull()
    return both.withColumn("change_kind", kind).filter("change_kind IS NOT NULL").select(
        F.coalesce("__no", "__no_b").alias(snapshot),
        *(F.when(here, F.col(f"__k_{n}")).otherwise(F.col(f"__k_{n}_b")).alias(n) for n in keys),
        "change_kind",
        F.when(F.col("change_kind") == "changed", changed).alias("changed_columns"),
    )


def change_counts(changes: DataFrame, *by: str) -> DataFrame:
    """Numbers of additions, removals and changes for each combination of ``by``."""
    kinds = {"num_added": "added", "num_removed": "removed", "num_changed": "changed"}
    return changes.groupBy(*by).agg(*(F.count_if(F.col("change_kind") == k).alias(n) for n, k in kinds.items()))
