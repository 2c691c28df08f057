"""Splits that keep related records together.

Records and the entities they share are a bipartite graph. Minimum labels spread over it, from records to entities and
back, until nothing changes; a record's label then names its component. Components are the items of a stratified group
assignment: each goes to the split whose label distribution it brings closest to the target.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from vdjlake.storage import cut, discard

#: Groups of at least 1 / SINGLE of the records are items of their own; all others share BINS hashed bins.
#: The STRATA most frequent strata have a column each, all others share as many hashed ones. Together they bound what the driver holds.
SINGLE, BINS, STRATA = 2048, 2048, 64


def components(edges: DataFrame, record: str = "record", entity: str = "entity", rounds: int = 64) -> DataFrame:
    """``record`` and ``component`` (its least record) for every record in ``edges``.

    Null records or entities tie nothing; repeated edges count once. Entities of a single record are dropped from the
    propagation, as they tie nothing. Records and entities are numbered once, so that labels are numbers. In a round,
    entities take the least label of their records, records the least of their entities, and labels then the label of
    the record they name, so that paths are halved rather than walked. Every round is a written table. An entity with a
    third of all edges is pre-aggregated on the way to it, and on the way back meets one row of its own in a join that
    adaptive execution may split.
    """
    e = cut(edges.select(F.col(record).alias("r"), F.col(entity).alias("e")).filter("r IS NOT NULL AND e IS NOT NULL").distinct(), "edges")
    # the numbers are fixed once they are written
    records = cut(e.select("r").distinct().withColumn("r_id", F.monotonically_increasing_id()), "records")
    entities = cut(e.select("e").distinct().withColumn("e_id", F.monotonically_increasing_id()), "entities")
    every = cut(e.join(records, "r").join(entities, "e").select("r_id", "e_id"), "numbered")
    shared = every.groupBy("e_id").agg(F.min("r_id").alias("lo"), F.max("r_id").alias("hi")).filter("lo <> hi").select("e_id")
    ties = cut(every.join(shared, "e_id", "left_semi"), "ties")
    labels = cut(ties.select("r_id").distinct().withColumn("label", F.col("r_id")), "labels")
    for _ in range(rounds):
        of_entity = ties.join(labels, "r_id").groupBy("e_id").agg(F.min("label").alias("label"))
        of_record = ties.join(of_entity, "e_id").groupBy("r_id").agg(F.min("label").alias("label"))
        onward = of_record.select(F.col("r_id").alias("label"), F.col("label").alias("next"))
        following = of_record.join(onward, "label", "left").select("r_id", F.least("label", "next").alias("label"))
        before = labels.withColumnRenamed("label", "before")
        following = cut(following.join(before, "r_id").select("r_id", "label", (F.col("label") != F.col("before")).alias("moved")), "labels")
        discard(labels)
        moved = not following.filter("moved").isEmpty()
        labels = following.drop("moved")
        if not moved:
            break
    else:
        raise RuntimeError(f"labels still move after {rounds} rounds")
    named = records.join(labels, "r_id", "left").select("r", F.coalesce("label", "r_id").alias("label"))
    least = named.groupBy("label").agg(F.min("r").alias("component"))
    out = cut(named.join(least, "label").select(F.col("r").alias(record), "component"), "components")
    for t in (e, records, entities, every, ties, labels):
        discard(t)
    return out


def linked_pairs(parts: DataFrame, record: str = "record") -> DataFrame:
    """All pairs of different records in one component, the lesser first, as ``{record}_a`` and ``{record}_b``.

    This is for results that are defined as pairs; use ``components`` where a class for each record will do.
    """
    a = parts.select("component", F.col(record).alias(f"{record}_a"))
    b = parts.select("component", F.col(record).alias(f"{record}_b"))
    return a.join(b, "component").filter(F.col(f"{record}_a") < F.col(f"{record}_b")).drop("component")


def _assign(sizes: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Split of each item. sizes: item x stratum. Largest items first, then moves while any lessens the deviation."""
    goal = shares[:, None] * sizes.sum(axis=0)[None, :]
    goal = np.concatenate([goal, goal.sum(axis=1, keepdims=True)], axis=1)  # the last column is the plain size
    items = np.concatenate([sizes, sizes.sum(axis=1, keepdims=True)], axis=1)
    scale = 1.0 / np.maximum(goal.sum(axis=0), 1.0)
    scale[-1] *= len(scale)
    have = np.zeros_like(goal)
    chosen = np.zeros(len(items), dtype=int)
    order = np.argsort(-items[:, -1], kind="stable")

    def cost(rows: np.ndarray) -> np.ndarray:
        return (((rows - goal) * scale) ** 2).sum(axis=1)

    for k in order:
        chosen[k] = int(np.argmin(cost(have + items[k]) - cost(have)))
        have[chosen[k]] += items[k]
    for _ in range(20):
        moves = 0
        for k in order[::-1]:
            at = chosen[k]
            gain = cost(have + items[k]) - cost(have)
            gain[at] = cost(have)[at] - cost(have - items[k])[at]
            to = int(np.argmin(gain))
            if gain[to] < gain[at] - 1e-15:
                have[at] -= items[k]
                have[to] += items[k]
                chosen[k] = to
                moves += 1
        if not moves:
            break
    return chosen


def assign_groups(records: DataFrame, group: str, stratum: str, targets: Mapping[str, float]) -> DataFrame:
    """``records`` with a column ``split``: all rows of a ``group`` in one, each split near its share of every stratum.

    Groups of at least 1/2048 of the rows are placed one by one; smaller ones are first hashed to 2048 bins, whose
    groups share a split. Each of the 64 most frequent strata is balanced for itself (ties by name), all others in 64
    hashed classes. Thus at most 4096 items of at most 128 strata reach the driver, at any size, and the hashed bins are
    even enough that placing them exactly costs little. Null groups are one group, null strata one stratum. Shares are
    scaled to a sum of 1. An empty table stays empty.
    """
    if not targets or min(targets.values()) < 0 or sum(targets.values()) <= 0:
        raise ValueError("targets must be shares of 0 or more, not all 0")
    named = records.select(F.col(group).alias("__group"), F.col(stratum).alias("__name")).groupBy("__group", "__name").agg(F.count(F.lit(1)).alias("n"))
    named = cut(named, "groups")
    most = named.groupBy("__name").agg(F.sum("n").alias("__n")).orderBy(F.desc("__n"), "__name").limit(STRATA)
    own = records.sparkSession.createDataFrame([(r["__name"], i) for i, r in enumerate(most.collect())], T.StructType([T.StructField("__own", named.schema["__name"].dataType), T.StructField("__at", T.IntegerType())]))
    kind = F.coalesce("__at", F.lit(STRATA) + F.pmod(F.xxhash64("__name"), F.lit(STRATA)).cast("int")).alias("__stratum")
    by = named.join(F.broadcast(own), F.col("__name").eqNullSafe(F.col("__own")), "left").groupBy("__group", kind).agg(F.sum("n").alias("n"))  # 64 rows at most
    total = by.agg(F.sum("n")).first()[0] or 0
    size = by.groupBy("__group").agg(F.sum("n").alias("__size"))
    name = F.when(F.col("__size") * SINGLE >= total, F.concat(F.lit("g"), F.coalesce("__group", F.lit("")), F.col("__group").isNull().cast("string"))).otherwise(
        F.concat(F.lit("b"), F.pmod(F.xxhash64("__group"), F.lit(BINS)).cast("string"))
    )
    items = cut(size.select("__group", name.alias("__item")), "items")
    same = by["__group"].eqNullSafe(items["__group"])
    rows = by.join(items, same).groupBy("__item", "__stratum").agg(F.sum("n").alias("n")).collect()
    discard(named)
    names = sorted({r["__item"] for r in rows})
    strata = sorted({r["__stratum"] for r in rows})
    at, col = {n: i for i, n in enumerate(names)}, {s: i for i, s in enumerate(strata)}
    sizes = np.zeros((len(names), max(1, len(strata))))
    for r in rows:
        sizes[at[r["__item"]], col[r["__stratum"]]] = r["n"]
    splits = list(targets)
    shares = np.array([targets[s] for s in splits], dtype=float)
    chosen = _assign(sizes, shares / shares.sum()) if names else []
    spark = records.sparkSession
    placed = spark.createDataFrame([(n, splits[c]) for n, c in zip(names, chosen)], "__item string, split string")
    placed = items.join(F.broadcast(placed), "__item").select("__group", "split")  # at most 4096 rows
    return records.join(placed, records[group].eqNullSafe(placed["__group"]), "left").drop("__group")


def split_shares(assigned: DataFrame, targets: Mapping[str, float], by: Sequence[str] = ()) -> DataFrame:
    """``split``, ``target_share``, ``num_records`` and ``actual_share`` (of all rows, or of each ``by``)."""
    spark = assigned.sparkSession
    goals = spark.createDataFrame(list(targets.items()), "split string, target_share double")
    counts = assigned.groupBy(*by, "split").agg(F.count(F.lit(1)).alias("num_records"))
    if not by:
        total = counts.agg(F.sum("num_records")).first()[0] or 0
        return goals.join(counts, "split", "left").select(
            "split", "target_share", F.coalesce("num_records", F.lit(0)).alias("num_records"), (F.coalesce("num_records", F.lit(0)) / F.lit(max(total, 1))).alias("actual_share")
        )
    share = F.col("num_records") / F.sum("num_records").over(Window.partitionBy(*by))  # a row a split
    return counts.join(goals, "split").select(*by, "split", "target_share", "num_records", share.alias("actual_share"))
