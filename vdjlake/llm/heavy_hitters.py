"""Most frequent values among billions, in bounded memory, by iceberg multi-hash filtering.

Pass 1 counts, exactly, how many rows fall into each of ``buckets`` coarse buckets under each of several hashes. A value
that reaches the threshold makes each of its buckets reach it, so pass 2 keeps only values whose every bucket did, and
counts these exactly. No frequent value can be lost, whatever the hashes do; a light value survives only if it shares a
heavy bucket under every hash, and is then dropped by its exact count.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping
from fractions import Fraction
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vdjlake.storage import cut, discard

#: Nothing needs to be finer: a bucket holds 1/4096 of the rows by chance, a twentieth of a support of 0.5 %.
BUCKETS, HASHES = 4096, 3


def _bucket(value: Column | str, which: int, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(which), value), F.lit(buckets)).cast("int")


def bucket_counts(values: DataFrame, hashes: int, buckets: int) -> DataFrame:
    """``field_name``, ``hash_no``, ``bucket``, ``n``: at most fields x hashes x buckets rows, also of each map task."""
    every = F.posexplode(F.array(*(_bucket("item", i, buckets) for i in range(hashes)))).alias("hash_no", "bucket")
    return values.select("field_name", every).groupBy("field_name", "hash_no", "bucket").agg(F.count(F.lit(1)).alias("n"))


def frequent_values(
    df: DataFrame,
    fields: Mapping[str, Column],
    support: float = 0.005,
    hashes: int = HASHES,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Values that stand in at least ``support`` of the rows in which their field isn't null.

    Result: ``field_name``, ``item`` (string), ``item_count`` (exact), ``field_rows``, ``share``. ``fields`` gives an
    expression for each reported name; null means missing and counts nowhere, an empty string is a value. Ties at the
    threshold all come out. A table without rows, or a field that is always null, gives no rows.

    What reaches the driver are the heavy buckets, at most 1 / support of them a field and hash. Partial counts are made before each shuffle, so a value in a third of all rows moves as one row a task.
    """
    if not 0 < support <= 1 or hashes < 1:
        raise ValueError("support must be in (0, 1], and there must be a hash")
    share = Fraction(str(support))
    buckets = max(buckets, 16 * ceil(1 / share))
    pairs = F.explode(F.array(*(F.struct(F.lit(name).alias("field_name"), e.cast("string").alias("item")) for name, e in fields.items())))
    values = df.select(pairs.alias("x")).select("x.field_name", "x.item").filter("item IS NOT NULL")
    counts = cut(bucket_counts(values, hashes, buckets), "buckets")
    # the buckets of one hash add up to the rows of the field
    totals = {r["field_name"]: r["n"] for r in counts.filter("hash_no = 0").groupBy("field_name").agg(F.sum("n").alias("n")).collect()}
    least = {name: max(1, ceil(share * n)) for name, n in totals.items()}
    enough = F.lit(False)
    for name, t in least.items():
        enough = enough | ((F.col("field_name") == name) & (F.col("n") >= t))
    heavy: dict[tuple[str, int], list[int]] = defaultdict(list)
    for r in counts.filter(enough).collect():  # 1 / support a field and hash at most
        heavy[r["field_name"], r["hash_no"]].append(r["bucket"])
    discard(counts)
    survives, threshold, rows = F.lit(False), F.lit(None).cast("long"), F.lit(None).cast("long")
    for name, t in least.items():
        all_heavy = F.col("field_name") == name
        for i in range(hashes):
            all_heavy = all_heavy & _bucket("item", i, buckets).isin(heavy[name, i])
        survives = survives | all_heavy
        threshold = F.when(F.col("field_name") == name, F.lit(t)).otherwise(threshold)
        rows = F.when(F.col("field_name") == name, F.lit(totals[name])).otherwise(rows)
    counted = values.filter(survives).groupBy("field_name", "item").agg(F.count(F.lit(1)).alias("item_count"))
    return counted.filter(F.col("item_count") >= threshold).select(
        "field_name", "item", "item_count", rows.alias("field_rows"), (F.col("item_count") / rows).alias("share")
    )
