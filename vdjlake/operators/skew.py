"""Per-key results where a few keys hold most rows.

Nothing here ever brings the rows of one key together. Counts are histograms with mergeable counts, summed map-side
first; quantiles are found by refining such histograms, digit by digit, until every rank is resolved to one value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from vdjlake.storage import cut, discard


def key_histogram(df: DataFrame, keys: Sequence[str], bin_of: Column | None = None, count: Column | None = None) -> DataFrame:
    """``keys``, ``bin`` and ``n``: how many rows (or, with ``count``, what sum) each key has in each bin.

    Without ``bin_of`` there is one bin, the coarsest histogram. Partial sums are made before the shuffle, so a key
    costs one row a bin and map task however many rows it has.
    """
    n = F.sum(count) if count is not None else F.count(F.lit(1))
    return df.withColumn("__bin", bin_of if bin_of is not None else F.lit(0)).groupBy(*keys, F.col("__bin").alias("bin")).agg(n.alias("n"))


def record_counts(df: DataFrame, keys: Sequence[str], record: Sequence[str], name: str = "num_records") -> DataFrame:
    """Number of distinct ``record`` combinations a key (nulls being values), repeated rows counted once.

    Where ``record`` has an integer column, its range is cut into bins of 64 values, and a bin of a key (and of the other
    columns of ``record``) holds a mask of those that occur: a distinct count that merges map-side, whatever the rows. The
    masks' sizes are the finest histogram, of which the sums are taken. Without such a column, the distinct combinations
    are found first, spread by key and record, and counted in one bin. An empty table gives no rows.
    """
    whole = [c for c in record if isinstance(df.schema[c].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))]
    if not whole:
        return key_histogram(df.select(*keys, *record).distinct(), keys).groupBy(*keys).agg(F.sum("n").alias(name))
    value = F.col(whole[0]).cast("long")
    # a null has a bin of its own
    bit = F.coalesce(F.expr("shiftleft(1L, cast(__v & 63 as int))"), F.lit(1).cast("long"))
    others = [c for c in record if c != whole[0]]
    masks = df.select(*keys, *others, value.alias("__v")).groupBy(*keys, *others, F.shiftright("__v", 6).alias("__range")).agg(F.bit_or(bit).alias("__mask"))
    return key_histogram(masks, keys, F.col("__range"), F.bit_count("__mask").cast("long")).groupBy(*keys).agg(F.sum("n").alias(name))


def roll_up(counts: DataFrame, keys: Sequence[str], *names: str) -> DataFrame:
    """Counts of finer keys summed to coarser ones; again only partial sums move."""
    return counts.groupBy(*keys).agg(*(F.sum(n).alias(n) for n in names))


def key_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Sequence[float],
    bits: int = 8,
) -> DataFrame:
    """Exact quantiles of the integer column ``value`` for every key: keys, ``quantile``, ``rank``, ``quantile_value``.

    The quantile q of n values is the value at rank max(1, ceil(q n)) in ascending order. Null values are left out; a
    key with only nulls has no rows. Null keys are one key. Method: counts of (key, value) are a mergeable histogram.
    Every round cuts the range of each open rank into 2**bits bins, sums the histogram to them, picks the bin that
    holds the rank and subtracts what lies before it, until bins are single values. The number of rounds is
    ceil(log2(max - min + 1) / bits), at most 64 / bits, whatever the rows. A round joins histogram rows, never input
    rows, by (key, bin), so a hot key is spread over its bins.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    fine = (
        df.select(*(F.col(k).alias(n) for k, n in zip(keys, names)), F.col(value).cast("long").alias("__v"))
        .filter("__v IS NOT NULL")
        .groupBy(*names, "__v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    fine = cut(fine, "histogram")
    low, high = fine.agg(F.min("__v"), F.max("__v")).first()
    spark = df.sparkSession
    kinds = {f.name: f.dataType for f in df.schema}
    if low is None:
        schema = T.StructType(
            [*(T.StructField(k, kinds[k]) for k in keys), T.StructField("quantile", T.DoubleType()), T.StructField("rank", T.LongType()), T.StructField("quantile_value", T.LongType())]
        )
        discard(fine)
        return spark.createDataFrame([], schema)
    width = max(1, (high - low).bit_length())
    # offsets from the least value, as decimals: their range may exceed a long
    fine = fine.withColumn("__d", (F.col("__v").cast("decimal(38,0)") - F.lit(str(low)).cast("decimal(38,0)")))
    total = fine.groupBy(*names).agg(F.sum("n").alias("__total"))
    ranks = total.select(*names, F.col("__total"), F.explode(F.array(*map(F.lit, quantiles))).alias("quantile")).select(
        *names, "quantile", F.greatest(F.lit(1), F.ceil(F.col("quantile") * F.col("__total"))).cast("long").alias("rank")
    )
    open_ = cut(ranks.select("*", F.col("rank").alias("__left"), F.lit("0").cast("decimal(38,0)").alias("__prefix")), "ranks")
    shift = width
    while shift > 0:
        step = min(bits, shift)
        parent, child = str(2**shift), str(2 ** (shift - step))
        binned = fine.groupBy(
            *names,
            # a bin is named by its least offset: a quotient of decimals would be rounded to six places
            (F.col("__d") - F.col("__d") % F.lit(parent).cast("decimal(38,0)")).cast("decimal(38,0)").alias("__parent"),
            (F.col("__d") - F.col("__d") % F.lit(child).cast("decimal(38,0)")).cast("decimal(38,0)").alias("__child"),
        ).agg(F.sum("n").alias("n"))
        # cumulative counts within one parent bin: at most 2**bits rows in a window
        w = Window.partitionBy(*names, "__parent").orderBy("__child")
        binned = binned.withColumn("__upto", F.sum("n").over(w)).select(
            *(F.col(n).alias(f"{n}_h") for n in names), "__parent", "__child", "n", "__upto"
        )
        on = F.col("__prefix") == F.col("__parent")
        for n in names:
            on = on & F.col(n).eqNullSafe(F.col(f"{n}_h"))
        hit = (F.col("__left") <= F.col("__upto")) & (F.col("__left") > F.col("__upto") - F.col("n"))
        following = open_.join(binned, on & hit).select(
            *names, "quantile", "rank", (F.col("__left") - (F.col("__upto") - F.col("n"))).alias("__left"), F.col("__child").alias("__prefix")
        )
        open_ = cut(following, "ranks")
        shift -= step
    value_at = (F.col("__prefix") + F.lit(str(low)).cast("decimal(38,0)")).cast("long")
    return open_.select(*(F.col(n).alias(k) for k, n in zip(keys, names)), "quantile", "rank", value_at.alias("quantile_value"))


def count_mismatches(declared: DataFrame, counted: DataFrame, keys: Sequence[str], said: str, found: str) -> DataFrame:
    """Distinct ``keys`` with ``said`` and ``found`` where the declared number isn't null and differs.

    A key without counted rows has 0. Keys are compared null-safely. One side has a row a key, the other at most as
    many: no key is larger than another.
    """
    right = counted.select(*(F.col(k).alias(f"{k}__c") for k in keys), F.col(found).alias("__found"))
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"{k}__c"))
    left = declared.select(*keys, said).filter(F.col(said).isNotNull()).distinct()
    both = left.join(right, on, "left").select(*keys, said, F.coalesce("__found", F.lit(0)).alias(found))
    return both.filter(F.col(said) != F.col(found))
