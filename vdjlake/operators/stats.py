"""Positional counts, length histograms, group counts and summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vdjlake.functions import positions as P
from vdjlake.schema import AMINO_ACIDS, REGIONS


def position_counts(df: DataFrame, by: Sequence[str] = ("chain",), value: str = "sequence_aa", positions: str = "imgt_positions", insertions: str = "imgt_insertions") -> DataFrame:
    """``by``, position (such as 112A), residue and count over all rows. Null values have no positions."""
    none = F.array().cast("array<string>")
    zipped = F.arrays_zip(F.split(value, "").alias("aa"), F.col(positions).alias("pos"), F.coalesce(F.col(insertions), none).alias("ins"))
    each = df.filter(F.col(value).isNotNull() & (F.col(value) != "")).select(*by, F.explode(zipped).alias("z"))
    at = F.concat(F.col("z.pos").cast("string"), F.coalesce(F.col("z.ins"), F.lit("")))
    return each.select(*by, at.alias("position"), F.col("z.aa").alias("residue")).groupBy(*by, "position", "residue").agg(F.count(F.lit(1)).alias("count"))


def ordinal_positions(df: DataFrame, value: str, positions: str = "imgt_positions", insertions: str = "imgt_insertions") -> DataFrame:
    """``df`` with plain positions 1, 2, ... for values that have no numbering."""
    n = F.length(value)
    return df.withColumns({positions: F.when(n > 0, F.sequence(F.lit(1), n)).cast("array<smallint>"), insertions: F.lit(None).cast("array<string>")})


def merge_counts(frames: Sequence[DataFrame], keys: Sequence[str], *counts: str) -> DataFrame:
    """Count tables of parts added up; a key that a part lacks counts as 0 there."""
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return every.groupBy(*keys).agg(*(F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in counts))


def position_matrix(counts: DataFrame, by: Sequence[str] = (), residues: Sequence[str] = tuple(AMINO_ACIDS), totals: bool = True) -> DataFrame:
    """A row a position and a column a residue, with region and row order; ``totals`` adds marginals.

    The residues are given, so no pass finds them; others are only in ``total``. The row ``total`` has the region
    ``sequence`` and comes last.
    """
    sums = [F.sum(F.when(F.col("residue") == r, F.col("count"))).alias(r) for r in residues]
    whole = [F.sum("count").alias("total")] if totals else []
    rows = counts.groupBy(*by, "position").agg(*sums, *whole)
    key = P.position_key(F.col("position"))
    rows = rows.select(*by, "position", P.region_of(key["number"]).alias("region"), key["number"].alias("number"), key["code"].alias("code"), *residues, *(["total"] if totals else []))
    if totals:
        last = counts.groupBy(*by).agg(*sums, *whole)
        empty = F.lit(None).cast("int")
        rows = rows.unionByName(last.select(*by, F.lit("total").alias("position"), F.lit("sequence").alias("region"), empty.alias("number"), empty.alias("code"), *residues, "total"))
    return rows


def in_position_order(matrix: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return matrix.orderBy(*by, F.col("number").asc_nulls_last(), "code").drop("number", "code")


def marginals(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Counts of positions, residues, both and neither, in long form: nulls mean all."""
    sets = [[*by, "position", "residue"], [*by, "position"], [*by, "residue"], [*by]]
    return counts.groupingSets([[F.col(c) for c in s] for s in sets], *by, "position", "residue").agg(F.sum("count").alias("count"))


def length_histogram(df: DataFrame, value: str = "sequence_aa", by: Sequence[str] = ("chain",)) -> DataFrame:
    """``by``, length, count; nulls are left out."""
    return df.filter(F.col(value).isNotNull()).groupBy(*by, F.length(value).alias("length")).agg(F.count(F.lit(1)).alias("count"))


def region_length_histograms(df: DataFrame, columns: Mapping[str, str] | None = None, by: Sequence[str] = ("chain",)) -> DataFrame:
    """``by``, region, length, count of all regions in one aggregation; nulls are left out."""
    columns = columns or {r: f"{r}_aa_length" for r in REGIONS if f"{r}_aa_length" in df.columns}
    each = F.explode(F.array(*(F.struct(F.lit(r).alias("region"), F.col(c).cast("int").alias("length")) for r, c in columns.items())))
    return df.select(*by, each.alias("x")).select(*by, "x.*").filter("length IS NOT NULL").groupBy(*by, "region", "length").agg(F.count(F.lit(1)).alias("count"))


def region_maxima(df: DataFrame, by: Sequence[str], columns: Mapping[str, str] | None = None, chain: str | None = None) -> DataFrame:
    """Largest length of each region by group; null where it has none. ``chain`` restricts to one."""
    columns = columns or {r: f"{r}_aa_length" for r in REGIONS if f"{r}_aa_length" in df.columns}
    rows = df.filter(F.col("chain") == chain) if chain else df
    return rows.groupBy(*by).agg(*(F.max(c).alias(f"{r}_max_length") for r, c in columns.items()))


def chain_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Records of either chain, all records, records as pairs count them (distinct positions), and the chains there."""
    return df.groupBy(*by).agg(
        F.count_if(F.col("chain") == "heavy").alias("num_heavy"),
        F.count_if(F.col("chain") == "light").alias("num_light"),
        F.count(F.lit(1)).alias("num_records"),
        F.array_join(F.array_sort(F.collect_set("chain")), ",").alias("chains"),
    )


def group_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of each combination of keys; a row with a null key isn't counted."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def regroup(counts: DataFrame, groupers: Sequence[str], also: str) -> DataFrame:
    """Counts by each of ``groupers`` and ``also`` in one pass: grouper, value, ``also``, count."""
    each = F.explode(F.array(*(F.struct(F.lit(g).alias("grouper"), F.col(g).cast("string").alias("value")) for g in groupers)))
    return counts.select(also, "count", each.alias("x")).groupBy("x.grouper", "x.value", also).agg(F.sum("count").alias("count")).select("grouper", "value", also, "count")


def percent_of_total(df: DataFrame, columns: Sequence[str], within: Sequence[str] = (), prefix: str = "pct_") -> DataFrame:
    """Percentages of the column sums. The totals are one row (or one a group) and joined, so no task sees all rows."""
    if within:
        w = Window.partitionBy(*within)
        return df.withColumns({f"{prefix}{c}": F.col(c) / F.sum(c).over(w) * 100 for c in columns})
    totals = df.agg(*(F.sum(c).alias(c) for c in columns)).first()
    return df.withColumns({f"{prefix}{c}": F.col(c) / F.lit(totals[c]) * 100 for c in columns})


def group_normalized(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Sums by key with percentages of the totals; the largest first when ordered by them."""
    sums = df.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in columns))
    return percent_of_total(sums, columns)


def melt(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str = "chain", value: str = "percentage") -> DataFrame:
    return df.unpivot(list(ids), list(columns), name, value)


def size_summary(df: DataFrame, size: str, by: Sequence[str] = ()) -> DataFrame:
    """Number, sum, mean, least and largest of sizes, in MiB."""
    mib = F.col(size) / F.lit(1024.0 * 1024.0)
    return df.groupBy(*by).agg(F.count(size).alias("num_files"), F.sum(mib).alias("total_mib"), F.avg(mib).alias("mean_mib"), F.min(mib).alias("min_mib"), F.max(mib).alias("max_mib"))


def column_presence(df: DataFrame, names: Column | str = "column_names", by: Sequence[str] = ("oas_subset",)) -> DataFrame:
    """In how many rows each name of an array column occurs."""
    return df.select(*by, F.explode(names).alias("column")).groupBy(*by, "column").agg(F.count(F.lit(1)).alias("num_units"))


def schema_groups(df: DataFrame, names: Column | str = "column_names", expected: Mapping[str, frozenset[str]] | None = None) -> DataFrame:
    """Rows grouped by their set of column names: columns, num_units, num_subsets, num_studies and, of ``expected``, family."""
    columns = F.array_join(F.array_sort(F.array_distinct(names)), ",")
    groups = df.select("oas_subset", "study_id", columns.alias("columns")).groupBy("columns").agg(
        F.count(F.lit(1)).alias("num_units"), F.count_distinct("oas_subset").alias("num_subsets"), F.count_distinct("study_id").alias("num_studies")
    )
    if expected:
        family = F.lit(None).cast("string")
        for name, known in expected.items():
            family = F.when(F.col("columns") == ",".join(sorted(known)), name).otherwise(family)
        groups = groups.withColumn("family", family)
    return groups


def check_schemas(groups: DataFrame) -> None:
    """An error if a group of ``schema_groups`` is of no expected family."""
    odd = groups.filter("family IS NULL").agg(F.count(F.lit(1)), F.sum("num_units")).first()
    if odd[0]:
        raise ValueError(f"{odd[0]} unexpected sets of columns, in {odd[1]} units")


def grand_totals(counts: DataFrame, by: Sequence[str] = ("chain",)) -> DataFrame:
    """Residues and distinct positions counted in each region."""
    region = P.region_of(P.position_number(F.col("position")))
    return counts.groupBy(*by, region.alias("region")).agg(F.sum("count").alias("num_residues"), F.count_distinct("position").alias("num_positions"))
