"""Row and unit filters, named pipelines of them, and their logs."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vdjlake.operators.dedup import merge_redundant, no_duplicates
from vdjlake.operators.joins import join_null_safe
from vdjlake.schema import UNIT_KEY
from vdjlake.storage import cut

#: Isotypes that units declare; fixed values.
UNIT_ISOTYPES = ("Bulk", "All", "IGHM", "IGHA", "IGHE", "IGHG", "IGHD")


@dataclass(frozen=True)
class RowFilter:
    """A step of a pipeline: a name and a function on DataFrames. Steps that only drop rows have a ``predicate``.

    ``needs`` are the columns that a step reads, None where these aren't known.
    """

    name: str
    apply: Callable[[DataFrame], DataFrame]
    predicate: Callable[[], Column] | None = None
    needs: tuple[str, ...] | None = None

    def __call__(self, df: DataFrame) -> DataFrame:
        return self.apply(df)


def keep_where(name: str, predicate: Callable[[], Column], *needs: str) -> RowFilter:
    """Rows for which the predicate, which reads the columns ``needs``, is true; null drops the row."""
    return RowFilter(name, lambda df: df.filter(predicate()), predicate, needs or None)


def identity() -> RowFilter:
    return RowFilter("Identity", lambda df: df, lambda: F.lit(True), ())


def only_productive() -> RowFilter:
    return keep_where("OnlyProductive", lambda: F.col("productive"), "productive")


def no_stop_codon() -> RowFilter:
    return keep_where("NoStopCodon", lambda: ~F.col("stop_codon"), "stop_codon")


def vj_in_frame() -> RowFilter:
    return keep_where("VJInFrame", lambda: F.col("vj_in_frame"), "vj_in_frame")


def no_unexpected_insertions() -> RowFilter:
    return keep_where("NoUnexpectedInsertions", lambda: ~F.col("has_unexpected_insertions"), "has_unexpected_insertions")


def _no_short(region: str, threshold: int | None) -> RowFilter:
    name = f"NoShort{region.upper()}(threshold={threshold})"
    if threshold is None:
        return keep_where(name, lambda: ~F.col(f"anarci_{region}_shorter_than_imgt_defined"), f"anarci_{region}_shorter_than_imgt_defined")
    return keep_where(name, lambda: F.col(f"{region}_aa_length") >= threshold, f"{region}_aa_length")


def no_short_fwr1(threshold: int | None = 20) -> RowFilter:
    return _no_short("fwr1", threshold)


def no_short_fwr4(threshold: int | None = 10) -> RowFilter:
    return _no_short("fwr4", threshold)


def no_kappa_gap_21() -> RowFilter:
    return keep_where("NoKappaGap21", lambda: ~F.col("has_kappa_gap_21"), "has_kappa_gap_21")


def no_deletions() -> RowFilter:
    return keep_where("NoDeletions", lambda: F.col("anarci_deletions").isNull(), "anarci_deletions")


def no_insertions_out_of_cdrs() -> RowFilter:
    return keep_where("NoInsertionsOutOfCDRs", lambda: F.col("anarci_insertions").isNull(), "anarci_insertions")


def no_unsupported_cdr3_length() -> RowFilter:
    return keep_where("NoUnsupportedCDR3Length", lambda: ~F.col("anarci_cdr3_is_over_37_aa_long"), "anarci_cdr3_is_over_37_aa_long")


def no_missing_conserved_cysteine() -> RowFilter:
    return keep_where("NoMissingConservedCysteine", lambda: ~F.col("anarci_missing_conserved_cysteine"), "anarci_missing_conserved_cysteine")


def no_unusual_residues() -> RowFilter:
    return keep_where("NoUnusualResidues", lambda: ~F.col("anarci_unusual_residue"), "anarci_unusual_residue")


def count_threshold(threshold: int = 2, column: str = "redundancy") -> RowFilter:
    return keep_where(f"CountThreshold(threshold={threshold})", lambda: F.col(column) >= threshold, column)


def only_isotypes(isotypes: Iterable[str] | str = UNIT_ISOTYPES, column: str = "isotype") -> RowFilter:
    """Rows whose unit declares one of ``isotypes``; ``column`` must be the unit's (see ``attach_units``)."""
    wanted = sorted({isotypes} if isinstance(isotypes, str) else set(isotypes))
    return keep_where(f"OnlyIsotypes(isotypes={wanted})", lambda: F.col(column).isin(wanted), column)


def only_units(units: DataFrame, keys: Sequence[str] = UNIT_KEY, name: str = "OnlyUnits") -> RowFilter:
    """Rows of the given units, by a semi join whose strategy is left to the planner."""
    return RowFilter(name, lambda df: df.join(units.select(*keys), list(keys), "left_semi"), None, tuple(keys))


def no_naive(threshold: int = 2, aligned: str = "v_sequence_alignment_aa", germline: str = "v_germline_alignment_aa") -> RowFilter:
    """Rows that differ from their germline in at least ``threshold`` aligned residues; gaps and X don't count."""

    def mutations() -> Column:
        pairs = F.arrays_zip(F.split(aligned, "").alias("a"), F.split(germline, "").alias("g"))
        plain = lambda c: c.isNotNull() & ~c.isin("-", ".", "X", "")
        return F.size(F.filter(pairs, lambda p: plain(p["a"]) & plain(p["g"]) & (p["a"] != p["g"])))

    return keep_where(f"NoNaive(threshold={threshold})", lambda: mutations() >= threshold, aligned, germline)


def simplify_schema(columns: Sequence[str]) -> RowFilter:
    """Only ``columns``; the planner then reads no others."""
    return RowFilter("SimplifySchema", lambda df: df.select(*columns), None, tuple(columns))


def merge_step(unit: Sequence[str] = UNIT_KEY, value: str = "sequence_aa", order: Sequence[str] = ("index_in_unit", "chain"), unique_order: bool = False) -> RowFilter:
    return RowFilter("MergeRedundant(use_all_known=False)", lambda df: merge_redundant(df, unit, value, order, unique_order=unique_order), None, (*unit, value, *order, "redundancy"))


def dedup_step(value: str = "sequence_aa", order: Sequence[Column | str] | None = None, unique_order: bool = False) -> RowFilter:
    plain = order is None or all(isinstance(c, str) for c in order)
    needs = (value, *(order or (*UNIT_KEY, "index_in_unit", "chain"))) if plain else None
    return RowFilter("NoDuplicates", lambda df: no_duplicates(df, value, order, unique_order), None, needs)


def pipeline(name: str = "none") -> tuple[RowFilter, ...]:
    """The steps of ``none``, ``default`` or ``most-strict``, in order; any other name is a KeyError."""
    shape = (no_insertions_out_of_cdrs(), no_unsupported_cdr3_length(), no_unusual_residues(), no_missing_conserved_cysteine(), no_kappa_gap_21())
    start = (only_productive(), no_short_fwr1(20), no_short_fwr4(10))
    return {
        "none": (),
        "default": (*start, *shape, merge_step(), dedup_step()),
        "most-strict": (merge_step(), count_threshold(3), *start, no_deletions(), *shape, dedup_step()),
    }[name]


def _narrowed(df: DataFrame, steps: Sequence[RowFilter], columns: Sequence[str] | None) -> DataFrame:
    """Only what ``steps`` read and ``columns``, where both are known."""
    if columns is None or any(f.needs is None for f in steps):
        return df
    wanted = {*columns, *(c for f in steps for c in f.needs)}
    return df.select(*(c for c in df.columns if c in wanted))


def run_filters(df: DataFrame, steps: Sequence[RowFilter] | str = "none", columns: Sequence[str] | None = None) -> DataFrame:
    """All steps, one after the other; the planner joins neighbouring predicates into one filter.

    With ``columns``, only these come out, and each step carries no more than what they and the steps after it need.
    """
    steps = list(pipeline(steps) if isinstance(steps, str) else steps)
    for i, f in enumerate(steps):
        # predicates read their columns before the rows are narrowed for what follows
        df = f(df if f.predicate is not None else _narrowed(df, steps[i:], columns))
    return df if columns is None else df.select(*columns)


def run_logged(df: DataFrame, steps: Sequence[RowFilter] | str, by: Sequence[str] = UNIT_KEY, columns: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows that pass all steps, and a log: ``by``, step, name, unfiltered_length, filtered_length, filtered_out.

    A run of row predicates is counted in one aggregation over the rows before it: each row carries how many of the
    run's predicates it passes. A step that aggregates is run once and written to the shared folder; the rows before it
    are those that the step before let pass, so they aren't counted again. Nulls in ``by`` are values.
    """
    steps = list(pipeline(steps) if isinstance(steps, str) else steps)
    logs, at, current, before = [], 0, df, None
    while at < len(steps):
        run = []
        while at + len(run) < len(steps) and (p := steps[at + len(run)].predicate) is not None:
            run.append(p)
        if run:
            failed = None
            for i, p in enumerate(run):
                fails = ~F.coalesce(p(), F.lit(False))
                failed = F.when(fails, i) if failed is None else failed.when(fails, i)
            counts = current.select(*by, failed.otherwise(len(run)).alias("__passed")).groupBy(*by).agg(*(F.count_if(F.col("__passed") >= i).alias(f"__n{i}") for i in range(len(run) + 1)))
            counts = cut(counts, "counts")
            entry = F.explode(
                F.array(*(F.struct(F.lit(at + i).alias("step"), F.lit(steps[at + i].name).alias("name"), F.col(f"__n{i}").alias("unfiltered_length"), F.col(f"__n{i + 1}").alias("filtered_length")) for i in range(len(run))))
            )
            logs.append(counts.select(*by, entry.alias("e")).select(*by, "e.*"))
            before = counts.select(*by, F.col(f"__n{len(run)}").alias("unfiltered_length")).filter("unfiltered_length > 0")
            current = reduce(lambda d, f: f(d), steps[at : at + len(run)], current)
            at += len(run)
        else:
            count = lambda d, n: d.groupBy(*by).agg(F.count(F.lit(1)).alias(n))
            before = count(current, "unfiltered_length") if before is None else before
            kept = None if columns is None else [*columns, *by]
            current = cut(steps[at](_narrowed(current, steps[at:], kept)), "step")
            after = cut(count(current, "filtered_length"), "counts")
            both = join_null_safe(before, after, by)
            logs.append(both.select(*by, F.lit(at).alias("step"), F.lit(steps[at].name).alias("name"), "unfiltered_length", F.coalesce("filtered_length", F.lit(0)).alias("filtered_length")))
            before, at = after.withColumnRenamed("filtered_length", "unfiltered_length"), at + 1
    rows = current if columns is None else current.select(*columns)
    if not logs:
        nothing = df.select(*by).limit(0)
        return rows, nothing.select(*by, F.lit(0).alias("step"), F.lit("").alias("name"), *(F.lit(0).cast("bigint").alias(f"{n}") for n in ("unfiltered_length", "filtered_length", "filtered_out")))
    out = reduce(lambda a, b: a.unionByName(b), logs)
    return rows, out.withColumn("filtered_out", F.col("unfiltered_length") - F.col("filtered_length"))


def filter_log(df: DataFrame, steps: Sequence[RowFilter] | str, by: Sequence[str] = UNIT_KEY) -> DataFrame:
    """The log of ``run_logged`` alone, for which no more than the columns that the steps read is carried."""
    return run_logged(df, steps, by, ())[1]


def log_totals(log: DataFrame) -> DataFrame:
    """Units, sequences and rows filtered out by each step."""
    return log.groupBy("step", "name").agg(F.count(F.lit(1)).alias("units"), F.sum("unfiltered_length").alias("sequences"), F.sum("filtered_out").alias("filtered_out"))
