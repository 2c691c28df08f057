"""From wide string rows of source files to the canonical sequence table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vdjlake.functions.numbering import with_numbering
from vdjlake.functions.scalars import loose_int, tf_flag
from vdjlake.schema import DOUBLE_COLUMNS, FLAGS, INT_COLUMNS, OFFSET_STRETCHES, REGIONS, SEQUENCE_SCHEMA, SOURCE_NAMES, U1
from vdjlake.storage import cut

SUFFIXES = ("", "_heavy", "_light")
CANDIDATES = tuple(sorted({*U1, "sequence_id", "Isotype"}))
#: Stretch lengths that may be negative in sources.
SIGNED = ("d_germline_length",)


def strip_suffix(df: DataFrame, suffix: str, keep: Sequence[str], candidates: Sequence[str] = CANDIDATES) -> DataFrame | None:
    """The columns of one chain under their plain names, beside ``keep``; None where the suffix has no column.

    A row without any value in them has no record of that chain and is left out, so that files of different headers
    can be in one table.
    """
    there = [c for c in candidates if f"{c}{suffix}" in df.columns]
    if not there:
        return None
    some = F.coalesce(*(F.col(f"{c}{suffix}").cast("string") for c in there)).isNotNull()
    return df.filter(some).select(*keep, *(F.col(f"{c}{suffix}").alias(c) for c in there))


def unpivot_pairs(df: DataFrame, keep: Sequence[str], candidates: Sequence[str] = CANDIDATES) -> DataFrame:
    """One row a chain: a paired row becomes two with the same ``keep``, an unpaired one stays. One scan a suffix."""
    frames = [f for s in SUFFIXES if (f := strip_suffix(df, s, keep, candidates)) is not None]
    if not frames:
        raise ValueError("none of the known columns is there")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def zero_based(df: DataFrame, stretches: Sequence[str] = OFFSET_STRETCHES, strict_names: bool = True) -> DataFrame:
    """1-based inclusive ``_start`` and ``_end`` become a 0-based ``_start`` and a ``_length``; ends are dropped.

    A stretch with only one of the two columns is an error, and so is a start or end of an unknown stretch.
    """
    computed = {f"{r}_aa_start" for r in REGIONS}
    for c in df.columns:
        if c not in computed and c.endswith(("_start", "_end")) and strict_names and c.rpartition("_")[0] not in stretches:
            raise ValueError(f"{c} is of no known stretch")
    new: dict[str, Column] = {}
    ends = []
    for s in stretches:
        start, end = f"{s}_start" in df.columns, f"{s}_end" in df.columns
        if start != end:
            raise ValueError(f"{s} has only one of start and end")
        if start:
            new[f"{s}_length"] = 1 + F.col(f"{s}_end") - F.col(f"{s}_start")
            new[f"{s}_start"] = F.col(f"{s}_start") - 1
            ends.append(f"{s}_end")
    return df.withColumns(new).drop(*ends) if new else df


def numbers(df: DataFrame) -> DataFrame:
    """String columns of whole numbers (also written 33.0), measures and T/F flags as their types."""
    new: dict[str, Column] = {}
    bounds = [f"{s}_{e}" for s in OFFSET_STRETCHES for e in ("start", "end")]
    for c in (*bounds, *INT_COLUMNS, "Redundancy"):
        if c in df.columns and dict(df.dtypes)[c] == "string":
            new[c] = loose_int(F.col(c), "bigint")
    for c in DOUBLE_COLUMNS:
        if c in df.columns and dict(df.dtypes)[c] == "string":
            new[c] = F.col(c).try_cast("double")
    for c in FLAGS:
        if c in df.columns and dict(df.dtypes)[c] == "string":
            new[c] = tf_flag(F.col(c), strict=False)
    return df.withColumns(new) if new else df


def conform(df: DataFrame, schema=SEQUENCE_SCHEMA, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` and the columns of ``schema`` in its order and types; missing ones null, an unexpected one an error."""
    spurious = [c for c in df.columns if c not in schema.names and c not in keep]
    if spurious:
        raise ValueError(f"unexpected columns: {', '.join(sorted(spurious))}")
    there = set(df.columns)
    return df.select(*keep, *((F.col(f.name) if f.name in there else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema))


def row_errors(df: DataFrame, flag_sources: Sequence[str] = ()) -> Column:
    """Why a row can't be in the canonical table: its numbering, a negative length, or a flag that is neither T nor F."""
    reasons = [F.col("numbering_error")] if "numbering_error" in df.columns else []
    for c in df.columns:
        if c in INT_COLUMNS and c not in SIGNED and c.endswith(("_length", "_start")):
            reasons.append(F.when(F.col(c) < 0, f"negative {c}"))
    reasons += [F.when(F.col(c).isNotNull() & ~F.col(c).isin("T", "F"), f"{c} is neither T nor F") for c in flag_sources]
    return F.nullif(F.concat_ws("; ", *reasons), F.lit("")) if reasons else F.lit(None).cast("string")


def canonical_rows(raw: DataFrame, keep: Sequence[str] = ("oas_subset", "study_id", "unit_id")) -> tuple[DataFrame, DataFrame]:
    """(rows of the canonical table, quarantined rows with ``error``) of raw rows with ``keep`` and ``index_in_unit``.

    One narrow pipeline without a shuffle, written once to the shared folder, as both results come from it: a filter on
    the error would otherwise repeat the parsing. A bad row goes to quarantine; the others of its unit stay.
    """
    ids = [*keep, "index_in_unit"]
    long = unpivot_pairs(raw, ids)
    for c in ("ANARCI_status", "ANARCI_numbering", "locus", "cdr3_aa"):
        if c not in long.columns:
            long = long.withColumn(c, F.lit(None).cast("string"))
    flags = [c for c in FLAGS if c in long.columns and dict(long.dtypes)[c] == "string"]
    bad_flag = row_errors(long.select(*flags), flags) if flags else F.lit(None).cast("string")
    long = long.withColumn("__flag_error", bad_flag)
    typed = zero_based(numbers(long))
    typed = with_numbering(typed).withColumn("chain", F.when(F.col("locus") == "H", "heavy").otherwise("light"))
    error = F.nullif(F.concat_ws("; ", F.col("__flag_error"), row_errors(typed)), F.lit(""))
    typed = cut(typed.withColumn("error", error).drop("__flag_error", "numbering_error", "ANARCI_numbering", "ANARCI_status"), "canonical")
    good = typed.filter("error IS NULL").drop("error").withColumnsRenamed({k: v for k, v in SOURCE_NAMES.items() if v != "anarci_status"})
    bad = typed.filter("error IS NOT NULL").select(*ids, "chain", "error")
    return conform(good, keep=list(keep)), bad
