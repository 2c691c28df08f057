"""Unit metadata: normalised view, checks against what is there, and the columns it lends to records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vdjlake.functions.scalars import floor_minute, http_date, loose_int, normalize_species, study_year
from vdjlake.schema import UNIT_KEY

#: Names in unit files and here; fixed values.
RENAMED = {
    "url": "original_url", "http_error": "download_error", "Date": "download_date", "Last-Modified": "online_modified_date",
    "Content-Length": "online_csv_size_bytes", "Run": "sequencing_run", "Link": "publication_link", "Author": "study_author",
    "Species": "species", "Age": "age", "BSource": "bsource", "BType": "btype", "Subject": "subject", "Disease": "disease",
    "Vaccine": "vaccine", "Longitudinal": "longitudinal", "Chain": "chain", "Isotype": "isotype",
    "Unique sequences": "theoretical_num_sequences_unique", "Total sequences": "theoretical_num_sequences_total",
}


def nice_metadata(raw: DataFrame) -> DataFrame:
    """Rows as unit files have them, with our names and types, ``study_year`` and ``normalized_species``."""
    low = {"chain", "isotype"} & set(raw.columns)  # as read from the address; the file's own are kept
    df = raw.drop(*low).withColumnsRenamed({k: v for k, v in RENAMED.items() if k in raw.columns})
    new = {}
    for c in ("download_date", "online_modified_date"):
        if c in df.columns:
            new[c] = http_date(F.col(c)) if dict(df.dtypes)[c] == "string" else floor_minute(F.col(c))
    for c in ("online_csv_size_bytes", "theoretical_num_sequences_unique", "theoretical_num_sequences_total"):
        if c in df.columns and dict(df.dtypes)[c] == "string":
            new[c] = loose_int(F.col(c), "bigint")
    if "study_author" in df.columns:
        new["study_year"] = study_year(F.col("study_author"))
    if "species" in df.columns:
        new["normalized_species"] = normalize_species(F.col("species"))
    return df.withColumns(new)


def usable_units(units: DataFrame, keep_missing: bool = False) -> DataFrame:
    """Units whose download had no error."""
    return units if keep_missing else units.filter(F.col("download_error").isNull())


def attach_units(rows: DataFrame, units: DataFrame, columns: Sequence[str], key: Sequence[str] = UNIT_KEY, order: str = "download_date") -> DataFrame:
    """``rows`` with ``columns`` of their unit; a clashing column of ``rows`` is replaced. Rows of no unit have nulls.

    A unit that stands more than once lends the values of one of its rows, so that no row is doubled: of the latest
    ``order``, where the table has that column, and of the largest values among those. Whether the units are sent to all
    tasks is left to the planner, which knows their size.
    """
    latest = [F.col(order).alias("__order")] if order in units.columns else []
    once = units.groupBy(*key).agg(F.max(F.struct(*latest, *columns)).alias("__unit")).select(*key, *(F.col(f"__unit.{c}").alias(c) for c in columns))
    return rows.drop(*columns).join(once, list(key), "left")


def stale_units(units: DataFrame, local: str = "original_local_csv_mdate", online: str = "online_modified_date", size: str = "online_csv_size_bytes", local_size: str = "local_csv_size_bytes") -> DataFrame:
    """Units to be downloaded again: no local file, one older than online by the minute, or one of another size."""
    older = floor_minute(F.col(local)) < floor_minute(F.col(online))
    return units.filter(F.col(local).isNull() | older | (F.col(size) != F.col(local_size)))


def miss_processing(units: DataFrame, counts: DataFrame, key: Sequence[str] = UNIT_KEY, declared: str = "theoretical_num_sequences_unique", counted: str = "num_records") -> DataFrame:
    """Units with fewer counted than declared records; a unit without any has 0. Declared nulls aren't held against it."""
    right = counts.select(*key, counted)
    both = units.select(*key, declared).join(right, list(key), "left").withColumn(counted, F.coalesce(counted, F.lit(0)))
    return both.filter(F.col(counted) < F.col(declared)).distinct()


def units_without(left: DataFrame, right: DataFrame, key: Sequence[str] = UNIT_KEY) -> DataFrame:
    """Units of ``left`` that ``right`` doesn't have: on disk but not listed, or listed and not yet processed."""
    return left.select(*key).distinct().join(right.select(*key), list(key), "left_anti")


def unit_ids(df: DataFrame, key: Sequence[str] = UNIT_KEY) -> DataFrame:
    """The distinct units of a table in processing order: paired before unpaired, then by study and unit."""
    return df.select(*key).distinct().orderBy(*key)


def one_unit(units: DataFrame, subset: str, study: str, unit: str) -> DataFrame:
    """The row of a unit; an error unless there is exactly one."""
    row = units.filter((F.col("oas_subset") == subset) & (F.col("study_id") == study) & (F.col("unit_id") == unit))
    n = len(row.limit(2).collect())
    if n != 1:
        raise LookupError(f"{'no' if not n else 'more than one'} unit {subset}/{study}/{unit}")
    return row
