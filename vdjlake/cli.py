"""``python -m vdjlake.cli``: imports, copies, statistics and reports from the command line."""

from __future__ import annotations

import argparse
import glob
import sys
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vdjlake import sinks
from vdjlake.functions.status import parse_status
from vdjlake.operators import dedup, metadata, normalize, stats
from vdjlake.schema import HEADER_FAMILIES, SEQUENCE_SCHEMA
from vdjlake.session import build_session, ship
from vdjlake.sources import csv_units, files


def _paths(pattern: str) -> list[str]:
    found = sorted(glob.glob(pattern, recursive=True))
    if not found:
        raise FileNotFoundError(pattern)
    return found


def populate_metadata(spark: SparkSession, a: argparse.Namespace) -> None:
    """Unit metadata from JSON files."""
    spark.conf.set("spark.sql.caseSensitive", "true")
    sinks.write_parquet(metadata.nice_metadata(spark.read.json(_paths(a.source), multiLine=True)), a.target, mode=a.mode)


def process_units(spark: SparkSession, a: argparse.Namespace) -> None:
    """Unit files to the canonical data set; bad rows go to ``<target>-quarantine``."""
    good, bad = normalize.canonical_rows(csv_units.read_units(spark, _paths(a.source)))
    sinks.write_sequences(good, a.target, mode=a.mode)
    sinks.write_parquet(bad, f"{a.target}-quarantine", mode=a.mode)


def copy(spark: SparkSession, a: argparse.Namespace) -> None:
    """A sampled and filtered copy of a data set."""
    units = spark.read.parquet(a.units) if a.units else None
    sinks.copy_dataset(spark, files.unit_rows(spark, a.source), a.target, a.filtering_strategy, units, a.unit_probability, a.max_rows_a_unit, a.mode)


def consolidate_stats(spark: SparkSession, a: argparse.Namespace) -> None:
    """Positional counts and length histograms of each unit."""
    rows = files.unit_rows(spark, a.source)
    by = ["oas_subset", "study_id", "unit_id", "chain"]
    sinks.write_parquet(stats.position_counts(rows, by), f"{a.target}/positions", mode=a.mode)
    sinks.write_parquet(stats.length_histogram(rows, by=by), f"{a.target}/sequence_lengths", mode=a.mode)
    sinks.write_parquet(stats.region_length_histograms(rows, by=by), f"{a.target}/region_lengths", mode=a.mode)


def summarize_stats(spark: SparkSession, a: argparse.Namespace) -> None:
    """Unit statistics added up to a matrix and histograms of each chain."""
    positions = stats.merge_counts([spark.read.parquet(f"{a.source}/positions")], ["chain", "position", "residue"], "count")
    sinks.write_parquet(stats.position_matrix(positions, ["chain"]), f"{a.target}/matrix", mode=a.mode)
    for name, keys in (("sequence_lengths", ["chain", "length"]), ("region_lengths", ["chain", "region", "length"])):
        sinks.write_parquet(stats.merge_counts([spark.read.parquet(f"{a.source}/{name}")], keys, "count"), f"{a.target}/{name}", mode=a.mode)


def build_index(spark: SparkSession, a: argparse.Namespace) -> None:
    """Index of unique sequences."""
    sinks.write_index(dedup.unique_index(files.unit_rows(spark, a.source)), a.target, a.mode)


def check_units(spark: SparkSession, a: argparse.Namespace) -> None:
    """Headers of unit files: what family, or what is wrong."""
    heads = csv_units.unit_headers(spark, _paths(a.source))
    heads.groupBy("family", F.col("error").isNotNull().alias("broken")).count().orderBy("family").show(len(HEADER_FAMILIES) * 2 + 2, False)


def check_status(spark: SparkSession, a: argparse.Namespace) -> None:
    """Status strings of unit files that no rule knows."""
    long = normalize.unpivot_pairs(csv_units.read_units(spark, _paths(a.source)), ["unit_id"])
    unknown = long.select(F.explode(parse_status(F.col("ANARCI_status"))["unknown"]).alias("unknown"))
    unknown.groupBy("unknown").count().orderBy(F.desc("count")).show(100, False)


def diagnose(spark: SparkSession, a: argparse.Namespace) -> None:
    """Units with fewer records than declared, units without records, and records without a unit."""
    units, rows = spark.read.parquet(a.units), files.unit_rows(spark, a.source)
    counts = stats.chain_counts(rows, ["oas_subset", "study_id", "unit_id"])
    reports: dict[str, DataFrame] = {
        "fewer records than declared": metadata.miss_processing(units, counts),
        "units without records": metadata.units_without(units, counts),
        "records without a unit": metadata.units_without(counts, units),
    }
    for name, report in reports.items():
        print(f"{name}: {report.count()}")
        report.show(20, False)


def check_schema(spark: SparkSession, a: argparse.Namespace) -> None:
    """Parquet files whose columns aren't the canonical ones."""
    paths = [p for p in _paths(a.source) if p.endswith(".parquet")]
    names = F.transform(F.split("schema", ","), lambda x: F.split_part(x, F.lit(":"), F.lit(1)))
    expected = F.array(*map(F.lit, SEQUENCE_SCHEMA.names))
    files.footers(spark, paths).filter(F.col("error").isNotNull() | (F.size(F.array_except(expected, names)) > 0)).select("path", "num_rows", "error").show(100, False)


COMMANDS: dict[str, Callable[[SparkSession, argparse.Namespace], None]] = {
    f.__name__.replace("_", "-"): f
    for f in (populate_metadata, process_units, copy, consolidate_stats, summarize_stats, build_index, check_units, check_status, diagnose, check_schema)
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="vdjlake", description=__doc__)
    commands = p.add_subparsers(dest="command", required=True)
    for name, f in COMMANDS.items():
        c = commands.add_parser(name, help=f.__doc__)
        c.add_argument("source", help="folder, or pattern of files")
        c.add_argument("--shared", help="folder for intermediate tables, which all executors share")
        if name not in ("check-units", "check-status", "diagnose", "check-schema"):
            c.add_argument("target")
            c.add_argument("--mode", choices=("errorifexists", "overwrite"), default="errorifexists")
        if name in ("copy", "diagnose"):
            c.add_argument("--units", help="unit metadata", required=name == "diagnose")
        if name == "copy":
            c.add_argument("--filtering-strategy", choices=("none", "default", "most-strict"), default="none")
            c.add_argument("--unit-probability", type=float, default=0.0)
            c.add_argument("--max-rows-a-unit", type=int, default=-1)
    return p


def main(arguments: Sequence[str] | None = None) -> int:
    a = parser().parse_args(arguments)
    spark = build_session(shared=a.shared)
    ship(spark)
    COMMANDS[a.command](spark, a)
    return 0


if __name__ == "__main__":
    sys.exit(main())
