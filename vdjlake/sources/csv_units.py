"""Units as CSV files: a line of metadata JSON, a header, and rows."""

from __future__ import annotations

import json
from collections.abc import Sequence
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vdjlake.schema import header_family
from vdjlake.sources.paths import open_text
from vdjlake.storage import over_cores


def parse_metadata_line(line: str) -> dict:
    """The metadata of a unit, from JSON that may be quoted once more with doubled quotes."""
    text = line.strip()
    if text.startswith('"'):
        text = text.replace('""', '"')
        text = text[1:-1] if text.endswith('"') else text[1:]
    return json.loads(text)


def peek(path: str) -> tuple[dict, list[str], str]:
    """(metadata, column names, first character) of a unit file, from its first two lines."""
    with open_text(path) as f:
        first, second = f.readline(), f.readline()
    return parse_metadata_line(first), [c.strip().strip('"') for c in second.rstrip("\r\n").split(",")], first.lstrip()[:1]


def unit_headers(spark: SparkSession, paths: Sequence[str] | DataFrame) -> DataFrame:
    """path, metadata (JSON), column_names, family and error of each file; read on the executors, two lines each.

    ``paths`` may be a table with a column ``path``, so that the driver needn't hold them.
    """
    schema = "path string, metadata string, column_names array<string>, first string, family string, error string"

    def run(batches):
        import pandas as pd

        for b in batches:
            rows = []
            for p in b["path"]:
                try:
                    meta, columns, first = peek(p)
                    rows.append((p, json.dumps(meta), columns, first, header_family(columns), None))
                except Exception as e:  # a broken file is a row of the report
                    rows.append((p, None, None, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["path", "metadata", "column_names", "first", "family", "error"])

    if isinstance(paths, DataFrame):
        return over_cores(paths.select("path")).mapInPandas(run, schema)
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    return files.repartition(max(1, min(len(paths), 200))).mapInPandas(run, schema)


def unit_lines(spark: SparkSession, paths: Sequence[str] | DataFrame, lines_a_batch: int = 10_000, heads: Sequence[tuple[str, ...]] | None = None) -> DataFrame:
    """path, line_no (of the rows, from 0), value of the rows of unit files, without metadata and header lines, and head.

    A file is read and numbered by one task, line by line, so that nothing is shuffled or sorted to number it; small
    files share batches and tasks. ``head`` is the place of the file's header in ``heads``; others' files are left out.
    """
    known = None if heads is None else {tuple(x): i for i, x in enumerate(heads)}

    def run(batches):
        import pyarrow as pa

        def made():
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(held, (pa.string(), pa.int64(), pa.string(), pa.int32()))], ["path", "line_no", "value", "head"])

        held = ([], [], [], [])
        for b in batches:
            for path in b.column("path").to_pylist():
                if known is not None:
                    try:
                        head = known.get(tuple(peek(path)[1]))
                    except Exception:  # reported with the headers
                        head = None
                    if head is None:
                        continue
                with open_text(path) as f:
                    f.readline(), f.readline()
                    at = 0
                    while lines := [x.rstrip("\r\n") for x in islice(f, lines_a_batch)]:
                        for to, values in zip(held, ([path] * len(lines), range(at, at + len(lines)), lines, [0 if known is None else head] * len(lines))):
                            to.extend(values)
                        at += len(lines)
                        if len(held[0]) >= lines_a_batch:
                            yield made()
                            held = ([], [], [], [])
        if held[0]:
            yield made()

    schema = "path string, line_no bigint, value string, head int"
    if isinstance(paths, DataFrame):
        return over_cores(paths.select("path")).mapInArrow(run, schema)
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    return files.repartition(max(1, min(len(paths), 32 * spark.sparkContext.defaultParallelism))).mapInArrow(run, schema)


def read_units(spark: SparkSession, paths: Sequence[str] | DataFrame, na_tokens: Sequence[str] = ("",), skip_broken: bool = False) -> DataFrame:
    """Raw string rows of unit files with oas_subset, study_id, unit_id and index_in_unit.

    Files are read as lines, so that the metadata line is left out by its number, whatever the rows look like, and a
    row's number is its place in the file. Lines are then parsed by position with the names of their file's header; a
    row with fewer fields has nulls for the rest. Null is the empty string; other ``na_tokens`` are nulls too where
    given. Ids are the last path parts above the file. Quoted line ends aren't expected in these files. A file is read
    by one task, which may read others too. A file with a broken head is an error or, with ``skip_broken``, left out;
    ``unit_headers`` reports these. Only the kinds of headers reach the driver.
    """
    found = unit_headers(spark, paths)
    kinds = found.groupBy("column_names").agg(F.min(F.when(F.col("error").isNotNull(), F.concat("path", F.lit(": "), "error"))).alias("error")).collect()
    errors = [r["error"] for r in kinds if r["error"]]
    if errors and not skip_broken:
        raise ValueError(min(errors))
    heads = sorted(tuple(r["column_names"]) for r in kinds if r["column_names"] is not None)
    if not heads:
        raise ValueError("no unit that can be read")
    parts = F.split("path", "/")
    keys = [F.element_at(parts, at).alias(name) for at, name in ((-4, "oas_subset"), (-3, "study_id"), (-2, "unit_id"))]
    lines = unit_lines(spark, paths, heads=heads)
    frames = []
    for i, columns in enumerate(heads):
        schema = ", ".join(f"`{c}` string" for c in columns)
        frames.append(F.when(F.col("head") == i, F.from_csv("value", schema, {"quote": '"', "escape": '"'})).alias(f"__r{i}"))
    parsed = lines.select(*keys, F.col("line_no").alias("index_in_unit"), *frames)
    names = list(dict.fromkeys(c for columns in heads for c in columns))
    values = [F.coalesce(*(F.col(f"__r{i}.`{c}`") for i, columns in enumerate(heads) if c in columns)).alias(c) for c in names]
    ids = ("oas_subset", "study_id", "unit_id", "index_in_unit")
    whole = parsed.select(*ids, *values)
    if tuple(na_tokens) != ("",):
        whole = whole.select(*(F.col(c) if c in ids else F.when(~F.col(c).isin(*na_tokens), F.col(c)).alias(c) for c in whole.columns))
    return whole


def check_row_counts(spark: SparkSession, rows: DataFrame, paths: Sequence[str]) -> None:
    """An error where a unit has other than its lines less two; quoted line ends aren't expected in these files."""
    lines = spark.read.text(list(paths)).groupBy(F.col("_metadata.file_path").alias("path")).agg((F.count(F.lit(1)) - 2).alias("lines"))
    parts = F.split(F.url_decode("path"), "/")
    lines = lines.select(F.element_at(parts, -3).alias("study_id"), F.element_at(parts, -2).alias("unit_id"), "lines")
    counted = rows.groupBy("study_id", "unit_id").agg(F.count(F.lit(1)).alias("rows"))
    odd = lines.join(counted, ["study_id", "unit_id"], "left").filter(F.col("lines") != F.coalesce("rows", F.lit(0))).limit(5).collect()
    if odd:
        raise ValueError(f"rows were lost, as in {odd}")
