"""Parquet written by others, metadata JSON, and lists of addresses."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vdjlake.functions.urls import fix_paired_url, parse_unit_url
from vdjlake.schema import SEQUENCE_SCHEMA, UNIT_KEY
from vdjlake.sources.paths import opened, size_of
from vdjlake.storage import over_cores


def read_parquet(spark: SparkSession, path: str | Sequence[str], columns: str | Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return df if columns is None else df.select(*([columns] if isinstance(columns, str) else columns))


def unit_rows(spark: SparkSession, root: str, subset: str | None = None, study: str | None = None, unit: str | None = None, columns: Sequence[str] | None = None, skip_broken: bool = False) -> DataFrame:
    """Rows of a partitioned data set, of one subset, study or unit where given: only their folders are read."""
    reader = spark.read.option("ignoreCorruptFiles", skip_broken).option("ignoreMissingFiles", skip_broken)
    df = reader.parquet(root)
    for name, value in zip(UNIT_KEY, (subset, study, unit)):
        if value is not None:
            df = df.filter(F.col(name) == value)
    return df.select(*columns) if columns else df


def _in_order(f, column: str) -> bool:
    """Whether a Parquet file is sorted by a column, nulls first; read in batches."""
    import pyarrow.compute as pc

    last = None
    for b in f.iter_batches(100_000, columns=[column], use_threads=False):
        values = b.column(0)
        nulls = values.null_count
        if nulls and (last is not None or values[nulls:].null_count):
            return False
        values = values[nulls:]
        if len(values):
            if last is not None and values[0].as_py() < last or not pc.all(pc.less_equal(values[:-1], values[1:]), min_count=0).as_py():
                return False
            last = values[-1].as_py()
    return True


def footers(spark: SparkSession, paths: Sequence[str] | DataFrame, ordered: str | None = None) -> DataFrame:
    """path, num_rows, schema (name:type, by commas), size and error of Parquet files, read on the executors.

    ``paths`` may be a table with a column ``path``, so that the driver needn't hold them. With a column ``ordered``,
    ``in_order`` says whether a file is sorted by it.
    """
    names = ["path", "num_rows", "schema", "size", "error", *(["in_order"] if ordered else [])]

    def run(batches):
        import pandas as pd
        import pyarrow.parquet as pq

        for b in batches:
            rows = []
            for p in b["path"]:
                try:
                    with opened(p) as raw:
                        f = pq.ParquetFile(raw)
                        row = (p, f.metadata.num_rows, ",".join(f"{x.name}:{x.type}" for x in f.schema_arrow), size_of(p), None)
                        rows.append((*row, _in_order(f, ordered)) if ordered else row)
                except Exception as e:  # broken files are what is asked for
                    rows.append((p, None, None, None, f"{type(e).__name__}: {e}", *([None] if ordered else [])))
            yield pd.DataFrame(rows, columns=names)

    given = over_cores(paths.select("path")) if isinstance(paths, DataFrame) else spark.createDataFrame([(p,) for p in paths], "path string")
    return given.mapInPandas(run, "path string, num_rows bigint, schema string, size bigint, error string" + ", in_order boolean" * bool(ordered))


def import_units(spark: SparkSession, paths: Sequence[str], schema: T.StructType = SEQUENCE_SCHEMA, keep: Sequence[str] = ()) -> DataFrame:
    """Files written by pandas as one table of ``schema``. Files are grouped by their own schema and read with it; a
    column that is all null in a file (and has no type there) becomes a null of the right type."""
    groups: dict[str, list[str]] = defaultdict(list)
    for r in footers(spark, paths).collect():  # a row a file
        if r["error"]:
            raise ValueError(f"{r['path']}: {r['error']}")
        groups[r["schema"]].append(r["path"])

    def typed(df: DataFrame, f: T.StructField, kinds: dict[str, str]) -> Column:
        if f.name not in kinds or kinds[f.name] == "null":
            return F.lit(None).cast(f.dataType).alias(f.name)
        return F.col(f.name).cast(f.dataType).alias(f.name)

    frames = []
    for text, files in groups.items():
        kinds = dict(x.split(":", 1) for x in text.split(",") if ":" in x)
        df = spark.read.parquet(*files)
        frames.append(df.select(*keep, *(typed(df, f, kinds) for f in schema)))
    return reduce(lambda a, b: a.unionByName(b), frames)


def unquote_json(line: Column) -> Column:
    """JSON that was quoted once more, as plain JSON; other text stays."""
    text = F.trim(line)
    inner = F.replace(text, F.lit('""'), F.lit('"'))
    return F.when(text.startswith('"'), F.regexp_replace(inner, '^"|"$', "")).otherwise(text)


def metadata_from_json(df: DataFrame, column: str, schema: str) -> DataFrame:
    """The fields of a (perhaps over-quoted) JSON column, and ``json_error`` for text that isn't JSON.

    Field names that differ in case only need spark.sql.caseSensitive.
    """
    parsed = df.withColumn("__m", F.from_json(unquote_json(F.col(column)), schema))
    wrong = F.col(column).isNotNull() & F.try_parse_json(unquote_json(F.col(column))).isNull()
    return parsed.select("*", F.col("__m.*"), wrong.alias("json_error")).drop("__m")


def download_list(spark: SparkSession, path: str, host: str, root: str, strict: bool = True) -> DataFrame:
    """The units in a script of ``command address`` lines: sorted, repaired and parsed. Repeated addresses are an error."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    words = F.split(F.trim("value"), r"\s+")
    urls = lines.select(fix_paired_url(F.element_at(words, -1), root).alias("url"), F.size(words).alias("words"))
    odd, repeated = urls.agg(F.count_if(F.col("words") != 2), F.count(F.lit(1)) - F.count_distinct("url")).first()
    if odd or repeated:
        raise ValueError(f"{odd} lines aren't a command with an address, {repeated} addresses are repeated")
    return urls.select("url", parse_unit_url(F.col("url"), host, root, strict).alias("u")).select("url", "u.*").orderBy("url")
