"""Queries that write the project's tables as files of every kind and read them again; their SQL is what the tables hold."""

from __future__ import annotations

import gzip
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vdjlake import sinks
from vdjlake.operators import dedup, normalize, stats
from vdjlake.plans import repertoire
from vdjlake.schema import HEADER_FAMILIES, UNIT_KEY
from vdjlake.sources import csv_units, files
from vdjlake.storage import shared_dir, table

UNIT = list(UNIT_KEY)
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
CSV = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__], ORACLE_SQL[f.__name__] = f, sql
        return f

    return register


def _folder(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/vdjlake/{label}-{uuid.uuid4().hex}"


def _id_of(part: Column, name: str) -> Column:
    """The value of a partition folder, in which a plus is itself."""
    value = F.url_decode(F.replace(F.substring_index(part, "=", -1), F.lit("+"), F.lit("%2B")))
    return F.nullif(value, F.lit("__HIVE_DEFAULT_PARTITION__")).alias(name)


def _id(name: str) -> Column:
    return _id_of(F.col(name), name)


def _unit_saver(names: tuple[str, ...]):
    """Lines as a compressed unit file: first its metadata, in JSON that is quoted once more, and a header."""

    def save(f, key, batches) -> None:
        meta = json.dumps({"Run": key[-1]}, ensure_ascii=False).replace('"', '""')
        with gzip.GzipFile(fileobj=f, mode="wb", compresslevel=6, mtime=0) as z:
            z.write(f'"{meta}"\n{",".join(names)}\n'.encode())
            for b in batches:
                z.write("".join(f"{x}\n" for x in b.column("value").to_pylist()).encode())

    return save


def _as_unit_files(spark: SparkSession, base: str) -> DataFrame:
    """In these files a null is an empty field. Every unit as a compressed file of a metadata line, a header and rows in the order of record_id."""
    df = table(spark, base, "sequences", *UNIT, "record_id", "locus", "v_call", "j_call", "junction_aa", "redundancy", "productive")
    names = ("sequence_id", "locus", "v_call", "j_call", "junction_aa", "Redundancy", "productive")
    one_line = F.regexp_replace("junction_aa", r"[\r\n]+", " ")  # rows of these files are lines
    row = F.struct(F.col("record_id").alias(names[0]), "locus", "v_call", "j_call", one_line.alias("junction_aa"), F.concat("redundancy", F.lit(".0")).alias("Redundancy"), F.when(F.col("productive"), "T").otherwise("F").alias("productive"))
    lines = df.select(*UNIT, "record_id", F.to_csv(row, CSV).alias("value")).repartition(*UNIT).sortWithinPartitions(*UNIT, "record_id").select(*UNIT, "value")
    return sinks.write_unit_files(lines, _folder(spark, "units"), _unit_saver(names), ".csv.gz").select("path")


@query("""SELECT oas_subset, study_id, unit_id, row_number() OVER (PARTITION BY oas_subset, study_id, unit_id ORDER BY record_id) - 1 AS index_in_unit, CAST(record_id AS VARCHAR) AS sequence_id,
  locus, v_call, j_call, nullif(regexp_replace(junction_aa, '[\\r\\n]+', ' ', 'g'), '') AS junction_aa, redundancy, productive FROM sequences""")
def units_round_trip(spark: SparkSession, base: str) -> DataFrame:
    raw = csv_units.read_units(spark, _as_unit_files(spark, base))
    typed = normalize.numbers(raw).withColumnRenamed("Redundancy", "redundancy")
    return typed.select(*map(_id, UNIT), "index_in_unit", "sequence_id", "locus", "v_call", "j_call", "junction_aa", "redundancy", "productive")


@query("SELECT DISTINCT oas_subset, study_id, unit_id, unit_id AS run, 7 AS num_columns, false AS broken FROM sequences")
def unit_heads(spark: SparkSession, base: str) -> DataFrame:
    """What the first two lines of every unit file say."""
    heads = csv_units.unit_headers(spark, _as_unit_files(spark, base))
    parts = F.split("path", "/")
    ids = [F.element_at(parts, at).alias(n) for at, n in ((-4, "oas_subset"), (-3, "study_id"), (-2, "unit_id"))]
    found = heads.select(*ids, F.get_json_object("metadata", "$.Run").alias("run"), F.size("column_names").alias("num_columns"), F.col("error").isNotNull().alias("broken"))
    return found.select(*map(_id, UNIT), "run", "num_columns", "broken")


@query(repertoire.ORACLE_SQL["pipeline_default"])
def copy_round_trip(spark: SparkSession, base: str) -> DataFrame:
    """The default pipeline through a copy of the data set, partitioned by unit and sorted."""
    copied = sinks.copy_dataset(spark, repertoire.sequences(spark, base), _folder(spark, "copy"), repertoire._steps("default"))
    return files.unit_rows(spark, f"{copied}/sequences", columns=["record_id", "redundancy"])


@query(repertoire.ORACLE_SQL["filter_log"])
def copy_log(spark: SparkSession, base: str) -> DataFrame:
    """The log that a copy leaves beside its rows."""
    copied = sinks.copy_dataset(spark, repertoire.sequences(spark, base), _folder(spark, "copy"), repertoire._steps("default"))
    return spark.read.parquet(f"{copied}/logs").drop("name")


@query("SELECT oas_subset, study_id, unit_id, count(*) AS num_rows, true AS in_order FROM sequences GROUP BY ALL")
def footers(spark: SparkSession, base: str) -> DataFrame:
    """Rows of each unit by the footers of its files, and whether these are sorted by sequence."""
    written = sinks.write_sequences(table(spark, base, "sequences", *UNIT, "record_id", "sequence_aa"), _folder(spark, "sorted"))
    found = files.footers(spark, written, "sequence_aa")
    parts = F.split("path", "/")
    ids = [_id_of(F.element_at(parts, at), n) for at, n in ((-4, "oas_subset"), (-3, "study_id"), (-2, "unit_id"))]
    # a file that can't be read has no rows and isn't in order
    return found.select(*ids, "num_rows", F.coalesce("in_order", F.lit(False)).alias("in_order")).groupBy(*UNIT).agg(F.sum("num_rows").alias("num_rows"), F.bool_and("in_order").alias("in_order"))


@query(repertoire.ORACLE_SQL["unique_index"])
def index_round_trip(spark: SparkSession, base: str) -> DataFrame:
    path = _folder(spark, "index")
    sinks.write_index(dedup.unique_index(table(spark, base, "sequences", *UNIT, "sequence_aa")), path)
    return spark.read.parquet(path).select("sequence_aa", F.array_join("units", " ").alias("units"), F.col("num_units").cast("bigint").alias("num_units"))


@query("SELECT DISTINCT oas_subset, study_id, unit_id, unit_id || '.csv.gz' AS file_name FROM unit_metadata")
def download_list(spark: SparkSession, base: str) -> DataFrame:
    """A script of commands with the addresses of all units, those of paired ones without a slash, read again."""
    df = table(spark, base, "unit_metadata", *UNIT).distinct()
    slash = F.when(F.col("oas_subset") == "paired", "").otherwise("/")
    line = F.concat(F.lit(f"wget http://{repertoire.HOST}/{repertoire.ROOT}/"), "oas_subset", slash, "study_id", F.lit("/csv/"), "unit_id", F.lit(".csv.gz"))
    path = _folder(spark, "script")
    df.select(line.alias("value")).write.text(path)
    return files.download_list(spark, path, repertoire.HOST, repertoire.ROOT).select(*UNIT, "file_name")


_FAMILY = "CASE length(unit_id) % 5 WHEN 0 THEN 'U1' WHEN 1 THEN 'U2' WHEN 2 THEN 'P1' WHEN 3 THEN 'P2' ELSE 'none' END"
_COUNT = "CASE length(unit_id) % 5 " + " ".join(f"WHEN {i} THEN {len(HEADER_FAMILIES[f])}" for i, f in enumerate(("U1", "U2", "P1", "P2"))) + " ELSE 96 END"


@query(f"SELECT nullif({_FAMILY}, 'none') AS family, {_COUNT} AS num_columns, count(*) AS num_units, count(DISTINCT oas_subset) AS num_subsets, count(DISTINCT study_id) AS num_studies FROM unit_metadata GROUP BY 1, 2")
def schema_families(spark: SparkSession, base: str) -> DataFrame:
    """Units grouped by the columns of their headers: the four known families, and one that lacks a column of the first."""
    known = [sorted(HEADER_FAMILIES[f]) for f in ("U1", "U2", "P1", "P2")]
    headers = [*known, known[0][1:]]
    names = F.lit(None).cast("array<string>")
    for i, columns in enumerate(headers):
        names = F.when(F.length("unit_id") % 5 == i, F.split(F.lit(",".join(columns)), ",")).otherwise(names)
    groups = stats.schema_groups(table(spark, base, "unit_metadata", "oas_subset", "study_id", "unit_id").withColumn("column_names", names), expected=HEADER_FAMILIES)
    return groups.select("family", F.size(F.split("columns", ",")).alias("num_columns"), "num_units", "num_subsets", "num_studies")
