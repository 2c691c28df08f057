"""Queries on snapshots (problem 5) and on skewed keys (problem 6), with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vdjlake.operators.skew import count_mismatches, key_quantiles, record_counts, roll_up
from vdjlake.operators.snapshots import change_counts, snapshot_changes, strip
from vdjlake.storage import table

UNIT = ["study_id", "unit_id"]


def _changes(spark: SparkSession, base: str) -> DataFrame:
    df = table(spark, base, "unit_snapshots", "snapshot_no", "delivered_at", *UNIT, "download_date", "online_modified_date", "online_csv_size_bytes")
    return snapshot_changes(
        df,
        "snapshot_no",
        {"study_id": F.col("study_id"), "unit_id": strip("unit_id")},
        {"online_modified_date": F.date_trunc("minute", "online_modified_date"), "online_csv_size_bytes": F.col("online_csv_size_bytes")},
        ["delivered_at", "download_date"],
    )


def p5_found(spark: SparkSession, base: str) -> DataFrame:
    return _changes(spark, base).select("snapshot_no", *UNIT, "change_kind")


def p5_changed_columns(spark: SparkSession, base: str) -> DataFrame:
    return _changes(spark, base).select("snapshot_no", *UNIT, "change_kind", F.array_join("changed_columns", ",").alias("changed_columns"))


def p5_study_counts(spark: SparkSession, base: str) -> DataFrame:
    return change_counts(_changes(spark, base), "snapshot_no", "study_id")


def _unit_counts(spark: SparkSession, base: str) -> DataFrame:
    return record_counts(table(spark, base, "sequences", *UNIT, "index_in_unit", "chain"), UNIT, ["index_in_unit", "chain"])


def p6_found(spark: SparkSession, base: str) -> DataFrame:
    units = table(spark, base, "unit_metadata", *UNIT, "sequences_num_records")
    return count_mismatches(units, _unit_counts(spark, base), UNIT, "sequences_num_records", "num_records").select(*UNIT).distinct()


def p6_unit_counts(spark: SparkSession, base: str) -> DataFrame:
    """Records of each unit that has any, beside the declared number."""
    units = table(spark, base, "unit_metadata", *UNIT, "sequences_num_records").groupBy(*UNIT).agg(F.max("sequences_num_records").alias("declared"))
    return _unit_counts(spark, base).join(units, UNIT, "left").select(*UNIT, "num_records", "declared")


def p6_study_counts(spark: SparkSession, base: str) -> DataFrame:
    """Units and records of each study, beside the sum of the declared numbers."""
    units = table(spark, base, "unit_metadata", *UNIT, "sequences_num_records").groupBy(*UNIT).agg(F.max("sequences_num_records").alias("declared"))
    both = units.join(_unit_counts(spark, base), UNIT, "full_outer").select(*UNIT, F.coalesce("num_records", F.lit(0)).alias("num_records"), "declared", F.lit(1).alias("num_units"))
    return roll_up(both, ["study_id"], "num_records", "declared", "num_units")


def p6_study_quantiles(spark: SparkSession, base: str) -> DataFrame:
    """Quartiles and the 99 % point of redundancy in each study, over all rows."""
    return key_quantiles(table(spark, base, "sequences", "study_id", "redundancy"), ["study_id"], "redundancy", [0.25, 0.5, 0.75, 0.99])


QUERIES = {f.__name__: f for f in (p5_found, p5_changed_columns, p5_study_counts, p6_found, p6_unit_counts, p6_study_counts, p6_study_quantiles)}

_CHANGES = """
WITH latest AS (
  SELECT snapshot_no, study_id, regexp_replace(unit_id, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') AS unit_id,
         date_trunc('minute', online_modified_date) AS modified, online_csv_size_bytes AS bytes,
         row_number() OVER (PARTITION BY snapshot_no, study_id, regexp_replace(unit_id, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g')
                            ORDER BY delivered_at DESC, download_date DESC) AS rn
  FROM unit_snapshots),
one AS (SELECT * FROM latest WHERE rn = 1),
ends AS (SELECT min(snapshot_no) AS lo, max(snapshot_no) AS hi FROM one),
now AS (SELECT one.* FROM one, ends WHERE snapshot_no > lo),
before AS (SELECT one.* REPLACE (snapshot_no + 1 AS snapshot_no) FROM one, ends WHERE snapshot_no < hi),
changes AS (
  SELECT coalesce(n.snapshot_no, b.snapshot_no) AS snapshot_no, coalesce(n.study_id, b.study_id) AS study_id,
         coalesce(n.unit_id, b.unit_id) AS unit_id,
         CASE WHEN b.rn IS NULL THEN 'added' WHEN n.rn IS NULL THEN 'removed'
              WHEN n.modified IS DISTINCT FROM b.modified OR n.bytes IS DISTINCT FROM b.bytes THEN 'changed' END AS change_kind,
         n.modified IS DISTINCT FROM b.modified AS m, n.bytes IS DISTINCT FROM b.bytes AS s
  FROM now n FULL OUTER JOIN before b
    ON n.snapshot_no = b.snapshot_no AND n.study_id = b.study_id AND n.unit_id = b.unit_id)
"""
_COUNTS = """
WITH counted AS (
  SELECT study_id, unit_id, count(*) AS num_records
  FROM (SELECT DISTINCT study_id, unit_id, index_in_unit, chain FROM sequences) GROUP BY 1, 2),
units AS (SELECT study_id, unit_id, max(sequences_num_records) AS declared FROM unit_metadata GROUP BY 1, 2)
"""

ORACLE_SQL = {
    "p5_found": _CHANGES + "SELECT snapshot_no, study_id, unit_id, change_kind FROM changes WHERE change_kind IS NOT NULL",
    "p5_changed_columns": _CHANGES
    + """SELECT snapshot_no, study_id, unit_id, change_kind,
      CASE WHEN change_kind = 'changed' THEN concat_ws(',', CASE WHEN m THEN 'online_modified_date' END, CASE WHEN s THEN 'online_csv_size_bytes' END) END AS changed_columns
      FROM changes WHERE change_kind IS NOT NULL""",
    "p5_study_counts": _CHANGES
    + """SELECT snapshot_no, study_id, count(*) FILTER (change_kind = 'added') AS num_added, count(*) FILTER (change_kind = 'removed') AS num_removed,
      count(*) FILTER (change_kind = 'changed') AS num_changed FROM changes WHERE change_kind IS NOT NULL GROUP BY 1, 2""",
    "p6_found": _COUNTS
    + """SELECT DISTINCT u.study_id, u.unit_id FROM unit_metadata u LEFT JOIN counted c ON u.study_id = c.study_id AND u.unit_id = c.unit_id
      WHERE u.sequences_num_records IS NOT NULL AND u.sequences_num_records <> coalesce(c.num_records, 0)""",
    "p6_unit_counts": _COUNTS + "SELECT c.study_id, c.unit_id, c.num_records, u.declared FROM counted c LEFT JOIN units u USING (study_id, unit_id)",
    "p6_study_counts": _COUNTS
    + """SELECT study_id, CAST(sum(coalesce(num_records, 0)) AS BIGINT) AS num_records, CAST(sum(declared) AS BIGINT) AS declared, count(*) AS num_units
      FROM units FULL OUTER JOIN counted USING (study_id, unit_id) GROUP BY 1""",
    "p6_study_quantiles": """
WITH v AS (SELECT study_id, redundancy, row_number() OVER (PARTITION BY study_id ORDER BY redundancy) AS rn,
                  count(*) OVER (PARTITION BY study_id) AS n FROM sequences WHERE redundancy IS NOT NULL),
q AS (SELECT unnest([0.25::DOUBLE, 0.5, 0.75, 0.99]) AS quantile)
SELECT study_id, quantile, greatest(1, ceil(quantile * n))::BIGINT AS rank, redundancy AS quantile_value
FROM v, q WHERE rn = greatest(1, ceil(quantile * n))::BIGINT""",
}
