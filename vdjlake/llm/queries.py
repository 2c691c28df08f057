"""Queries of the training-data operators on this project's tables, and their SQL where there is any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vdjlake.llm import canonical, heavy_hitters, linked_splits, mixing, mojibake, overlap, packing
from vdjlake.llm.residues import residues
from vdjlake.storage import table

RESIDUE_FIELDS = ("sequence_aa", "junction_aa")
UNIT = ["study_id", "unit_id"]
#: What a subject may say without naming anyone; fixed values given by the problem.
NO_SUBJECT = r"^(no|none|pooled|unknown|na|(donor|subject|patient|mouse|animal|participant)?\p{Nd}+)?$"


def _frequent(spark: SparkSession, base: str) -> DataFrame:
    return heavy_hitters.frequent_values(table(spark, base, "sequences", *RESIDUE_FIELDS), {f: residues(f) for f in RESIDUE_FIELDS}, 0.005)


def p1_found(spark: SparkSession, base: str) -> DataFrame:
    return _frequent(spark, base).select("field_name", "item")


def p1_counts(spark: SparkSession, base: str) -> DataFrame:
    return _frequent(spark, base).select("field_name", "item", "item_count", "field_rows")


def _subject_edges(spark: SparkSession, base: str) -> DataFrame:
    subject = F.regexp_replace(F.lower("subject"), r"[^\p{L}\p{N}]", "")
    units = table(spark, base, "unit_metadata", "study_id", "subject").select(F.col("study_id").alias("record"), subject.alias("entity"))
    return units.filter(~F.col("entity").rlike(NO_SUBJECT))


def p2_found(spark: SparkSession, base: str) -> DataFrame:
    parts = linked_splits.components(_subject_edges(spark, base))
    return linked_splits.linked_pairs(parts.withColumnRenamed("record", "study_id"), "study_id")


def _assigned(spark: SparkSession, base: str) -> tuple[DataFrame, dict[str, float]]:
    targets = {r["ml_subset"]: r["target_share"] for r in table(spark, base, "split_targets").collect()}  # 3 rows, fixed
    units = table(spark, base, "unit_metadata", *UNIT, "chain").distinct()
    parts = linked_splits.components(_subject_edges(spark, base)).withColumnRenamed("record", "study_id")
    whole = units.join(parts, "study_id", "left").withColumn("component", F.coalesce("component", "study_id"))
    return linked_splits.assign_groups(whole, "component", "chain", targets), targets


def p2_assignment(spark: SparkSession, base: str) -> DataFrame:
    return _assigned(spark, base)[0].select(*UNIT, F.col("split").alias("ml_subset"))


def p2_shares(spark: SparkSession, base: str) -> DataFrame:
    """Shares reached, of all units and of the units of each chain."""
    assigned, targets = _assigned(spark, base)
    return linked_splits.split_shares(assigned, targets).select(F.lit("all").alias("chain"), "*").unionByName(linked_splits.split_shares(assigned, targets, ["chain"]))


def _overlaps(spark: SparkSession, base: str, measures: bool = False) -> DataFrame:
    rows = table(spark, base, "sequences", "record_id", "study_id", "ml_subset", *RESIDUE_FIELDS)
    return overlap.split_overlaps(rows, residues("sequence_aa"), residues("junction_aa"), measures=measures)


def p3_found(spark: SparkSession, base: str) -> DataFrame:
    return _overlaps(spark, base).select("record_id").distinct()


def p3_study_counts(spark: SparkSession, base: str) -> DataFrame:
    """Overlapping and all evaluation records of each split and study, those that are equal, and the mean containment."""
    every = table(spark, base, "sequences", "study_id", "ml_subset").filter(F.col("ml_subset").isin("validation", "test"))
    every = every.groupBy("ml_subset", "study_id").agg(F.count(F.lit(1)).alias("num_records"))
    hit = _overlaps(spark, base, True).groupBy("ml_subset", "study_id").agg(
        F.count(F.lit(1)).alias("num_overlapping"), F.count_if(F.col("edits") == 0).alias("num_equal"), F.avg("containment").alias("mean_containment")
    )
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("num_overlapping", "num_equal")]
    return every.join(hit, ["ml_subset", "study_id"], "left").select("ml_subset", "study_id", "num_records", *zero, "mean_containment")


FREE_FIELDS = ("species", "btype", "vaccine")


def _mapped(spark: SparkSession, base: str) -> DataFrame:
    entries = canonical.read_entries(table(spark, base, "reference_values"))
    typed = canonical.free_values(table(spark, base, "unit_metadata", *UNIT, *FREE_FIELDS), FREE_FIELDS, entries, *UNIT)
    return canonical.map_values(typed, entries)


def p4_found(spark: SparkSession, base: str) -> DataFrame:
    return _mapped(spark, base).select(*UNIT, "field_name", "ref_id").distinct()


def p4_values(spark: SparkSession, base: str) -> DataFrame:
    """Every typed value with its entry (0: none), all entries it mentions, and how often it stands; values without one are the report."""
    return _mapped(spark, base).groupBy("field_name", "value", "ref_id", "how", F.array_join("mentions", ",").alias("mentions")).agg(F.count(F.lit(1)).alias("num_rows"))


def _budgets(spark: SparkSession, base: str) -> list[tuple[str, int]]:
    return [(r["container_kind"], r["capacity_tokens"]) for r in table(spark, base, "token_budgets").orderBy("container_kind").collect()]  # 3 rows, fixed


def p7_containers(spark: SparkSession, base: str) -> DataFrame:
    return packing.pack_texts(table(spark, base, "documents", "doc_id", "text"), _budgets(spark, base))


def p7_use(spark: SparkSession, base: str) -> DataFrame:
    return packing.container_use(p7_containers(spark, base), _budgets(spark, base))


def _mixture(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    return mixing.mix_sources(table(spark, base, "documents", "doc_id", "source", "text"), table(spark, base, "mix_targets"))


def p8_mixture(spark: SparkSession, base: str) -> DataFrame:
    return _mixture(spark, base)[0]


def p8_shares(spark: SparkSession, base: str) -> DataFrame:
    return _mixture(spark, base)[1]


def _garbled(spark: SparkSession, base: str) -> DataFrame:
    return mojibake.garbled_documents(table(spark, base, "documents", "doc_id", "text"))


def p9_found(spark: SparkSession, base: str) -> DataFrame:
    return _garbled(spark, base).select("doc_id").distinct()


def p9_restored(spark: SparkSession, base: str) -> DataFrame:
    return _garbled(spark, base)


QUERIES = {
    f.__name__: f
    for f in (
        p1_found, p1_counts, p2_found, p2_assignment, p2_shares, p3_found, p3_study_counts, p4_found, p4_values,
        p7_containers, p7_use, p8_mixture, p8_shares, p9_found, p9_restored,
    )
}

_FREQUENT = """
WITH v AS (
  SELECT 'sequence_aa' AS field_name, regexp_replace(upper(sequence_aa), '[^A-Z]+', '', 'g') AS item FROM sequences
  UNION ALL SELECT 'junction_aa', regexp_replace(upper(junction_aa), '[^A-Z]+', '', 'g') FROM sequences),
c AS (SELECT field_name, item, count(*) AS item_count FROM v WHERE item <> '' GROUP BY 1, 2),
n AS (SELECT field_name, CAST(sum(item_count) AS BIGINT) AS field_rows FROM c GROUP BY 1)
"""

ORACLE_SQL = {
    "p1_found": _FREQUENT + "SELECT field_name, item FROM c JOIN n USING (field_name) WHERE item_count * 200 >= field_rows",
    "p1_counts": _FREQUENT + "SELECT field_name, item, item_count, field_rows FROM c JOIN n USING (field_name) WHERE item_count * 200 >= field_rows",
    "p2_found": r"""
WITH RECURSIVE e AS (
  SELECT DISTINCT study_id, subject FROM (SELECT study_id, regexp_replace(lower(subject), '[^\p{L}\p{N}]', '', 'g') AS subject FROM unit_metadata)
  WHERE NOT regexp_matches(subject, '^(no|none|pooled|unknown|na|(donor|subject|patient|mouse|animal|participant)?\p{Nd}+)?$')),
tie AS (SELECT DISTINCT a.study_id AS a, b.study_id AS b FROM e a JOIN e b ON a.subject = b.subject AND a.study_id <> b.study_id),
reach AS (SELECT a, b FROM tie UNION SELECT r.a, t.b FROM reach r JOIN tie t ON r.b = t.a)
SELECT DISTINCT a AS study_id_a, b AS study_id_b FROM reach WHERE a < b""",
}
