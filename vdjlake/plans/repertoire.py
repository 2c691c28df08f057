"""Queries of the repertoire operators on this project's tables, with their SQL."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vdjlake.functions import positions as P
from vdjlake.functions import scalars as S
from vdjlake.functions.embed import composition_model, embed
from vdjlake.functions.numbering import with_numbering
from vdjlake.functions.status import parse_status
from vdjlake.functions.urls import fix_paired_url, parse_unit_url
from vdjlake.operators import dedup, filters, metadata, normalize, pairs, sampling, stats
from vdjlake.schema import UNIT_KEY
from vdjlake.sources.files import metadata_from_json
from vdjlake.storage import shared_dir, spread, table
from vdjlake.streaming.ingest import file_stream, first_seen, ingest, windowed_counts

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
UNIT = list(UNIT_KEY)
ORDER = ("index_in_unit", "chain", "record_id")
HOST, ROOT = "data.example.org", "archive/units"


def query(sql: str | None = None):
    """Register a function (spark, base) under its name, with its SQL."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def sequences(spark: SparkSession, base: str) -> DataFrame:
    """The sequence table with the flags that it leaves to be derived from lengths."""
    df = table(spark, base, "sequences")
    return df.withColumns({
        "anarci_cdr3_is_over_37_aa_long": F.coalesce(F.col("cdr3_aa_length") > 37, F.lit(False)),
        "anarci_fwr1_shorter_than_imgt_defined": F.col("fwr1_aa_length") < 25,
        "anarci_fwr4_shorter_than_imgt_defined": F.col("fwr4_aa_length") < 11,
    })


# --- filters

_FILTERS = {
    "filter_identity": (filters.identity(), "true"),
    "filter_only_productive": (filters.only_productive(), "productive"),
    "filter_no_stop_codon": (filters.no_stop_codon(), "NOT stop_codon"),
    "filter_vj_in_frame": (filters.vj_in_frame(), "vj_in_frame"),
    "filter_no_unexpected_insertions": (filters.no_unexpected_insertions(), "NOT has_unexpected_insertions"),
    "filter_no_short_fwr1": (filters.no_short_fwr1(24), "fwr1_aa_length >= 24"),
    "filter_no_short_fwr1_flag": (filters.no_short_fwr1(None), "NOT fwr1_aa_length < 25"),
    "filter_no_short_fwr4": (filters.no_short_fwr4(10), "fwr4_aa_length >= 10"),
    "filter_no_short_fwr4_flag": (filters.no_short_fwr4(None), "NOT fwr4_aa_length < 11"),
    "filter_no_kappa_gap_21": (filters.no_kappa_gap_21(), "NOT has_kappa_gap_21"),
    "filter_no_deletions": (filters.no_deletions(), "anarci_deletions IS NULL"),
    "filter_no_insertions_out_of_cdrs": (filters.no_insertions_out_of_cdrs(), "anarci_insertions IS NULL"),
    "filter_no_unsupported_cdr3_length": (filters.no_unsupported_cdr3_length(), "NOT coalesce(cdr3_aa_length > 37, false)"),
    "filter_no_missing_conserved_cysteine": (filters.no_missing_conserved_cysteine(), "NOT anarci_missing_conserved_cysteine"),
    "filter_no_unusual_residues": (filters.no_unusual_residues(), "NOT anarci_unusual_residue"),
    "filter_count_threshold": (filters.count_threshold(2), "redundancy >= 2"),
}
for _name, (_step, _where) in _FILTERS.items():
    QUERIES[_name] = lambda spark, base, step=_step: step(sequences(spark, base)).select("record_id")
    if _where:
        ORACLE_SQL[_name] = f"SELECT record_id FROM sequences WHERE {_where}"


@query("""WITH g AS (SELECT v_call, min(sequence_aa) AS germline FROM sequences WHERE sequence_aa <> '' GROUP BY 1)
SELECT record_id FROM sequences JOIN g USING (v_call)
WHERE len(list_filter(range(1, least(length(sequence_aa), length(germline)) + 1), lambda i:
      sequence_aa[i] NOT IN ('-', '.', 'X') AND germline[i] NOT IN ('-', '.', 'X') AND sequence_aa[i] <> germline[i])) >= 15""")
def filter_no_naive(spark: SparkSession, base: str) -> DataFrame:
    """Mismatches with the germline of the gene, for which, as the table has none, the least sequence of the gene stands."""
    df = table(spark, base, "sequences", "record_id", "v_call", "sequence_aa")
    germline = df.filter("sequence_aa <> ''").groupBy("v_call").agg(F.min("sequence_aa").alias("germline"))
    return filters.no_naive(15, "sequence_aa", "germline")(df.join(germline, "v_call")).select("record_id")


@query("""SELECT s.record_id FROM sequences s WHERE (SELECT max(isotype) FROM unit_metadata u
  WHERE u.oas_subset = s.oas_subset AND u.study_id = s.study_id AND u.unit_id = s.unit_id) IN ('IGHM', 'IGHG')""")
def filter_only_isotypes(spark: SparkSession, base: str) -> DataFrame:
    units = table(spark, base, "unit_metadata", *UNIT, "download_date", "isotype")
    return filters.only_isotypes(("IGHM", "IGHG"))(metadata.attach_units(table(spark, base, "sequences", *UNIT, "record_id"), units, ["isotype"])).select("record_id")


@query("""SELECT record_id FROM sequences SEMI JOIN (SELECT * FROM unit_metadata WHERE longitudinal = 'no') u USING (oas_subset, study_id, unit_id)""")
def filter_only_units(spark: SparkSession, base: str) -> DataFrame:
    units = table(spark, base, "unit_metadata").filter("longitudinal = 'no'")
    return filters.only_units(units)(table(spark, base, "sequences")).select("record_id")


_MERGE = """(SELECT * REPLACE (total AS redundancy) FROM (
  SELECT *, CAST(sum(coalesce(redundancy, 1)) OVER (PARTITION BY oas_subset, study_id, unit_id, sequence_aa) AS BIGINT) AS total,
         row_number() OVER (PARTITION BY oas_subset, study_id, unit_id, sequence_aa ORDER BY index_in_unit, chain, record_id) AS rn FROM {src}) WHERE rn = 1)"""
_DEDUP = """(SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY sequence_aa ORDER BY oas_subset, study_id, unit_id, index_in_unit, chain, record_id) AS rd FROM {src})
  WHERE rd = 1 OR sequence_aa IS NULL OR sequence_aa = '')"""
_START = "productive AND fwr1_aa_length >= 20 AND fwr4_aa_length >= 10"
_SHAPE = "anarci_insertions IS NULL AND NOT coalesce(cdr3_aa_length > 37, false) AND NOT anarci_unusual_residue AND NOT anarci_missing_conserved_cysteine AND NOT has_kappa_gap_21"
_KEPT = "record_id, redundancy"


def _steps(name: str) -> list[filters.RowFilter]:
    """A named pipeline whose order ends with record_id, as records are delivered repeatedly."""
    # 'paired' sorts before 'unpaired'
    swap = {"NoDuplicates": filters.dedup_step(order=[*UNIT, *ORDER], unique_order=True), "MergeRedundant(use_all_known=False)": filters.merge_step(order=ORDER, unique_order=True)}
    return [swap.get(s.name, s) for s in filters.pipeline(name)]


@query(f"SELECT {_KEPT} FROM " + _MERGE.format(src="sequences"))
def merge_redundant(spark: SparkSession, base: str) -> DataFrame:
    return dedup.merge_redundant(table(spark, base, "sequences", *UNIT, *ORDER, "sequence_aa", "redundancy"), order=ORDER, unique_order=True).select("record_id", "redundancy")


@query(f"SELECT {_KEPT} FROM " + _DEDUP.format(src="sequences"))
def no_duplicates(spark: SparkSession, base: str) -> DataFrame:
    df = table(spark, base, "sequences", *UNIT, *ORDER, "sequence_aa", "redundancy")
    return dedup.no_duplicates(df, order=[*UNIT, *ORDER], unique_order=True).select("record_id", "redundancy")


@query(f"SELECT {_KEPT} FROM " + _DEDUP.format(src=_MERGE.format(src=f"(SELECT * FROM sequences WHERE {_START} AND {_SHAPE})")))
def pipeline_default(spark: SparkSession, base: str) -> DataFrame:
    return filters.run_filters(sequences(spark, base), _steps("default"), ["record_id", "redundancy"])


@query(f"SELECT {_KEPT} FROM " + _DEDUP.format(src=f"(SELECT * FROM {_MERGE.format(src='sequences')} WHERE redundancy >= 3 AND {_START} AND anarci_deletions IS NULL AND {_SHAPE})"))
def pipeline_most_strict(spark: SparkSession, base: str) -> DataFrame:
    return filters.run_filters(sequences(spark, base), _steps("most-strict"), ["record_id", "redundancy"])


_LOGGED = ["productive", "fwr1_aa_length >= 20", "fwr4_aa_length >= 10", "anarci_insertions IS NULL", "NOT coalesce(cdr3_aa_length > 37, false)", "NOT anarci_unusual_residue", "NOT anarci_missing_conserved_cysteine", "NOT has_kappa_gap_21"]


def _log_sql() -> str:
    parts = []
    for i in range(8):
        before = " AND ".join(_LOGGED[:i]) or "true"
        parts.append(f"SELECT oas_subset, study_id, unit_id, {i} AS step, count(*) FILTER ({before}) AS unfiltered_length, count(*) FILTER ({before} AND {_LOGGED[i]}) AS filtered_length FROM sequences GROUP BY ALL")
    kept = f"(SELECT * FROM sequences WHERE {' AND '.join(_LOGGED)})"
    merged = _MERGE.format(src=kept)
    for i, (a, b) in enumerate(((kept, merged), (merged, _DEDUP.format(src=merged))), 8):
        parts.append(f"SELECT a.*, coalesce(b.n, 0) AS filtered_length FROM (SELECT oas_subset, study_id, unit_id, {i} AS step, count(*) AS unfiltered_length FROM {a} GROUP BY ALL) a LEFT JOIN (SELECT oas_subset, study_id, unit_id, count(*) AS n FROM {b} GROUP BY ALL) b USING (oas_subset, study_id, unit_id)")
    return " UNION ALL ".join(f"({p})" for p in parts)


@query("SELECT *, unfiltered_length - filtered_length AS filtered_out FROM (" + _log_sql() + ")")
def filter_log(spark: SparkSession, base: str) -> DataFrame:
    return filters.filter_log(sequences(spark, base), _steps("default")).drop("name")


@query("""SELECT step, count(*) AS units, CAST(sum(unfiltered_length) AS BIGINT) AS sequences, CAST(sum(unfiltered_length - filtered_length) AS BIGINT) AS filtered_out
FROM (""" + _log_sql() + ") GROUP BY 1")
def filter_log_totals(spark: SparkSession, base: str) -> DataFrame:
    return filters.log_totals(filters.filter_log(sequences(spark, base), _steps("default"))).drop("name")


@query("""SELECT sequence_aa, string_agg(unit, ' ' ORDER BY unit) AS units, count(*) AS num_units
FROM (SELECT DISTINCT sequence_aa, concat_ws(',', oas_subset, study_id, unit_id) AS unit FROM sequences WHERE sequence_aa <> '') GROUP BY 1""")
def unique_index(spark: SparkSession, base: str) -> DataFrame:
    index = dedup.unique_index(table(spark, base, "sequences", *UNIT, "sequence_aa"))
    return index.select("sequence_aa", F.array_join("units", " ").alias("units"), F.col("num_units").cast("bigint").alias("num_units"))


@query("SELECT count(*) AS num_sequences, count(DISTINCT nullif(sequence_aa, '')) AS num_unique FROM sequences")
def index_totals(spark: SparkSession, base: str) -> DataFrame:
    return dedup.index_totals(table(spark, base, "sequences", "sequence_aa"))


@query("""SELECT min(record_id) AS record_id FROM sequences GROUP BY study_id, unit_id, index_in_unit, chain, junction_aa""")
def distinct_on(spark: SparkSession, base: str) -> DataFrame:
    df = table(spark, base, "sequences", "study_id", "unit_id", "index_in_unit", "chain", "junction_aa", "redundancy", "record_id")
    return dedup.distinct_on(df, order=("record_id",)).select("record_id")


# --- reshaping

_PAIRS = """SELECT h.oas_subset, h.study_id, h.unit_id, h.index_in_unit, h.v_call AS v_call_heavy, l.v_call AS v_call_light,
  h.junction_aa AS junction_aa_heavy, l.junction_aa AS junction_aa_light
FROM sequences h JOIN sequences l USING (oas_subset, study_id, unit_id, index_in_unit) WHERE h.chain = 'heavy' AND l.chain = 'light'"""


@query(_PAIRS)
def repair_pairs(spark: SparkSession, base: str) -> DataFrame:
    return pairs.repair_pairs(table(spark, base, "sequences", *UNIT, "index_in_unit", "chain", "v_call", "junction_aa"), ["v_call", "junction_aa"])


@query(f"""WITH p AS ({_PAIRS}) SELECT study_id, unit_id, index_in_unit, v_call_heavy AS v_call, junction_aa_heavy AS junction_aa FROM p
UNION ALL SELECT study_id, unit_id, index_in_unit, v_call_light, junction_aa_light FROM p""")
def unpivot_pairs(spark: SparkSession, base: str) -> DataFrame:
    return normalize.unpivot_pairs(repair_pairs(spark, base), ["study_id", "unit_id", "index_in_unit"]).select("study_id", "unit_id", "index_in_unit", "v_call", "junction_aa")


@query("SELECT record_id, fwr1_aa_length AS fwr1_start, cdr3_aa_length AS fwr1_length FROM sequences")
def offsets(spark: SparkSession, base: str) -> DataFrame:
    df = table(spark, base, "sequences", "record_id", "fwr1_aa_length", "cdr3_aa_length")
    given = df.select("record_id", (F.col("fwr1_aa_length") + 1).alias("fwr1_start"), (F.col("fwr1_aa_length") + F.col("cdr3_aa_length")).alias("fwr1_end"))
    return normalize.zero_based(given)


@query("""SELECT record_id, CASE WHEN v_identity < 90 THEN CAST(floor(v_identity) AS INTEGER) END AS whole, productive AS flag FROM sequences""")
def conversions(spark: SparkSession, base: str) -> DataFrame:
    df = table(spark, base, "sequences", "record_id", "v_identity", "productive")
    text = F.when(F.col("v_identity") < 90, F.concat(F.floor("v_identity").cast("string"), F.lit(".0"))).otherwise(F.lit("n/a"))
    return df.select("record_id", S.loose_int(text).alias("whole"), S.tf_flag(F.when(F.col("productive"), "T").otherwise("F")).alias("flag"))


@query("SELECT index_in_unit, chain, locus, v_call, junction_aa, junction_aa_length, redundancy, v_identity, productive, CAST(NULL AS VARCHAR) AS d_call FROM sequences")
def conform(spark: SparkSession, base: str) -> DataFrame:
    df = table(spark, base, "sequences", "redundancy", "v_call", "chain", "locus", "index_in_unit", "junction_aa", "junction_aa_length", "productive", "v_identity")
    return normalize.conform(df).select("index_in_unit", "chain", "locus", "v_call", "junction_aa", "junction_aa_length", "redundancy", "v_identity", "productive", "d_call")


# --- positions, status, numbering

_LETTER = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', CAST(record_id % 26 AS INTEGER) + 1, 1)"
_INSERTION = f"CASE record_id % 3 WHEN 0 THEN '' WHEN 1 THEN {_LETTER} ELSE {_LETTER} || {_LETTER} END"
_CODE = "CASE record_id % 3 WHEN 0 THEN 0 WHEN 1 THEN record_id % 26 + 1 ELSE record_id % 26 + 27 END"


def _positions(spark: SparkSession, base: str) -> DataFrame:
    df = table(spark, base, "sequences", "record_id")
    letter = F.char(65 + F.pmod("record_id", F.lit(26)))
    ins = F.when(F.col("record_id") % 3 == 0, "").when(F.col("record_id") % 3 == 1, letter).otherwise(F.concat(letter, letter))
    return df.withColumn("position", F.concat((F.col("record_id") % 128 + 1).cast("string"), ins))


@query(f"""SELECT record_id, CAST(record_id % 128 + 1 AS INTEGER) AS number, {_INSERTION} AS insertion,
  CAST(CASE WHEN record_id % 128 + 1 = 112 THEN -({_CODE}) ELSE {_CODE} END AS INTEGER) AS code, {_INSERTION} AS again,
  CASE WHEN record_id % 128 + 1 <= 26 THEN 'fwr1' WHEN record_id % 128 + 1 <= 38 THEN 'cdr1' WHEN record_id % 128 + 1 <= 55 THEN 'fwr2'
       WHEN record_id % 128 + 1 <= 65 THEN 'cdr2' WHEN record_id % 128 + 1 <= 104 THEN 'fwr3' WHEN record_id % 128 + 1 <= 117 THEN 'cdr3' ELSE 'fwr4' END AS region
FROM sequences""")
def positions(spark: SparkSession, base: str) -> DataFrame:
    key = P.position_key(F.col("position"))
    return _positions(spark, base).select(
        "record_id", P.position_number(F.col("position")).alias("number"), P.position_insertion(F.col("position")).alias("insertion"), key["code"].alias("code"),
        P.insertion_of_code(key["code"]).alias("again"), P.region_of(key["number"]).alias("region"),
    )


@query("SELECT record_id, 112 AS number, CAST(-(record_id % 26 + 1) AS INTEGER) AS code, substr(v_call, 1, 1) AS residue FROM sequences")
def position_residue(spark: SparkSession, base: str) -> DataFrame:
    df = table(spark, base, "sequences", "record_id", "v_call")
    text = F.concat(F.lit("112"), F.char(65 + F.pmod("record_id", F.lit(26))), F.lit("="), F.substring("v_call", 1, 1))
    return df.select("record_id", P.position_residue(text).alias("p")).select("record_id", "p.*")


@query("""SELECT record_id, anarci_missing_conserved_cysteine AS missing_conserved_cysteine, anarci_unusual_residue AS unusual_residue, fwr1_aa_length < 25 AS fwr1_shorter,
  array_to_string(list_sort(list_distinct(anarci_deletions)), ',') AS deletions, array_to_string(list_sort(list_distinct(anarci_insertions)), ',') AS insertions
FROM sequences""")
def status_rules(spark: SparkSession, base: str) -> DataFrame:
    """Status strings with rules between bars, written from the table's own columns and read again."""
    df = sequences(spark, base)
    joined = lambda c: F.array_join(F.col(c).cast("array<string>"), ", ")
    text = F.concat_ws(
        "|", F.lit(""), F.concat(F.lit("Deletions: "), joined("anarci_deletions")), F.concat(F.lit("Insertion: "), joined("anarci_insertions")),
        F.when(F.col("anarci_missing_conserved_cysteine"), "Missing Conserved Cysteine: 23"), F.when(F.col("anarci_unusual_residue"), "Unusual residue: X27"),
        F.when(F.col("anarci_fwr1_shorter_than_imgt_defined"), "Shorter than IMGT defined: fw1"), F.lit(""),
    )
    return _status(df.withColumn("text", text))


def _status(df: DataFrame) -> DataFrame:
    return df.select("record_id", parse_status(F.col("text")).alias("s")).select(
        "record_id", "s.missing_conserved_cysteine", "s.unusual_residue", F.col("s.fwr1_shorter_than_imgt_defined").alias("fwr1_shorter"),
        F.array_join("s.deletions", ",").alias("deletions"), F.array_join("s.insertions", ",").alias("insertions"),
    )


@query("""SELECT record_id, anarci_missing_conserved_cysteine AS missing_conserved_cysteine, anarci_unusual_residue AS unusual_residue, fwr1_aa_length < 25 AS fwr1_shorter,
  CAST(NULL AS VARCHAR) AS deletions, array_to_string(list_sort(list_distinct(anarci_insertions)), ',') AS insertions FROM sequences""")
def status_messages(spark: SparkSession, base: str) -> DataFrame:
    """The other grammar: a list of messages."""
    df = sequences(spark, base)
    q = lambda s: F.lit(f"'{s}'")
    inserted = F.array_join(F.transform("anarci_insertions", lambda i: F.concat(F.lit("'Insertion: "), i, F.lit("'"))), ", ")
    items = F.concat_ws(
        ", ", F.when(F.col("anarci_missing_conserved_cysteine"), q("Missing Conserved Cysteine 23 or 104")), F.when(F.col("anarci_unusual_residue"), q("Unusual amino acid: X27")),
        F.when(F.col("anarci_fwr1_shorter_than_imgt_defined"), q("fw1 is shorter than IMGT defined")), F.nullif(inserted, F.lit("")),
    )
    return _status(df.withColumn("text", F.concat(F.lit("["), items, F.lit("]"))))


_CLEAN = "nullif(regexp_replace(upper(junction_aa), '[^A-Z]+', '', 'g'), '')"


_RESIDUES = "nullif(regexp_replace(upper(sequence_aa), '[^A-Z]+', '', 'g'), '')"
#: A whole sequence numbered: residue k on position k, and what it has beyond 128 residues inserted on 111 and 112.
_NUMBERED = f"""q AS (SELECT record_id, chain, locus, {_RESIDUES} AS r, anarci_missing_conserved_cysteine AS mc, anarci_unusual_residue AS ur, anarci_deletions AS d, anarci_insertions AS i FROM sequences),
w AS (SELECT *, CASE WHEN locus = 'K' AND record_id % 7 = 0 AND length(r) >= 21 THEN substr(r, 1, 20) || '-' || substr(r, 22) ELSE r END AS s,
  coalesce(length(r), 0) AS n, greatest(coalesce(length(r), 0) - 128, 0) AS x FROM q),
e AS (SELECT record_id, chain, k, substr(s, CAST(k AS INTEGER), 1) AS aa,
  CASE WHEN k <= 111 OR x = 0 THEN k WHEN k <= 111 + x // 2 THEN 111 WHEN k <= 111 + x THEN 112 ELSE k - x END AS p,
  CASE WHEN x = 0 OR k <= 111 OR k > 111 + x THEN 0 WHEN k <= 111 + x // 2 THEN k - 111 ELSE 112 + x - k END AS c
  FROM (SELECT *, unnest(range(1, n + 1)) AS k FROM w WHERE locus IS NOT NULL)),
t AS (SELECT *, p || CASE WHEN c = 0 THEN '' WHEN c <= 26 THEN chr(CAST(64 + c AS INTEGER)) ELSE repeat(chr(CAST(38 + c AS INTEGER)), 2) END AS position FROM e)"""
_SPANS = [("fwr1", 1, 26), ("cdr1", 27, 38), ("fwr2", 39, 55), ("cdr2", 56, 65), ("fwr3", 66, 104), ("cdr3", 105, 117), ("fwr4", 118, 128)]
_SIZES = ", ".join(f"CASE WHEN locus IS NULL THEN 0 WHEN n > 128 THEN {b - a + 1}{' + x' if r == 'cdr3' else ''} ELSE greatest(least(n, {b}) - {a - 1}, 0) END" for r, a, b in _SPANS)


def _numbering(spark: SparkSession, base: str) -> DataFrame:
    """Numbering literals of whole sequences with their status, read again by ``with_numbering``.

    All regions are there, with their positions in the order of strings, as the numbering software writes them. Some
    kappa chains get a gap at 21, and every eleventh record another CDR3 to be compared with.
    """
    df = spread(table(spark, base, "sequences", "record_id", "chain", "locus", "sequence_aa", "anarci_missing_conserved_cysteine", "anarci_unusual_residue", "anarci_deletions", "anarci_insertions"))
    r = F.nullif(F.regexp_replace(F.upper("sequence_aa"), "[^A-Z]+", ""), F.lit(""))
    df = df.withColumn("r", r).withColumns({"n": F.coalesce(F.length("r"), F.lit(0)), "x": F.greatest(F.coalesce(F.length("r"), F.lit(0)) - 128, F.lit(0))})
    gap = (F.col("locus") == "K") & (F.col("record_id") % 7 == 0)
    at = lambda p: F.substring("r", p, 1) if p < 112 else F.substr("r", F.col("x") + p, F.lit(1))
    residue = lambda p: F.when(gap, "-").otherwise(at(p)) if p == 21 else at(p)
    entry = lambda p: F.when(F.col("n") >= p, F.concat(F.lit(f"'{p} ': '"), residue(p), F.lit("'")))
    inserted = lambda at, size, index: F.when(size > 0, F.array_join(F.transform(F.sequence(F.lit(1), size), lambda i: F.concat(F.lit(f"'{at}"), P.insertion_of_code(i), F.lit("': '"), F.substr("r", index(i), F.lit(1)), F.lit("'"))), ", "))
    first = F.floor(F.col("x") / 2).cast("int")
    regions = []
    for name, a, b in _SPANS:
        pieces = [entry(p) for p in sorted(range(a, b + 1), key=str)]
        if name == "cdr3":
            pieces += [inserted(111, first, lambda i: F.lit(111) + i), inserted(112, F.col("x") - first, lambda i: F.lit(112) + F.col("x") - i)]
        key = F.concat(F.lit("'" + name[: 2 if name.startswith("fwr") else 3]), F.lower("locus"), F.lit(name[-1]))
        regions.append(F.concat(key, F.lit("': {"), F.concat_ws(", ", *pieces), F.lit("}")))
    joined = lambda c: F.array_join(F.col(c).cast("array<string>"), ", ")
    status = F.concat_ws(
        "|", F.lit(""), F.concat(F.lit("Deletions: "), joined("anarci_deletions")), F.concat(F.lit("Insertion: "), joined("anarci_insertions")),
        F.when(F.col("anarci_missing_conserved_cysteine"), "Missing Conserved Cysteine: 23"), F.when(F.col("anarci_unusual_residue"), "Unusual residue: X27"), F.lit(""),
    )
    cdr3 = F.substr("r", F.lit(105), F.least(F.col("n") - 104, F.lit(13) + F.col("x")))
    expected = F.when(F.col("n") > 104, F.concat(cdr3, F.when(F.col("record_id") % 11 == 0, "A").otherwise("")))
    literal = F.when(F.col("n") > 0, F.concat(F.lit("{"), F.concat_ws(", ", *regions), F.lit("}")))
    rows = df.select("record_id", "chain", "locus", literal.alias("literal"), status.alias("status"), expected.alias("expected"))
    return with_numbering(rows, "locus", "literal", "status", "expected")


def _places() -> Column:
    text = F.col("imgt_positions").cast("array<string>")
    return F.when(F.col("has_insertions"), F.zip_with(text, "imgt_insertions", lambda p, i: F.concat(p, i))).otherwise(text)


@query(f"""WITH {_NUMBERED}, a AS (SELECT record_id, string_agg(position, ',' ORDER BY k) AS positions FROM t GROUP BY 1), z AS (SELECT *, [{_SIZES}] AS sizes FROM w)
SELECT record_id, CASE WHEN locus IS NULL THEN '' ELSE coalesce(s, '') END AS sequence_aa, coalesce(positions, '') AS positions, array_to_string(sizes, ',') AS lengths,
  array_to_string(list_transform(range(1, 8), lambda g: CASE WHEN sizes[g] > 0 THEN CAST(coalesce(list_sum(sizes[1:g - 1]), 0) AS INTEGER) ELSE -1 END), ',') AS starts,
  locus IS NOT NULL AND x > 0 AS has_insertions, coalesce(locus IS NOT NULL AND ((n >= 23 AND s[23] <> 'C') OR (n >= 104 AND s[104] <> 'C')), false) AS has_mutated_conserved_cysteines,
  coalesce(locus = 'K' AND s[21] = '-', false) AS has_kappa_gap_21, locus IS NULL OR n < 105 OR record_id % 11 = 0 AS has_wrong_cdr3_reconstruction,
  mc AS anarci_missing_conserved_cysteine, ur AS anarci_unusual_residue, array_to_string(list_sort(list_distinct(d)), ',') AS deletions, array_to_string(list_sort(list_distinct(i)), ',') AS insertions,
  CASE WHEN locus IS NULL THEN 'no locus' WHEN r IS NULL THEN 'no numbering' END AS numbering_error
FROM z LEFT JOIN a USING (record_id)""")
def numbering(spark: SparkSession, base: str) -> DataFrame:
    out = _numbering(spark, base)
    names = [r for r, _, _ in _SPANS]
    flags = ("has_insertions", "has_mutated_conserved_cysteines", "has_kappa_gap_21", "has_wrong_cdr3_reconstruction", "anarci_missing_conserved_cysteine", "anarci_unusual_residue")
    return out.select(
        "record_id", "sequence_aa", F.array_join(_places(), ",").alias("positions"), F.concat_ws(",", *(f"{r}_aa_length" for r in names)).alias("lengths"),
        F.concat_ws(",", *(F.coalesce(f"{r}_aa_start", F.lit(-1)) for r in names)).alias("starts"), *flags,
        F.array_join("anarci_deletions", ",").alias("deletions"), F.array_join("anarci_insertions", ",").alias("insertions"), "numbering_error",
    )


@query(f"WITH {_NUMBERED} SELECT chain, position, aa AS residue, count(*) AS count FROM t GROUP BY ALL")
def position_counts_numbered(spark: SparkSession, base: str) -> DataFrame:
    """Counts by numbered position, insertions included."""
    return stats.position_counts(_numbering(spark, base).filter("numbering_error IS NULL"))


#: Residue k of a whole junction: where it stands. 104 and 118 are the ends; between them, up to 7 and 6 positions of CDR3, the rest inserted on 111 and 112.
_WHERE = """CASE WHEN k = 1 THEN 104 WHEN k = length(w) THEN 118 WHEN k - 1 <= least(7, (length(w) - 1) // 2) THEN 103 + k
  WHEN k - 8 BETWEEN 1 AND greatest(length(w) - 15, 0) // 2 THEN 111 WHEN length(w) - k > 6 THEN 112 ELSE 118 - (length(w) - k) END"""
_INSERTED = """CASE WHEN length(w) > 15 AND k > 8 AND k - 8 <= (length(w) - 15) // 2 THEN k - 8
  WHEN length(w) > 15 AND k > 8 AND length(w) - k > 6 AND length(w) - 6 - k > 0 THEN length(w) - 6 - k ELSE 0 END"""


@query(f"""WITH r AS (SELECT record_id, locus, {_CLEAN} AS j FROM sequences),
w AS (SELECT record_id, locus, j, CASE WHEN locus IS NOT NULL THEN j END AS w FROM r),
e AS (SELECT record_id, k, {_WHERE} AS p, {_INSERTED} AS c FROM (SELECT record_id, w, unnest(range(1, length(w) + 1)) AS k FROM w)),
a AS (SELECT record_id, string_agg(p || CASE WHEN c = 0 THEN '' WHEN c <= 26 THEN chr(CAST(64 + c AS INTEGER)) ELSE repeat(chr(CAST(38 + c AS INTEGER)), 2) END, ',' ORDER BY k) AS positions FROM e GROUP BY 1)
SELECT record_id, coalesce(w, '') AS sequence_aa, coalesce(positions, '') AS positions, CASE WHEN length(w) > 0 THEN 0 END AS fwr3_aa_start, CASE WHEN length(w) > 0 THEN 1 ELSE 0 END AS fwr3_aa_length,
  CASE WHEN length(w) > 2 THEN 1 END AS cdr3_aa_start, CAST(greatest(coalesce(length(w), 0) - 2, 0) AS INTEGER) AS cdr3_aa_length,
  CASE WHEN length(w) > 1 THEN CAST(length(w) - 1 AS INTEGER) END AS fwr4_aa_start, CASE WHEN length(w) > 1 THEN 1 ELSE 0 END AS fwr4_aa_length,
  coalesce(length(w) > 15, false) AS has_insertions, coalesce(length(w), 0) < 3 AS has_wrong_cdr3_reconstruction,
  CASE WHEN locus IS NULL THEN 'no locus' WHEN j IS NULL THEN 'no numbering' END AS numbering_error
FROM w LEFT JOIN a USING (record_id)""")
def numbering_whole(spark: SparkSession, base: str) -> DataFrame:
    """Numbering literals of whole junctions, read again: 104, CDR3 with what it has beyond 13 residues inserted on 111 and 112, 118.

    All rows come out. Those without locus or junction have no literal, those with more than 119 residues more
    insertions than there are letters; both have their ``numbering_error``.
    """
    j = F.nullif(F.regexp_replace(F.upper("junction_aa"), "[^A-Z]+", ""), F.lit(""))
    df = table(spark, base, "sequences", "record_id", "locus", "junction_aa").withColumn("j", j).withColumn("n", F.length("j") - 2)
    n = F.greatest(F.col("n"), F.lit(0))
    head, tail, extra = F.least(F.lit(7), F.ceil(n / 2).cast("int")), F.least(F.lit(6), F.floor(n / 2).cast("int")), F.greatest(n - 13, F.lit(0))
    df = df.withColumns({"head": head, "tail": tail, "first": F.floor(extra / 2).cast("int"), "second": F.ceil(extra / 2).cast("int")})
    # keys in numbering order; a third letter, which no insertion has, marks what can't be numbered
    span = lambda start, size: F.when(size > 0, F.transform(F.sequence(F.lit(1), size), lambda i: F.concat((start + i).cast("string"), F.lit(" ")))).otherwise(F.array())
    letters = lambda i: F.coalesce(P.insertion_of_code(i), F.lit("AAA"))
    inserted = lambda at, size: F.when(size > 0, F.transform(F.sequence(F.lit(1), size), lambda i: F.concat(F.lit(at), letters(i)))).otherwise(F.array())
    keys = F.concat(span(F.lit(104), F.col("head")), inserted("111", F.col("first")), F.reverse(inserted("112", F.col("second"))), span(F.lit(117) - F.col("tail"), F.col("tail")))
    middle = F.split(F.substring("j", 2, 1 << 30).substr(F.lit(1), n), "")
    entry = lambda k, x: F.concat(F.lit("'"), k, F.lit("': '"), x, F.lit("'"))
    # in the order of strings, as the numbering software writes them
    cdr3 = F.when(n > 0, F.array_join(F.array_sort(F.zip_with(keys, middle, entry)), ", ")).otherwise(F.lit(""))
    low, last = F.lower("locus"), F.when(F.length("j") > 1, F.concat(F.lit("'118 ': '"), F.substring("j", -1, 1), F.lit("'"))).otherwise(F.lit(""))
    literal = F.concat(F.lit("{'fw"), low, F.lit("3': {'104 ': '"), F.substring("j", 1, 1), F.lit("'}, 'cdr"), low, F.lit("3': {"), cdr3, F.lit("}, 'fw"), low, F.lit("4': {"), last, F.lit("}}"))
    df = df.withColumns({"literal": literal, "status": F.lit(None).cast("string"), "expected": F.when(F.col("n") > 0, F.substring("j", 2, 1 << 30).substr(F.lit(1), n))})
    out = with_numbering(df, "locus", "literal", "status", "expected")
    at = _places()
    regions = [f"{r}_aa_{x}" for r in ("fwr3", "cdr3", "fwr4") for x in ("start", "length")]
    return out.select("record_id", "sequence_aa", F.array_join(at, ",").alias("positions"), *regions, "has_insertions", "has_wrong_cdr3_reconstruction", "numbering_error")


# --- statistics

_COUNTS = "SELECT chain, CAST(i AS VARCHAR) AS position, substr(junction_aa, CAST(i AS INTEGER), 1) AS residue, count(*) AS count FROM (SELECT chain, junction_aa, unnest(range(1, length(junction_aa) + 1)) AS i FROM sequences WHERE junction_aa <> '') GROUP BY ALL"


def _counts(spark: SparkSession, base: str) -> DataFrame:
    df = stats.ordinal_positions(table(spark, base, "sequences", "chain", "junction_aa"), "junction_aa")
    return stats.position_counts(df, value="junction_aa")


@query(_COUNTS)
def position_counts(spark: SparkSession, base: str) -> DataFrame:
    return _counts(spark, base)


_REGION = "CASE WHEN CAST(position AS INTEGER) <= 26 THEN 'fwr1' WHEN CAST(position AS INTEGER) <= 38 THEN 'cdr1' ELSE 'fwr2' END"
_SUMS = ", ".join(f"CAST(sum(count) FILTER (residue = '{r}') AS BIGINT) AS {r}" for r in stats.AMINO_ACIDS)


@query(f"""SELECT chain, position, {_REGION} AS region, {_SUMS}, CAST(sum(count) AS BIGINT) AS total FROM ({_COUNTS}) GROUP BY ALL
UNION ALL SELECT chain, 'total', 'sequence', {_SUMS}, CAST(sum(count) AS BIGINT) FROM ({_COUNTS}) GROUP BY ALL""")
def position_matrix(spark: SparkSession, base: str) -> DataFrame:
    return stats.in_position_order(stats.position_matrix(_counts(spark, base), ["chain"]), ["chain"])


@query(f"SELECT chain, position, residue, CAST(sum(count) AS BIGINT) AS count FROM ({_COUNTS}) GROUP BY GROUPING SETS ((chain, position, residue), (chain, position), (chain, residue), (chain))")
def position_marginals(spark: SparkSession, base: str) -> DataFrame:
    return stats.marginals(_counts(spark, base), ["chain"])


@query(f"SELECT chain, {_REGION} AS region, CAST(sum(count) AS BIGINT) AS num_residues, count(DISTINCT position) AS num_positions FROM ({_COUNTS}) GROUP BY ALL")
def grand_totals(spark: SparkSession, base: str) -> DataFrame:
    return stats.grand_totals(_counts(spark, base))


@query("SELECT chain, CAST(length(sequence_aa) AS INTEGER) AS length, count(*) AS count FROM sequences WHERE sequence_aa IS NOT NULL GROUP BY ALL")
def length_histogram(spark: SparkSession, base: str) -> DataFrame:
    return stats.length_histogram(table(spark, base, "sequences", "chain", "sequence_aa"))


@query("SELECT chain, region, length, count(*) AS count FROM (UNPIVOT (SELECT chain, fwr1_aa_length AS fwr1, cdr3_aa_length AS cdr3, fwr4_aa_length AS fwr4 FROM sequences) ON fwr1, cdr3, fwr4 INTO NAME region VALUE length) GROUP BY ALL")
def region_length_histograms(spark: SparkSession, base: str) -> DataFrame:
    return stats.region_length_histograms(table(spark, base, "sequences", "chain", "fwr1_aa_length", "cdr3_aa_length", "fwr4_aa_length"))


@query("SELECT study_id, unit_id, max(fwr1_aa_length) AS fwr1_max_length, max(cdr3_aa_length) AS cdr3_max_length, max(fwr4_aa_length) AS fwr4_max_length FROM sequences WHERE chain = 'heavy' GROUP BY ALL")
def region_maxima(spark: SparkSession, base: str) -> DataFrame:
    return stats.region_maxima(table(spark, base, "sequences"), ["study_id", "unit_id"], chain="heavy")


@query("""SELECT oas_subset, study_id, unit_id, count(*) FILTER (chain = 'heavy') AS num_heavy, count(*) FILTER (chain = 'light') AS num_light, count(*) AS num_records,
  string_agg(DISTINCT chain, ',' ORDER BY chain) AS chains FROM sequences GROUP BY ALL""")
def chain_counts(spark: SparkSession, base: str) -> DataFrame:
    return stats.chain_counts(table(spark, base, "sequences", *UNIT, "chain"), UNIT)


_GROUPS = """SELECT species, chain, v_call, ml_subset, count(*) AS count FROM (
  SELECT s.chain, v_call, ml_subset, (SELECT max(species) FROM unit_metadata u WHERE u.oas_subset = s.oas_subset AND u.study_id = s.study_id AND u.unit_id = s.unit_id) AS species
  FROM sequences s) WHERE species IS NOT NULL AND ml_subset IS NOT NULL GROUP BY ALL"""


def _grouped(spark: SparkSession, base: str) -> DataFrame:
    rows = metadata.attach_units(table(spark, base, "sequences", *UNIT, "chain", "v_call", "ml_subset"), table(spark, base, "unit_metadata", *UNIT, "download_date", "species"), ["species"])
    return stats.group_counts(rows, ["species", "chain", "v_call", "ml_subset"])


@query(_GROUPS)
def group_counts(spark: SparkSession, base: str) -> DataFrame:
    return _grouped(spark, base)


@query(" UNION ALL ".join(f"SELECT '{g}' AS grouper, {g} AS value, ml_subset, CAST(sum(count) AS BIGINT) AS count FROM ({_GROUPS}) GROUP BY ALL" for g in ("species", "chain", "v_call")))
def regroup(spark: SparkSession, base: str) -> DataFrame:
    return stats.regroup(_grouped(spark, base), ["species", "chain", "v_call"], "ml_subset")


@query("""SELECT v_call, CAST(coalesce(sum(n) FILTER (c = 'heavy'), 0) AS BIGINT) AS heavy, CAST(coalesce(sum(n) FILTER (c = 'light'), 0) AS BIGINT) AS light
FROM (SELECT v_call, chain AS c, count(*) AS n FROM sequences GROUP BY ALL) GROUP BY 1""")
def merge_counts(spark: SparkSession, base: str) -> DataFrame:
    df = table(spark, base, "sequences", "v_call", "chain")
    part = lambda chain: df.filter(F.col("chain") == chain).groupBy("v_call").agg(F.count(F.lit(1)).alias(chain))
    return stats.merge_counts([part("heavy"), part("light")], ["v_call"], "heavy", "light")


_NORMAL = """SELECT study_id, heavy, light, round(heavy / sum(heavy) OVER () * 100, 6) AS pct_heavy, round(light / sum(light) OVER () * 100, 6) AS pct_light
FROM (SELECT study_id, count(*) FILTER (chain = 'heavy') AS heavy, count(*) FILTER (chain = 'light') AS light FROM sequences GROUP BY 1)"""


def _normalized(spark: SparkSession, base: str) -> DataFrame:
    df = table(spark, base, "sequences", "study_id", "chain").select("study_id", (F.col("chain") == "heavy").cast("bigint").alias("heavy"), (F.col("chain") == "light").cast("bigint").alias("light"))
    out = stats.group_normalized(df, ["study_id"], ["heavy", "light"])
    return out.withColumns({c: F.round(c, 6) for c in ("pct_heavy", "pct_light")})


@query(_NORMAL)
def group_normalized(spark: SparkSession, base: str) -> DataFrame:
    return _normalized(spark, base).orderBy(F.desc("pct_heavy"), "study_id")


@query(f"SELECT study_id, chain, percentage FROM (UNPIVOT ({_NORMAL}) ON pct_heavy, pct_light INTO NAME chain VALUE percentage)")
def melt(spark: SparkSession, base: str) -> DataFrame:
    return stats.melt(_normalized(spark, base), ["study_id"], ["pct_heavy", "pct_light"])


@query("""SELECT study_id, chain, count, round(count / sum(count) OVER (PARTITION BY study_id) * 100, 6) AS pct_count
FROM (SELECT study_id, chain, count(*) AS count FROM sequences GROUP BY ALL)""")
def percent_within(spark: SparkSession, base: str) -> DataFrame:
    counts = table(spark, base, "sequences", "study_id", "chain").groupBy("study_id", "chain").count()
    return stats.percent_of_total(counts, ["count"], ["study_id"]).withColumn("pct_count", F.round("pct_count", 6))


@query("""SELECT oas_subset, count(online_csv_size_bytes) AS num_files, round(sum(online_csv_size_bytes / 1048576), 4) AS total_mib, round(avg(online_csv_size_bytes / 1048576), 6) AS mean_mib,
  round(min(online_csv_size_bytes / 1048576), 6) AS min_mib, round(max(online_csv_size_bytes / 1048576), 6) AS max_mib FROM unit_metadata GROUP BY 1""")
def size_summary(spark: SparkSession, base: str) -> DataFrame:
    out = stats.size_summary(table(spark, base, "unit_metadata", "oas_subset", "online_csv_size_bytes"), "online_csv_size_bytes", ["oas_subset"])
    return out.select("oas_subset", "num_files", F.round("total_mib", 4).alias("total_mib"), *(F.round(c, 6).alias(c) for c in ("mean_mib", "min_mib", "max_mib")))


@query("SELECT oas_subset, count(DISTINCT study_id) AS num_studies, CAST(sum(theoretical_num_sequences_unique) AS BIGINT) AS num_sequences FROM unit_metadata GROUP BY 1")
def study_report(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "unit_metadata").groupBy("oas_subset").agg(F.count_distinct("study_id").alias("num_studies"), F.sum("theoretical_num_sequences_unique").alias("num_sequences"))


_NAMES = "list_filter([CASE WHEN species IS NOT NULL THEN 'species' END, CASE WHEN age IS NOT NULL THEN 'age' END, CASE WHEN subject IS NOT NULL THEN 'subject' END, CASE WHEN vaccine IS NOT NULL THEN 'vaccine' END], lambda x: x IS NOT NULL)"


def _named(spark: SparkSession, base: str) -> DataFrame:
    """Units with the names of the fields that they have, standing for the columns of their files."""
    names = F.array_compact(F.array(*(F.when(F.col(c).isNotNull(), c) for c in ("species", "age", "subject", "vaccine"))))
    return table(spark, base, "unit_metadata").withColumn("column_names", names)


@query(f'SELECT oas_subset, "column", count(*) AS num_units FROM (SELECT oas_subset, unnest({_NAMES}) AS "column" FROM unit_metadata) GROUP BY ALL')
def column_presence(spark: SparkSession, base: str) -> DataFrame:
    return stats.column_presence(_named(spark, base))


@query(f"SELECT array_to_string(list_sort({_NAMES}), ',') AS columns, count(*) AS num_units, count(DISTINCT oas_subset) AS num_subsets, count(DISTINCT study_id) AS num_studies FROM unit_metadata GROUP BY 1")
def schema_groups(spark: SparkSession, base: str) -> DataFrame:
    return stats.schema_groups(_named(spark, base))


# --- splits, samples, order

_BUCKET = "CAST(('0x' || substr(md5({x}), 1, 8)) AS BIGINT) % 100"


@query(f"SELECT record_id, CASE WHEN sequence_aa IS NULL THEN NULL WHEN {_BUCKET.format(x='sequence_aa')} < 80 THEN 'train' WHEN {_BUCKET.format(x='sequence_aa')} < 90 THEN 'validation' ELSE 'test' END AS subset FROM sequences")
def split_portable(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "sequences", "record_id", "sequence_aa").select("record_id", S.portable_subset(F.col("sequence_aa")).alias("subset"))


@query()
def split_xxh32(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "sequences", "record_id", "sequence_aa").select("record_id", S.xxh32_subset(F.col("sequence_aa")).alias("subset"))


@query()
def unit_hashes(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "unit_metadata", *UNIT).distinct().select(*UNIT, S.xxh3_64(F.concat_ws(",", *UNIT)).alias("unit_hash"))


@query("""SELECT record_id FROM (SELECT record_id, row_number() OVER (PARTITION BY oas_subset, study_id, unit_id
  ORDER BY md5(concat_ws('|', '19', CAST(record_id AS VARCHAR))), record_id) AS rn FROM sequences) WHERE rn <= 5""")
def sample_rows(spark: SparkSession, base: str) -> DataFrame:
    return sampling.sample_rows(table(spark, base, "sequences", *UNIT, "record_id"), 5, key=["record_id"]).select("record_id")


@query(f"SELECT DISTINCT oas_subset, study_id, unit_id FROM unit_metadata WHERE {_BUCKET.format(x="concat_ws(',', oas_subset, study_id, unit_id)")} < 30")
def sample_units_portable(spark: SparkSession, base: str) -> DataFrame:
    return sampling.portable_unit_sample(table(spark, base, "unit_metadata", *UNIT).distinct(), 30)


@query()
def sample_units(spark: SparkSession, base: str) -> DataFrame:
    return sampling.sample_units(table(spark, base, "unit_metadata", *UNIT).distinct(), 0.3)


_LAST = "(SELECT oas_subset, study_id, unit_id, max(online_csv_size_bytes) AS size FROM unit_metadata GROUP BY ALL)"


@query(f"SELECT study_id, unit_id, CAST((row_number() OVER (ORDER BY size DESC NULLS LAST, oas_subset, study_id, unit_id) - 1) % 90 AS INTEGER) AS shard FROM {_LAST}")
def shards(spark: SparkSession, base: str) -> DataFrame:
    units = table(spark, base, "unit_metadata").groupBy(*UNIT).agg(F.max("online_csv_size_bytes").alias("size"))
    return sampling.shard_of(units, "size", 90).select("study_id", "unit_id", "shard")


@query("SELECT record_id, v_identity FROM sequences ORDER BY v_identity DESC NULLS LAST, record_id LIMIT 25")
def top_identity(spark: SparkSession, base: str) -> DataFrame:
    return sampling.top_rows(table(spark, base, "sequences", "record_id", "v_identity"), 25, F.desc_nulls_last("v_identity"), "record_id")


# --- scalars and metadata

_SPECIES = "CASE species WHEN 'mouse_C57BL/6' THEN 'mouse' WHEN 'HIS-Mouse' THEN 'mouse' WHEN 'rat_SD' THEN 'rat' ELSE species END"


@query(f"""SELECT DISTINCT study_id, unit_id, TRY_CAST(right(trim(study_author), 4) AS BIGINT) AS study_year, {_SPECIES} AS normalized_species,
  strftime(online_modified_date AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:00') AS modified, round(online_csv_size_bytes / 1048576, 6) AS mib FROM unit_metadata""")
def unit_scalars(spark: SparkSession, base: str) -> DataFrame:
    df = table(spark, base, "unit_metadata")
    return df.select("study_id", "unit_id", S.study_year(F.col("study_author")).alias("study_year"), S.normalize_species(F.col("species")).alias("normalized_species"),
                     F.date_format(S.floor_minute(F.col("online_modified_date")), "yyyy-MM-dd HH:mm:ss").alias("modified"), F.round(S.mebibytes(F.col("online_csv_size_bytes")), 6).alias("mib")).distinct()


@query("SELECT DISTINCT study_id, lower(regexp_replace(study_id, '([a-z0-9])([A-Z])', '\\1_\\2', 'g')) AS snake FROM unit_metadata")
def snake_case(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "unit_metadata", "study_id").distinct().select("study_id", S.snake_case(F.col("study_id")).alias("snake"))


@query("""SELECT DISTINCT cdr3_aa_length AS length, CAST(1 AS DOUBLE) AS none, CAST(cdr3_aa_length * 20 AS DOUBLE) AS one, CAST(cdr3_aa_length * (cdr3_aa_length - 1) / 2 * 400 AS DOUBLE) AS two
FROM sequences WHERE cdr3_aa_length >= 2""")
def mutants(spark: SparkSession, base: str) -> DataFrame:
    n = F.col("length")
    lengths = table(spark, base, "sequences", "cdr3_aa_length").filter("cdr3_aa_length >= 2").select(F.col("cdr3_aa_length").alias("length")).distinct()
    return lengths.select("length", *(S.num_mutants(n, F.lit(k)).alias(name) for k, name in enumerate(("none", "one", "two"))))


@query(f"""SELECT DISTINCT oas_subset, study_id, unit_id, unit_id || '.csv.gz' AS file_name,
  CASE WHEN oas_subset = 'paired' THEN string_split(unit_id, '_')[1] ELSE string_split(unit_id, '_')[1] END AS origin_id,
  CASE WHEN oas_subset = 'unpaired' AND len(string_split(unit_id, '_')) = 4 THEN string_split(unit_id, '_')[2] END AS origin_occurrence,
  CASE WHEN oas_subset = 'unpaired' THEN string_split(unit_id, '_')[-2] END AS chain, CASE WHEN oas_subset = 'unpaired' THEN string_split(unit_id, '_')[-1] END AS isotype
FROM unit_metadata""")
def url_parts(spark: SparkSession, base: str) -> DataFrame:
    """Addresses written for every unit (paired ones with the slash left out) and taken apart again."""
    df = table(spark, base, "unit_metadata", *UNIT).distinct()
    slash = F.when(F.col("oas_subset") == "paired", "").otherwise("/")
    url = F.concat(F.lit(f"http://{HOST}/{ROOT}/"), "oas_subset", slash, "study_id", F.lit("/csv/"), "unit_id", F.lit(".csv.gz"))
    return df.select(parse_unit_url(url, HOST, ROOT).alias("u")).select("u.*").drop("error")


@query(f"SELECT DISTINCT 'http://{HOST}/{ROOT}/' || oas_subset || '/' || study_id AS url FROM unit_metadata")
def url_fix(spark: SparkSession, base: str) -> DataFrame:
    df = table(spark, base, "unit_metadata", "oas_subset", "study_id").distinct()
    slash = F.when(F.col("oas_subset") == "paired", "").otherwise("/")
    return df.select(fix_paired_url(F.concat(F.lit(f"http://{HOST}/{ROOT}/"), "oas_subset", slash, "study_id"), ROOT).alias("url"))


@query("SELECT DISTINCT study_id, unit_id, study_author AS \"Author\", theoretical_num_sequences_unique AS \"Unique\", false AS json_error FROM unit_metadata")
def metadata_json(spark: SparkSession, base: str) -> DataFrame:
    """Metadata as JSON quoted once more, and read again."""
    df = table(spark, base, "unit_metadata", "study_id", "unit_id", "study_author", "theoretical_num_sequences_unique").distinct()
    plain = F.to_json(F.struct(F.col("study_author").alias("Author"), F.col("theoretical_num_sequences_unique").alias("Unique")))
    quoted = F.concat(F.lit('"'), F.replace(plain, F.lit('"'), F.lit('""')), F.lit('"'))
    return metadata_from_json(df.select("study_id", "unit_id", quoted.alias("line")), "line", "Author string, Unique bigint").drop("line")


@query("""SELECT DISTINCT study_id, unit_id FROM unit_metadata
WHERE date_trunc('minute', download_date) < date_trunc('minute', online_modified_date) OR download_date IS NULL OR online_csv_size_bytes <> theoretical_num_sequences_total""")
def stale_units(spark: SparkSession, base: str) -> DataFrame:
    return metadata.stale_units(table(spark, base, "unit_metadata"), "download_date", local_size="theoretical_num_sequences_total").select("study_id", "unit_id").distinct()


@query("""SELECT DISTINCT oas_subset, study_id, unit_id, theoretical_num_sequences_unique, coalesce(n, 0) AS num_records FROM unit_metadata
LEFT JOIN (SELECT oas_subset, study_id, unit_id, count(*) AS n FROM sequences GROUP BY ALL) USING (oas_subset, study_id, unit_id) WHERE coalesce(n, 0) < theoretical_num_sequences_unique""")
def miss_processing(spark: SparkSession, base: str) -> DataFrame:
    counts = table(spark, base, "sequences", *UNIT).groupBy(*UNIT).agg(F.count(F.lit(1)).alias("num_records"))
    return metadata.miss_processing(table(spark, base, "unit_metadata"), counts)


@query("SELECT DISTINCT oas_subset, study_id, unit_id FROM unit_metadata ANTI JOIN sequences USING (oas_subset, study_id, unit_id)")
def unprocessed_units(spark: SparkSession, base: str) -> DataFrame:
    return metadata.units_without(table(spark, base, "unit_metadata", *UNIT), table(spark, base, "sequences", *UNIT).distinct())


@query("SELECT DISTINCT oas_subset, study_id, trim(unit_id) AS unit_id FROM unit_snapshots s WHERE NOT EXISTS (SELECT 1 FROM unit_metadata u WHERE u.oas_subset = s.oas_subset AND u.study_id = s.study_id AND u.unit_id = trim(s.unit_id))")
def orphan_units(spark: SparkSession, base: str) -> DataFrame:
    seen = table(spark, base, "unit_snapshots", *UNIT).withColumn("unit_id", F.trim("unit_id"))
    return metadata.units_without(seen, table(spark, base, "unit_metadata", *UNIT))


@query("SELECT DISTINCT oas_subset, study_id, unit_id FROM sequences ORDER BY ALL")
def units_on_disk(spark: SparkSession, base: str) -> DataFrame:
    return metadata.unit_ids(table(spark, base, "sequences", *UNIT))


@query("SELECT DISTINCT snapshot_no, oas_subset, study_id, unit_id, download_error FROM unit_snapshots WHERE download_error IS NULL")
def usable_units(spark: SparkSession, base: str) -> DataFrame:
    return metadata.usable_units(table(spark, base, "unit_snapshots", "snapshot_no", *UNIT, "download_error")).distinct()


# --- streams and models


def _stream(spark: SparkSession, base: str, name: str) -> DataFrame:
    path = f"{base}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    if os.path.isfile(path):  # a stream needs a folder
        return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(base)
    return file_stream(spark, path, schema)


def _run(stream: DataFrame, label: str) -> DataFrame:
    spark = stream.sparkSession
    target = f"{shared_dir(spark)}/vdjlake/{label}-{uuid.uuid4().hex}"
    ingest(stream, f"{target}/rows", f"{target}/state").awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{target}/rows").select(*stream.columns)


@query("SELECT DISTINCT sequence_aa FROM sequences WHERE sequence_aa <> '' UNION ALL SELECT sequence_aa FROM sequences WHERE sequence_aa IS NULL OR sequence_aa = ''")
def stream_dedup(spark: SparkSession, base: str) -> DataFrame:
    return _run(first_seen(_stream(spark, base, "sequences").select("sequence_aa")), "stream").select("sequence_aa")


@query("""SELECT event_type, strftime(date_trunc('day', ts), '%Y-%m-%d') AS start, count(*) AS count FROM events
GROUP BY event_type, date_trunc('day', ts) HAVING date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""")
def stream_windows(spark: SparkSession, base: str) -> DataFrame:
    """Daily counts whose windows the watermark has passed."""
    events = _stream(spark, base, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    counts = windowed_counts(events, "ts", ["event_type"], "1 day", "1 hour")
    return _run(counts.select("event_type", F.date_format("window.start", "yyyy-MM-dd").alias("start"), "count"), "windows")


@query(f"""SELECT record_id, array_to_string(list_transform(string_split('ACDEFGHIKLMNPQRSTVWY', ''), lambda x: length(j) - length(replace(j, x, ''))), ',') AS residues
FROM (SELECT record_id, {_CLEAN} AS j FROM sequences)""")
def embed_composition(spark: SparkSession, base: str) -> DataFrame:
    """The shares of all residues that the stand-in model gives, as numbers of residues again."""
    j: Column = F.nullif(F.regexp_replace(F.upper("junction_aa"), "[^A-Z]+", ""), F.lit(""))
    df = table(spark, base, "sequences", "record_id", "junction_aa").select("record_id", j.alias("j"))
    out = embed(df, composition_model, "j")
    counts = F.transform("embedding", lambda x: F.round(x * F.length("j")).cast("int").cast("string"))
    return out.select("record_id", F.array_join(counts, ",").alias("residues"))
