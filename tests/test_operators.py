import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vdjlake.operators import dedup, filters, metadata, normalize, pairs, sampling, stats
from vdjlake.schema import HEADER_FAMILIES, SEQUENCE_SCHEMA, U1, header_family

UNIT = "oas_subset string, study_id string, unit_id string"


def test_schema_counts():
    assert len(SEQUENCE_SCHEMA) == 128
    assert {k: len(v) for k, v in HEADER_FAMILIES.items()} == {"U1": 97, "U2": 95, "P1": 180, "P2": 198}
    assert header_family(U1) == "U1" and header_family(["a"]) is None


@pytest.fixture
def records(rows):
    data = [
        ("unpaired", "B", "u", 0, "heavy", "AAA", 2, True, 25), ("unpaired", "B", "u", 1, "heavy", "AAA", None, True, 25), ("unpaired", "B", "u", 2, "heavy", "CCC", 1, None, 25),
        ("paired", "Z", "v", 0, "heavy", "AAA", 5, True, 10), ("paired", "Z", "v", 0, "light", "", 1, True, 25), ("paired", "Z", "v", 1, "light", "", 1, False, None),
        ("unpaired", "B", "w", 0, "light", None, None, True, 25), ("unpaired", "B", "w", 1, "light", None, 4, True, 25),
    ]
    return rows(data, f"{UNIT}, index_in_unit bigint, chain string, sequence_aa string, redundancy bigint, productive boolean, fwr1_aa_length int")


def test_merge_redundant(records):
    out = {(r["unit_id"], r["sequence_aa"]): (r["index_in_unit"], r["redundancy"]) for r in dedup.merge_redundant(records).collect()}
    assert out == {("u", "AAA"): (0, 3), ("u", "CCC"): (2, 1), ("v", "AAA"): (0, 5), ("v", ""): (0, 2), ("w", None): (0, 5)}
    assert records.agg(F.sum(F.coalesce("redundancy", F.lit(1)))).first()[0] == dedup.merge_redundant(records).agg(F.sum("redundancy")).first()[0]


def test_no_duplicates_keeps_paired_first_and_all_empty(records):
    once = dedup.no_duplicates(records)
    got = sorted((r["unit_id"], r["index_in_unit"], r["sequence_aa"] or "-") for r in once.collect())
    assert got == [("u", 2, "CCC"), ("v", 0, "-"), ("v", 0, "AAA"), ("v", 1, "-"), ("w", 0, "-"), ("w", 1, "-")]
    assert sorted(map(str, dedup.no_duplicates(once).collect())) == sorted(map(str, once.collect()))
    assert dedup.no_duplicates(records.limit(0)).count() == 0 and dedup.merge_redundant(records.limit(0)).count() == 0


def test_unique_index(records):
    out = {r["sequence_aa"]: r["units"] for r in dedup.unique_index(records).collect()}
    assert out == {"AAA": ["paired,Z,v", "unpaired,B,u"], "CCC": ["unpaired,B,u"]}
    assert tuple(dedup.index_totals(records).first()) == (8, 2)


def test_filters_drop_nulls_and_name_themselves(records):
    assert filters.only_productive()(records).count() == 6
    assert filters.no_short_fwr1(20)(records).count() == 6
    assert filters.no_short_fwr1(20).name == "NoShortFWR1(threshold=20)"
    assert filters.only_isotypes("IGHM").name == "OnlyIsotypes(isotypes=['IGHM'])"
    assert filters.run_filters(records, "none").count() == 8
    with pytest.raises(KeyError):
        filters.pipeline("unknown")


@pytest.mark.parametrize("wanted", ["IGHM", "IGHG"])
def test_only_isotypes_keeps_or_drops_whole_units(rows, records, wanted):
    units = rows([("unpaired", "B", "u", "IGHM"), ("unpaired", "B", "u", "IGHM"), ("paired", "Z", "v", "IGHG")], f"{UNIT}, isotype string")
    out = filters.only_isotypes((wanted,))(metadata.attach_units(records, units, ["isotype"]))
    assert {r["unit_id"] for r in out.collect()} == {"u" if wanted == "IGHM" else "v"} and out.count() == 3


def test_filter_log_adds_up(records):
    steps = [filters.only_productive(), filters.no_short_fwr1(20), filters.merge_step(), filters.dedup_step()]
    log = filters.filter_log(records, steps).collect()
    for unit in ("u", "v", "w"):
        mine = sorted((r for r in log if r["unit_id"] == unit), key=lambda r: r["step"])
        assert all(a["filtered_length"] == b["unfiltered_length"] for a, b in zip(mine, mine[1:]))
        assert all(r["filtered_out"] == r["unfiltered_length"] - r["filtered_length"] for r in mine)
    assert sum(r["filtered_length"] for r in log if r["step"] == 3) == filters.run_filters(records, steps).count()
    assert filters.filter_log(records, "none").count() == 0


def test_no_naive(rows):
    df = rows([("QVX", "QVA"), ("QVA", "EIA"), (None, "Q")], "v_sequence_alignment_aa string, v_germline_alignment_aa string")
    assert [r[0] for r in filters.no_naive(2)(df).collect()] == ["QVA"]


def test_position_counts_and_matrix(rows):
    df = rows([("heavy", "CAW", [111, 111, 112], ["", "A", ""]), ("heavy", "CAW", [111, 112, 118], None), ("heavy", None, None, None), ("light", "", [], None)], "chain string, sequence_aa string, imgt_positions array<smallint>, imgt_insertions array<string>")
    counts = stats.position_counts(df)
    assert {(r["position"], r["residue"]): r["count"] for r in counts.collect()} == {("111", "C"): 2, ("111A", "A"): 1, ("112", "A"): 1, ("112", "W"): 1, ("118", "W"): 1}
    matrix = stats.in_position_order(stats.position_matrix(counts, ["chain"])).collect()
    assert [r["position"] for r in matrix] == ["111", "111A", "112", "118", "total"] and matrix[-1]["total"] == 6 and matrix[-1]["region"] == "sequence" and matrix[3]["region"] == "fwr4"
    assert stats.marginals(counts).filter("position IS NULL AND residue IS NULL").first()["count"] == 6


def test_histograms_total_the_rows(records):
    assert stats.length_histogram(records).agg(F.sum("count")).first()[0] == 6
    regions = stats.region_length_histograms(records, {"fwr1": "fwr1_aa_length"})
    assert regions.agg(F.sum("count")).first()[0] == 7
    assert stats.region_maxima(records, ["unit_id"], {"fwr1": "fwr1_aa_length"}, "heavy").filter("unit_id = 'v'").first()[1] == 10


def test_counts_drop_null_keys_and_merge(rows):
    df = rows([("a", "x"), ("a", None), (None, "x"), ("a", "x")], "g string, h string")
    assert [tuple(r) for r in stats.group_counts(df, ["g", "h"]).collect()] == [("a", "x", 2)]
    a, b = rows([("x", 1), ("y", 2)], "k string, n bigint"), rows([("y", 5)], "k string, n bigint")
    assert {r["k"]: r["n"] for r in stats.merge_counts([a, b], ["k"], "n").collect()} == {"x": 1, "y": 7}


def test_check_schemas(rows):
    df = rows([("paired", "s", ["b", "a"]), ("unpaired", "t", ["a", "b"]), ("unpaired", "t", ["a"])], "oas_subset string, study_id string, column_names array<string>")
    groups = stats.schema_groups(df, expected={"AB": frozenset("ab")})
    assert {r["columns"]: (r["num_units"], r["family"]) for r in groups.collect()} == {"a,b": (2, "AB"), "a": (1, None)}
    with pytest.raises(ValueError, match="unexpected"):
        stats.check_schemas(groups)


def test_offsets(rows):
    df = rows([(1, 14, 5)], "fwr1_start int, fwr1_end int, fwr1_aa_start int")
    assert normalize.zero_based(df).first().asDict() == {"fwr1_start": 0, "fwr1_aa_start": 5, "fwr1_length": 14}
    with pytest.raises(ValueError, match="only one"):
        normalize.zero_based(df.drop("fwr1_end"))
    with pytest.raises(ValueError, match="no known stretch"):
        normalize.zero_based(df.withColumn("odd_start", F.lit(1)))


def test_conform_refuses_and_fills(rows):
    out = normalize.conform(rows([("H", "1")], "locus string, redundancy string"))
    assert out.schema.names == SEQUENCE_SCHEMA.names and out.first()["redundancy"] == 1 and out.first()["d_call"] is None
    with pytest.raises(ValueError, match="unexpected columns: odd"):
        normalize.conform(rows([(1,)], "odd int"))


def test_canonical_rows_quarantine(rows):
    number = "{'fwh1': {'1 ': 'Q', '2 ': 'V'}, 'cdrh3': {'105 ': 'A'}}"
    data = [(0, "H", number, "A", "T", "1.0", "3.0"), (1, None, number, "A", "T", "1", "3"), (2, "H", number, "A", "maybe", "1", "3"), (3, "H", number, "A", "F", "9", "3")]
    raw = rows([("unpaired", "s", "u", *r) for r in data], f"{UNIT}, index_in_unit bigint, locus string, ANARCI_numbering string, cdr3_aa string, productive string, fwr1_start string, fwr1_end string")
    good, bad = normalize.canonical_rows(raw)
    row = good.first()
    assert good.count() == 1 and (row["sequence_aa"], row["fwr1_start"], row["fwr1_length"], row["productive"], row["chain"]) == ("QVA", 0, 3, True, "heavy")
    assert {r["index_in_unit"]: r["error"].split(" ")[0] for r in bad.collect()} == {1: "no", 2: "productive", 3: "negative"}


def test_paired_rows_become_two(rows):
    raw = rows([("paired", "s", "u", 0, "H", "K", "x")], f"{UNIT}, index_in_unit bigint, locus_heavy string, locus_light string, v_call_light string")
    out = {r["locus"]: r["v_call"] for r in normalize.unpivot_pairs(raw, ["index_in_unit"]).collect()}
    assert out == {"H": None, "K": "x"}


def test_repair_pairs(rows):
    df = rows([("p", "s", "u", 0, "heavy", "A"), ("p", "s", "u", 0, "light", "B"), ("p", "s", "u", 1, "heavy", "C"), ("p", "s", "u", None, "light", "D")], f"{UNIT}, index_in_unit bigint, chain string, v string")
    assert [(r["v_heavy"], r["v_light"]) for r in pairs.repair_pairs(df, ["v"]).collect()] == [("A", "B")]


def test_samples(records, spark):
    assert sampling.sample_rows(records, 1).groupBy("unit_id").count().filter("count > 1").count() == 0
    assert sorted(map(str, sampling.sample_rows(records.repartition(1), 2).collect())) == sorted(map(str, sampling.sample_rows(records.repartition(7), 2).collect()))
    assert sampling.sample_rows(records, -1).count() == 8 and sampling.sample_rows(records, 0).count() == 0
    units = spark.range(3000).select(F.lit("paired").alias("oas_subset"), F.lit("s").alias("study_id"), F.col("id").cast("string").alias("unit_id"))
    assert abs(sampling.sample_units(units, 0.3).count() / 3000 - 0.3) < 0.04 and sampling.sample_units(units, 0).count() == 3000 and sampling.sample_units(units, 1).count() == 3000


def test_unit_sample_matches_numpy(spark):
    import numpy as np
    import xxhash

    ids = ["paired,a,b", "unpaired,c,d"]
    got = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "id string").coalesce(1).select(sampling.unit_chance("id")).collect()]
    assert got == [np.random.RandomState(xxhash.xxh32_intdigest(i)).uniform() for i in ids]


def test_metadata(rows):
    raw = rows([("A et al., 2015", "HIS-Mouse", "Tue, 01 Feb 2022 10:11:12 GMT", "24.0")], "Author string, Species string, `Last-Modified` string, `Content-Length` string")
    r = metadata.nice_metadata(raw).first()
    assert (r["study_year"], r["normalized_species"], r["online_csv_size_bytes"]) == (2015, "mouse", 24) and str(r["online_modified_date"]) == "2022-02-01 10:11:00"
    t = dt.datetime(2022, 1, 1, 10, 0, 30)
    units = rows([("a", None, t, 1, 1), ("b", t, t.replace(second=59), 1, 1), ("c", t, t.replace(minute=5), 1, 1), ("d", t, t, 1, 2), ("e", t, None, None, 2)], "u string, original_local_csv_mdate timestamp, online_modified_date timestamp, online_csv_size_bytes bigint, local_csv_size_bytes bigint")
    assert {r["u"] for r in metadata.stale_units(units).collect()} == {"a", "c", "d"}
    one = rows([("paired", "s", "u")], UNIT)
    assert metadata.one_unit(one, "paired", "s", "u").count() == 1
    with pytest.raises(LookupError):
        metadata.one_unit(one, "paired", "s", "x")


def test_attach_units_replaces_clashing_columns_and_doubles_nothing(rows, records):
    units = rows([("paired", "Z", "v", 9), ("paired", "Z", "v", 9)], f"{UNIT}, redundancy bigint")
    out = metadata.attach_units(records, units, ["redundancy"])
    assert out.count() == 8 and {r["redundancy"] for r in out.collect()} == {9, None}


def test_merge_then_dedup_on_random_rows(spark):
    rng = random.Random(5)
    data = [("unpaired", f"s{rng.randrange(2)}", f"u{rng.randrange(3)}", i, "heavy", rng.choice(["AA", "CC", "DD", "", None]), rng.choice([None, 1, 2])) for i in range(300)]
    df = spark.createDataFrame(data, f"{UNIT}, index_in_unit bigint, chain string, sequence_aa string, redundancy bigint")
    merged = {}
    for r in sorted(data, key=lambda r: (r[1], r[2], r[3])):
        k = (r[1], r[2], r[5])
        merged[k] = (merged[k][0] if k in merged else r[3], (merged[k][1] if k in merged else 0) + (1 if r[6] is None else r[6]))
    seen, left = set(), []
    for (s, u, v), (i, n) in sorted(merged.items(), key=lambda x: (x[0][0], x[0][1], x[1][0])):
        if not v or v not in seen:
            seen.add(v)
            left.append((s, u, v, i, n))
    got = filters.run_filters(df, [filters.merge_step(), filters.dedup_step()]).collect()
    assert sorted(map(str, ((r["study_id"], r["unit_id"], r["sequence_aa"], r["index_in_unit"], r["redundancy"]) for r in got))) == sorted(map(str, left))


def _tables(folder, **tables):
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_numbering_whole_loses_no_residue(rows, folder):
    from vdjlake.plans.repertoire import QUERIES

    long = "C" + "ARGLLGRFLEWWTTEGYGMDV" + "W"
    data = [(1, "H", long), (2, "K", "cqq-ynt w"), (3, "H", "CW"), (4, "H", "C"), (5, None, long), (6, "L", " - "), (7, "H", "C" + "A" * 117 + "W"), (8, "H", "C" + "A" * 118 + "W"), (9, "H", "C" + "ARGLLGRFLEWWT" + "W")]
    base = _tables(folder, sequences=rows(data, "record_id bigint, locus string, junction_aa string"))
    got = {r["record_id"]: r for r in QUERIES["numbering_whole"](rows([], "x int").sparkSession, base).collect()}
    assert sorted(got) == list(range(1, 10))
    assert got[1]["sequence_aa"] == long and not got[1]["has_wrong_cdr3_reconstruction"] and got[1]["has_insertions"]
    assert got[1]["positions"] == "104,105,106,107,108,109,110,111,111A,111B,111C,111D,112D,112C,112B,112A,112,113,114,115,116,117,118"
    assert (got[1]["cdr3_aa_start"], got[1]["cdr3_aa_length"], got[1]["fwr4_aa_start"]) == (1, 21, 22)
    assert (got[2]["sequence_aa"], got[2]["positions"]) == ("CQQYNTW", "104,105,106,107,116,117,118")
    assert (got[3]["positions"], got[4]["positions"], got[3]["has_wrong_cdr3_reconstruction"]) == ("104,118", "104", True)
    assert (len(got[7]["sequence_aa"]), got[7]["numbering_error"], got[7]["has_wrong_cdr3_reconstruction"]) == (119, None, False)
    assert [got[i]["numbering_error"] for i in (5, 6, 8)] == ["no locus", "no numbering", "malformed position"]
    assert got[9]["positions"] == ",".join(map(str, range(104, 119))) and not got[9]["has_insertions"]


def test_position_matrix_has_every_residue(rows, folder):
    from vdjlake.plans.repertoire import QUERIES

    base = _tables(folder, sequences=rows([("heavy", stats.AMINO_ACIDS), ("heavy", "YJ"), ("light", None)], "chain string, junction_aa string"))
    got = {r["position"]: r.asDict() for r in QUERIES["position_matrix"](rows([], "x int").sparkSession, base).collect()}
    assert set(stats.AMINO_ACIDS) <= set(got["1"])
    assert {k: v for k, v in got["1"].items() if v} == {"chain": "heavy", "position": "1", "region": "fwr1", stats.AMINO_ACIDS[0]: 1, "Y": 1, "total": 2}
    # a letter that is no residue is in the total only
    assert sum(got["total"][r] for r in stats.AMINO_ACIDS) == len(stats.AMINO_ACIDS) + 1 and got["total"]["total"] == len(stats.AMINO_ACIDS) + 2


def test_usable_units_has_every_snapshot(rows, folder):
    from vdjlake.plans.repertoire import QUERIES

    data = [(n, "paired", "s", u, e) for n in (1, 6, 17) for u, e in (("a", None), ("a", None), ("b", "gone"), (f"c{n}", None))]
    base = _tables(folder, unit_snapshots=rows(data, f"snapshot_no int, {UNIT}, download_error string"))
    got = [(r["snapshot_no"], r["unit_id"]) for r in QUERIES["usable_units"](rows([], "x int").sparkSession, base).collect()]
    assert sorted(got) == [(1, "a"), (1, "c1"), (6, "a"), (6, "c6"), (17, "a"), (17, "c17")]


def test_numbering_of_whole_sequences(rows, folder):
    from vdjlake.plans.repertoire import QUERIES

    seq = "".join("ADEFGHIKLMNPQRSTVWY"[i % 19] for i in range(133))
    data = [(7, "light", "K", seq[:128]), (2, "heavy", "H", seq), (3, "heavy", "H", " c-" + seq[:40].lower()), (4, "heavy", None, seq), (5, "heavy", "L", " "), (6, "heavy", "L", None), (22, "heavy", "L", seq[:110])]
    schema = "record_id bigint, chain string, locus string, sequence_aa string, anarci_missing_conserved_cysteine boolean, anarci_unusual_residue boolean, anarci_deletions array<smallint>, anarci_insertions array<string>"
    base = _tables(folder, sequences=rows([(*d, True, False, [9, 3, 9], None) for d in data], schema))
    got = {r["record_id"]: r for r in QUERIES["numbering"](rows([], "x int").sparkSession, base).collect()}
    assert sorted(got) == [2, 3, 4, 5, 6, 7, 22]
    assert got[7]["sequence_aa"] == seq[:20] + "-" + seq[21:128] and got[7]["has_kappa_gap_21"] and got[7]["positions"] == ",".join(map(str, range(1, 129)))
    assert got[2]["sequence_aa"] == seq and got[2]["positions"].split(",")[109:120] == ["110", "111", "111A", "111B", "112C", "112B", "112A", "112", "113", "114", "115"]
    assert (got[2]["lengths"], got[2]["starts"], got[2]["has_wrong_cdr3_reconstruction"]) == ("26,12,17,10,39,18,11", "0,26,38,55,65,104,122", False)
    assert got[3]["sequence_aa"] == "C" + seq[:40] and got[3]["lengths"] == "26,12,3,0,0,0,0" and got[3]["starts"] == "0,26,38,-1,-1,-1,-1" and got[3]["has_wrong_cdr3_reconstruction"]
    assert [got[i]["numbering_error"] for i in (4, 5, 6)] == ["no locus", "no numbering", "no numbering"] and got[22]["has_wrong_cdr3_reconstruction"]
    assert all(r["deletions"] == "3,9" and r["anarci_missing_conserved_cysteine"] and not r["anarci_unusual_residue"] for r in got.values())


def test_first_rows_of_narrow_and_wide_tables_agree(spark):
    rng = random.Random(5)
    data = [(rng.choice("uv"), rng.choice(["A", "B", "", None]), i, rng.choice([None, 1, 4]), f"x{i % 7}") for i in range(300)]
    df = spark.createDataFrame(data, "unit string, s string, i int, redundancy bigint, more string").repartition(5)
    wide = dedup.merge_redundant(df, ["unit"], "s", ("i",), unique_order=True)
    narrow = dedup.merge_redundant(df.drop("more"), ["unit"], "s", ("i",), unique_order=True)
    assert sorted(map(str, wide.drop("more").collect())) == sorted(map(str, narrow.collect())) and wide.count() == 8
    assert all(r["more"] == f"x{r['i'] % 7}" for r in wide.collect())
    assert dedup.no_duplicates(df, "s", ["i"], unique_order=True).count() == 2 + sum(not d[1] for d in data)
    plan = dedup.no_duplicates(df, "s", ["i"], unique_order=True).select("s")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
