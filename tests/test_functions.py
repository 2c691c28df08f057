import pytest
from pyspark.sql import functions as F

from vdjlake.functions import positions as P
from vdjlake.functions import scalars as S
from vdjlake.functions.numbering import with_numbering
from vdjlake.functions.status import parse_status
from vdjlake.functions.urls import fix_paired_url, parse_unit_url


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("text", "number", "code"),
    [("1", 1, 0), ("111", 111, 0), ("111A", 111, 1), ("111Z", 111, 26), ("112", 112, 0), ("112A", 112, -1), ("112Z", 112, -26), ("111AA", 111, 27), ("112ZZ", 112, -52), ("56 ", 56, 0), ("62A", 62, 1), ("111AB", 111, None), ("x", None, 0)],
)
def test_position_key(spark, text, number, code):
    key = one(spark, P.position_key(F.lit(text)))
    assert (key["number"], key["code"]) == (number, code)


@pytest.mark.parametrize(("text", "expected"), [("1=A", (1, 0, "A")), ("112A=V", (112, -1, "V"))])
def test_position_residue(spark, text, expected):
    assert tuple(one(spark, P.position_residue(F.lit(text)))) == expected


def test_insertion_round_trip(spark):
    codes = spark.range(0, 54).select(F.col("id").cast("int").alias("c"), P.insertion_of_code(-F.col("id").cast("int")).alias("i"))
    out = {r["c"]: r["i"] for r in codes.collect()}
    assert (out[0], out[1], out[26], out[27], out[52], out[53]) == ("", "A", "Z", "AA", "ZZ", None)
    with pytest.raises(Exception, match="unknown insertion"):
        one(spark, P.insertion_code(F.lit("AB"), strict=True))


STATUS = [
    ("|Deletions: 9, 3, 3||", {"deletions": [3, 9]}),
    ("|Missing Conserved Cysteine: 104|Unusual residue: B14|", {"missing_conserved_cysteine": True, "unusual_residue": True}),
    ("Shorter than IMGT defined: fw4, fw1", {"fwr1_shorter_than_imgt_defined": True, "fwr4_shorter_than_imgt_defined": True}),
    ("||CDR3 is over 37 aa long|Shorter than IMGT defined: fw4", {"cdr3_is_over_37_aa_long": True, "fwr4_shorter_than_imgt_defined": True}),
    (" | Insertion: 85B | Deletions: 128 |", {"insertions": ["85B"], "deletions": [128]}),
    ("|||Insertion: 3A, 1B|", {"insertions": ["1B", "3A"]}),
    ("['fw4 is shorter than IMGT defined']", {"fwr4_shorter_than_imgt_defined": True}),
    ("['Unusual amino acid: Z9', 'Missing Conserved Cysteine 23 or 104']", {"unusual_residue": True, "missing_conserved_cysteine": True}),
    ("['Insertion: 17C', 'Insertion: 17B', 'fw1 is shorter than IMGT defined']", {"insertions": ["17B", "17C"], "fwr1_shorter_than_imgt_defined": True}),
    ("[]", {}),
    (None, {}),
    ("", {}),
    ("||||", {}),
]


@pytest.mark.parametrize(("text", "expected"), STATUS)
def test_status(spark, text, expected):
    got = one(spark, parse_status(F.lit(text).cast("string"))).asDict()
    assert got.pop("unknown") == []
    assert {k: v for k, v in got.items() if v} == expected


@pytest.mark.parametrize("text", ["|Deletions: 1: 2|", "|Something new: 3|", "['Something new']", "[not a list", "|Shorter than IMGT defined: fw2|"])
def test_status_unknown(spark, text):
    assert one(spark, parse_status(F.lit(text)))["unknown"]
    with pytest.raises(Exception, match="unknown status"):
        one(spark, parse_status(F.lit(text), strict=True))


def _literal(regions, locus="h"):
    """A map with its positions in the order of strings, as the numbering software writes them."""
    names = {"fwr": "fw", "cdr": "cdr"}
    return str({f"{names[r[:3]]}{locus}{r[3]}": {f"{k} " if k.isdigit() else k: v for k, v in sorted(e.items())} for r, e in regions.items()})


def _placed(text, *positions):
    return dict(zip(map(str, positions), text, strict=True))


#: A made-up kappa chain: a full first region, gaps in the loops, three deletions in the third framework, two insertions on either side of CDR3.
KAPPA = {
    "fwr1": _placed("DIVLSQTPATLSVTPGERLSLTCKAS", *range(1, 27)),
    "cdr1": _placed("QNVGTH", 27, 28, 29, 36, 37, 38),
    "fwr2": _placed("LNWFQKRPGESPKVLIF", *range(39, 56)),
    "cdr2": _placed("RTN", 56, 57, 65),
    "fwr3": _placed("YRDTGVPERFTGSGHGTEYSLRIDSLEPADLAVFYC", *(p for p in range(66, 105) if p not in (73, 81, 82))),
    "cdr3": _placed("QHWNDYPGAVHPREMFT", *range(105, 112), "111A", "111B", "112B", "112A", *range(112, 118)),
    "fwr4": _placed("FGEGTRLDVK", *range(118, 128)),
}


def _numbered(rows, locus="H", numbering=None, status=None, cdr3="QHWNDYPGAVHPREMFT"):
    df = rows([(locus, numbering, status, cdr3)], "locus string, ANARCI_numbering string, ANARCI_status string, cdr3_aa string")
    return with_numbering(df).first()


def test_numbering_record(rows):
    r = _numbered(rows, "K", _literal(KAPPA, "k"), "|Deletions: 82, 73, 81|Insertion: 111A|")
    got = [(r[f"{x}_aa_start"], r[f"{x}_aa_length"]) for x in KAPPA]
    assert got == [(0, 26), (26, 6), (32, 17), (49, 3), (52, 36), (88, 17), (105, 10)]
    assert r["sequence_aa"] == "DIVLSQTPATLSVTPGERLSLTCKAS" "QNVGTH" "LNWFQKRPGESPKVLIF" "RTN" "YRDTGVPERFTGSGHGTEYSLRIDSLEPADLAVFYC" "QHWNDYPGAVHPREMFT" "FGEGTRLDVK"
    assert "".join(r["imgt_insertions"]) == "ABBA" and r["imgt_positions"][93:101] == [110, 111, 111, 111, 112, 112, 112, 113]
    assert r["has_insertions"] and r["anarci_deletions"] == [73, 81, 82] and r["anarci_insertions"] == ["111A"] and r["numbering_error"] is None
    flags = [k for k in r.asDict() if k.startswith(("has_", "anarci_")) and r[k] is True]
    assert flags == ["has_insertions"]


def test_numbering_edges(rows):
    kappa = _numbered(rows, "K", _literal({"fwr1": {"21": "-", "23": "A"}, "cdr2": {"62": "x", "62A": "y", "61A": "z"}}, "k"), cdr3=None)
    assert kappa["has_kappa_gap_21"] and kappa["has_mutated_conserved_cysteines"] and kappa["has_unexpected_insertions"]
    assert kappa["sequence_aa"] == "-Azyx" and kappa["has_wrong_cdr3_reconstruction"] and kappa["cdr3_aa_start"] is None and kappa["cdr3_aa_length"] == 0
    assert not _numbered(rows, "H", _literal({"fwr1": {"1": "Q"}}))["has_mutated_conserved_cysteines"]  # absence doesn't flag
    errors = [
        _numbered(rows, None, _literal(KAPPA)), _numbered(rows, "H", None), _numbered(rows, "H", "{'fwh1': {'1 ': None"),
        _numbered(rows, "L", _literal(KAPPA)), _numbered(rows, "H", _literal({"fwr1": {"1AB": "Q"}})), _numbered(rows, "H", _literal(KAPPA), "|What: 1|"),
    ]
    assert [e["numbering_error"].split(":")[0] for e in errors] == ["no locus", "no numbering", "unreadable numbering", "no region of this locus", "malformed position", "unknown status"]


HOST, ROOT = "data.example.org", "archive/units"


@pytest.mark.parametrize(
    ("tail", "expected"),
    [
        ("paired/Lab_2021/csv/X77_paired.csv.gz", ("paired", "X77_paired", "X77", None, None, None)),
        ("pairedLab_2021/csv/X77_paired.csv.gz", ("paired", "X77_paired", "X77", None, None, None)),
        ("unpaired/A_2018/csv/run9_Light_Bulk.csv.gz", ("unpaired", "run9_Light_Bulk", "run9", None, "Light", "Bulk")),
        ("unpaired/A_2018/csv/run9_3_Heavy_IGHA.csv.gz", ("unpaired", "run9_3_Heavy_IGHA", "run9", "3", "Heavy", "IGHA")),
        ("unpaired/A_2018/csv/donor_b_07_Heavy_IGHD.csv.gz", ("unpaired", "donor_b_07_Heavy_IGHD", "donorb", "07", "Heavy", "IGHD")),
        ("unpaired/A_2018/csv/schanz_2014_04_2_Light_Bulk.csv.gz", ("unpaired", "schanz_2014_04_2_Light_Bulk", "schanz201404", "2", "Light", "Bulk")),
    ],
)
def test_urls(spark, tail, expected):
    u = one(spark, parse_unit_url(F.lit(f"http://{HOST}/{ROOT}/{tail}"), HOST, ROOT))
    assert (u["oas_subset"], u["unit_id"], u["origin_id"], u["origin_occurrence"], u["chain"], u["isotype"]) == expected


@pytest.mark.parametrize("url", [f"https://{HOST}/{ROOT}/paired/A/csv/x.csv.gz", f"http://other/{ROOT}/paired/A/csv/x.csv.gz", f"http://{HOST}/{ROOT}/paired/A/x.csv.gz", f"http://{HOST}/{ROOT}/unpaired/A/csv/a_b_c_1_Heavy_IGHM.csv.gz", f"http://{HOST}/{ROOT}/unpaired/A/csv/a_b.csv.gz", "nonsense"])
def test_bad_urls(spark, url):
    assert one(spark, parse_unit_url(F.lit(url), HOST, ROOT, strict=False))["error"]
    with pytest.raises(Exception):
        one(spark, parse_unit_url(F.lit(url), HOST, ROOT))


def test_fix_url_leaves_good_ones(spark):
    good = f"http://{HOST}/{ROOT}/paired/A/csv/x"
    assert one(spark, fix_paired_url(F.lit(good), ROOT)) == good


@pytest.mark.parametrize(("length", "k", "expected"), [(5, 0, 1), (4, 1, 80), (4, 2, 2400), (2, None, 400), (0, None, 1)])
def test_mutants(spark, length, k, expected):
    assert one(spark, S.num_mutants(F.lit(length), F.lit(k).cast("int"))) == expected == S.num_mutants_exact(length, k)


def test_mutants_refuses(spark):
    with pytest.raises(ValueError):
        S.num_mutants_exact(2, 3)
    with pytest.raises(Exception, match="more mutations"):
        one(spark, S.num_mutants(F.lit(2), F.lit(3)))


def test_small_conversions(spark):
    assert one(spark, S.loose_int(F.lit("33.0"))) == 33 and one(spark, S.loose_int(F.lit("33.5"))) is None and one(spark, S.loose_int(F.lit(""))) is None
    assert one(spark, S.loose_int(F.lit("9007199254740993"), "bigint")) == 9007199254740993 and one(spark, S.loose_int(F.lit(" -2e1 "))) == -20 and one(spark, S.loose_int(F.lit("99999999999"))) is None
    assert one(spark, S.tf_flag(F.lit("T"))) is True and one(spark, S.tf_flag(F.lit("F"))) is False
    with pytest.raises(Exception, match="not T or F"):
        one(spark, S.tf_flag(F.lit("maybe")))
    assert [one(spark, S.snake_case(F.lit(x))) for x in ("UnitTable", "readJSONLine", "plain", "V2Call", "Gene_Name", "x-Yz")] == ["unit_table", "read_json_line", "plain", "v2_call", "gene_name", "x-_yz"]
    assert one(spark, S.study_year(F.lit("Bhiman et al., 2015 "))) == 2015 and one(spark, S.study_year(F.lit("nobody"))) is None
    assert one(spark, S.normalize_species(F.lit("HIS-Mouse"))) == "mouse" and one(spark, S.normalize_species(F.lit("axolotl"))) == "axolotl"
    assert str(one(spark, S.http_date(F.lit("Tue, 01 Feb 2022 10:11:12 GMT")))) == "2022-02-01 10:11:00" and one(spark, S.http_date(F.lit("soon"))) is None
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert one(spark, S.http_date(F.lit("Tue, 01 Feb 2022 10:11:12 GMT")).cast("long")) == 1643710260
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_splits(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("s"))
    for split in (S.portable_subset, S.xxh32_subset):
        shares = {r["x"]: r["count"] / 20000 for r in df.groupBy(split(F.col("s")).alias("x")).count().collect()}
        assert abs(shares["train"] - 0.8) < 0.02 and abs(shares["test"] - 0.1) < 0.02
        assert one(spark, split(F.lit(None).cast("string"))) is None
    with pytest.raises(ValueError):
        S.portable_subset(F.col("s"), (("train", 50),))


def test_hashes_are_the_public_ones(spark):
    import xxhash

    assert int(one(spark, S.xxh3_64(F.lit("QVQL")))) == xxhash.xxh3_64_intdigest("QVQL")
    bucket = xxhash.xxh32_intdigest("QVQL") % 100
    assert one(spark, S.xxh32_subset(F.lit("QVQL"))) == ("train" if bucket < 80 else "validation" if bucket < 90 else "test")
