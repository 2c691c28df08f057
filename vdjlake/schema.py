"""The canonical sequence table, and the headers that source files come with."""

from __future__ import annotations

from pyspark.sql import types as T

REGIONS = ("fwr1", "cdr1", "fwr2", "cdr2", "fwr3", "cdr3", "fwr4")
GENES = ("v", "d", "j")
#: Stretches that source files give as 1-based, inclusive start and end.
OFFSET_STRETCHES = (
    *(f"{g}_alignment" for g in GENES),
    *(f"{g}_{kind}" for g in GENES for kind in ("sequence", "germline")),
    *REGIONS,
)
FLAGS = ("rev_comp", "stop_codon", "vj_in_frame", "v_frameshift", "productive", "complete_vdj")
#: Flags computed from the numbering, and from the status string.
NUMBERING_FLAGS = ("has_insertions", "has_unexpected_insertions", "has_mutated_conserved_cysteines", "has_wrong_cdr3_reconstruction", "has_kappa_gap_21")
STATUS_FLAGS = ("missing_conserved_cysteine", "unusual_residue", "fwr1_shorter_than_imgt_defined", "fwr4_shorter_than_imgt_defined", "cdr3_is_over_37_aa_long")
UNIT_KEY = ("oas_subset", "study_id", "unit_id")
SUBSETS = ("paired", "unpaired")  # in the order in which they are processed
AMINO_ACIDS = "ABCDEFGHIKLMNPQRSTUVWXYZ"
NATURAL_AMINO_ACIDS = "ACDEFGHIKLMNPQRSTVWY"

#: The 128 columns in their order; fixed values.
SEQUENCE_COLUMNS = """
    index_in_unit bigint, chain string, locus string, isotype string, v_call string, d_call string, j_call string, sequence string, sequence_aa
    string, imgt_positions array<smallint>, imgt_insertions array<string>, rev_comp boolean, junction_aa string, junction_aa_length int, fwr1_start
    int, fwr1_length int, fwr1 string, cdr1_start int, cdr1_length int, cdr1 string, fwr2_start int, fwr2_length int, fwr2 string, cdr2_start int,
    cdr2_length int, cdr2 string, fwr3_start int, fwr3_length int, fwr3 string, cdr3_start int, cdr3_length int, cdr3 string, fwr4_start int,
    fwr4_length int, fwr4 string, fwr1_aa_start int, fwr1_aa_length int, fwr1_aa string, cdr1_aa_start int, cdr1_aa_length int, cdr1_aa string,
    fwr2_aa_start int, fwr2_aa_length int, fwr2_aa string, cdr2_aa_start int, cdr2_aa_length int, cdr2_aa string, fwr3_aa_start int, fwr3_aa_length
    int, fwr3_aa string, cdr3_aa_start int, cdr3_aa_length int, cdr3_aa string, fwr4_aa_start int, fwr4_aa_length int, fwr4_aa string, redundancy
    bigint, sequence_id string, sequence_alignment string, sequence_alignment_aa string, germline_alignment string, germline_alignment_aa string,
    junction string, junction_length int, d_alignment_length int, d_alignment_start int, d_cigar string, d_germline_alignment string,
    d_germline_alignment_aa string, d_germline_length int, d_germline_start int, d_identity double, d_score double, d_sequence_alignment string,
    d_sequence_alignment_aa string, d_sequence_length int, d_sequence_start int, d_support double, j_alignment_length int, j_alignment_start int,
    j_cigar string, j_germline_alignment string, j_germline_alignment_aa string, j_germline_length int, j_germline_start int, j_identity double,
    j_score double, j_sequence_alignment string, j_sequence_alignment_aa string, j_sequence_length int, j_sequence_start int, j_support double,
    v_alignment_length int, v_alignment_start int, v_cigar string, v_germline_alignment string, v_germline_alignment_aa string, v_germline_length int,
    v_germline_start int, v_identity double, v_score double, v_sequence_alignment string, v_sequence_alignment_aa string, v_sequence_length int,
    v_sequence_start int, v_support double, c_region string, np1 string, np1_length int, np2 string, np2_length int, stop_codon boolean, vj_in_frame
    boolean, v_frameshift boolean, productive boolean, complete_vdj boolean, has_insertions boolean, has_unexpected_insertions boolean,
    has_mutated_conserved_cysteines boolean, has_wrong_cdr3_reconstruction boolean, has_kappa_gap_21 boolean, anarci_deletions array<smallint>,
    anarci_insertions array<string>, anarci_missing_conserved_cysteine boolean, anarci_unusual_residue boolean, anarci_fwr1_shorter_than_imgt_defined
    boolean, anarci_fwr4_shorter_than_imgt_defined boolean, anarci_cdr3_is_over_37_aa_long boolean
"""
_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "double": T.DoubleType(), "boolean": T.BooleanType(),
    "array<smallint>": T.ArrayType(T.ShortType()), "array<string>": T.ArrayType(T.StringType()),
}
SEQUENCE_SCHEMA = T.StructType([T.StructField(n, _TYPES[t]) for n, t in map(str.split, SEQUENCE_COLUMNS.split(","))])
INT_COLUMNS = tuple(f.name for f in SEQUENCE_SCHEMA if isinstance(f.dataType, (T.IntegerType, T.LongType)) and f.name != "index_in_unit")
DOUBLE_COLUMNS = tuple(f.name for f in SEQUENCE_SCHEMA if isinstance(f.dataType, T.DoubleType))
#: What source files call three of the columns.
SOURCE_NAMES = {"Redundancy": "redundancy", "ANARCI_status": "anarci_status", "Isotype": "isotype"}


#: The 97 columns of the fullest unpaired header; fixed values.
U1 = tuple(
    """
    ANARCI_numbering ANARCI_status Redundancy c_region cdr1 cdr1_aa cdr1_end cdr1_start cdr2 cdr2_aa cdr2_end cdr2_start cdr3 cdr3_aa cdr3_end
    cdr3_start complete_vdj d_alignment_end d_alignment_start d_call d_cigar d_germline_alignment d_germline_alignment_aa d_germline_end
    d_germline_start d_identity d_score d_sequence_alignment d_sequence_alignment_aa d_sequence_end d_sequence_start d_support fwr1 fwr1_aa fwr1_end
    fwr1_start fwr2 fwr2_aa fwr2_end fwr2_start fwr3 fwr3_aa fwr3_end fwr3_start fwr4 fwr4_aa fwr4_end fwr4_start germline_alignment
    germline_alignment_aa j_alignment_end j_alignment_start j_call j_cigar j_germline_alignment j_germline_alignment_aa j_germline_end
    j_germline_start j_identity j_score j_sequence_alignment j_sequence_alignment_aa j_sequence_end j_sequence_start j_support junction junction_aa
    junction_aa_length junction_length locus np1 np1_length np2 np2_length productive rev_comp sequence sequence_alignment sequence_alignment_aa
    stop_codon v_alignment_end v_alignment_start v_call v_cigar v_frameshift v_germline_alignment v_germline_alignment_aa v_germline_end
    v_germline_start v_identity v_score v_sequence_alignment v_sequence_alignment_aa v_sequence_end v_sequence_start v_support vj_in_frame
    """.split()
)
#: What the first paired header lacks of these; fixed values.
_NEVER_IN_P1 = {"Redundancy", "c_region", "complete_vdj", "v_frameshift", "fwr4", "fwr4_aa", "fwr4_start", "fwr4_end"}
_P1 = tuple(sorted(({*U1} - _NEVER_IN_P1) | {"sequence_id"}))
_P2 = tuple(sorted({*U1, "sequence_id", "Isotype"}))
#: The header families that source files come in. Paired ones have their columns once a chain.
HEADER_FAMILIES: dict[str, frozenset[str]] = {
    "U1": frozenset(U1),
    "U2": frozenset(U1) - {"complete_vdj", "v_frameshift"},
    "P1": frozenset(f"{c}_{chain}" for c in _P1 for chain in ("heavy", "light")),
    "P2": frozenset(f"{c}_{chain}" for c in _P2 for chain in ("heavy", "light")),
}


def header_family(columns: list[str] | tuple[str, ...]) -> str | None:
    """The family that has exactly these columns, None for an unknown header."""
    return next((name for name, family in HEADER_FAMILIES.items() if family == frozenset(columns)), None)
