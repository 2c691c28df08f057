"""Numbered positions such as ``112A``: number, insertion letters, and the code that orders them.

All functions build Columns of built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Last position of each region in the IMGT scheme; fixed values.
REGION_ENDS = {"fwr1": 26, "cdr1": 38, "fwr2": 55, "cdr2": 65, "fwr3": 104, "cdr3": 117, "fwr4": 128}
#: Positions whose insertions run backwards, in records and in summaries.
MIRRORED_IN_RECORDS, MIRRORED_IN_SUMMARIES = (62, 112), (112,)
POSITION = r"^(\d+)([A-Z]*)"


def position_number(text: Column) -> Column:
    """The leading number; null where there is none."""
    return F.regexp_extract(text, POSITION, 1).try_cast("int")


def position_insertion(text: Column) -> Column:
    """The letters after the number, empty for none."""
    return F.regexp_extract(text, POSITION, 2)


def insertion_code(insertion: Column, strict: bool = False) -> Column:
    """'' and null are 0, A to Z 1 to 26, AA, BB to ZZ 27 to 52; anything else null, or an error when ``strict``."""
    single = (F.length(insertion) == 1) & insertion.rlike("^[A-Z]$")
    double = insertion.rlike(r"^([A-Z])\1$")
    other = F.raise_error(F.concat(F.lit("unknown insertion: "), insertion)).cast("int") if strict else F.lit(None).cast("int")
    return (
        F.when(insertion.isNull() | (insertion == ""), 0)
        .when(single, F.ascii(insertion) - 64)
        .when(double, F.ascii(insertion) - 38)
        .otherwise(other)
    )


def insertion_of_code(code: Column) -> Column:
    """The letters of an insertion code, whatever its sign; null beyond 52."""
    n = F.abs(code)
    letter = F.char(F.lit(65) + F.pmod(n - 1, F.lit(26)))
    return F.when(n == 0, "").when(n <= 26, letter).when(n <= 52, F.concat(letter, letter))


def signed_code(number: Column, code: Column, mirrored: tuple[int, ...] = MIRRORED_IN_SUMMARIES) -> Column:
    return F.when(number.isin(*mirrored), -code).otherwise(code)


def position_key(text: Column, mirrored: tuple[int, ...] = MIRRORED_IN_SUMMARIES) -> Column:
    """Struct (number, code) that sorts positions in numbering order."""
    number = position_number(text)
    return F.struct(number.alias("number"), signed_code(number, insertion_code(position_insertion(text)), mirrored).alias("code"))


def position_residue(text: Column) -> Column:
    """``112A=V`` as a struct (number, code, residue)."""
    parts = F.split(text, "=", 2)
    key = position_key(parts[0])
    return F.struct(key["number"].alias("number"), key["code"].alias("code"), parts[1].alias("residue"))


def region_of(number: Column) -> Column:
    """The region that holds a position; null outside of 1 to 128."""
    out = None
    start = 1
    for region, end in REGION_ENDS.items():
        hit = number.between(start, end)
        out = F.when(hit, region) if out is None else out.when(hit, region)
        start = end + 1
    return out
