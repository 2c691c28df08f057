"""Numbering maps (region -> position -> residue) turned into typed record fields.

A map has more than a hundred entries, which Spark's higher-order functions interpret one by one; so maps are parsed in
Arrow batches, each once a row. What can be had from the parsed fields is built of expressions.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vdjlake.functions import positions as P
from vdjlake.functions.status import parse_status
from vdjlake.schema import REGIONS, STATUS_FLAGS

PARSED = T.StructType([
    *(T.StructField(f"{r}_aa_{x}", T.IntegerType()) for r in REGIONS for x in ("start", "length")),
    T.StructField("sequence_aa", T.StringType()), T.StructField("cdr3", T.StringType()),
    T.StructField("imgt_positions", T.ArrayType(T.ShortType())), T.StructField("imgt_insertions", T.ArrayType(T.StringType())),
    *(T.StructField(f, T.BooleanType()) for f in ("has_insertions", "has_unexpected_insertions", "has_mutated_conserved_cysteines", "has_kappa_gap_21")),
    T.StructField("error", T.StringType()),
])
_POSITION = re.compile(P.POSITION)
#: Sorts after all positions.
LAST = 1 << 15


class Places(dict):
    """Position text -> (number, signed code, insertion, code). What isn't a position has the number LAST."""

    def __missing__(self, text: str) -> tuple[int, int, str, int]:
        found = _POSITION.match(text)
        number, ins = (int(found[1]), found[2]) if found else (LAST, "")
        code = 0 if not ins else ord(ins[0]) - 64 if len(ins) == 1 else ord(ins[0]) - 38 if len(ins) == 2 and ins[0] == ins[1] else None
        bad = number >= LAST or code is None
        place = (LAST, 0, ins, 0) if bad else (number, -code if number in P.MIRRORED_IN_RECORDS else code, ins, code)
        if len(self) < 100_000:
            self[text] = place
        return place


@lru_cache(maxsize=None)
def region_keys(locus: str) -> tuple[str, ...]:
    """``fwr1`` is called ``fwh1`` in a heavy chain's map, ``cdr3`` there ``cdrh3``."""
    return tuple((r[:2] if r.startswith("fwr") else r[:3]) + locus.lower() + r[-1] for r in REGIONS)


def read_map(literal: str) -> dict | None:
    """A Python literal or JSON object as a map of maps; None where it can't be read."""
    for text in (literal.replace("'", '"'), literal):
        try:
            out = json.loads(text)
        except ValueError:
            continue
        if isinstance(out, dict) and all(m is None or isinstance(m, dict) for m in out.values()):
            return out
    return None


def _number(loci: list[str | None], literals: list[str | None]) -> dict[str, list]:
    """The fields of PARSED but for the arrays, which come flat with the ends of their rows."""
    places = Places()
    out: dict[str, list] = {f.name: [] for f in PARSED}
    flat_positions, flat_insertions, ends, inserted = [], [], [0], []
    for locus, literal in zip(loci, literals):
        regions = read_map(literal) if literal is not None else None
        error = None
        if locus is None:
            error = "no locus"
        elif regions is None:
            error = "no numbering" if literal is None else "unreadable numbering"
        keys = region_keys(locus) if locus is not None and regions is not None else ()
        if keys and not any(k in regions for k in keys):
            error = "no region of this locus"
        every, start, cdr3 = [], 0, ""
        for i, r in enumerate(REGIONS):
            entries = regions.get(keys[i]) if keys else None
            n = len(entries) if entries else 0
            out[f"{r}_aa_start"].append(start if n else None)
            out[f"{r}_aa_length"].append(n)
            if n:
                placed = sorted([(places[k], v if v is None or isinstance(v, str) else str(v)) for k, v in entries.items()], key=lambda e: e[0])
                if r == "cdr3":
                    cdr3 = "".join([v or "" for _, v in placed])
                every += placed
                start += n
        has = unexpected = mutated = gap = False
        for (number, _, _, code), aa in every:
            if code:
                has = True
                unexpected = unexpected or number not in (111, 112)
            elif number in (21, 23, 104) and aa is not None:
                gap = gap or (number == 21 and aa == "-" and locus == "K")
                mutated = mutated or (number != 21 and aa != "C")
            elif number == LAST or aa is None:
                error = error or "malformed position"
        out["sequence_aa"].append("".join([v or "" for _, v in every]))
        out["cdr3"].append(cdr3)
        flat_positions += [p[0] if p[0] < LAST else 0 for p, _ in every]
        flat_insertions += [p[2] for p, _ in every] if has else []
        ends.append(len(flat_positions))
        inserted.append(len(flat_insertions) if has else None)
        for name, x in (("has_insertions", has), ("has_unexpected_insertions", unexpected), ("has_mutated_conserved_cysteines", mutated), ("has_kappa_gap_21", gap), ("error", error)):
            out[name].append(x)
    out["imgt_positions"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.array(flat_positions, dtype=np.int16)))
    return _with_insertions(out, flat_insertions, inserted)


def _with_insertions(out: dict[str, list], flat: list[str], upto: list[int | None]) -> dict[str, list]:
    """The array of insertions, null for rows without any."""
    ends = [0]
    for n in upto:
        ends.append(ends[-1] if n is None else n)
    offsets = pa.array(ends[:-1] + [ends[-1]], pa.int32())
    out["imgt_insertions"] = pa.ListArray.from_arrays(offsets, pa.array(flat, pa.string()), mask=pa.array([n is None for n in upto], pa.bool_()))
    return out


@F.arrow_udf(PARSED)
def numbered(loci: pa.Array, literals: pa.Array) -> pa.Array:
    out = _number(loci.to_pylist(), literals.to_pylist())
    kinds = {T.IntegerType(): pa.int32(), T.StringType(): pa.string(), T.BooleanType(): pa.bool_()}
    arrays = [out[f.name] if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], kinds[f.dataType]) for f in PARSED]
    return pa.StructArray.from_arrays(arrays, names=PARSED.names)


def with_numbering(df: DataFrame, locus: str = "locus", numbering: str = "ANARCI_numbering", status: str = "ANARCI_status", cdr3: str = "cdr3_aa", null_cdr3_is_wrong: bool = True) -> DataFrame:
    """``df`` with the fields computed from its numbering, and ``numbering_error`` (null where all is well).

    Starts are running totals of the lengths before; a missing or empty region has a null start and length 0.
    ``has_wrong_cdr3_reconstruction`` compares the numbered CDR3 with ``cdr3``: without a numbered one it is true, and
    a null ``cdr3`` is wrong too unless told otherwise. Rows whose map can't be read, has none of the locus's regions,
    or has a malformed position, and rows with a null locus or an unknown status, aren't dropped: they get the error.
    """
    # not to be run once more by a filter on its fields that is pushed below
    parsed = numbered.asNondeterministic()(F.col(locus), F.col(numbering))
    whole = df.withColumns({"__n": parsed, "__s": parse_status(F.col(status))})
    fields: dict[str, Column] = {f.name: F.col(f"__n.{f.name}") for f in PARSED if f.name not in ("cdr3", "error")}
    right = (F.col("__n.cdr3_aa_length") > 0) & (F.col("__n.cdr3") == F.col(cdr3))
    fields["has_wrong_cdr3_reconstruction"] = F.when(F.col(cdr3).isNull(), F.lit(True) if null_cdr3_is_wrong else F.lit(None).cast("boolean")).otherwise(~right)
    fields |= {f"anarci_{f}": F.col(f"__s.{f}") for f in (*STATUS_FLAGS, "deletions", "insertions")}
    odd = F.when(F.size("__s.unknown") > 0, F.concat(F.lit("unknown status: "), F.array_join("__s.unknown", "; ")))
    fields["numbering_error"] = F.coalesce(F.col("__n.error"), odd)
    return whole.withColumns(fields).drop("__n", "__s")
