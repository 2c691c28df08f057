"""Small conversions, hashes and splits."""

from __future__ import annotations

from math import comb

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Species names that are normalised; others stay as they are. Fixed values.
SPECIES = {
    "camel": "camel", "mouse": "mouse", "mouse_C57BL/6": "mouse", "mouse_BALB/c": "mouse", "HIS-Mouse": "mouse",
    "mouse_RAG2-GFP/129Sve": "mouse", "mouse_Swiss-Webster": "mouse", "human": "human", "rabbit": "rabbit",
    "rat_SD": "rat", "rat": "rat", "rhesus": "rhesus",
}
SUBSETS = (("train", 80), ("validation", 10), ("test", 10))


def normalize_species(species: Column) -> Column:
    table = F.create_map(*(F.lit(x) for pair in SPECIES.items() for x in pair))
    return F.coalesce(F.try_element_at(table, species), species)


def study_year(author: Column) -> Column:
    """The last four characters of the trimmed author as a number; null where they aren't one."""
    return F.right(F.trim(author), F.lit(4)).try_cast("bigint")


def snake_case(name: Column) -> Column:
    """``CamelCase`` and ``camelHTTPCase`` as ``camel_case`` and ``camel_http_case``.

    A word starts at a capital that follows a small letter or digit, and at one that small letters follow.
    """
    starts = r"(?<=[a-z0-9])(?=[A-Z])|(?<=[^_])(?=[A-Z][a-z])"
    return F.lower(F.array_join(F.split(name, starts), "_"))


def tf_flag(value: Column, strict: bool = True) -> Column:
    """T and F as booleans; null stays null, anything else is an error, or null when not ``strict``."""
    other = F.raise_error(F.concat(F.lit("not T or F: "), value)).cast("boolean") if strict else F.lit(None).cast("boolean")
    return F.when(value.isNull(), F.lit(None).cast("boolean")).when(value == "T", True).when(value == "F", False).otherwise(other)


def loose_int(value: Column, kind: str = "int") -> Column:
    """Integers that may be written as ``33.0``; null where it isn't a whole number."""
    exact = F.nullif(F.regexp_extract(value, r"^\s*([+-]?\d+)(\.0*)?\s*$", 1), F.lit("")).try_cast(kind)
    number = value.try_cast("double")  # other ways to write them, such as 1e3
    return F.coalesce(exact, F.when((number == F.floor(number)) & (F.abs(number) < 2.0**53), number.try_cast(kind)))


def mebibytes(size: Column) -> Column:
    return size / F.lit(1024.0 * 1024.0)


def floor_minute(when: Column) -> Column:
    return F.date_trunc("minute", when)


def http_date(text: Column) -> Column:
    """``Tue, 01 Feb 2022 10:11:12 GMT`` as a timestamp cut to the minute, in whatever zone the session is; null where it can't be read."""
    clean = F.regexp_extract(text, r"(\d{1,2} [A-Z][a-z]{2} \d{4} \d\d:\d\d:\d\d)", 1)
    return floor_minute(F.try_to_timestamp(F.concat(clean, F.lit(" +00:00")), F.lit("d MMM yyyy HH:mm:ss XXX")))


def num_mutants(length: Column, mutations: Column, letters: int = 20) -> Column:
    """C(L, k) letters^k, with k = L where it is null; k beyond L is an error. Exact where a double is."""
    k = F.coalesce(mutations, length)
    ways = F.aggregate(
        F.when(k > 0, F.sequence(F.lit(1), k.cast("int"))).otherwise(F.array().cast("array<int>")),
        F.lit(1.0),
        lambda acc, i: acc * (length - k + i) / i,
    )
    value = F.round(ways) * F.pow(F.lit(float(letters)), k)
    return F.when(k > length, F.raise_error(F.lit("more mutations than positions")).cast("double")).otherwise(value)


def num_mutants_exact(length: int, mutations: int | None = None, letters: int = 20) -> int:
    k = length if mutations is None else mutations
    if k > length:
        raise ValueError(f"{k} mutations in {length} positions")
    return comb(length, k) * letters**k


def _by_bucket(bucket: Column, subsets: tuple[tuple[str, int], ...]) -> Column:
    if sum(p for _, p in subsets) != 100:
        raise ValueError("percentages must add up to 100")
    out, upto = None, 0
    for name, percent in subsets:
        upto += percent
        hit = bucket < upto
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def portable_subset(value: Column, subsets: tuple[tuple[str, int], ...] = SUBSETS) -> Column:
    """Split by the first 32 bits of the md5 of ``value``: any engine can repeat it. Null stays null."""
    return _by_bucket(F.conv(F.substring(F.md5(value), 1, 8), 16, 10).cast("bigint") % 100, subsets)


def _xxh32(value: Column, seed: int) -> Column:
    """Unsigned 32-bit xxHash of a string, in Arrow batches."""

    @F.arrow_udf(T.LongType())
    def hashed(values: pa.Array) -> pa.Array:
        import xxhash

        digest = xxhash.xxh32_intdigest
        return pa.array([None if v is None else digest(v, seed) for v in values.to_pylist()], pa.int64())

    return hashed(value)


@F.pandas_udf(T.DecimalType(20, 0))
def xxh3_64(values: pd.Series) -> pd.Series:
    """Unsigned 64-bit XXH3 of a string; Spark's own xxhash64 is another function."""
    from decimal import Decimal

    import xxhash

    return pd.Series([None if v is None else Decimal(xxhash.xxh3_64_intdigest(v)) for v in values], dtype="object")


def xxh32_subset(value: Column, seed: int = 0, subsets: tuple[tuple[str, int], ...] = SUBSETS) -> Column:
    """Split by xxh32 modulo 100, as models trained elsewhere expect it. Null stays null."""
    return _by_bucket(_xxh32(value, seed) % 100, subsets)
