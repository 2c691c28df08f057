"""Addresses of units: ``http://host/root/subset/study/csv/file``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Origins whose file names have six parts; others with six are refused. Fixed values.
SIX_PART_ORIGINS = (
    "Mouse-1Richardson2022", "Mouse-2Richardson2022", "Mouse-3Richardson2022", "Mouse-4Richardson2022", "Mouse-5Richardson2022",
    "Mouse-6Richardson2022", "Mouse-7Richardson2022", "schanz201401", "schanz201402", "schanz201403", "schanz201404", "schanz201405", "schanz201406",
    "schanz201407", "schanz201408", "schanz201409", "schanz201410", "rettig201801", "rettig201802", "rettig201803", "rettig201804", "rettig201805",
    "rettig201806", "rettig201807", "rettig201808",
)


def fix_paired_url(url: Column, root: str) -> Column:
    """Put in the slash that some scripts leave out after ``root/paired``."""
    broken = ~F.contains(url, F.lit(f"{root}/paired/"))
    return F.when(broken, F.replace(url, F.lit(f"{root}/paired"), F.lit(f"{root}/paired/"))).otherwise(url)


def parse_unit_url(url: Column, host: str, root: str, strict: bool = True) -> Column:
    """A struct of the unit's key, file name, origin, occurrence, chain and isotype, and ``error``.

    ``root`` is the path above the subset, without slashes at its ends. Unpaired names have three to six parts between
    underscores: origin (one to three parts), occurrence (from four parts on), chain, isotype; paired names give the
    origin only. With ``strict`` an address of another form is an error, else its ``error`` says why.
    """
    fixed = fix_paired_url(url, root)
    path = F.url_decode(F.coalesce(F.try_parse_url(fixed, F.lit("PATH")), F.lit("")))
    parts = F.split(path, "/")  # the first is empty
    above = root.count("/") + 1
    part = lambda i: F.get(parts, F.lit(above + i))
    subset, study, form, name = part(1), part(2), part(3), part(4)
    tokens = F.split(F.split_part(name, F.lit("."), F.lit(1)), "_")
    n = F.size(tokens)
    paired = subset == "paired"
    heads = F.when(n <= 4, 1).when(n == 5, 2).otherwise(3)
    origin = F.when(paired, F.get(tokens, F.lit(0))).otherwise(F.array_join(F.slice(tokens, F.lit(1), heads), ""))
    error = (
        F.when(F.try_parse_url(fixed, F.lit("PROTOCOL")).isNull() | (F.try_parse_url(fixed, F.lit("PROTOCOL")) != "http"), "scheme must be http")
        .when(F.try_parse_url(fixed, F.lit("HOST")) != host, "unexpected host")
        .when(F.size(parts) != above + 5, "unexpected number of path parts")
        .when(~path.startswith(f"/{root}/") | (form != "csv"), "unexpected path")
        .when(~subset.isin("paired", "unpaired"), "unknown subset")
        .when(~paired & ~n.between(3, 6), "unexpected file name")
        .when(~paired & (n == 6) & ~origin.isin(*SIX_PART_ORIGINS), "unknown origin")
    )
    if strict:
        error = F.when(error.isNotNull(), F.raise_error(F.concat(error, F.lit(": "), url)).cast("string"))
    good = lambda c: F.when(error.isNull(), c)
    return F.struct(
        good(subset).alias("oas_subset"), good(study).alias("study_id"), good(F.replace(name, F.lit(".csv.gz"), F.lit(""))).alias("unit_id"), good(name).alias("file_name"),
        good(origin).alias("origin_id"), good(F.when(~paired & (n > 3), F.get(tokens, n - 3))).alias("origin_occurrence"),
        good(F.when(~paired, F.get(tokens, n - 2))).alias("chain"), good(F.when(~paired, F.get(tokens, n - 1))).alias("isotype"),
        error.alias("error"),
    )
