"""Status strings of the numbering software, in both grammars, as flags and lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _listed(items: Column, prefix: str) -> Column:
    """The comma lists of the items that start with ``prefix:``, as one array of trimmed strings."""
    hits = F.filter(items, lambda x: F.trim(F.split_part(x, F.lit(":"), F.lit(1))) == prefix)
    lists = F.transform(hits, lambda x: F.split(F.split_part(x, F.lit(":"), F.lit(2)), ","))
    return F.transform(F.flatten(lists), lambda x: F.trim(x))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def parse_status(status: Column, strict: bool = False) -> Column:
    """A struct of the five flags, ``deletions`` (array of smallint, sorted), ``insertions`` (sorted) and ``unknown``.

    A string that starts with ``[`` is a list of messages, any other a sequence of rules between bars; null sets
    nothing. Lists without an element are null. ``unknown`` holds messages of no known rule, or with more than one
    colon; with ``strict`` these are an error.
    """
    is_list = F.coalesce(F.ltrim(status).startswith("["), F.lit(False))
    none = F.array().cast("array<string>")
    listed = F.from_json(F.when(is_list, status), "array<string>")
    messages = F.transform(F.coalesce(listed, none), lambda x: F.trim(x))
    rules = F.when(~is_list, F.filter(F.transform(F.split(status, r"\|"), lambda x: F.trim(x)), lambda x: x != ""))
    unreadable = is_list & listed.isNull()
    parts = F.struct(messages.alias("messages"), F.coalesce(rules, none).alias("rules"), F.when(unreadable, F.array(status)).otherwise(none).alias("unparsed"))
    return let(parts, lambda p: let(F.struct(p.alias("p"), _listed(p["rules"], "Shorter than IMGT defined").alias("shorter")), lambda q: _fields(q["p"], q["shorter"], strict)))


def _fields(parts: Column, shorter: Column, strict: bool) -> Column:
    rules, messages = parts["rules"], parts["messages"]

    def rule_named(name: str) -> Column:
        return F.exists(rules, lambda x: F.trim(F.split_part(x, F.lit(":"), F.lit(1))) == name)

    def message_like(pattern: str) -> Column:
        return F.exists(messages, lambda x: x.rlike(pattern))

    known_rule = r"^(Deletions|Insertion|Missing Conserved Cysteine|Shorter than IMGT defined|Unusual residue)\s*:[^:]*$|^CDR3 is over 37 aa long(:[^:]*)?$"
    known_message = r"^(Missing Conserved Cysteine 23 or 104|fw[14] is shorter than IMGT defined|Unusual amino acid: \S+|Insertion: \S+)$"
    odd_region = F.filter(shorter, lambda x: ~x.isin("fw1", "fw4"))
    unknown = F.concat(F.filter(rules, lambda x: ~x.rlike(known_rule)), F.filter(messages, lambda x: ~x.rlike(known_message)), odd_region, parts["unparsed"])
    if strict:
        unknown = F.when(F.size(unknown) > 0, F.raise_error(F.concat(F.lit("unknown status: "), F.array_join(unknown, "; "))).cast("array<string>")).otherwise(unknown)
    deletions = F.array_sort(F.array_distinct(F.transform(F.filter(_listed(rules, "Deletions"), lambda x: x != ""), lambda x: x.try_cast("smallint"))))
    inserted = F.concat(_listed(rules, "Insertion"), F.transform(F.filter(messages, lambda x: x.startswith("Insertion: ")), lambda x: F.substr(x, F.lit(12))))
    insertions = F.array_sort(F.array_distinct(F.filter(inserted, lambda x: x != "")))
    none_if_empty = lambda a: F.when(F.size(a) > 0, a)
    return F.struct(
        (rule_named("Missing Conserved Cysteine") | message_like("^Missing Conserved Cysteine")).alias("missing_conserved_cysteine"),
        (rule_named("Unusual residue") | message_like("^Unusual amino acid")).alias("unusual_residue"),
        (F.array_contains(shorter, "fw1") | message_like("^fw1 is shorter")).alias("fwr1_shorter_than_imgt_defined"),
        (F.array_contains(shorter, "fw4") | message_like("^fw4 is shorter")).alias("fwr4_shorter_than_imgt_defined"),
        rule_named("CDR3 is over 37 aa long").alias("cdr3_is_over_37_aa_long"),
        none_if_empty(deletions).alias("deletions"),
        none_if_empty(insertions).alias("insertions"),
        unknown.alias("unknown"),
    )
