"""Freely typed values mapped to the entries of a canonical list.

Every distinct value is matched once. A multi-pattern automaton over all canonical names and aliases finds the mentions
embedded in it, also where spaces between words were lost or added; of these the longest that don't overlap are kept, and
the longest of them names the entry. Values without a mention go to token-set similarity: edits needed to turn the
value's tokens, in any order, into a name's, with a cost for surplus ones, or those needed to turn the tokens joined. The
names to compare come from an index of pieces: a name within n edits has one of its n + 1 pieces whole.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: More entries than this aren't shipped to the workers in one piece.
MAX_ENTRIES = 100_000
UNMATCHED = 0


def fold(value: str) -> str:
    """Compatibility form, case folded, accents off, letters and digits only, single spaces."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", value) if not unicodedata.combining(c))
    return " ".join(re.findall(r"[^\W_]+", plain.casefold()))


def edits(a: str, b: str, most: int) -> int:
    """Insertions, deletions, replacements and swaps of neighbours between a and b; most + 1 when there are more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    if a == b:
        return 0
    before: list[int] = []
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            cost = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, older[j - 2] + 1)
            row.append(cost)
        if min(row) > most and (not before or min(before) > most):
            return most + 1
    return min(row[-1], most + 1)


def allowed(name: str) -> int:
    """Edits granted to a name: one to four letters 1, to nine 2, then 3; longer ones an edit for every six letters."""
    n = len(name.replace(" ", ""))
    return 1 if n <= 4 else 2 if n <= 9 else max(3, n // 6)


def token_edits(value: Sequence[str], name: Sequence[str], most: int) -> int:
    """Edits that turn tokens of ``value``, one to one and in any order, into all of ``name``, and one for each surplus
    token; most + 1 when there are more. A token is granted an edit for every three letters: short ones must be equal."""
    surplus = len(value) - len(name)
    if not 0 <= surplus <= most:
        return most + 1
    common = Counter(value) & Counter(name)
    theirs, ours = list((Counter(value) - common).elements()), list((Counter(name) - common).elements())
    if len(ours) > most - surplus:
        return most + 1

    def fewest(k: int, free: tuple[int, ...], budget: int) -> int:
        if k == len(ours):
            return 0
        best = budget + 1
        for i in free:
            limit = min(best - 1, len(ours[k]) // 3)
            d = edits(theirs[i], ours[k], limit)
            if d <= limit:
                best = min(best, d + fewest(k + 1, tuple(j for j in free if j != i), best - 1 - d))
        return best

    return min(surplus + fewest(0, tuple(range(len(theirs))), most - surplus), most + 1)


def pieces(name: str, edits_: int) -> list[str]:
    """``name`` cut into edits_ + 1 pieces, or into its letters where it has fewer: one stays whole under that many edits."""
    n = min(len(name), edits_ + 1)
    return [name[i * len(name) // n : (i + 1) * len(name) // n] for i in range(n)]


class Matcher:
    """Matches values of one field against (ref_id, names) entries."""

    def __init__(self, entries: Sequence[tuple[int, Sequence[str]]]):
        import ahocorasick

        self.names: dict[str, int] = {}
        squashed: dict[str, int] = {}
        for ref, names in sorted(entries, key=lambda e: e[0]):
            for name in map(fold, filter(None, names)):
                if name:  # of equal names the entry with the least ref_id counts
                    self.names.setdefault(name, ref)
                    squashed.setdefault(name.replace(" ", ""), ref)
        self.automaton, self.index = ahocorasick.Automaton(), ahocorasick.Automaton()
        for name, ref in squashed.items():
            self.automaton.add_word(name, (len(name), ref))
        self.listed = [(name, name.replace(" ", ""), "".join(sorted(name.split())), allowed(name), ref) for name, ref in self.names.items()]
        found: dict[str, set[int]] = {}
        for i, (name, flat, ordered, most, _) in enumerate(self.listed):
            for text, e in ((flat, most), (ordered, most), *((t, len(t) // 3) for t in name.split())):
                # with as many edits as letters nothing need stay whole; such names are few letters, and always compared
                for piece in pieces(text, e) if e < len(text) else [""]:
                    found.setdefault(piece, set()).add(i)
        self.always = found.pop("", set())
        for piece, at in found.items():
            self.index.add_word(piece, frozenset(at))
        if self.names:
            self.automaton.make_automaton()
            self.index.make_automaton()

    def mentions(self, folded: str) -> list[tuple[int, int, int]]:
        """(start, end, ref_id) of the mentions that don't overlap, in the text without spaces; longer ones first.

        A mention begins and ends with a word of the value. Of equally long ones that overlap the first counts.
        """
        tokens = folded.split()
        ends = list(accumulate(map(len, tokens)))
        starts, stops = {0, *ends[:-1]}, set(ends)
        spans = [(end + 1 - n, end + 1, ref) for end, (n, ref) in self.automaton.iter("".join(tokens)) if end + 1 in stops and end + 1 - n in starts]
        taken: list[tuple[int, int, int]] = []
        by_start: list[tuple[int, int]] = []
        for a, b, ref in sorted(spans, key=lambda s: (s[0] - s[1], s[0])):
            at = bisect_left(by_start, (a, b))
            if (at == 0 or by_start[at - 1][1] <= a) and (at == len(by_start) or b <= by_start[at][0]):
                by_start.insert(at, (a, b))
                taken.append((a, b, ref))
        return taken

    def similar(self, folded: str) -> int:
        """The entry whose name is the fewest edits away; UNMATCHED beyond what is allowed or when entries tie."""
        tokens = folded.split()
        flat, ordered = folded.replace(" ", ""), "".join(sorted(tokens))
        near = set(self.always).union(*(at for text in {flat, ordered} for _, at in self.index.iter(text)))
        best: dict[int, int] = {}
        for i in near:
            name, its_flat, its_order, most, ref = self.listed[i]
            d = token_edits(tokens, name.split(), most)
            if d and abs(len(flat) - len(its_flat)) <= most:
                d = min(d, edits(flat, its_flat, most), edits(ordered, its_order, most) if len(tokens) > 1 else most + 1)
            if d <= most:
                best[ref] = min(d, best.get(ref, d))
        if not best:
            return UNMATCHED
        least = min(best.values())
        winners = [r for r, d in best.items() if d == least]
        return winners[0] if len(winners) == 1 else UNMATCHED

    def match_all(self, value: str) -> tuple[int, str, list[int]]:
        """ref_id, how it was found (mention, similar or none) and the entries of all mentions, in the order of the text."""
        folded = fold(value)
        if not folded or not self.names:
            return UNMATCHED, "none", []
        if found := self.mentions(folded):
            return found[0][2], "mention", [ref for _, _, ref in sorted(found)]
        if ref := self.similar(folded):
            return ref, "similar", []
        return UNMATCHED, "none", []

    def match(self, value: str) -> tuple[int, str]:
        return self.match_all(value)[:2]


def read_entries(reference: DataFrame) -> list[tuple[int, str, str, list[str]]]:
    """The rows of a list (ref_id, field_name, canonical, synonyms), refused beyond MAX_ENTRIES."""
    rows = reference.select("ref_id", "field_name", "canonical", "synonyms").limit(MAX_ENTRIES + 1).collect()
    if len(rows) > MAX_ENTRIES:
        raise ValueError(f"the list has more than {MAX_ENTRIES} entries")
    return [(r["ref_id"], r["field_name"], r["canonical"], list(r["synonyms"] or [])) for r in rows]


def map_values(values: DataFrame, entries: Sequence[tuple[int, str, str, Sequence[str]]], field: str = "field_name", value: str = "value") -> DataFrame:
    """``values`` with ``ref_id`` (0: the list has none), ``how`` and ``mentions``, the entries of all mentions.

    A null or blank value has no entry, nor has any value of a field that the list doesn't have. The list may be
    empty. Very long values are matched whole. Distinct values are matched, then joined to the rows; a value in a third
    of all rows is one row of the side joined, so adaptive execution may split its rows. Columns of ``values`` named as
    those of the result are replaced.
    """
    kept = values.drop("ref_id", "how", "mentions")
    plain = [(ref, f, (c, *s)) for ref, f, c, s in entries]
    once = kept.select(F.col(field).alias("__field"), F.col(value).alias("__value")).filter("__field IS NOT NULL AND __value IS NOT NULL").distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matchers = {f: Matcher([(r, n) for r, g, n in plain if g == f]) for f in {f for _, f, _ in plain}}
        for b in batches:
            hits = [matchers[f].match_all(v) if f in matchers else (UNMATCHED, "none", []) for f, v in zip(b["__field"], b["__value"])]
            yield b.assign(ref_id=[h[0] for h in hits], how=[h[1] for h in hits], mentions=pd.Series([h[2] for h in hits], index=b.index, dtype="object"))

    # matching is the work, not the few bytes of a value: a number of tasks that isn't lowered for small partitions
    spark = values.sparkSession
    once = once.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), "__field", "__value")
    schema = T.StructType([*once.schema.fields, T.StructField("ref_id", T.LongType()), T.StructField("how", T.StringType()), T.StructField("mentions", T.ArrayType(T.LongType()))])
    matched = once.mapInPandas(run, schema)
    both = kept.join(matched, (kept[field] == matched["__field"]) & (kept[value] == matched["__value"]), "left")
    return both.select(*kept.columns, F.coalesce("ref_id", F.lit(UNMATCHED)).alias("ref_id"), F.coalesce("how", F.lit("none")).alias("how"), F.coalesce("mentions", F.array().cast("array<bigint>")).alias("mentions"))


def free_values(df: DataFrame, fields: Sequence[str], entries: Sequence[tuple[int, str, str, Sequence[str]]], *keys: str) -> DataFrame:
    """``keys``, ``field_name`` and ``value`` for every value that isn't null, blank or exactly a canonical name."""
    every = F.explode(F.array(*(F.struct(F.lit(f).alias("field_name"), F.col(f).alias("value")) for f in fields))).alias("x")
    long = df.select(*keys, every).select(*keys, "x.field_name", "x.value").filter(F.col("value").rlike(r"[^\s\p{Z}]"))
    exact = df.sparkSession.createDataFrame([(f, c) for _, f, c, _ in entries if f in fields], "__field string, __name string")
    return long.join(exact, (long["field_name"] == exact["__field"]) & (long["value"] == exact["__name"]), "left_anti")
