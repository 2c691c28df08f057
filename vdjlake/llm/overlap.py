"""Records of evaluation splits that stand, exactly or almost, among the training records.

Words are residues here and n-grams are segments of a value. A training value of length L is cut into k + 1 disjoint
segments of equal width, half of them counted from its start, half from its end. Up to k edits leave one segment whole,
and one of those left whole is displaced by fewer edits than there are segments between it and its end of the value.
So an evaluation value needs its n-grams at a few displacements only: 8 for k = 3. Their hashes are partitioned with
those of the training segments; a hit is one n-gram in common. Hits are gathered for each pair to the containment of the
evaluation value in the training value, which is at least 1 / (k + 1) for every true pair, and the pairs are then
checked by their exact edit distance. No true pair is lost.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vdjlake.storage import cut, discard

#: An n-gram whose possible pairs (evaluation x training values) exceed this is refined by n-grams of the rest.
HOT_PAIRS = 1_000_000
#: How often hot n-grams are refined, before the pairs of those still hot are spread over blocks.
REFINEMENTS = 2
#: Lowest three bits of keys: those below 4 are segments of this number.
TINY, WHOLE, SHORT = 5, 6, 7


@F.pandas_udf(T.LongType())
def signature(values: pd.Series) -> pd.Series:
    """64 parities of hashed residue pairs. One edit flips at most four, so k edits at most 4 k."""
    data = [v.encode() for v in values]
    lengths = np.fromiter(map(len, data), dtype=np.int64, count=len(data))
    out = np.zeros(len(data), dtype=np.uint64)
    flat = np.frombuffer(b"".join(data), dtype=np.uint8).astype(np.uint32)
    long_enough = lengths >= 2
    if len(flat) < 2 or not long_enough.any():
        return pd.Series(out.view(np.int64))
    bit = np.uint64(1) << (((flat[:-1] * 2654435761 + flat[1:] * 40503 * 65537) >> 13) & 63).astype(np.uint64)
    bit = np.append(bit, np.uint64(0))
    ends = np.cumsum(lengths)
    bit[(ends - 1)[lengths > 0]] = 0  # a pair doesn't cross from one value to the next
    starts = (ends - lengths)[long_enough]
    bit_or_zero = np.bitwise_xor.reduceat(bit, starts)
    out[long_enough] = bit_or_zero
    return pd.Series(out.view(np.int64))


def _width(length: Column, k: int) -> Column:
    """Width of the segments of a value: L // (k + 1), from 8 on cut to a multiple of 4, so that neighbours agree."""
    q = F.floor(length / F.lit(k + 1)).cast("int")
    return F.when(q < 8, q).otherwise(q - F.pmod(q, F.lit(4)))


def _grams(value: Column, length: Column, width: Column, k: int, shifted: bool) -> Column:
    """Array of (key, start) for the k + 1 segments at ``width``; ``shifted``: at every displacement they may have."""
    found = []
    half = (k + 1) // 2
    for i in range(k + 1):
        from_start = i < half
        far = i if from_start else k - i
        for s in range(-far, far + 1) if shifted else (0,):
            start = (width * i + (s + 1)) if from_start else (length - width * (far + 1) + (s + 1))
            inside = (start >= 1) & (start + width - 1 <= length) & (width >= 1)
            # the lowest three bits name the segment
            key = F.xxhash64(F.lit(i), F.substring(value, start, width)).bitwiseAND(F.lit(-8)).bitwiseOR(F.lit(i))
            found.append(F.when(inside, F.struct(key.alias("key"), start.cast("int").alias("start"), width.cast("int").alias("width"))))
    return F.array_compact(F.array(*found))


def _short(value: Column) -> Column:
    """Keys of values too short for segments: their single residues. Beyond k residues one must be in common."""
    return F.transform(
        F.array_distinct(F.split(value, "")),
        lambda c: F.struct(F.xxhash64(F.lit(-1), c).bitwiseAND(F.lit(-8)).bitwiseOR(F.lit(SHORT)).alias("key"), F.lit(0).alias("start"), F.lit(0).alias("width")),
    )


def _as_one(key: Column, kind: int) -> Column:
    """An n-gram that stands for a value as one piece."""
    return F.struct(key.bitwiseAND(F.lit(-8)).bitwiseOR(F.lit(kind)).alias("key"), F.lit(0).alias("start"), F.lit(0).alias("width"))


def _rows(values: DataFrame, grams: Column, text: bool = False) -> DataFrame:
    """A row for each n-gram: vid, len, sig, key, start, width and, with ``text``, v. Keys hold the class."""
    kept = ["vid", "len", "sig", *(["v"] if text else [])]
    found = values.select("class", *kept, F.explode(grams).alias("g"))
    key = F.xxhash64("class", "g.key").bitwiseAND(F.lit(-8)).bitwiseOR(F.col("g.key").bitwiseAND(F.lit(7)))
    return found.select(*kept, key.alias("key"), "g.start", "g.width")


def _keys(values: DataFrame, k: int, query: bool, text: bool = False) -> DataFrame:
    """The n-grams of segments. ``query``: of the evaluation side, at the displacements and widths they may have."""
    v, n = F.col("v"), F.col("len")
    if not query:
        return _rows(values, _grams(v, n, _width(n, k), k, False), text)
    # the widths that training values within k residues of this length may have; the middle one suffices between
    widths = F.array_distinct(F.array(*(_width(F.greatest(n + d, F.lit(0)), k) for d in (-k, 0, k))))
    return _rows(values.withColumn("w", F.explode(widths)).filter("w >= 1"), _grams(v, n, F.col("w"), k, True), text)


def _hot(queries: DataFrame, reference: DataFrame, limit: int) -> DataFrame:
    """key, q_rows, r_rows of the n-grams whose possible pairs exceed ``limit``, by exact counts of each."""
    q = queries.groupBy("key").agg(F.count(F.lit(1)).alias("q_rows"))
    r = reference.groupBy("key").agg(F.count(F.lit(1)).alias("r_rows"))
    return q.join(r, "key").filter(F.col("q_rows").cast("double") * F.col("r_rows") > limit)


def _sides(queries: DataFrame, reference: DataFrame, *on: str) -> tuple[DataFrame, DataFrame]:
    q = queries.select(*on, F.col("vid").alias("q"), F.col("len").alias("q_len"), F.col("sig").alias("q_sig"))
    return q, reference.select(*on, F.col("vid").alias("r"), F.col("len").alias("r_len"), F.col("sig").alias("r_sig"))


def _hits(queries: DataFrame, reference: DataFrame, k: int, *on: str) -> DataFrame:
    """Pairs with an n-gram in common whose lengths and signatures allow k edits: q, r, segments (a bit for each)."""
    q, r = _sides(queries, reference, "key", *on)
    near = (F.abs(F.col("q_len") - F.col("r_len")) <= k) & (F.bit_count(F.col("q_sig").bitwiseXOR(F.col("r_sig"))) <= 4 * k)
    segment = F.expr("shiftleft(1, CAST(key & 7 AS INT))")
    return q.join(r, ["key", *on]).filter(near).groupBy("q", "r").agg(F.bit_or(segment).alias("segments"))


def _in_blocks(queries: DataFrame, reference: DataFrame, hot: DataFrame, k: int, limit: int) -> DataFrame:
    """As ``_hits``, for n-grams that can't be refined further: their pairs are cut into blocks of about ``limit``.

    Either side of an n-gram is hashed into parts of about the root of ``limit`` rows, and each part is sent to every
    part of the other side, so no task gets more than a block of them at once. No pair is lost.
    """
    side = max(1, int(limit**0.5))
    parts = lambda rows: F.ceil(F.col(rows) / side).cast("int")
    part = lambda rows: F.pmod(F.xxhash64("vid"), parts(rows)).cast("int")
    every = lambda rows: F.explode(F.sequence(F.lit(0), parts(rows) - 1))
    q = queries.join(hot, "key").withColumn("a", part("q_rows")).withColumn("b", every("r_rows"))
    r = reference.join(hot, "key").withColumn("b", part("r_rows")).withColumn("a", every("q_rows"))
    return _hits(q, r, k, "a", "b")


def _refined(keys: DataFrame, values: DataFrame | None, k: int, query: bool) -> DataFrame:
    """Keys made of a hot n-gram and an n-gram of the value without it. An edit of the rest is an edit of the value.

    From a width of 2 on, the rest of a training value has more than k residues, so it has segments of its own.
    """
    whole = keys.join(values.select("vid", "v"), "vid") if values is not None else keys
    rest = whole.select(
        "vid", "sig", F.col("key").alias("class"),
        F.concat(F.expr("substring(v, 1, start - 1)"), F.expr("substring(v, start + width)")).alias("v"),
    )
    return _keys(rest.withColumn("len", F.length("v")), k, query, True).dropDuplicates(["vid", "key", "start", "v"])


def near_values(queries: DataFrame, reference: DataFrame, k: int, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """Pairs of a query value and a reference value of one class, at most ``k`` edits apart.

    Columns: class, q_value, r_value, edits, containment (the share of the reference value's n-grams that the query value
    holds). Both tables come from ``value_table``: a row for each class and value. ``k`` is 1, 2 or 3. A value that is
    both query and reference meets itself, by an n-gram that is the whole value, and no other reference.

    Hot n-grams are found by exact counts of each and refined: their values meet only where they also share an n-gram of
    what remains, by the same argument. What is still hot after two refinements, or too short for one, is joined in
    blocks of bounded size. Values of up to k residues are all within k edits of each other, so one reference value
    stands for all of a class; every other pair comes out.
    """
    if k not in (1, 2, 3):
        raise ValueError("k must be 1, 2 or 3")
    both = F.col("query") & F.col("reference")
    tiny = {t["class"]: t["v"] for t in reference.filter(F.col("len") <= k).groupBy("class").agg(F.min("v").alias("v")).collect()}  # a row a class
    q_keys = _keys(queries.filter(~F.col("reference")), k, True)
    r_keys = _keys(reference, k, False)
    whole = F.array(_as_one(F.xxhash64(F.lit(-2), "v"), WHOLE))
    q_keys, r_keys = q_keys.unionByName(_rows(queries.filter(both), whole)), r_keys.unionByName(_rows(reference.filter(both), whole))
    if tiny:
        q_short = queries.filter(~F.col("reference") & (F.col("len") <= 2 * k))
        q_keys = q_keys.unionByName(_rows(q_short.filter(F.col("len") > 0), _short(F.col("v"))))
        r_keys = r_keys.unionByName(_rows(reference.filter((F.col("len") <= k) & (F.col("len") > 0)), _short(F.col("v"))))
        stands = F.lit(False)
        for c, v in tiny.items():
            stands = stands | ((F.col("class") == c) & (F.col("v") == v))
        one = F.array(_as_one(F.lit(-3).cast("long"), TINY))
        q_keys, r_keys = q_keys.unionByName(_rows(q_short.filter(F.col("len") <= k), one)), r_keys.unionByName(_rows(reference.filter(stands), one))
    found, used, texts = [], [], (queries, reference)
    for level in range(REFINEMENTS + 1):
        hot = cut(_hot(q_keys, r_keys, hot_pairs), "hot")
        used.append(hot)
        if hot.isEmpty():
            found.append(_hits(q_keys, r_keys, k))
            break
        found.append(_hits(q_keys.join(hot, "key", "left_anti"), r_keys.join(hot, "key", "left_anti"), k))
        q_hot, r_hot = q_keys.join(hot, "key", "left_semi"), r_keys.join(hot, "key", "left_semi")
        last = F.lit(True) if level == REFINEMENTS else F.col("width") < 2
        found.append(_in_blocks(q_hot.filter(last), r_hot.filter(last), hot, k, hot_pairs))
        if level < REFINEMENTS:
            q_keys = cut(_refined(q_hot.filter(~last), texts[0], k, True), "refined")
            r_keys = cut(_refined(r_hot.filter(~last), texts[1], k, False), "refined")
            used += [q_keys, r_keys]
            texts = (None, None)
    hits = found[0]
    for f in found[1:]:
        hits = hits.unionByName(f)
    if len(found) > 1:
        hits = hits.groupBy("q", "r").agg(F.bit_or("segments").alias("segments"))
    hits = cut(hits, "hits")
    for t in used:
        discard(t)
    with_q = hits.join(queries.select(F.col("vid").alias("q"), "class", F.col("v").alias("q_value")), "q")
    with_r = with_q.join(reference.select(F.col("vid").alias("r"), F.col("class").alias("r_class"), F.col("v").alias("r_value")), "r").filter("class = r_class")
    edits = F.levenshtein("q_value", "r_value", k)
    share = F.when(F.col("segments").bitwiseAND(F.lit(1 << WHOLE)) != 0, 1.0).otherwise(F.bit_count(F.col("segments").bitwiseAND(F.lit(15))) / (k + 1))
    return with_r.select("class", "q_value", "r_value", edits.alias("edits"), share.alias("containment")).filter("edits >= 0")


def value_table(rows: DataFrame, value: str, classes: list[tuple[Column, Column]]) -> DataFrame:
    """The distinct values of a column that are of use, a row a class: class, v, vid, len, sig, query, reference.

    ``classes``: whether a row makes its value a query, or a reference, of class 0, 1, ... A value in a third of all
    rows is one row after the partial aggregation of each task.
    """
    flags = [f.alias(f"f{i}") for i, f in enumerate(c for pair in classes for c in pair)]
    once = rows.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(*(F.max(f).alias(f"f{i}") for i, f in enumerate(flags)))
    each = F.array(*(F.struct(F.lit(i).alias("class"), F.col(f"f{2 * i}").alias("query"), F.col(f"f{2 * i + 1}").alias("reference")) for i in range(len(classes))))
    once = once.select("v", F.length("v").alias("len"), signature("v").alias("sig"), F.explode(each).alias("c")).filter("c.query OR c.reference")
    return once.select("c.class", "v", F.xxhash64("c.class", "v").alias("vid"), "len", "sig", "c.query", "c.reference")


def overlapping_values(values: DataFrame, k: int, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """class and v of the queries that equal, or are within ``k`` edits of, a reference of their class.

    With them: ``edits`` to the nearest reference and ``containment``, the largest. Equal values are settled by the
    n-gram that is the whole of them.
    """
    near = near_values(values.filter("query"), values.filter("reference"), k, hot_pairs)
    return near.groupBy("class", F.col("q_value").alias("v")).agg(F.min("edits").alias("edits"), F.max("containment").alias("containment"))


def split_overlaps(
    rows: DataFrame,
    sequence: Column,
    junction: Column,
    subset: str = "ml_subset",
    evaluation: tuple[str, ...] = ("validation", "test"),
    training: str = "train",
    sequence_edits: int = 3,
    junction_edits: int = 1,
    hot_pairs: int = HOT_PAIRS,
    measures: bool = False,
) -> DataFrame:
    """The rows of the evaluation splits that overlap with some training row, with all their columns.

    Rows that both have a sequence overlap by it alone (at most ``sequence_edits`` apart); where one or both have none,
    they overlap by their junctions (at most ``junction_edits`` apart). ``sequence`` and ``junction`` must be null where
    missing. A row without either overlaps with nothing; so does one of another split or of none. Repeated rows all come
    out. Empty tables give no rows. ``measures``: with ``edits`` and ``containment`` of the nearest training value, which
    replace columns of these names.
    """
    marked = rows.withColumns({"__s": sequence, "__j": junction, "__eval": F.coalesce(F.col(subset).isin(*evaluation), F.lit(False)), "__train": F.coalesce(F.col(subset) == training, F.lit(False))})
    used = marked.filter("__eval OR __train")
    in_eval, in_train, bare = F.col("__eval"), F.col("__train"), F.col("__s").isNull()
    s = cut(value_table(used.select("__s", "__eval", "__train"), "__s", [(in_eval, in_train)]), "sequences")
    # class 0: by their junctions against all training rows; class 1: against those that have no sequence
    classes = [(in_eval & bare, in_train), (in_eval & ~bare, in_train & bare)]
    j = cut(value_table(used.select("__s", "__j", "__eval", "__train"), "__j", classes), "junctions")
    # two 64-bit hashes stand for a value from here on
    names = lambda c: (F.xxhash64(c), F.xxhash64(F.lit(1), c))
    found = []
    for values, k, by in ((s, sequence_edits, 2), (j, junction_edits, 0)):
        hit = overlapping_values(values, k, hot_pairs)
        one, two = names(F.col("v"))
        found.append(cut(hit.select((F.col("class") + by).alias("__how"), one.alias("__h1"), two.alias("__h2"), "edits", "containment"), "overlapping"))
        discard(values)  # what follows needs the hashes only
    evaluated = marked.filter("__eval")
    s1, s2 = names(F.col("__s"))
    j1, j2 = names(F.col("__j"))
    out = [c for c in rows.columns if not (measures and c in ("edits", "containment"))]
    keyed = evaluated.select(
        *out, F.lit(2).alias("__sh"), F.when(F.col("__s").isNotNull(), s1).alias("__s1"), s2.alias("__s2"),
        F.when(bare, 0).otherwise(1).alias("__jh"), F.when(F.col("__j").isNotNull(), j1).alias("__j1"), j2.alias("__j2"),
    )
    by_s = found[0].select(F.col("__how").alias("__sh"), F.col("__h1").alias("__s1"), F.col("__h2").alias("__s2"), F.col("edits").alias("__s_edits"), F.col("containment").alias("__s_share"))
    by_j = found[1].select(F.col("__how").alias("__jh"), F.col("__h1").alias("__j1"), F.col("__h2").alias("__j2"), F.col("edits").alias("__j_edits"), F.col("containment").alias("__j_share"))
    both = keyed.join(by_s, ["__sh", "__s1", "__s2"], "left").join(by_j, ["__jh", "__j1", "__j2"], "left").filter("__s_edits IS NOT NULL OR __j_edits IS NOT NULL")
    nearest = [F.coalesce("__s_edits", "__j_edits").alias("edits"), F.coalesce("__s_share", "__j_share").alias("containment")] if measures else []
    return both.select(*out, *nearest)
