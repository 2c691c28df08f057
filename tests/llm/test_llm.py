"""Operators of the training-data subpackage against brute force, exact round trips and edge cases."""

import random
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from vdjlake.llm import canonical, heavy_hitters, linked_splits, mixing, mojibake, overlap, packing
from vdjlake.llm.residues import residues
from vdjlake.llm.tokens import encoding

# --- p1: frequent values


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_frequent_values_against_counts(spark, buckets):
    rng = random.Random(buckets)
    data = [(rng.choice(["hot"] * 40 + [f"v{i}" for i in range(60)]), rng.choice([None, "", "x"])) for _ in range(2000)]
    df = spark.createDataFrame(data, "a string, b string")
    got = {(r["field_name"], r["item"]): r["item_count"] for r in heavy_hitters.frequent_values(df, {"A": F.col("a"), "b": F.col("b")}, 0.011, buckets=buckets).collect()}
    want = {}
    for i, name in enumerate(("A", "b")):
        counts = Counter(r[i] for r in data if r[i] is not None)
        want |= {(name, v): n for v, n in counts.items() if n >= 0.011 * sum(counts.values())}
    assert got == want


def test_frequent_values_edges(rows):
    f = {"s": residues("s")}
    assert heavy_hitters.frequent_values(rows([], "s string, item string"), f).count() == 0
    assert heavy_hitters.frequent_values(rows([(None, "x"), ("--", "x")], "s string, item string"), f).count() == 0
    tie = heavy_hitters.frequent_values(rows([("aC-", "x"), ("AC", "y"), ("d" * 50_000, "z"), (None, None)] + [(c, "q") for c in "EFGHIKL"], "s string, item string"), f, 0.1)
    assert {r["item"]: r["item_count"] for r in tie.collect()} == {"AC": 2, "D" * 50_000: 1, **dict.fromkeys("EFGHIKL", 1)}
    with pytest.raises(ValueError):
        heavy_hitters.frequent_values(rows([], "s string"), f, 0)


# --- p2: linked splits


def _components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    by = {}
    for r, e in edges:
        if r is not None and e is not None:
            find(r)
            by.setdefault(e, []).append(r)
    for members in by.values():
        for m in members[1:]:
            a, b = find(members[0]), find(m)
            parent[max(a, b)] = min(a, b)
    return {r: find(r) for r in parent}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_against_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(f"r{rng.randrange(40):02}", f"e{rng.randrange(45)}") for _ in range(55)] + [(None, "e1"), ("r01", None), ("r02", "e3"), ("r02", "e3")]
    edges += [(f"c{i:02}", f"x{i + d}") for i in range(30) for d in (0, 1)]  # a long chain
    got = {r["record"]: r["component"] for r in linked_splits.components(spark.createDataFrame(edges, "record string, entity string")).collect()}
    want = _components(edges)
    assert got == want
    pairs = linked_splits.linked_pairs(spark.createDataFrame(list(got.items()), "record string, component string"))
    assert {(r["record_a"], r["record_b"]) for r in pairs.collect()} == {(a, b) for a, b in product(want, want) if a < b and want[a] == want[b]}


def test_components_empty(rows):
    assert linked_splits.components(rows([], "record string, entity string")).count() == 0


def test_assignment_keeps_groups_and_shares(spark):
    rng = random.Random(3)
    data = [(g, rng.choice(["Heavy", "Light", None])) for g in ["big"] * 600 + [f"g{rng.randrange(400)}" for _ in range(2400)] + [None] * 20]
    targets = {"train": 0.8, "validation": 0.1, "test": 0.1}
    out = linked_splits.assign_groups(spark.createDataFrame(data, "g string, chain string"), "g", "chain", targets)
    got = out.collect()
    assert len(got) == len(data) and all(r["split"] for r in got)
    splits = {}
    for r in got:
        splits.setdefault(r["g"], set()).add(r["split"])
    assert all(len(s) == 1 for s in splits.values())
    for r in linked_splits.split_shares(out, targets).collect():
        assert abs(r["actual_share"] - r["target_share"]) < 0.01
    for r in linked_splits.split_shares(out, targets, ["chain"]).collect():
        assert abs(r["actual_share"] - r["target_share"]) < 0.03


def test_assignment_edges(rows):
    assert linked_splits.assign_groups(rows([], "g string, chain string"), "g", "chain", {"a": 1.0}).count() == 0
    with pytest.raises(ValueError):
        linked_splits.assign_groups(rows([], "g string, chain string"), "g", "chain", {})


# --- p3: overlaps


def _edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def _mutate(rng, s, n):
    s = list(s)
    for _ in range(n):
        kind, at = rng.randrange(3), rng.randrange(len(s) + 1)
        if kind == 0:
            s.insert(at, rng.choice("ACDE"))
        elif s and kind == 1:
            del s[min(at, len(s) - 1)]
        elif s:
            s[min(at, len(s) - 1)] = rng.choice("ACDE")
    return "".join(s)


def _overlapping(data):
    out = set()
    train = [r for r in data if r[1] == "train"]
    for i, split, s, j in data:
        if split in ("validation", "test"):
            for _, _, ts, tj in train:
                if s and ts:
                    hit = _edit_distance(s, ts) <= 3
                else:
                    hit = bool(j and tj) and _edit_distance(j, tj) <= 1
                if hit:
                    out.add(i)
                    break
    return out


@pytest.mark.parametrize(("seed", "lengths", "hot"), [(1, (30, 60), 10**6), (2, (1, 9), 10**6), (3, (20, 44), 2), (4, (100, 130), 10**6), (5, (4, 16), 1)])
def test_overlaps_against_edit_distances(spark, seed, lengths, hot):
    """Random families of values; with a low bound, hot n-grams are refined."""
    rng = random.Random(seed)
    bases = ["".join(rng.choice("ACDEFGHIKL") for _ in range(rng.randint(*lengths))) for _ in range(12)]
    bases += [bases[0][: len(bases[0]) // 2] + "".join(rng.choice("ACDEFGHIKL") for _ in range(max(1, len(bases[0]) // 2))) for _ in range(6)]
    junctions = ["C" + "".join(rng.choice("ACDE") for _ in range(rng.randint(0, 14))) + "W" for _ in range(10)]
    data = []
    for i in range(260):
        s = _mutate(rng, rng.choice(bases), rng.randint(0, 5)) if rng.random() > 0.2 else None
        j = _mutate(rng, rng.choice(junctions), rng.randint(0, 2)) if rng.random() > 0.1 else None
        data.append((i, rng.choice(["train", "train", "validation", "test", None]), s or None, j or None))
    df = spark.createDataFrame(data, "record_id bigint, ml_subset string, s string, j string")
    got = overlap.split_overlaps(df, F.col("s"), F.col("j"), hot_pairs=hot)
    assert got.columns == df.columns
    ids = [r["record_id"] for r in got.collect()]
    assert len(ids) == len(set(ids)) and set(ids) == _overlapping(data)


def test_overlap_edges(rows):
    schema = "record_id bigint, ml_subset string, s string, j string, v string, class string"
    run = lambda data: {r["record_id"] for r in overlap.split_overlaps(rows([(*d, "v", "c") for d in data], schema), F.col("s"), F.col("j")).collect()}
    assert run([]) == set()
    assert run([(1, "train", None, None), (2, "test", None, None)]) == set()
    long = "ACDEFGHIKL" * 3000
    data = [(1, "train", long, "X"), (2, "test", long[:9000] + "W" + long[9003:], "Y"), (3, "test", long[:5000] + long[5009:], "X"), (4, "validation", None, "X"), (5, "test", "A", None), (6, "test", None, "XYZ"), (7, None, long, "X")]
    assert run(data) == {2, 4}
    assert run([(1, "train", "AC", None), (2, "test", "WWW", None), (3, "test", "GGGG", None), (4, "test", "GGGGA", None), (5, "test", "AGGCG", None), (5, "test", "AGGCG", None)]) == {2, 5}


def test_containment_of_pairs(spark):
    df = spark.createDataFrame([("ACDEFGHIKLMNPQRSTVWYACDEFGHIKLMN", False), ("ACDEFGHIKLMNPQRSTVWYACDEFGHIKLMW", True)], "s string, q boolean")
    values = overlap.value_table(df, "s", [(F.col("q"), ~F.col("q"))])
    r = overlap.near_values(values.filter("query"), values.filter("reference"), 3).first()
    assert (r["edits"], r["containment"]) == (1, 0.75)


@pytest.mark.parametrize("seed", range(3))
def test_signature_moves_little(seed):
    import pandas as pd

    rng = random.Random(seed)
    base = "".join(rng.choice("ACDEFGHIKL") for _ in range(80))
    for k in (1, 2, 3):
        values = [base, *(_mutate(rng, base, k) for _ in range(50)), "", "A"]
        sig = overlap.signature.func(pd.Series(values)).to_numpy().view(np.uint64)
        assert all(bin(int(sig[0]) ^ int(x)).count("1") <= 4 * k for x in sig[1:51]) and sig[-1] == 0 and sig[-2] == 0


# --- p4: canonical values

ENTRIES = [
    (101, "species", "human", ["Homo sapiens"]), (102, "species", "house mouse", ["Mus musculus", "mouse"]), (103, "species", "brown rat", ["rat"]), (117, "btype", "memory B cells", []),
    (118, "btype", "naive B cells", ["unswitched virgin B cells"]), (132, "vaccine", "Hepandrix A", []), (133, "vaccine", "Hepandrix B", []), (128, "vaccine", "none", ["no vaccine given"]),
]


@pytest.mark.parametrize(
    ("field", "value", "ref"),
    [
        ("species", "HUMAN", 101), ("species", " sapiens, Homo ?", 101), ("species", "humaan", 101), ("species", "housemouse", 102), ("species", "a tired rat (brown)", 103), ("species", "Xenopus", 0),
        ("species", "brown rat of the house", 103), ("species", "???", 0), ("species", "", 0), ("species", "mouse rat", 102), ("btype", "cells, naive B", 118), ("btype", "memor B cels", 117), ("btype", "B cells", 0),
        ("vaccine", "HepandrixA", 132), ("vaccine", "Hepandrix-b*", 133), ("vaccine", "Hepandrix C", 0), ("vaccine", "no_vaccine_givn", 128), ("vaccine", "saline", 0), ("vaccine", "n/a", 0), ("other", "human", 0), ("species", None, 0),
        ("species", "x" * 100_000, 0), ("species", "Ｈｕｍａｎ", 101),
    ],
)
def test_matching(field, value, ref):
    matchers = {f: canonical.Matcher([(r, (c, *s)) for r, g, c, s in ENTRIES if g == f]) for f in {e[1] for e in ENTRIES}}
    got = matchers[field].match(value)[0] if field in matchers and value is not None else 0
    assert got == ref


def test_free_values_and_mapping(rows):
    df = rows([("k1", "human", "memory b cells", None), ("k1", "human", "memory b cells", None), ("k2", "Human", " ", "n/a"), ("k3", None, "none", "none")], "ref_id string, species string, btype string, vaccine string")
    typed = canonical.free_values(df, ("species", "btype", "vaccine"), ENTRIES, "ref_id").withColumnRenamed("ref_id", "unit")
    out = canonical.map_values(typed.withColumn("how", F.lit("clash")), ENTRIES)
    assert sorted((r["unit"], r["field_name"], r["ref_id"]) for r in out.collect()) == [("k1", "btype", 117), ("k1", "btype", 117), ("k2", "species", 101), ("k2", "vaccine", 0), ("k3", "btype", 0)]
    assert {r["ref_id"] for r in canonical.map_values(typed, []).collect()} == {0}
    assert canonical.map_values(typed.limit(0), ENTRIES).count() == 0


def test_edits_count_swaps_once():
    assert canonical.edits("mouse", "muose", 3) == 1 and canonical.edits("abc", "abc", 0) == 0 and canonical.edits("abc", "xyz", 2) == 3 and canonical.edits("", "ab", 3) == 2


# --- p7: packing


def _documents(spark, n=160, seed=0):
    rng = random.Random(seed)
    words = [f"word{i}" for i in range(80)]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([1, 5, 20, 60, 400]))) for _ in range(n)] + [None, "", "  ", "same text here", "same text here"]
    return texts, spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


@pytest.mark.parametrize("shard_texts", [10_000, 20])
def test_packing_holds_every_token_once(spark, shard_texts):
    texts, df = _documents(spark)
    budgets = [("short", 64), ("long", 512)]
    out = packing.pack_texts(df, budgets, shard_texts=shard_texts)
    got = out.collect()
    sizes = {i: len(encoding().encode_ordinary(t)) for i, t in enumerate(texts) if t}
    for kind, capacity in budgets:
        mine = [r for r in got if r["container_kind"] == kind]
        fill = Counter()
        for r in mine:
            fill[r["container_id"]] += r["n_tokens"]
        assert max(fill.values()) <= capacity
        pieces = {}
        for r in sorted(mine, key=lambda r: r["piece_no"]):
            pieces.setdefault(r["doc_id"], []).append((r["start_token"], r["n_tokens"]))
        assert {d: sum(n for _, n in p) for d, p in pieces.items()} == sizes
        for d, p in pieces.items():
            assert len(p) == -(-sizes[d] // capacity) and all(a + n == b for (a, n), (b, _) in zip(p, p[1:]))
    use = {r["container_kind"]: r["unused_share"] for r in packing.container_use(out, budgets).collect()}
    assert use["short"] < 0.03 and use["long"] < 0.12  # the last container of 512 may be nearly empty


def test_neighbours_fill_a_container_to_its_end():
    # texts of 80, 12, 20 and 8 tokens; the second and fourth share a term with the first, the third none
    terms = [np.array([0, 1]), np.array([0]), np.array([2]), np.array([0])]
    index = packing.Index(terms, [np.array([40, 40]), np.array([12]), np.array([20]), np.array([8])], np.ones(3), 30.0)
    assert packing.fill(np.array([80, 12, 20, 8]), np.arange(4), index, 100) == [[0, 1, 3], [2]]
    # nothing with a score fits: by size
    assert packing.fill(np.array([80, 30, 20, 25]), np.arange(4), index, 100) == [[0, 2], [1, 3]]


def test_packing_edges(spark):
    assert packing.pack_texts(spark.createDataFrame([(1, None), (2, "")], "doc_id bigint, text string"), [("a", 8)]).count() == 0
    with pytest.raises(ValueError):
        packing.pack_texts(spark.createDataFrame([], "doc_id bigint, text string"), [("a", 0)])


def test_bm25_prefers_the_like():
    terms = [np.array(t) for t in ([1, 2, 3], [1, 2, 9], [7, 8, 9], [3])]
    idf = np.ones(10)
    score = packing.Index(terms, [np.ones(len(t)) for t in terms], idf, 2.5).scores(0)
    assert score[1] > score[3] > score[2] == 0


# --- p8: mixing


def test_flight_keeps_its_constraints():
    rng = np.random.default_rng(1)
    p, t = rng.random(400), rng.integers(1, 500, 400).astype(float)
    x = np.column_stack([t, np.ones(400)])
    out = mixing.flight(p, x, rng)
    assert ((out > 1e-9) & (out < 1 - 1e-9)).sum() <= 2 and np.allclose(x.T @ out, x.T @ p)


def test_flight_is_unbiased():
    p = np.array([0.2, 0.5, 0.8, 0.4, 0.6, 0.5])
    t = np.array([1.0, 2.0, 3.0, 4.0, 5.0, 6.0])
    mean = np.mean([mixing.flight(p, np.column_stack([t, np.ones(6)]), np.random.default_rng(i)) for i in range(1500)], axis=0)
    assert np.abs(mean - p).max() < 0.05


@pytest.mark.parametrize("block", [20_000, 30])
def test_mixture_reaches_its_shares(spark, block):
    rng = random.Random(4)
    data = [(i, s, " ".join(f"w{rng.randrange(999)}" for _ in range(rng.choice([3, 10, 40, 300])))) for i, s in enumerate(["a"] * 300 + ["b"] * 120 + ["c"] * 10 + ["unlisted"] * 20)]
    data += [(1000 + i, s, t) for i, s, t in data[:50]] + [(2000, "a", None), (2001, None, "x"), (2002, "a", " ")]
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 2), ("c", 0.1, 3), ("gone", 0.1, 4)], "source string, target_share double, max_repeats int")
    chosen, shares = mixing.mix_sources(spark.createDataFrame(data, "doc_id bigint, source string, text string"), targets, block=block)
    got = {r["source"]: r for r in shares.collect()}
    assert got["gone"]["used_texts"] == 0 and got["gone"]["actual_share"] == 0
    assert sum(r["actual_share"] for r in got.values()) == pytest.approx(1)
    for s in "abc":
        assert got[s]["actual_share"] == pytest.approx(got[s]["reachable_share"], abs=0.01) and got[s]["most_repeats"] <= got[s]["max_repeats"]
    texts = {i: t for i, _, t in data}
    used = Counter()
    for r in chosen.collect():
        used[r["source"], texts[r["doc_id"]]] += r["repeats"]
    assert all(n <= got[s]["max_repeats"] for (s, _), n in used.items())
    again, _ = mixing.mix_sources(spark.createDataFrame(data, "doc_id bigint, source string, text string").repartition(5), targets, block=block)
    assert sorted(map(str, again.collect())) == sorted(map(str, chosen.collect()))


def test_mixture_edges(spark):
    targets = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    chosen, shares = mixing.mix_sources(spark.createDataFrame([], "doc_id bigint, source string, text string"), targets)
    assert chosen.count() == 0 and shares.first()["actual_share"] == 0
    with pytest.raises(ValueError, match="twice"):
        mixing.mix_sources(spark.createDataFrame([], "doc_id bigint, source string, text string"), targets.unionByName(targets))


# --- p9: garbled text

CLEAN = [
    "Für die Studie wurden schwere Ketten ausgewählt und später zusammengeführt.", "La région CDR3 était déjà modifiée après l’étape précédente.", "A região CDR3 tinha em média nove aminoácidos após a correção.",
    "La anotación automática falló en los niños más pequeños.", "Повторные строки следует считать только один раз.", "Образцы хранили при низкой температуре и размораживали постепенно.", "Plain text only.",
]
PAIRS = [("utf_8", "cp1252"), ("utf_8", "latin_1"), ("utf_8", "cp437"), ("utf_8", "mac_roman"), ("utf_8", "cp1251")]


def test_unread_inverts_misread():
    for written, read in [*PAIRS, ("cp1251", "koi8_r"), ("koi8_r", "cp1251"), ("cp866", "cp1251"), ("cp1252", "mac_roman")]:
        for text in CLEAN[4:6] if "koi" in written + read or written in ("cp1251", "cp866") else CLEAN[:2]:
            assert mojibake.unread(mojibake.misread(text, written, read), written, read) == text
    assert mojibake.unread("é", "utf_8", "cp1252") is None and mojibake.unread("Ω≈ж", "cp1252", "koi8_r") is None


def test_garbled_documents(spark):
    data, truth = [], {}
    for i in range(420):
        text = CLEAN[i % 7] + f" Lauf {i}."
        if i % 10 == 0 and not text.isascii():
            written, read = PAIRS[(i // 10) % 5]
            if i % 20 == 0:
                text, whole = mojibake.misread(text, written, read), text
            else:  # a single word
                words = text.split(" ")
                k = next(n for n, w in enumerate(words) if not w.isascii())
                whole, words[k] = text, mojibake.misread(words[k], written, read)
                text = " ".join(words)
            truth[i] = whole
        data.append((i, text))
    data += [(900, None), (901, ""), (902, " "), (903, "replaced �ber"), (904, "├── paired\n└── unpaired")] + [(910 + n, "├── paired\n└── unpaired") for n in range(8)]
    rows = spark.createDataFrame(data, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in mojibake.garbled_documents(rows.withColumn("key", F.lit(1)).withColumn("states", F.lit("clash"))).collect()}
    assert set(got) == {*truth, 903}
    assert not got[903]["fully_restored"] and got[903]["restored_text"] == "replaced �ber"
    assert sum(got[i]["restored_text"] == t for i, t in truth.items()) >= 0.95 * len(truth)


def test_garbled_edges(rows):
    assert mojibake.garbled_documents(rows([], "doc_id bigint, text string")).count() == 0
    assert mojibake.garbled_documents(rows([(1, "ascii"), (2, None)], "doc_id bigint, text string")).count() == 0


def test_the_subpackage_stands_apart():
    import pathlib

    import vdjlake

    root = pathlib.Path(vdjlake.__file__).parent
    assert not [p for p in root.rglob("*.py") if "llm" not in p.parts and "vdjlake.llm" in p.read_text()]


def test_token_sets_with_surplus_tokens_and_many_tokens():
    from vdjlake.llm.canonical import Matcher, token_edits

    m = Matcher([(1, ["human", "Homo sapiens"]), (2, ["rat"]), (3, ["T1/T2 immature B cells"]), (4, ["innate-like B-1 lymphocytes"]), (5, ["B cells"]), (6, ["mouse"])])
    found = {v: m.match(v)[0] for v in ("humna donor", "Homo sapeins adult", "cells B imature T2 T1", "B-1 lymphocites innate like", "lymphocytes, B-1 xinnate like")}
    assert found == {"humna donor": 1, "Homo sapeins adult": 1, "cells B imature T2 T1": 3, "B-1 lymphocites innate like": 4, "lymphocytes, B-1 xinnate like": 4}
    # surplus costs: a short name needs to stand as it is, single letters aren't exchanged
    assert [m.match(v)[0] for v in ("cat donor", "T cells blood", "huumna donor of blood kept", "horse donor")] == [0, 0, 0, 0]
    assert token_edits(["a", "bcd"], ["bcd"], 0) == 1 and token_edits(["bcd"], ["bcd", "a"], 3) == 4 and token_edits("x abc abd".split(), "abd abe".split(), 3) == 2


def test_values_that_share_three_segments_stay_within_bounds(spark, monkeypatch):
    """400 evaluation and 400 training values alike but for their last quarter: pairs of an n-gram fall below the limit."""
    rng = random.Random(11)
    base = "".join(rng.choice("ACDEFGHIKL") for _ in range(90))
    tails = ["".join(rng.choice("ACDEFGHIKLMNPQRSTVWY") for _ in range(30)) for _ in range(760)]
    data = [(i, "train" if i < 400 else "test", base + t) for i, t in enumerate(tails)]
    data += [(1000 + i, "test", _mutate(rng, base + tails[i], 2)) for i in range(40)]
    most, plain = [], overlap._hits

    def counted(q, r, k, *on):
        both = q.groupBy("key", *on).count().join(r.groupBy("key", *on).agg(F.count(F.lit(1)).alias("n")), ["key", *on])
        most.append(both.agg(F.max(F.col("count") * F.col("n"))).first()[0] or 0)
        return plain(q, r, k, *on)

    monkeypatch.setattr(overlap, "_hits", counted)
    df = spark.createDataFrame(data, "record_id bigint, ml_subset string, s string")
    got = {r["record_id"] for r in overlap.split_overlaps(df, F.col("s"), F.lit(None).cast("string"), hot_pairs=2000, measures=True).collect() if r["edits"] <= 3 and r["containment"] >= 0.25}
    assert got == {1000 + i for i in range(40)}
    assert len(most) > 2 and max(most) <= 8000  # blocks are hashed, so about 2000


def test_hot_keys_are_joined_in_blocks(spark):
    values = [("A" * 6 + "".join(p), i % 2 == 0, i % 2 == 1) for i, p in enumerate(product("CDEFG", repeat=2))]
    df = overlap.value_table(spark.createDataFrame(values, "s string, q boolean, r boolean"), "s", [(F.col("q"), F.col("r"))])
    for hot in (1, 10**6):
        pairs = {(r["q_value"], r["r_value"]) for r in overlap.near_values(df.filter("query"), df.filter("reference"), 1, hot).collect()}
        assert pairs == {(a, b) for a, q, _ in values for b, _, r in values if q and r and _edit_distance(a, b) <= 1}
        assert pairs


def test_tilted_probabilities_keep_both_totals():
    rng = np.random.default_rng(3)
    q, t = rng.random(300), rng.integers(1, 400, 300).astype(float)
    for off in (-4000.0, 0.0, 6000.0):
        out = mixing.tilted(q, t, float(q @ t) + off, float(q.sum()) - 2)
        assert out.min() >= 0 and out.max() <= 1 and abs(out @ t - q @ t - off) < 1 and abs(out.sum() - q.sum() + 2) < 0.01
    assert mixing.tilted(q, t, 2 * t.sum(), 5).min() == 1 and mixing.tilted(q, t, -5, 5).max() == 0


def test_texts_that_never_fill_a_container_stay_in_their_shards(spark, monkeypatch):
    """300 texts of 0.7 of the capacity, in shards of 20: no group of a later stage holds more."""
    df = spark.createDataFrame([(i, " ".join(f"w{(i * 7 + j) % 97}" for j in range(10))) for i in range(300)], "doc_id bigint, text string")
    n = len(encoding().encode_ordinary(" ".join(f"w{j}" for j in range(10))))
    out = packing.pack_texts(df, [("k", int(n * 1.4))], shard_texts=20).collect()
    assert len({r["container_id"] for r in out}) == len(out) == 300
    groups = Counter(r["container_id"].rsplit("-", 1)[0] for r in out)
    assert len(groups) >= 15 and max(groups.values()) <= 60


def test_strata_do_not_share_a_column(spark):
    data = [(f"g{i:02}", s) for i in range(60) for s in (["s0"] if i % 2 else ["s18"]) * 100]
    out = linked_splits.assign_groups(spark.createDataFrame(data, "g string, s string"), "g", "s", {"a": 0.5, "b": 0.5})
    assert {(r["split"], r["s"]): r["count"] for r in out.groupBy("split", "s").count().collect()} == {(x, s): 1500 for x in "ab" for s in ("s0", "s18")}
