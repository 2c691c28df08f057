import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vdjlake.operators.skew import count_mismatches, key_quantiles, record_counts, roll_up
from vdjlake.operators.snapshots import change_counts, snapshot_changes, strip

SNAP = "no int, at timestamp, k string, size bigint, modified timestamp, other string"
T0 = dt.datetime(2022, 1, 1)


def changes(df, **keys):
    return snapshot_changes(df, "no", keys or {"k": strip("k")}, {"modified": F.date_trunc("minute", "modified"), "size": F.col("size")}, ["at"])


def snap(no, k, size=1, minute=0, second=0, at=0):
    return (no, T0 + dt.timedelta(hours=at), k, size, None if minute is None else T0 + dt.timedelta(minutes=minute, seconds=second), "x")


def test_snapshot_changes(rows):
    data = [
        snap(1, "same"), snap(2, " same\t", second=40), snap(1, "gone"), snap(2, "new"), snap(1, "size"), snap(2, "size ", size=None), snap(1, "nulls", None, None), snap(2, "nulls", None, None),
        snap(1, "time", None), snap(2, "time", None, None), snap(2, "late", 5, at=9), snap(2, "late", 1, at=1), snap(1, "late", 5), snap(1, None), snap(2, None, 7), snap(None, "lost"), snap(2, "late", 5, at=9),
    ]
    out = {(r["no"], r["k"]): (r["change_kind"], r["changed_columns"]) for r in changes(rows(data, SNAP)).collect()}
    assert out == {(2, "gone"): ("removed", None), (2, "new"): ("added", None), (2, "size"): ("changed", ["size"]), (2, "time"): ("changed", ["modified"]), (2, None): ("changed", ["size"])}


def test_snapshot_gap_and_ends(rows):
    out = changes(rows([snap(1, "a"), snap(3, "a"), snap(3, "b")], SNAP))
    assert {(r["no"], r["k"], r["change_kind"]) for r in out.collect()} == {(2, "a", "removed"), (3, "a", "added"), (3, "b", "added")}
    counts = {r["no"]: (r["num_added"], r["num_removed"], r["num_changed"]) for r in change_counts(out, "no").collect()}
    assert counts == {2: (0, 1, 0), 3: (2, 0, 0)}


def test_snapshots_empty_and_single(rows):
    assert changes(rows([], SNAP)).count() == 0 and changes(rows([snap(1, "a")], SNAP)).count() == 0


def test_snapshot_ties_dont_depend_on_partitions(spark):
    data = [snap(1, "a", 1), snap(2, "a", 1), snap(2, "a", 2), snap(2, "a", 3)]
    got = {str(changes(spark.createDataFrame(data, SNAP).repartition(n)).collect()) for n in (1, 2, 5)}
    assert len(got) == 1


def test_snapshot_keys_named_like_other_columns(rows):
    df = rows([snap(1, "a"), snap(2, "b")], SNAP).withColumnsRenamed({"other": "change_kind"})
    assert {r["size"] for r in changes(df, size=F.col("k")).collect()} == {"a", "b"}


def test_record_counts_and_mismatches(rows):
    data = [("s", "u", 0, "h")] * 50 + [("s", "u", 0, "l"), ("s", "u", None, "h"), ("s", "v", 1, "h"), (None, "v", 1, "h"), ("s", "v", 1, "h")]
    counted = record_counts(rows(data, "study string, unit string, i bigint, chain string"), ["study", "unit"], ["i", "chain"])
    assert {(r["study"], r["unit"]): r["num_records"] for r in counted.collect()} == {("s", "u"): 3, ("s", "v"): 1, (None, "v"): 1}
    assert {r["study"]: r["num_records"] for r in roll_up(counted, ["study"], "num_records").collect()} == {"s": 4, None: 1}
    units = rows([("s", "u", 3), ("s", "v", 2), ("s", "v", 2), ("s", "w", 0), ("s", "x", 1), ("s", "y", None), (None, "v", 9)], "study string, unit string, said bigint")
    wrong = count_mismatches(units, counted, ["study", "unit"], "said", "num_records")
    assert {(r["study"], r["unit"], r["num_records"]) for r in wrong.collect()} == {("s", "v", 1), ("s", "x", 0), (None, "v", 1)}
    assert wrong.count() == 3


def test_record_counts_come_from_bins_that_merge(spark):
    rng = random.Random(7)
    values = [None, -(2**63), 2**63 - 1, -65, -64, -1, 0, 63, 64, 127, 128]
    data = [("hot", rng.choice(values) if rng.random() < 0.3 else rng.randint(-300, 300), rng.choice("hl")) for _ in range(3000)] + [("one", 5, None), ("one", 5, None), (None, None, None)]
    counted = record_counts(spark.createDataFrame(data, "unit string, i bigint, chain string").repartition(6), ["unit"], ["i", "chain"])
    want = {k: len({r for r in data if r[0] == k}) for k in ("hot", "one", None)}
    assert {r["unit"]: r["num_records"] for r in counted.collect()} == want
    # what is shuffled are bins with masks, never records
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "bit_or" in plan and "Aggregate [unit#" in plan and "Distinct" not in plan


@pytest.mark.parametrize("span", [1, 5, 300, 2**40, 2**62])
def test_key_quantiles_are_exact(spark, span):
    rng = random.Random(span)
    data = [(k, rng.randint(-span, span)) for k, n in (("hot", 400), ("cold", 7), (None, 3)) for _ in range(n)] + [("none", None), ("one", -span)]
    got = key_quantiles(spark.createDataFrame(data, "k string, v bigint").repartition(5), ["k"], "v", [0.0, 0.25, 0.5, 0.99, 1.0]).collect()
    for k in ("hot", "cold", None, "one"):
        values = sorted(v for x, v in data if x == k and v is not None)
        mine = {r["quantile"]: r["quantile_value"] for r in got if r["k"] == k}
        assert mine == {q: values[max(1, -int(-q * len(values) // 1)) - 1] for q in (0.0, 0.25, 0.5, 0.99, 1.0)}
    assert not [r for r in got if r["k"] == "none"]


@pytest.mark.parametrize("bits", [8, 3])
@pytest.mark.parametrize("top", [2**24, 2**40, 2**63 - 1])
def test_key_quantiles_at_the_ends_of_bins(spark, top, bits):
    low = 0 if top < 2**63 - 1 else -(2**63)
    values = sorted([low, 1, 2**21 - 1, 2**21, 2**24 - 1, top - 1, top])
    got = key_quantiles(spark.createDataFrame([("k", v) for v in values], "k string, v bigint"), ["k"], "v", [i / 7 for i in range(1, 8)], bits).collect()
    assert sorted(r["quantile_value"] for r in got) == values


def test_key_quantiles_empty(spark):
    assert key_quantiles(spark.createDataFrame([], "k string, v int"), ["k"], "v", [0.5]).count() == 0


def test_queries_have_the_columns_of_their_sql(spark):
    import glob
    import os

    import duckdb

    from vdjlake.plans import catalogue

    base = "/root/testdata/sf0.001"
    if not os.path.isdir(base):
        pytest.skip("no test tables")
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for p in glob.glob(f"{base}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    for name in ("p5_found", "p5_study_counts", "p6_found", "p6_study_counts", "pipeline_default", "pipeline_most_strict", "filter_log"):
        df = catalogue.QUERIES[name](spark, base)
        cursor = con.execute(catalogue.ORACLE_SQL[name])
        names = [d[0] for d in cursor.description]
        assert sorted(names) == sorted(df.columns)
        assert sorted(map(str, (tuple(r[c] for c in names) for r in df.collect()))) == sorted(map(str, cursor.fetchall())), name


def test_cut_tables_are_files_and_can_be_deleted(spark):
    from vdjlake.storage import cut, discard, sweep

    a, b = cut(spark.range(5), "a"), cut(spark.range(3).withColumn("x", F.lit(None).cast("string")), "b")
    assert (a.count(), b.schema.names, b.count()) == (5, ["id", "x"], 3)
    discard(a)
    with pytest.raises(Exception):
        a.collect()
    assert b.count() == 3
    sweep(spark)
    with pytest.raises(Exception):
        b.collect()
