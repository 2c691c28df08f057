import gzip
import json
import os
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from vdjlake import sinks
from vdjlake.functions.embed import composition_model, embed
from vdjlake.operators.normalize import canonical_rows
from vdjlake.schema import HEADER_FAMILIES, UNIT_KEY
from vdjlake.sources.csv_units import check_row_counts, parse_metadata_line, peek, read_units, unit_headers
from vdjlake.sources.files import download_list, footers, import_units, metadata_from_json, unit_rows
from vdjlake.streaming.ingest import file_stream, first_seen, ingest

NUMBERING = "{'fw%s1': {'1 ': 'Q', '2 ': 'V'}, 'cdr%s3': {'105 ': 'A'}}"


def _unit(folder, subset, study, unit, family, plain=False, rows=2):
    """A unit file of a header family: two records, the second without most values."""
    columns = sorted(HEADER_FAMILIES[family])
    values = {"ANARCI_status": "|||", "cdr3_aa": "A", "locus": "H", "productive": "T", "fwr1_start": "1.0", "fwr1_end": "6.0", "v_identity": "98.5", "Redundancy": "3", "Isotype": "IGHM"}

    def cell(c, i):
        base, chain = (c.removesuffix("_heavy").removesuffix("_light"), "k" if c.endswith("_light") else "h")
        if base == "ANARCI_numbering":
            return '"' + NUMBERING % (chain, chain) + '"'
        if base == "locus":
            return chain.upper()
        return values.get(base, "") if i == 0 or base in ("cdr3_aa",) else ""

    meta = json.dumps({"Run": unit, "Author": "A et al., 2015", "Unique sequences": rows})
    first = meta if plain else '"' + meta.replace('"', '""') + '"'
    path = f"{folder}/{subset}/{study}/{unit}"
    os.makedirs(path)
    name = f"{path}/{unit}.csv.gz"
    with gzip.open(name, "wt") as f:
        f.write(first + "\n" + ",".join(columns) + "\n" + "".join(",".join(cell(c, i) for c in columns) + "\n" for i in range(rows)))
    return name


def test_units_of_every_header_family(spark, folder):
    paths = [_unit(folder, "paired" if f[0] == "P" else "unpaired", "S_2020", f"{f}_Heavy_IGHM", f, plain=f in ("U2", "P2")) for f in HEADER_FAMILIES]
    heads = {r["path"]: r for r in unit_headers(spark, [*paths, f"{folder}/none.csv.gz"]).collect()}
    assert [heads[p]["family"] for p in paths] == list(HEADER_FAMILIES) and heads[f"{folder}/none.csv.gz"]["error"]
    raw = read_units(spark, paths)
    assert raw.count() == 8 and {r[0] for r in raw.select("index_in_unit").distinct().collect()} == {0, 1}
    check_row_counts(spark, raw, paths)
    good, bad = canonical_rows(raw)
    assert bad.count() == 0 and good.count() == 12
    first = good.filter("unit_id = 'U1_Heavy_IGHM' AND index_in_unit = 0").first()
    assert (first["sequence_aa"], first["redundancy"], first["fwr1_length"], first["v_identity"], first["productive"]) == ("QVA", 3, 6, 98.5, True)
    pair = {r["chain"]: r["isotype"] for r in good.filter("unit_id = 'P2_Heavy_IGHM' AND index_in_unit = 0").collect()}
    assert pair == {"heavy": "IGHM", "light": "IGHM"}


def test_rows_that_start_like_the_metadata_stay(spark, folder):
    path = _unit(folder, "unpaired", "S", "u", "U2", rows=0)
    with gzip.open(path, "at") as f:
        f.write('"starts ""like"" the, metadata",NA' + "," * 93 + "\n")
    raw = read_units(spark, [path])
    check_row_counts(spark, raw, [path])
    assert (raw.first()["ANARCI_numbering"], raw.first()["ANARCI_status"]) == ('starts "like" the, metadata', "NA")
    assert read_units(spark, [path], ("", "NA")).first()["ANARCI_status"] is None
    with pytest.raises(ValueError, match="rows were lost"):
        check_row_counts(spark, raw.limit(0), [path])


def test_metadata_lines(spark, folder):
    assert parse_metadata_line('"{""Run"": ""x""}"\n') == {"Run": "x"} == parse_metadata_line('{"Run": "x"}')
    meta, columns, first = peek(_unit(folder, "paired", "S", "u", "P1"))
    assert meta["Run"] == "u" and len(columns) == 180 and first == '"'
    df = spark.createDataFrame([(1, '"{""Run"": ""x""}"'), (2, "{broken"), (3, None)], "id int, line string")
    assert {r["id"]: (r["Run"], r["json_error"]) for r in metadata_from_json(df, "line", "Run string").collect()} == {1: ("x", False), 2: (None, True), 3: (None, False)}


def test_import_of_pandas_files(spark, folder):
    pd.DataFrame({"locus": ["H"], "redundancy": pd.array([3], dtype="UInt64"), "anarci_deletions": [[1, 2]], "productive": [None]}).to_parquet(f"{folder}/a.parquet")
    pd.DataFrame({"locus": [None], "redundancy": pd.array([None], dtype="UInt64"), "anarci_deletions": [None], "productive": [True]}).to_parquet(f"{folder}/b.parquet")
    with open(f"{folder}/c.parquet", "w") as f:
        f.write("no parquet")
    report = {os.path.basename(r["path"]): (r["num_rows"], r["error"] is None) for r in footers(spark, [f"{folder}/{x}.parquet" for x in "abc"]).collect()}
    assert report == {"a.parquet": (1, True), "b.parquet": (1, True), "c.parquet": (None, False)}
    out = import_units(spark, [f"{folder}/a.parquet", f"{folder}/b.parquet"])
    assert {(r["locus"], r["redundancy"], tuple(r["anarci_deletions"] or ()), r["productive"]) for r in out.collect()} == {("H", 3, (1, 2), None), (None, None, (), True)}
    assert out.filter("anarci_deletions IS NULL").count() == 1


def test_download_list(spark, folder):
    base = "http://data.example.org/archive/units"
    lines = [f"wget {base}/unpaired/B_2018/csv/E_Heavy_IGHM.csv.gz", "", f"wget {base}/pairedA_2019/csv/S_paired.csv.gz"]
    with open(f"{folder}/all.sh", "w") as f:
        f.write("\n".join(lines) + "\n")
    assert [r["study_id"] for r in download_list(spark, f"{folder}/all.sh", "data.example.org", "archive/units").collect()] == ["A_2019", "B_2018"]
    with open(f"{folder}/all.sh", "a") as f:
        f.write(lines[0] + "\n")
    with pytest.raises(ValueError, match="1 addresses are repeated"):
        download_list(spark, f"{folder}/all.sh", "data.example.org", "archive/units")


def _records(spark):
    return spark.range(400).select(
        F.when(F.col("id") % 2 == 0, "paired").otherwise("unpaired").alias("oas_subset"), F.lit("s").alias("study_id"), F.concat(F.lit("u"), F.col("id") % 4).alias("unit_id"),
        F.col("id").alias("index_in_unit"), F.lit("heavy").alias("chain"), F.sha1((F.col("id") % 150).cast("string")).alias("sequence_aa"), F.lit(1).cast("bigint").alias("redundancy"),
        F.lit(True).alias("productive"), F.lit(22).alias("fwr1_aa_length"), F.lit(11).alias("fwr4_aa_length"), F.lit(None).cast("array<string>").alias("anarci_insertions"),
        F.lit(False).alias("anarci_cdr3_is_over_37_aa_long"), F.lit(False).alias("anarci_unusual_residue"), F.lit(False).alias("anarci_missing_conserved_cysteine"), F.lit(False).alias("has_kappa_gap_21"),
    )


def test_copy_dataset(spark, folder):
    rows = _records(spark)
    base = sinks.copy_dataset(spark, rows, folder, "default", units=rows.select(*UNIT_KEY).distinct())
    assert base.endswith("filters=default")
    out = unit_rows(spark, f"{base}/sequences")
    assert out.count() == 150 and unit_rows(spark, f"{base}/sequences", "paired", "s", "u0").select("unit_id").distinct().count() == 1
    assert spark.read.parquet(f"{base}/logs").agg(F.sum("filtered_out")).first()[0] == 250
    for name in (f for f in out.inputFiles()):
        values = pd.read_parquet(name.removeprefix("file://"))["sequence_aa"].tolist()
        assert values == sorted(values)
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        sinks.copy_dataset(spark, rows, folder, "default")
    small = sinks.copy_dataset(spark, rows, folder, "none", max_rows_a_unit=3)
    assert unit_rows(spark, f"{small}/sequences").count() == 12


def test_copy_file(folder):
    with gzip.open(f"{folder}/a.gz", "wt") as f:
        f.write("1\n2\n3\n")
    sinks.copy_file(f"{folder}/a.gz", f"{folder}/x/b.gz", head=2)
    assert gzip.open(f"{folder}/x/b.gz", "rt").read() == "1\n2\n"
    with pytest.raises(FileExistsError):
        sinks.copy_file(f"{folder}/a.gz", f"{folder}/x/b.gz")


def test_stream_goes_on_from_its_checkpoint(spark, folder):
    rows = _records(spark).select("sequence_aa", "index_in_unit")
    rows.filter("index_in_unit < 200").coalesce(1).write.parquet(f"{folder}/in/a")
    run = lambda: ingest(first_seen(file_stream(spark, f"{folder}/in/*", rows.schema)), f"{folder}/out", f"{folder}/state").awaitTermination()
    run()
    assert spark.read.parquet(f"{folder}/out").count() == 150
    rows.coalesce(1).write.parquet(f"{folder}/in/b")
    run()
    assert spark.read.parquet(f"{folder}/out").count() == 150


def test_embed(spark):
    df = spark.createDataFrame([(1, "ACAC"), (2, None), (3, "")], "id int, sequence_aa string")
    out = {r["id"]: r["embedding"] for r in embed(df, composition_model, batch=1).collect()}
    assert out[1][:2] == [0.5, 0.5] and out[2] is None and sum(out[3]) == 0


def test_command_line(spark, folder):
    from vdjlake import cli

    _unit(f"{folder}/raw", "unpaired", "S_2020", "a_Heavy_IGHM", "U1")
    assert cli.main(["process-units", f"{folder}/raw/*/*/*/*.csv.gz", f"{folder}/rows"]) == 0
    assert cli.main(["consolidate-stats", f"{folder}/rows", f"{folder}/stats"]) == 0
    assert cli.main(["summarize-stats", f"{folder}/stats", f"{folder}/summary"]) == 0
    assert spark.read.parquet(f"{folder}/summary/matrix").filter("position = 'total'").first()["total"] == 6
    assert cli.main(["build-index", f"{folder}/rows", f"{folder}/index"]) == 0
    with pytest.raises(SystemExit):
        cli.main(["copy"])
    with pytest.raises(FileNotFoundError):
        cli.main(["check-units", f"{folder}/nothing*"])


def test_null_units_are_written_and_logged(spark, folder):
    rows = _records(spark).withColumn("unit_id", F.when(F.col("index_in_unit") % 4 == 3, None).otherwise(F.col("unit_id")))
    two = spark.createDataFrame([("paired", "s", "u", "A"), ("paired", "s", None, "B")], "oas_subset string, study_id string, unit_id string, sequence_aa string")
    sinks.write_sequences(two, f"{folder}/two")
    assert spark.read.parquet(f"{folder}/two").count() == 2
    base = sinks.copy_dataset(spark, rows, folder, "default", units=rows.select(*UNIT_KEY).distinct())
    log = spark.read.parquet(f"{base}/logs")
    assert log.filter("unit_id IS NULL AND step = 8 AND filtered_length > 0").count() == 1 and spark.read.parquet(f"{base}/sequences").count() == 150
    assert spark.read.parquet(f"{base}/units").filter("unit_id IS NULL").count() == 1


def test_stream_keeps_rows_without_a_value(spark, folder):
    df = spark.createDataFrame([("A",), ("A",), (None,), (None,), ("",), ("",)], "sequence_aa string")
    df.coalesce(1).write.parquet(f"{folder}/in/a")
    ingest(first_seen(file_stream(spark, f"{folder}/in/*", df.schema)), f"{folder}/out", f"{folder}/state").awaitTermination()
    assert sorted(str(r[0]) for r in spark.read.parquet(f"{folder}/out").select("sequence_aa").collect()) == ["", "", "A", "None", "None"]


def test_small_units_are_written_without_a_wait_for_each(spark, folder):
    ids = ["plain", "a+b c", "x:y/z=%41{[^]}#?*'\"\\", "", None]
    rows = spark.range(3000).select(
        F.lit("s").alias("oas_subset"), F.lit("t").alias("study_id"), F.when(F.col("id") < 5, F.element_at(F.array(*map(F.lit, ids)), (F.col("id") + 1).cast("int"))).otherwise(F.concat(F.lit("u"), F.col("id"))).alias("unit_id"),
        F.when(F.col("id") != 7, F.sha1(F.col("id").cast("string"))).alias("sequence_aa"), F.array(F.col("id").cast("smallint")).alias("places"), F.timestamp_seconds("id").alias("at"), F.lit(None).cast("array<string>").alias("none"),
    )
    began = time.perf_counter()
    files = sinks.write_sequences(rows, f"{folder}/out")
    assert time.perf_counter() - began < 20 and files.count() == 3000
    out = spark.read.parquet(f"{folder}/out")
    assert sorted(out.dtypes) == sorted(rows.dtypes)
    whole = rows.withColumn("unit_id", F.when(F.col("unit_id") != "", F.col("unit_id")))
    assert out.select(*rows.columns).exceptAll(whole).count() == whole.exceptAll(out.select(*rows.columns)).count() == 0


def test_large_units_are_cut_into_sorted_files(spark, folder):
    rows = _records(spark).withColumn("unit_id", F.when(F.col("index_in_unit") < 390, "u").otherwise("v"))
    sinks.write_sequences(rows, f"{folder}/out", rows_a_file=60)
    sinks.write_sequences(rows, f"{folder}/out", mode="append", rows_a_file=60)
    out = spark.read.parquet(f"{folder}/out")
    assert out.count() == 800 and out.select(*rows.columns).exceptAll(rows.unionAll(rows)).count() == 0
    counts = [pd.read_parquet(f.removeprefix("file://"))["sequence_aa"].tolist() for f in out.inputFiles()]
    assert max(map(len, counts)) == 60 and all(x == sorted(x) for x in counts)
    sinks.write_sequences(rows, f"{folder}/out", mode="overwrite")
    assert spark.read.parquet(f"{folder}/out").count() == 400


def test_footers_of_a_table_of_paths_and_their_order(spark, folder):
    from vdjlake.plans import files as plans

    for name, values in {"a": [None, "A", "B"], "b": ["B", "A"], "c": ["A", None], "d": []}.items():
        pd.DataFrame({"sequence_aa": pd.array(values, dtype="string")}).to_parquet(f"{folder}/{name}.parquet")
    paths = spark.createDataFrame([(f"{folder}/{x}.parquet",) for x in "abcde"], "path string")
    found = {r["path"][-9]: (r["num_rows"], r["in_order"]) for r in footers(spark, paths, "sequence_aa").collect()}
    assert found == {"a": (3, True), "b": (2, False), "c": (2, False), "d": (0, True), "e": (None, None)}
    rows = spark.range(3000).select(
        F.col("id").alias("record_id"), F.lit("s").alias("oas_subset"), F.lit("t").alias("study_id"), F.when(F.col("id") > 1, F.concat(F.lit("a+b:% "), F.col("id") % 1500)).alias("unit_id"), F.sha1(F.col("id").cast("string")).alias("sequence_aa")
    )
    rows.write.parquet(f"{folder}/sequences.parquet")
    began = time.perf_counter()
    out = plans.footers(spark, folder).collect()
    assert time.perf_counter() - began < 20 and all(r["in_order"] for r in out)
    assert {r["unit_id"]: r["num_rows"] for r in out} == {r["unit_id"]: r["n"] for r in rows.groupBy("unit_id").agg(F.count("*").alias("n")).collect()}


def test_many_small_units_are_read_in_few_tasks(spark, folder):
    from vdjlake.plans import files as plans

    ids = F.when(F.col("id") > 1, F.concat(F.lit('a+"b\\:% '), F.col("id") % 1500))
    rows = spark.range(3000).select(
        F.col("id").alias("record_id"), F.lit("s").alias("oas_subset"), F.lit("t").alias("study_id"), ids.alias("unit_id"), F.lit("H").alias("locus"), F.lit('v,"1"').alias("v_call"),
        F.lit(None).cast("string").alias("j_call"), F.concat(F.lit("A"), F.col("id")).alias("junction_aa"), F.col("id").alias("redundancy"), (F.col("id") % 2 == 0).alias("productive"),
    )
    rows.write.parquet(f"{folder}/sequences.parquet")
    began = time.perf_counter()
    out = plans.units_round_trip(spark, folder)
    assert out.rdd.getNumPartitions() < 100 and {(r["unit_id"], int(r["sequence_id"]), r["v_call"], r["j_call"], r["junction_aa"], r["redundancy"], r["productive"]) for r in out.collect()} == {
        (r["unit_id"], r["record_id"], r["v_call"], None, r["junction_aa"], r["redundancy"], r["productive"]) for r in rows.collect()
    }
    assert time.perf_counter() - began < 40
    assert {r["index_in_unit"] for r in out.collect()} == {0, 1}


def test_units_with_different_headers_and_a_broken_one(spark, folder):
    paths = [_unit(folder, "paired" if f[0] == "P" else "unpaired", "S", f"{f}_{i}", f) for f in HEADER_FAMILIES for i in range(3)]
    table = spark.createDataFrame([(p,) for p in [*paths, f"{folder}/none.csv.gz"]], "path string")
    with pytest.raises(ValueError, match="none.csv.gz"):
        read_units(spark, table)
    out = read_units(spark, table, skip_broken=True)
    whole = read_units(spark, paths)
    assert out.count() == 24 and out.exceptAll(whole).count() == 0 and out.filter("unit_id LIKE 'P2%' AND locus_heavy = 'H'").count() == 6 == out.filter("unit_id LIKE 'U2%' AND locus = 'H'").count()
