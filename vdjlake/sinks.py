"""Writing tables: compressed, sorted, partitioned by unit; whole copies of a data set; file copies."""

from __future__ import annotations

import gzip
import os
import re
import shutil
import uuid
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vdjlake.operators.filters import RowFilter, pipeline, run_logged
from vdjlake.operators.joins import join_null_safe
from vdjlake.operators.sampling import sample_rows, sample_units
from vdjlake.schema import UNIT_KEY
from vdjlake.sources.paths import ARROW_SCHEMES, created
from vdjlake.storage import cut, uncoalesced


def write_parquet(df: DataFrame, path: str, level: int = 9, mode: str = "errorifexists", partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode(mode).option("compression", "zstd").option("parquet.compression.codec.zstd.level", str(level))
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def _folder_name(value: str | None) -> str:
    """A value as Spark writes it in the name of a partition folder."""
    return re.sub("[\x01-\x1f\x7f\"#%'*/:=?\\\\{\\[\\]^]", lambda m: f"%{ord(m[0]):02X}", value) if value else "__HIVE_DEFAULT_PARTITION__"


def _runs(batch, unit: Sequence[str]) -> Iterator[tuple[tuple, object]]:
    """The runs of rows of one unit in an Arrow batch: the unit, and its rows without the unit's columns."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    if not batch.num_rows:
        return
    new = np.zeros(batch.num_rows, bool)
    new[0] = True
    for c in unit:
        values = batch.column(c)
        a, b = values[1:], values[:-1]
        new[1:] |= pc.if_else(pc.and_(a.is_null(), b.is_null()), False, pc.fill_null(pc.not_equal(a, b), True)).to_numpy(zero_copy_only=False)
    starts = np.flatnonzero(new)
    keys = zip(*(batch.column(c).take(pa.array(starts)).to_pylist() for c in unit))
    rest = batch.drop_columns(list(unit))
    for key, start, end in zip(keys, starts.tolist(), [*starts[1:].tolist(), batch.num_rows]):
        yield key, rest.slice(start, end - start)


def write_unit_files(df: DataFrame, path: str, save: Callable, ending: str, unit: Sequence[str] = UNIT_KEY, rows_a_file: int = 2**62) -> DataFrame:
    """A file of each unit of each partition of ``df``, whose rows of a unit lie together, in a partition folder; path and num_rows of the files.

    ``save(file, unit values, iterator of Arrow batches)`` runs in the tasks. Spark's writer takes about 10 ms a file, so
    files are written by Python. Their names come from the partition's number: a task that runs again replaces what it
    wrote before. The files of a finished job are listed in the hidden table ``_files``.
    """
    spark, job = df.sparkSession, uuid.uuid4().hex
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    root = system.makeQualified(hadoop).toString()

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, done, left = TaskContext.get().partitionId(), [], None
        runs = (x for b in batches for x in _runs(b, unit))
        left = next(runs, None)
        while left is not None:
            key, rows = left[0], 0

            def own():  # batches of the file that is open
                nonlocal left, rows
                while left is not None and left[0] == key and rows < rows_a_file:
                    batch = left[1]
                    now = batch.slice(0, rows_a_file - rows)
                    rows += now.num_rows
                    left = (key, batch.slice(now.num_rows)) if now.num_rows < batch.num_rows else next(runs, None)
                    yield now

            folder = "/".join(f"{c}={_folder_name(v)}" for c, v in zip(unit, key))
            name = f"{folder}/part-{part:05d}-{job}.c{len(done):06d}{ending}"
            with created(root, name) as f:
                save(f, key, own())
            done.append((f"{root}/{name}", rows))
        for at in range(0, len(done), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done[at : at + 10_000])], ["path", "num_rows"])

    text = df.withColumns({c: F.col(c).cast("string") for c in unit})
    with uncoalesced(spark):
        text.mapInArrow(run, "path string, num_rows bigint").write.mode("append").option("compression", "zstd").parquet(f"{path}/_files/{job}")
    system.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS"), True).close()
    return spark.read.schema("path string, num_rows bigint").parquet(f"{path}/_files/{job}")


def _parquet_saver(schema: T.StructType, level: int = 10, group_bytes: int = 64_000_000) -> Callable:
    """Batches as a Parquet file that says its Spark schema, in row groups of ``group_bytes`` in memory."""
    said = {"org.apache.spark.sql.parquet.row.metadata": schema.json()}

    def save(f, key, batches) -> None:
        import pyarrow as pa
        import pyarrow.parquet as pq

        writer, held = None, []
        for b in batches:
            writer = writer or pq.ParquetWriter(f, b.schema.with_metadata(said), compression="zstd", compression_level=level, store_schema=False)
            held.append(b)
            if sum(x.nbytes for x in held) >= group_bytes:
                writer.write_table(pa.Table.from_batches(held).replace_schema_metadata(said))
                held = []
        if held:
            writer.write_table(pa.Table.from_batches(held).replace_schema_metadata(said))
        writer.close()

    return save


def write_sequences(df: DataFrame, path: str, unit: Sequence[str] = UNIT_KEY, value: str = "sequence_aa", mode: str = "errorifexists", rows_a_file: int = 2_000_000) -> DataFrame:
    """A data set partitioned by unit, each file sorted by ``value``, which compresses best; path of each file written.

    Rows are rebalanced by unit: adaptive execution cuts the partition of a large unit into several tasks and lets
    small units share one. The input is run once. Rows with a null in the unit are written too, as such a folder. What
    exists is overwritten by Spark, which refuses to do so while reading it; so is written what Arrow has no access to.
    """
    spark = df.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    exists = system.exists(hadoop)
    laid = df.hint("rebalance", *unit).sortWithinPartitions(*unit, value)
    if system.getUri().getScheme() in ARROW_SCHEMES and (not exists or mode == "append"):
        schema = T.StructType([f for f in df.schema if f.name not in unit])
        return write_unit_files(laid, path, _parquet_saver(schema), ".zstd.parquet", unit, rows_a_file).select("path")
    writer = laid.write.mode(mode).option("compression", "zstd").option("parquet.compression.codec.zstd.level", "10").option("maxRecordsPerFile", rows_a_file)
    writer.partitionBy(*unit).parquet(path)
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select("path")


def write_index(index: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The index of unique values, a folder for each shard."""
    write_parquet(index.repartition("shard"), path, 9, mode, ("shard",))


def copy_dataset(
    spark: SparkSession, rows: DataFrame, destination: str, strategy: str | Sequence[RowFilter] = "none", units: DataFrame | None = None,
    unit_probability: float = 0.0, max_rows_a_unit: int = -1, mode: str = "errorifexists", name: str | None = None,
) -> str:
    """Sampled and filtered units below ``destination/filters=<strategy>``, with logs; refuses to overwrite by default.

    Units are sampled by id, rows within units, then come the filters in order. The sample is drawn once and every step
    runs once, whatever is written from it.
    """
    steps = pipeline(strategy) if isinstance(strategy, str) else tuple(strategy)
    label = name or (strategy if isinstance(strategy, str) else "custom")
    base = f"{destination.rstrip('/')}/filters={label}"
    chosen = rows
    if 0 < unit_probability < 1:
        kept = sample_units(units if units is not None else rows.select(*UNIT_KEY).distinct(), unit_probability)
        chosen = join_null_safe(chosen, kept.select(*UNIT_KEY).distinct(), UNIT_KEY, "left_semi")
    if max_rows_a_unit >= 0:
        chosen = cut(sample_rows(chosen, max_rows_a_unit), "sample")
    kept_rows, log = run_logged(chosen, steps)
    write_sequences(kept_rows, f"{base}/sequences", mode=mode)
    if units is not None:
        write_parquet(join_null_safe(units, chosen.select(*UNIT_KEY).distinct(), UNIT_KEY, "left_semi"), f"{base}/units", mode=mode)
    if steps:
        write_parquet(log, f"{base}/logs", mode=mode)
    return base


def copy_file(source: str, target: str, head: int = -1, overwrite: bool = False) -> None:
    """A copy of a file, or of its first ``head`` lines."""
    if os.path.exists(target) and not overwrite:
        raise FileExistsError(target)
    os.makedirs(os.path.dirname(target) or ".", exist_ok=True)
    if head < 0:
        shutil.copyfile(source, target)
        return
    opened = gzip.open if source.endswith(".gz") else open
    with opened(source, "rt") as f, opened(target, "wt") as out:
        for _, line in zip(range(head), f):
            out.write(line)
