"""Tables: reading inputs, and cutting lineage through files that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR = "spark.checkpoint.dir"


def table(spark: SparkSession, base: str, name: str, *columns: str) -> DataFrame:
    """The Parquet table ``name`` below ``base``, with only ``columns`` when given."""
    df = spark.read.parquet(f"{base}/{name}.parquet")
    return df.select(*columns) if columns else df


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores, where its files have fewer splits than that; for work that is much per row."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def over_cores(files: DataFrame, tasks_a_core: int = 8) -> DataFrame:
    """A list of files, hashed to a few tasks a core: its own size says nothing of the work that they are."""
    return files.repartition(tasks_a_core * files.sparkSession.sparkContext.defaultParallelism, "path")


@contextmanager
def uncoalesced(spark: SparkSession) -> Iterator[None]:
    """Shuffled partitions stay apart however few bytes they have, for work that is much per file."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by the session. Only where it is unset (tests, local runs) is one made here."""
    path = spark.conf.get(SHARED_DIR, None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{SHARED_DIR} must name a folder that all executors share")
        made = tempfile.mkdtemp(prefix="vdjlake-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        path = f"file://{made}"
        spark.conf.set(SHARED_DIR, path)
    return path.rstrip("/")


def cut(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later stages depend on files, not on executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/vdjlake/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files behind a ``cut`` table that nothing reads any more."""
    spark = df.sparkSession
    base = f"{shared_dir(spark)}/vdjlake/"
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if base.removeprefix("file://") in folder:
            path.getFileSystem(conf).delete(path, True)


def sweep(spark: SparkSession) -> None:
    """Delete all tables that ``cut`` has written to the shared folder; call it when their results aren't read any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/vdjlake")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
