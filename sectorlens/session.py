"""Session helpers: one place for the configuration every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import SparkConf
from pyspark.sql import DataFrame, SparkSession

# Settings that hold at any scale: AQE re-plans shuffles at run time
# (coalescing small partitions, splitting skewed join partitions), and the
# Arrow batch size is kept small because HTML rows are wide.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "sectorlens") -> SparkSession:
    """A session with the settings above.

    Master, memory and partition counts belong to the job's configuration:
    they are set here only if given, and ``local[*]`` is used only where
    nothing names a master (a plain ``python`` run).
    """
    builder = SparkSession.builder.appName(app_name)
    if master is None and not SparkConf().contains("spark.master"):
        master = "local[*]"
    if master is not None:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory", os.environ.get("SECTORLENS_DRIVER_MEM", "16g"))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if spark.sparkContext.master.startswith("local["):
        ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is
    used as is; a scratch folder is made only where it is unset and the
    whole job runs in one local process (tests).
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current
    existing = sc.getCheckpointDir()
    if existing:
        return existing
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="sectorlens-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/sectorlens-run/{name}-{uuid.uuid4().hex}"


#: Spark drops a query's shuffle files when it ends, not when the driver next collects its garbage.
LEAN = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}
#: Rows that hold whole texts go to the workers in small batches.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "256"}


def _stored(df: DataFrame, name: str, conf: dict[str, str]) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/sectorlens-stage/{name}-{uuid.uuid4().hex}"
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path), path


def staged(df: DataFrame, name: str, lean: bool = False) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back: the lineage is cut and the planner knows the size. ``lean``: closely
    compressed, and its shuffle files go as soon as it is written."""
    return _stored(df, name, LEAN if lean else {})[0]


@contextmanager
def scratch(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``staged`` (lean, in small batches) for as long as the block runs: what it makes of the table must be stored before it ends."""
    stored, path = _stored(df, name, LEAN | SMALL_BATCHES)
    try:
        yield stored
    finally:
        spark = df.sparkSession
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
