"""Session helpers: sane defaults and a shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


# Settings for a large cluster (~100 TB of stop times, ~1000 executors).
# The shuffle partition count is an upper bound that AQE coalesces down;
# skewed join partitions are split; small dimensions (agencies, calendars,
# routes, zones, directions) are broadcast only below a measured size.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
    "spark.storage.decommission.rddBlocks.enabled": "true",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "headway", cluster: bool = False) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    if cluster:
        for k, v in CLUSTER_CONF.items():
            builder = builder.config(k, v)
        spark = builder.config("spark.ui.showConsoleProgress", "false").getOrCreate()
        spark.sparkContext.setLogLevel("WARN")
        ensure_checkpoint_dir(spark, shared=True)
        return spark
    spark = (
        builder
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Intermediate tables written in this process: folder, and name where the
# table is in the catalog.
_scratch: list[tuple[str, str | None]] = []


def note_scratch(path: str, table: str | None = None) -> None:
    _scratch.append((path, table))


def scratch_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once under the checkpoint folder and return it reread: the lineage is cut."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    note_scratch(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Deletes the intermediate tables written inside the block when it ends."""
    before = len(_scratch)
    try:
        yield
    finally:
        jvm = spark.sparkContext._jvm
        for path, table in _scratch[before:]:
            if table:
                spark.sql(f"DROP TABLE IF EXISTS {table}")
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        del _scratch[before:]


def ensure_checkpoint_dir(spark: SparkSession, shared: bool = False) -> str:
    """Return the session's checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only when nothing is configured (tests, local runs) a scratch
    folder is created; with ``shared``, or away from a local master, that is
    an error, since every executor would write to its own disk.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if shared or not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="headway-ckpt-",
                                      dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
