"""Intermediate tables in the shared checkpoint folder.

A table written here cuts the lineage: a lost executor re-reads files.  On a
cluster ``spark.checkpoint.dir`` names the shared folder; only where it is
unset (tests, local runs) the session helper makes one.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from headway.session import ensure_checkpoint_dir


def write_table(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` once under the checkpoint folder and return it reread."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._headway_path = path
    return out


def bucketed_table(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``write_table`` with the rows bucketed and sorted by ``keys``: a join on them leaves the table where it is."""
    spark = df.sparkSession
    table = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    path = f"{ensure_checkpoint_dir(spark)}/{table}"
    (df.write.bucketBy(shuffle_partitions(spark), *keys).sortBy(*keys).option("path", path).option("compression", "zstd").saveAsTable(table))
    out = spark.table(table)
    out._headway_path, out._headway_table = path, table
    return out


def drop_table(df: DataFrame) -> None:
    """Delete a table made by ``write_table`` or ``bucketed_table`` once nothing reads it any more."""
    path = getattr(df, "_headway_path", None)
    if path:
        spark: SparkSession = df.sparkSession
        if table := getattr(df, "_headway_table", None):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that nothing refers to any more.

    Spark does so when the driver's garbage collector finds the plan gone,
    which on a driver with little to do may be half an hour later.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package to the executors once per application, wherever the driver found it."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        _shipped.add(sc.applicationId)
        package = Path(__file__).resolve().parents[1]
        archive = f"{tempfile.mkdtemp(prefix='headway-py-')}/{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for source in sorted(package.rglob("*.py")):
                z.write(source, source.relative_to(package.parent))
        sc.addPyFile(archive)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
