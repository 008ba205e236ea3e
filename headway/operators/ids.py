"""Dense, deterministic surrogate ids (C7) and high-water marks.

``row_number() OVER ()`` over a whole table is a single-partition window
in Spark.  Instead the rows are range partitioned and sorted on the order
keys, each partition counts its rows, the running offsets of those counts
(one row per partition: a proven size bound) are broadcast back, and each
row's id is ``offset + position inside its partition``.  The ranged rows
are written once as a table under the session's checkpoint folder, so a
lost executor re-reads them instead of numbering rows differently.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.session import ensure_checkpoint_dir, note_scratch

_LOW_BITS = (1 << 33) - 1


def _orders(cols):
    return [(F.col(c) if isinstance(c, str) else c).asc_nulls_last() for c in cols]


def dense_id(df: DataFrame, order_cols: list, name: str, offset: int = 0,
             num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based row number over ``order_cols`` (ASC NULLS
    LAST) plus ``offset``.  Rows tied on every order column receive
    distinct ids in an unspecified order."""
    spark = df.sparkSession
    ckpt = ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    orders = _orders(order_cols)
    # the range sample and the write both read the input: compute it once.
    # ``_hw_tie`` is a last order key so that rows equal on every order
    # column (even a third of all rows) still spread over many partitions.
    src = df.withColumn("_hw_tie", F.monotonically_increasing_id()).persist(StorageLevel.MEMORY_AND_DISK)
    orders = orders + [F.col("_hw_tie").asc()]
    path = f"{ckpt.rstrip('/')}/dense-id-{uuid.uuid4().hex}"
    (src.repartitionByRange(n, *orders)
     .sortWithinPartitions(*orders)
     .withColumn("_hw_mid", F.monotonically_increasing_id())
     .drop("_hw_tie")
     .write.parquet(path))
    note_scratch(path)
    src.unpersist()
    # a written table in the shared checkpoint folder cuts the lineage: a
    # lost executor re-reads these files instead of renumbering rows
    ranged = spark.read.parquet(path)
    pid = F.shiftright(F.col("_hw_mid"), 33)
    counts = ranged.groupBy(pid.alias("_hw_pid")).agg(F.count(F.lit(1)).alias("_hw_n"))
    before = Window.orderBy("_hw_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_hw_pid", F.coalesce(F.sum("_hw_n").over(before), F.lit(0)).alias("_hw_off"))
    out = (ranged.withColumn("_hw_pid", pid)
           .join(F.broadcast(offsets), "_hw_pid")
           .withColumn(name, (F.col("_hw_off") + F.col("_hw_mid").bitwiseAND(F.lit(_LOW_BITS))
                              + F.lit(offset + 1)).cast("bigint"))
           .drop("_hw_pid", "_hw_off", "_hw_mid"))
    return out


def rank_within(df: DataFrame, partition_cols: list[str], order_cols: list, name: str) -> DataFrame:
    """``row_number() OVER (PARTITION BY p ORDER BY o)`` that survives a
    partition holding a large share of all rows: a global dense id over
    (p, o) minus the first id of each p (a partial aggregate)."""
    ided = dense_id(df, list(partition_cols) + list(order_cols), "_hw_gid")
    first = ided.groupBy(*partition_cols).agg(F.min("_hw_gid").alias("_hw_first"))
    cond = [ided[c].eqNullSafe(first[c]) for c in partition_cols]
    joined = ided.join(first, cond).select(ided["*"], first["_hw_first"])
    return (joined.withColumn(name, (F.col("_hw_gid") - F.col("_hw_first") + 1).cast("bigint"))
            .drop("_hw_gid", "_hw_first"))


def next_id(df: DataFrame, col: str) -> int:
    """``1 + max(col)``; 1 for an empty table."""
    top = df.agg(F.max(col).alias("m")).first()["m"]
    return 1 if top is None else int(top) + 1


def high_water_marks(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row per table: (table_name, next_id) computed as one union of
    global aggregates (A9)."""
    parts = [df.agg(F.max(col).alias("m")).select(
        F.lit(name).alias("table_name"),
        (F.coalesce(F.col("m"), F.lit(0)) + 1).cast("bigint").alias("next_id"))
        for name, (df, col) in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
