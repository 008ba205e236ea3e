"""L1: stops arriving on a stream get their time zone (the row trigger of
the original, re-aimed as a micro-batch job sharing the batch code).

The polygons are covered once when the stream starts.  Points resolved by
earlier batches are kept in a memo, so a batch meets the cover only with points
that it sees for the first time, and reads no polygon edge at all where there
are none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headway.config import MigrateConfig
from headway.operators.cover import Cover, build_cover
from headway.operators.spatial import point_timezone
from headway.sources.files import Files

BUCKETS = 64
COMPACT_AFTER = 32           # generations


class PointMemo:
    """Points with their zone (NULL: none), by generation and bucket of their coarsest cell.

    A generation holds what one batch resolved (``b00000007``), the merged
    generations before it (``m00000007``), or the cells whose polygons changed
    (``x00000007``): points of those cells resolved by earlier batches are
    forgotten.  A batch reads the buckets that its own points fall in.
    """

    SCHEMA = "lon double, lat double, tzid string, cx long, cy long, batch long, _bucket int"

    def __init__(self, spark: SparkSession, root: str, size: float):
        self.spark, self.root, self.size = spark, root.rstrip("/"), size
        self.files = Files(spark, root)

    def placed(self, points: DataFrame) -> DataFrame:
        """Points with their cell and bucket."""
        cell = points.select("*", F.floor(F.col("lon") / self.size).alias("cx"), F.floor(F.col("lat") / self.size).alias("cy"))
        return cell.withColumn("_bucket", F.pmod(F.xxhash64("cx", "cy"), F.lit(BUCKETS)).cast("int"))

    def _generations(self, before: int) -> list[str]:
        """The newest merged generation before a batch and those after it."""
        merged = [n for n in self.files.complete("", "m") if int(n[1:]) < before]
        since = int(merged[-1][1:]) if merged else -1
        return merged[-1:] + [n for n in self.files.complete("", "b") if since < int(n[1:]) < before]

    def known(self, before: int, buckets: list[int] | None = None) -> DataFrame:
        """Points resolved by batches before ``before``, without those of cells changed since."""
        paths = [f"{self.root}/{n}" for n in self._generations(before)]
        if not paths:
            return self.spark.createDataFrame([], self.SCHEMA)
        rows = self.spark.read.schema(self.SCHEMA).parquet(*paths) if len(paths) == 1 else self._union(paths)
        if buckets is not None:
            rows = rows.where(F.col("_bucket").isin(*buckets))           # folders of other buckets aren't read
        gone = [f"{self.root}/{n}" for n in self.files.complete("", "x") if int(n[1:]) < before]
        if gone:
            changed = self.spark.read.schema("cx long, cy long, batch long").parquet(*gone).groupBy("cx", "cy").agg(F.max("batch").alias("_changed"))
            rows = (rows.join(changed, ["cx", "cy"], "left").where(F.col("_changed").isNull() | (F.col("batch") > F.col("_changed")))
                    .drop("_changed"))
        return rows

    def _union(self, paths: list[str]) -> DataFrame:
        out = None
        for p in paths:
            part = self.spark.read.schema(self.SCHEMA).parquet(p)
            out = part if out is None else out.unionByName(part)
        return out

    def _write(self, rows: DataFrame, name: str) -> None:
        rows.select("lon", "lat", "tzid", "cx", "cy", "batch", "_bucket").repartition("_bucket").write.mode("overwrite").partitionBy(
            "_bucket").parquet(f"{self.root}/{name}")

    def add(self, resolved: DataFrame, batch: int) -> None:
        self._write(self.placed(resolved).withColumn("batch", F.lit(batch).cast("long")), f"b{batch:08d}")

    def forget(self, cells: DataFrame, batch: int) -> None:
        """Points of ``cells`` (cx, cy) resolved by batches up to ``batch`` have to be resolved again."""
        cells.select("cx", "cy").distinct().withColumn("batch", F.lit(batch).cast("long")).write.mode("overwrite").parquet(f"{self.root}/x{batch:08d}")

    def compact(self, before: int) -> None:
        """Merges the generations before a batch once there are many."""
        names = self._generations(before)
        if len(names) > COMPACT_AFTER:
            self._write(self.known(before), f"m{int(names[-1][1:]):08d}")
            for n in names:
                self.files.delete(n)

    def map_changed(self, old: Cover, new: Cover, batch: int) -> None:
        """Forgets the coarsest cells where the two covers differ."""
        self.forget(changed_cells(old, new), batch)


def _fingerprints(cover: Cover) -> DataFrame:
    """One row per coarsest cell with a hash of all that the cover says below it."""
    def coarse(df, *what):
        return df.select(F.floor(F.col("cx") / F.pow(F.lit(2), F.col("level"))).alias("cx0"), F.floor(F.col("cy") / F.pow(F.lit(2), F.col("level"))).alias("cy0"),
                         F.xxhash64("level", "cx", "cy", "tzid", *what).cast("decimal(20,0)").alias("h"))
    rows = coarse(cover.cells, "is_border", "centre_inside").unionByName(coarse(cover.cuts, "x1", "y1", "x2", "y2"))
    return rows.groupBy(F.col("cx0").alias("cx"), F.col("cy0").alias("cy")).agg(F.sum("h").alias("h"))


def changed_cells(old: Cover, new: Cover) -> DataFrame:
    """Coarsest cells (cx, cy) whose polygons or edges differ."""
    a, b = _fingerprints(old), _fingerprints(new).withColumnRenamed("h", "h2")
    return a.join(b, ["cx", "cy"], "full").where(~F.col("h").eqNullSafe(F.col("h2"))).select("cx", "cy")


def timezone_batch(stops: DataFrame, polygons: DataFrame | Cover, cfg: MigrateConfig | None = None, memo: PointMemo | None = None,
                   batch_id: int = 0) -> DataFrame:
    """One micro-batch of source stops -> (stop_id, lon, lat, timezone)."""
    pts = stops.select(F.col("stop_lon").alias("lon"), F.col("stop_lat").alias("lat"))
    tz = point_timezone(pts, polygons, cfg) if memo is None else remembered(pts, polygons, memo, batch_id, cfg)
    return (stops.join(tz, (stops.stop_lon == tz.lon) & (stops.stop_lat == tz.lat), "left")
            .select("stop_id", F.col("stop_lon").alias("lon"), F.col("stop_lat").alias("lat"),
                    F.col("tzid").alias("timezone")))


def remembered(points: DataFrame, polygons: DataFrame | Cover, memo: PointMemo, batch_id: int, cfg: MigrateConfig | None = None) -> DataFrame:
    """``point_timezone`` that resolves unseen points only and adds them to the memo."""
    asked = memo.placed(points.where(F.col("lon").isNotNull() & F.col("lat").isNotNull()).distinct()).persist()
    try:
        buckets = sorted(r["_bucket"] for r in asked.select("_bucket").distinct().collect())          # at most BUCKETS
        memo.compact(batch_id)
        known = memo.known(batch_id, buckets).select("lon", "lat", "tzid")
        unseen = asked.select("lon", "lat").join(known, ["lon", "lat"], "left_anti")
        if not unseen.isEmpty():
            memo.add(point_timezone(unseen, polygons, cfg), batch_id)
        return memo.known(batch_id + 1, buckets).select("lon", "lat", "tzid").join(asked.select("lon", "lat"), ["lon", "lat"], "left_semi")
    finally:
        asked.unpersist()


def latest_timezones(written: DataFrame) -> DataFrame:
    """The newest row of every stop: a moved stop leaves its earlier rows behind."""
    newest = written.groupBy("stop_id").agg(F.max_by(F.struct("lon", "lat", "timezone"), "batch_id").alias("s"))
    return newest.select("stop_id", "s.*")


def stream_timezones(stops_stream: DataFrame, edges: DataFrame, out_path: str, checkpoint: str,
                     cfg: MigrateConfig | None = None, available_now: bool = False, memo_path: str | None = None) -> StreamingQuery:
    """Write the time zone of every inserted or moved stop under ``out_path``.
    The polygons are a static cover joined in every micro-batch; with
    ``memo_path`` points resolved before are looked up there.  Every batch has
    its own partition ``batch_id=N``, which a retried batch overwrites, so each
    lands exactly once."""
    cfg = cfg or MigrateConfig()
    cover = build_cover(edges, cfg)
    memo = PointMemo(stops_stream.sparkSession, memo_path, cover.size) if memo_path else None

    def write(batch: DataFrame, batch_id: int) -> None:
        timezone_batch(batch, cover, cfg, memo, batch_id).write.mode("overwrite").parquet(f"{out_path}/batch_id={batch_id}")

    writer = stops_stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
