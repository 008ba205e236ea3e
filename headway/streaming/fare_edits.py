"""L2: edits made through the symmetric fare view, applied as they arrive.

Rules are stored in buckets by their pair key (fare, agency, route, contains
and the unordered zones, NULL meaning all), so both directions of a rule and
every edit of them share a bucket.  A micro-batch reads only the buckets that
its edits touch, applies them with ``fares.apply_edits`` (ordered by ``seq``)
and writes those buckets as a new generation.  A version is a manifest that
names the generation of every bucket; untouched buckets keep their files from
version to version.  The manifest's ``_SUCCESS`` publishes the version, no path
is ever read and overwritten in one job, and a retried batch rewrites the same
generation from the same earlier version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from headway.operators.fares import EDIT_COLUMNS, apply_edits, pair_bucket
from headway.operators.ids import next_id
from headway.session import scratch_tables
from headway.sources.files import Files

BUCKETS = 64
_MANIFEST = "bucket int, generation string, next_id long"


class RuleStore:
    """Versions ``manifest/v00000003`` over generations ``data/g00000003/_bucket=17``."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.files = Files(spark, root)

    def versions(self) -> list[str]:
        return self.files.complete("manifest", "v")

    def manifest(self, version: str) -> dict[int, tuple[str | None, int]]:
        """Generation (None: no rows) and next free rule id by bucket."""
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifest/{version}").collect()      # a row per bucket
        return {r["bucket"]: (r["generation"], r["next_id"]) for r in rows}

    def _read(self, manifest: dict[int, tuple[str | None, int]], buckets: list[int], schema) -> DataFrame:
        paths = [f"{self.root}/data/{manifest[b][0]}/_bucket={b}" for b in buckets if manifest[b][0]]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _schema(self):
        generation = self.files.complete("data", "g")[0]
        schema = self.spark.read.parquet(f"{self.root}/data/{generation}").schema
        return type(schema)([f for f in schema if f.name != "_bucket"])

    def read(self, version: str | None = None) -> DataFrame:
        """The rules of a version, by default the newest."""
        return self._read(self.manifest(version or self.versions()[-1]), list(range(self.buckets)), self._schema())

    def _write(self, rules: DataFrame, number: int, before: dict[int, tuple[str | None, int]], touched: list[int]) -> None:
        generation = f"g{number:08d}"
        bucketed = rules.withColumn("_bucket", pair_bucket(self.buckets))
        bucketed.repartition(max(1, len(touched)), "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.root}/data/{generation}")
        filled = {int(n.split("=")[1]) for n in self.files.names(f"data/{generation}", "_bucket=")}
        free = max((n for _, n in before.values()), default=1)
        if filled:
            free = max(free, next_id(self.spark.read.parquet(f"{self.root}/data/{generation}"), "fare_rule_id"))
        rows = [(b, (generation if b in filled else None) if b in touched else before[b][0], free) for b in range(self.buckets)]
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/v{number:08d}")

    def create(self, rules: DataFrame) -> None:
        """Version 0: every bucket of the initial rules."""
        if not self.versions():
            self._write(rules, 0, {}, list(range(self.buckets)))

    def touched(self, edits: DataFrame) -> list[int]:
        """Buckets of the rules that the edits remove or add, at most all of them."""
        sides = [edits.where(F.col("op").isin(*ops)).select(pair_bucket(self.buckets, side).alias("b"))
                 for side, ops in (("old", ("DELETE", "UPDATE")), ("new", ("INSERT", "UPDATE")))]
        return sorted(r["b"] for r in sides[0].union(sides[1]).distinct().collect())

    def apply(self, edits: DataFrame, number: int, run_ts=None) -> list[int]:
        """Version ``number``: the newest earlier version with ``edits`` applied; the buckets written."""
        before = self.manifest([v for v in self.versions() if int(v[1:]) < number][-1])
        touched = self.touched(edits)
        rules = self._read(before, touched, self._schema())
        with scratch_tables(self.spark):
            first = max(n for _, n in before.values())
            self._write(apply_edits(rules, edits.select(*EDIT_COLUMNS), first, run_ts), number, before, touched)
        return touched

    def retire(self, keep: int) -> None:
        """Deletes all but the newest ``keep`` versions and the buckets that none of those names."""
        done = self.versions()
        for v in done[:-keep]:
            self.files.delete(f"manifest/{v}")
        named = {(g, b) for v in done[-keep:] for b, (g, _) in self.manifest(v).items() if g}
        for g in self.files.complete("data", "g"):
            held = self.files.names(f"data/{g}", "_bucket=")
            left = [n for n in held if (g, int(n.split("=")[1])) in named]
            for n in set(held) - set(left):
                self.files.delete(f"data/{g}/{n}")
            if not left and g[1:] < done[-1][1:]:
                self.files.delete(f"data/{g}")


def stream_fare_edits(spark: SparkSession, edit_stream: DataFrame, initial_rules: str, out_root: str,
                      checkpoint: str, available_now: bool = False, keep_versions: int = 5, buckets: int = BUCKETS) -> StreamingQuery:
    """Starts the job; ``RuleStore(spark, out_root).read()`` gives the rules.  The newest ``keep_versions`` versions
    (at least the two a retried batch needs) stay."""
    store = RuleStore(spark, out_root, buckets)
    store.create(spark.read.parquet(initial_rules))

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()                        # the edits are read by several branches
        store.apply(batch, batch_id + 1)
        batch.unpersist()
        store.retire(max(2, keep_versions))

    writer = edit_stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
