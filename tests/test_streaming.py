"""Streaming jobs give the batch result (availableNow over files)."""

import os
from collections import Counter

from pyspark.sql import functions as F

from headway.operators import fares, spatial
from headway.plans.registry import migration
from headway.operators.cover import build_cover
from headway.streaming import timezones
from headway.streaming.fare_edits import RuleStore, stream_fare_edits
from headway.streaming.timezones import PointMemo, changed_cells, stream_timezones, timezone_batch

SF = "/root/testdata/sf0.001"


def test_stream_timezones_equals_batch(spark, tmp_path):
    m = migration(spark, SF)
    stops = m.src["stops"]
    inbox = str(tmp_path / "inbox")
    # two arrival files
    stops.where("stop_id % 2 = 0").write.parquet(inbox + "/a")
    stops.where("stop_id % 2 = 1").write.parquet(inbox + "/b")
    stream = spark.readStream.schema(stops.schema).option("recursiveFileLookup", "true").parquet(inbox)
    out = str(tmp_path / "out")
    q = stream_timezones(stream, spatial.polygon_edges(m.src["tz_polygons"]), out, str(tmp_path / "ckpt"),
                         m.cfg, available_now=True)
    q.awaitTermination(300)
    got = {(r.stop_id, r.timezone) for r in spark.read.parquet(out).collect()}
    pts = stops.select(F.col("stop_lon").alias("lon"), F.col("stop_lat").alias("lat"))
    tz = spatial.point_timezone(pts, spatial.polygon_edges(m.src["tz_polygons"]), m.cfg)
    want = {(r.stop_id, r.tzid) for r in stops.join(
        tz, (stops.stop_lon == tz.lon) & (stops.stop_lat == tz.lat), "left").collect()}
    assert got == want


def test_stream_fare_edits_equals_batch(spark, tmp_path):
    m = migration(spark, SF)
    rules = m.fare_rules
    initial = str(tmp_path / "rules0")
    rules.write.parquet(initial)
    edits = fares.derive_edits(rules)
    inbox = str(tmp_path / "edits")
    edits.write.parquet(inbox)
    stream = spark.readStream.schema(edits.schema).parquet(inbox)
    out = str(tmp_path / "versions")
    q = stream_fare_edits(spark, stream, initial, out, str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination(300)
    cols = ["fare_id", "route_id", "origin_id", "destination_id", "contains_id", "agency_id", "is_combinable"]
    got = Counter(tuple(r) for r in RuleStore(spark, out).read().select(*cols).collect())
    want = Counter(tuple(r) for r in fares.apply_edits(rules, edits).select(*cols).collect())
    assert got == want


def test_stream_fare_edits_over_two_batches(spark, tmp_path):
    """Edits arriving in two micro-batches (later seqs second) give the
    same rules as applying them all at once; each batch writes a version."""
    m = migration(spark, SF)
    rules = m.fare_rules
    initial = str(tmp_path / "rules0")
    rules.write.parquet(initial)
    edits = fares.derive_edits(rules)
    cut = edits.approxQuantile("seq", [0.5], 0.0)[0]
    inbox = str(tmp_path / "edits")
    edits.where(F.col("seq") <= cut).coalesce(1).write.parquet(inbox + "/part1")
    edits.where(F.col("seq") > cut).coalesce(1).write.parquet(inbox + "/part2")
    stream = (spark.readStream.schema(edits.schema).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(inbox))
    out = str(tmp_path / "versions")
    q = stream_fare_edits(spark, stream, initial, out, str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination(300)
    assert len(RuleStore(spark, out).versions()) >= 3
    cols = ["fare_id", "route_id", "origin_id", "destination_id", "contains_id", "agency_id", "is_combinable"]
    got = Counter(tuple(r) for r in RuleStore(spark, out).read().select(*cols).collect())
    want = Counter(tuple(r) for r in fares.apply_edits(rules, edits).select(*cols).collect())
    assert got == want


def files_of(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    rules = migration(spark, SF).fare_rules
    store = RuleStore(spark, str(tmp_path), buckets=16)
    store.create(rules)
    before, first = files_of(tmp_path / "data"), store.manifest("v00000000")
    edits = fares.derive_edits(rules).orderBy("seq").limit(2)
    touched = store.apply(edits, 1)
    assert 0 < len(touched) <= 4
    after, second = files_of(tmp_path / "data"), store.manifest("v00000001")
    assert before.items() <= after.items()                          # nothing was rewritten
    assert all(second[b][0] == first[b][0] for b in range(16) if b not in touched)
    assert all(second[b][0] in ("g00000001", None) for b in touched)
    cols = ["fare_id", "route_id", "origin_id", "destination_id", "contains_id", "agency_id", "is_combinable"]
    want = Counter(tuple(r) for r in fares.apply_edits(rules, edits).select(*cols).collect())
    assert Counter(tuple(r) for r in store.read().select(*cols).collect()) == want
    assert store.read("v00000000").count() == rules.count()          # the earlier version is still whole
    assert store.apply(edits, 1) == touched                          # a retried batch writes the same version
    assert Counter(tuple(r) for r in store.read().select(*cols).collect()) == want
    store.retire(1)
    assert store.versions() == ["v00000001"]
    assert Counter(tuple(r) for r in store.read().select(*cols).collect()) == want
    ids = [r.fare_rule_id for r in store.read().collect()]
    assert len(ids) == len(set(ids))


def boxes(spark, rows):
    return spatial.box_edges(spark.createDataFrame([(t, *map(float, box)) for t, *box in rows], "tzid string, min_lon double, max_lon double, min_lat double, max_lat double"))


def stop_rows(spark, points):
    return spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "stop_id long, stop_lon double, stop_lat double")


def test_memo_resolves_a_point_once(spark, tmp_path, monkeypatch):
    cover = build_cover(boxes(spark, [("a", 0, 10, 0, 20), ("b", 10, 20, 0, 20)]))
    memo = PointMemo(spark, str(tmp_path), cover.size)
    resolved = []

    def counted(points, polygons, cfg=None):
        resolved.append(points.count())
        return spatial.point_timezone(points, polygons, cfg)

    monkeypatch.setattr(timezones, "point_timezone", counted)
    first = [(1, 7), (1, 7), (12, 7), (-5, -5)]
    def zones(points, batch, using=cover):
        return {r.stop_id: r.timezone for r in timezone_batch(stop_rows(spark, points), using, None, memo, batch).collect()}
    assert zones(first, 0) == {0: "a", 1: "a", 2: "b", 3: None} and resolved == [3]
    assert zones(first[::-1], 1) == {0: None, 1: "b", 2: "a", 3: "a"} and resolved == [3]      # no edge is read
    assert zones([(1, 7), (13, 7)], 2) == {0: "a", 1: "b"} and resolved == [3, 1]
    assert zones([(1, 7), (13, 7)], 2) == {0: "a", 1: "b"} and resolved == [3, 1, 1]           # a retried batch
    # the border moves from 10 to 12.5: points west of 10 are still known
    moved = build_cover(boxes(spark, [("a", 0, 12.5, 0, 20), ("b", 12.5, 20, 0, 20)]))
    assert {r.cx for r in changed_cells(cover, moved).where("cy = 1").collect()} == {2} and changed_cells(cover, cover).count() == 0
    memo.map_changed(cover, moved, 2)
    assert zones([(1, 7), (12, 7), (13, 7)], 3, moved) == {0: "a", 1: "a", 2: "b"} and resolved == [3, 1, 1, 2]
    assert zones([(12, 7), (13, 7)], 4, moved) == {0: "a", 1: "b"} and len(resolved) == 4
    monkeypatch.setattr(timezones, "COMPACT_AFTER", 1)
    assert zones([(1, 7), (12, 7), (13, 7)], 5, moved) == {0: "a", 1: "a", 2: "b"} and len(resolved) == 4
    assert len([d for d in os.listdir(tmp_path) if d.startswith("b")]) == 0


def test_stream_with_memo_equals_batch(spark, tmp_path):
    m = migration(spark, SF)
    stops = m.src["stops"]
    inbox = str(tmp_path / "inbox")
    stops.where("stop_id % 2 = 0").coalesce(1).write.parquet(inbox + "/a")
    stops.coalesce(1).write.parquet(inbox + "/b")
    stream = (spark.readStream.schema(stops.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(inbox))
    out = str(tmp_path / "out")
    q = stream_timezones(stream, spatial.polygon_edges(m.src["tz_polygons"]), out, str(tmp_path / "ckpt"), m.cfg, True, str(tmp_path / "memo"))
    q.awaitTermination(300)
    got = {(r.stop_id, r.timezone) for r in spark.read.parquet(out).collect()}
    assert got == {(r.stop_id, r.timezone) for r in timezone_batch(stops, spatial.polygon_edges(m.src["tz_polygons"]), m.cfg).collect()}
