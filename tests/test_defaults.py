"""Nothing is dropped unless a run says so; NULLs last; retried batches; scratch tables."""

import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from headway.config import MigrateConfig
from headway.operators import audits, naming, patterns as pat, reference_tables as ref, trips as trp
from headway.session import ensure_checkpoint_dir, note_scratch, scratch_tables
from headway.streaming import fare_edits, timezones


def test_default_scope_keeps_every_agency_and_trip(spark, catalog):
    agency = spark.createDataFrame([(7, "A"), (21, "B")], "agency_id int, agency_name string")
    assoc = spark.createDataFrame([(7, 1), (21, 1)], "agency_id int, agency_group_id int")
    src = catalog(agency=agency, agency_group_assoc=assoc)
    assert {r.agency_id for r in ref.agencies(src, MigrateConfig()).collect()} == {7, 21}
    st = spark.createDataFrame([(0, 7, 1, 5, 100, 110, 0)],
                               "trip_id long, agency_id int, stop_sequence int, stop_id long, arrival_time long, departure_time long, pickup_type int")
    tr = spark.createDataFrame([(0, 7, 3, 0, None, None)],
                               "trip_id long, agency_id int, route_id long, direction_id int, headsign_id int, based_on long")
    dst = spark.createDataFrame([(7,)], "agency_id int")
    per_trip = pat.trip_stop_rows(catalog(stop_times=st, trips=tr, agency=dst), dst, MigrateConfig())
    assert [r.trip_id for r in trp.first_arrivals(per_trip, MigrateConfig()).collect()] == [0]


def test_key_audit_refuses_a_missing_column(spark):
    frame = spark.createDataFrame([(1,)], "other long")
    migration = SimpleNamespace(targets=lambda names: {n: frame for n in names})
    with pytest.raises(ValueError, match="no column"):
        audits.key_audit(migration)


def test_null_stop_sequence_stands_last(spark, catalog):
    rows = [(1, 1, None, 30, 300, 300, 0), (1, 1, 1, 10, 100, 100, 0), (1, 1, 2, 20, 200, 200, 0)]
    st = spark.createDataFrame(rows, "trip_id long, agency_id int, stop_sequence int, stop_id long, arrival_time long, departure_time long, pickup_type int")
    tr = spark.createDataFrame([(1, 1, 3, 0, None, None)],
                               "trip_id long, agency_id int, route_id long, direction_id int, headsign_id int, based_on long")
    dst = spark.createDataFrame([(1,)], "agency_id int")
    row = pat.trip_stop_rows(catalog(stop_times=st, trips=tr, agency=dst), dst, MigrateConfig()).first()
    assert row.stops_pattern == "10, 20, 30"


def test_direction_without_a_name_is_the_last_choice(spark):
    tpsn = spark.createDataFrame([(1, 0, None), (1, 0, "Outbound")], "agency_id int, direction_id int, direction_name string")
    assert naming.directions(tpsn, spark.createDataFrame([(1,)], "agency_id int")).first().name == "Outbound"


def test_pattern_shared_by_two_agencies_has_one_name(spark):
    patterns = spark.createDataFrame([(1, 5, 7, 0), (2, 5, 7, 0), (1, 6, 7, 0)], "agency_id int, pattern_id long, route_id long, direction_id int")
    primary = spark.createDataFrame([(7, 0, 6)], "route_id long, direction_id int, primary_pattern_id long")
    stops = spark.createDataFrame([(1, 5, 1, 10), (2, 5, 1, 10), (1, 5, 2, 11), (2, 5, 2, 11), (1, 6, 1, 10)],
                                  "agency_id int, pattern_id long, stop_order int, stop_id long")
    names = spark.createDataFrame([(10, "A"), (11, "B")], "stop_id long, name string")
    diff = naming.pattern_stop_difference(patterns, primary, stops)
    got = [r.name for r in naming.pattern_names(patterns, diff, names).where("pattern_id = 5").collect()]
    assert got == ["+ B - 0 stops"] * 2


def test_scratch_tables_are_deleted(spark):
    root = ensure_checkpoint_dir(spark).replace("file:", "")
    path = f"{root}/some-scratch"
    with scratch_tables(spark):
        spark.range(3).write.parquet(path)
        note_scratch(path)
        assert os.path.isdir(path)
    assert not os.path.exists(path)


def test_cluster_needs_a_shared_checkpoint_folder():
    session = SimpleNamespace(sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://x"),
                              conf=SimpleNamespace(get=lambda key, default: default))
    with pytest.raises(ValueError, match="share"):
        ensure_checkpoint_dir(session)


def test_retried_time_zone_batch_lands_once(spark, tmp_path):
    edges = spark.createDataFrame([("z", 0.0, 0.0, 10.0, 0.0), ("z", 10.0, 0.0, 10.0, 10.0), ("z", 10.0, 10.0, 0.0, 10.0), ("z", 0.0, 10.0, 0.0, 0.0)],
                                  "tzid string, x1 double, y1 double, x2 double, y2 double")
    stops = spark.createDataFrame([(1, 5.0, 5.0), (2, 50.0, 50.0)], "stop_id long, stop_lon double, stop_lat double")
    out = str(tmp_path / "tz")
    for batch, frame in ((0, stops), (0, stops), (1, stops.where("stop_id = 1").withColumn("stop_lon", F.lit(60.0)))):
        timezones.timezone_batch(frame, edges).write.mode("overwrite").parquet(f"{out}/batch_id={batch}")
    written = spark.read.parquet(out)
    assert written.count() == 3
    assert {tuple(r) for r in timezones.latest_timezones(written).collect()} == {(1, 60.0, 5.0, None), (2, 50.0, 50.0, None)}


def test_fare_rule_versions_on_a_path_without_scheme(spark, tmp_path):
    root = str(tmp_path / "rules")
    rules = spark.createDataFrame([(i, i % 3, 1, 2, 3, None, 5, True, None) for i in range(6)],
                                  "fare_rule_id long, fare_id long, route_id long, origin_id long, destination_id long, contains_id long, "
                                  "agency_id int, is_combinable boolean, last_modified timestamp")
    store = fare_edits.RuleStore(spark, root, buckets=4)
    store.create(rules)
    store.create(rules.limit(1))                                    # there already
    assert store.versions() == ["v00000000"] and store.read().count() == 6
    none = spark.createDataFrame([], "seq long, op string, old_fare_id long, old_agency_id int, old_route_id long, old_zone_id_a long, "
                                 "old_zone_id_b long, old_contains_id long, new_fare_id long, new_agency_id int, new_route_id long, "
                                 "new_zone_id_a long, new_zone_id_b long, new_contains_id long, new_is_combinable boolean")
    for batch in (1, 2, 3):
        assert store.apply(none, batch) == []                       # a batch without edits writes no bucket
    store.retire(2)
    assert store.versions() == ["v00000002", "v00000003"] and store.read().count() == 6
    assert sorted(os.listdir(f"{root}/manifest")) == ["v00000002", "v00000003"]
