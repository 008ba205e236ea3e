"""Distributed algorithms against brute force on small fixtures."""

import datetime as dt
import random
from collections import Counter

from pyspark.sql import Window
from pyspark.sql import functions as F

from headway.config import MigrateConfig
from headway.operators import fares, spatial
from headway.operators.ids import dense_id, next_id, rank_within


def test_dense_id_is_row_number_whatever_the_partitioning(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice([None, "a", "b", "c"]), rnd.randint(0, 50), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, v int, u int")
    want = {r.u: r.rn for r in df.select("u", F.row_number().over(
        Window.orderBy(F.col("k").asc_nulls_last(), "v", "u")).alias("rn")).collect()}
    for n in (1, 3, 7):
        got = {r.u: r.id for r in dense_id(df, ["k", "v", "u"], "id", num_partitions=n).collect()}
        assert got == want


def test_dense_id_offset_and_next_id(spark):
    df = spark.createDataFrame([(5,), (9,), (7,)], "x int")
    assert sorted(r.id for r in dense_id(df, ["x"], "id", offset=100).collect()) == [101, 102, 103]
    assert next_id(df, "x") == 10
    assert next_id(df.where("x > 100"), "x") == 1


def test_rank_within_matches_window(spark):
    rnd = random.Random(2)
    rows = [(rnd.randint(0, 4), rnd.choice(["x", "y", None]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "g int, name string, id int")
    w = Window.partitionBy("g").orderBy(F.col("name").asc_nulls_last(), "id")
    want = {r.id: r.rn for r in df.select("id", F.row_number().over(w).alias("rn")).collect()}
    got = {r.id: r.rk for r in rank_within(df, ["g"], ["name", "id"], "rk").collect()}
    assert got == want


def _inside(px, py, ring):
    c = 0
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if (y1 > py) != (y2 > py) and px < x1 + (py - y1) * (x2 - x1) / (y2 - y1):
            c += 1
    return c % 2 == 1


def test_point_in_polygon_matches_ray_casting(spark):
    rnd = random.Random(3)
    polys = []
    for k in range(6):
        cx, cy = rnd.uniform(-50, 50), rnd.uniform(-30, 30)
        ring = [(cx + rnd.uniform(-20, 20), cy + rnd.uniform(-15, 15)) for _ in range(5)]
        ring.append(ring[0])
        polys.append((f"tz{k}", ring))
    pts = [(rnd.uniform(-70, 70), rnd.uniform(-45, 45)) for _ in range(400)]
    rings = spark.createDataFrame([(t, [{"lon": x, "lat": y} for x, y in r]) for t, r in polys],
                                  "tzid string, ring array<struct<lon:double,lat:double>>")
    got = {(r.lon, r.lat): r.tzid for r in spatial.point_timezone(
        spark.createDataFrame(pts, "lon double, lat double"), spatial.ring_edges(rings),
        MigrateConfig(tz_cell_degrees=3.0, tz_band_salt=3)).collect()}
    for x, y in pts:
        inside = sorted(t for t, r in polys if _inside(x, y, r))
        assert got[(x, y)] == (inside[0] if inside else None)


RULE_SCHEMA = ("fare_rule_id bigint, fare_id bigint, route_id bigint, origin_id bigint, destination_id bigint, "
               "contains_id bigint, agency_id int, is_combinable boolean, last_modified timestamp")


def _nma(v):
    return -411 if v is None else v


def _random_rules(seed, n=120):
    rnd = random.Random(seed)
    zones = [None, -411, 1, 2, 3]
    ts = [None, dt.datetime(2024, 1, 1), dt.datetime(2024, 6, 1), dt.datetime(2025, 1, 1)]
    return [(i, rnd.choice([1, 2]), rnd.choice([None, 7]), rnd.choice(zones), rnd.choice(zones),
             rnd.choice([None, 5]), rnd.choice([1, 2]), rnd.choice([True, False]), rnd.choice(ts))
            for i in range(1, n + 1)]


def test_symmetric_fares_match_pairwise_definition(spark):
    rules = _random_rules(4)
    want = set()
    for r1 in rules:
        for r2 in rules:
            _, f1, rt1, o1, d1, c1, a1, comb1, lm1 = r1
            _, f2, rt2, o2, d2, c2, a2, _, lm2 = r2
            if (f1 == f2 and a1 == a2 and _nma(o1) == _nma(d2) and _nma(d1) == _nma(o2)
                    and _nma(rt1) == _nma(rt2) and _nma(c1) == _nma(c2)
                    and _nma(o1) < _nma(d1) and _nma(o2) > _nma(d2)):
                lms = [x for x in (lm1, lm2) if x is not None]
                want.add((a1, f1, o1, d1, rt1, c1, comb1, max(lms) if lms else None))
    df = spark.createDataFrame(rules, RULE_SCHEMA)
    got = {tuple(r) for r in fares.symmetric(df).select(*fares.SYM_COLUMNS, "last_modified").collect()}
    assert got == want


def _simulate(rules, edits):
    """The row trigger, one edit at a time."""
    table = [dict(zip(["fare_rule_id", "fare_id", "route_id", "origin_id", "destination_id", "contains_id",
                       "agency_id", "is_combinable"], r[:8])) for r in rules]
    nid = max(r["fare_rule_id"] for r in table) + 1

    def delete(f, a, rt, za, zb, c):
        nonlocal table
        def hit(r):
            pair = {(_nma(r["origin_id"]), _nma(r["destination_id"]))}
            return (r["fare_id"] == f and r["agency_id"] == a and f is not None and a is not None
                    and _nma(r["route_id"]) == _nma(rt) and _nma(r["contains_id"]) == _nma(c)
                    and pair & {(_nma(za), _nma(zb)), (_nma(zb), _nma(za))})
        table = [r for r in table if not hit(r)]

    for e in sorted(edits, key=lambda e: e["seq"]):
        if e["op"] in ("UPDATE", "DELETE"):
            delete(e["old_fare_id"], e["old_agency_id"], e["old_route_id"], e["old_zone_id_a"],
                   e["old_zone_id_b"], e["old_contains_id"])
        if e["op"] in ("INSERT", "UPDATE"):
            delete(e["new_fare_id"], e["new_agency_id"], e["new_route_id"], e["new_zone_id_a"],
                   e["new_zone_id_b"], e["new_contains_id"])
            for o, d in ((e["new_zone_id_a"], e["new_zone_id_b"]), (e["new_zone_id_b"], e["new_zone_id_a"])):
                table.append({"fare_rule_id": nid, "fare_id": e["new_fare_id"], "route_id": e["new_route_id"],
                              "origin_id": o, "destination_id": d, "contains_id": e["new_contains_id"],
                              "agency_id": e["new_agency_id"], "is_combinable": e["new_is_combinable"]})
                nid += 1
    return table


def test_fare_edits_match_sequential_trigger(spark):
    rules = _random_rules(5, 60)
    rnd = random.Random(6)
    zones = [None, 1, 2, 3]
    edits = []
    for seq in rnd.sample(range(1000), 40):
        op = rnd.choice(["INSERT", "UPDATE", "DELETE"])
        f, a, rt, c = rnd.choice([1, 2]), rnd.choice([1, 2]), rnd.choice([None, 7]), rnd.choice([None, 5])
        za, zb = rnd.sample(zones, 2)
        edits.append({"seq": seq, "op": op, "old_fare_id": f, "old_agency_id": a, "old_route_id": rt,
                      "old_zone_id_a": rnd.choice(zones), "old_zone_id_b": rnd.choice(zones), "old_contains_id": c,
                      "new_fare_id": f, "new_agency_id": a, "new_route_id": rt, "new_zone_id_a": za,
                      "new_zone_id_b": zb, "new_contains_id": c, "new_is_combinable": rnd.choice([True, False])})
    cols = fares.EDIT_COLUMNS
    edf = spark.createDataFrame([tuple(e[c] for c in cols) for e in edits],
                                "seq bigint, op string, " + ", ".join(
                                    f"{c} {'boolean' if c == 'new_is_combinable' else 'int' if 'agency' in c else 'bigint'}"
                                    for c in cols[2:]))
    got = fares.apply_edits(spark.createDataFrame(rules, RULE_SCHEMA), edf).collect()
    want = _simulate(rules, edits)
    key = ["fare_id", "route_id", "origin_id", "destination_id", "contains_id", "agency_id", "is_combinable"]
    assert Counter(tuple(r[k] for k in key) for r in got) == Counter(tuple(r[k] for k in key) for r in want)
    originals = {r[0] for r in rules}
    kept = [r.fare_rule_id for r in got if r.fare_rule_id in originals]
    assert sorted(kept) == sorted(r["fare_rule_id"] for r in want if r["fare_rule_id"] in originals)
    new_ids = [r.fare_rule_id for r in got if r.fare_rule_id not in originals]
    assert len(new_ids) == len(set(new_ids)) and all(i > max(originals) for i in new_ids)


def test_dense_id_spreads_identical_rows(spark):
    # a third of the rows identical on every order column: still many partitions
    rows = [(1, "same")] * 300 + [(i, "x") for i in range(600)]
    df = spark.createDataFrame(rows, "k int, s string")
    out = dense_id(df, ["k", "s"], "id", num_partitions=6)
    ids = [r.id for r in out.collect()]
    assert sorted(ids) == list(range(1, 901))
    parts = out.where("s = 'same'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 1
