"""Deletes along the key graph."""

import random

from headway.operators.cascade import Cascade, ForeignKey, parents_first, prune_orphans, schema_keys


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


KEYS = [ForeignKey("city", "state_id", "state", "state_id"), ForeignKey("street", "city_id", "city", "city_id"),
        ForeignKey("house", "street_id", "street", "street_id"), ForeignKey("office", "city_id", "city", "city_id", cascade=False)]


def tables(spark):
    return {
        "house": spark.createDataFrame([(1, 100), (2, 101), (3, None), (4, 999), (5, 102)], "house_id long, street_id long"),
        "street": spark.createDataFrame([(100, 10), (101, 11), (102, 12)], "street_id long, city_id long"),
        "city": spark.createDataFrame([(10, 1), (11, 2), (12, 2)], "city_id long, state_id long"),
        "state": spark.createDataFrame([(1,), (2,)], "state_id long"),
        "office": spark.createDataFrame([(7, 10), (8, 11), (9, None), (6, 55)], "office_id long, city_id long"),
    }


def test_three_levels_and_restrict(spark):
    gone = {"state": spark.createDataFrame([(1,), (1,), (77,)], "state_id long")}
    left, report = prune_orphans(tables(spark), KEYS, gone)
    assert rows(left["state"]) == [(2,)] and rows(left["city"]) == [(11, 2), (12, 2)]
    assert rows(left["street"]) == [(101, 11), (102, 12)]
    assert rows(left["house"]) == [(2, 101), (3, None), (5, 102)]
    assert rows(left["office"]) == rows(tables(spark)["office"])                  # RESTRICT keeps the rows
    up = "city.state_id -> state.state_id: deleted"
    assert rows(report) == sorted([
        ("state", "deleted", "deleted", 1), ("state", "kept", "", 1),
        ("city", "cascade", up, 1), ("city", "kept", "", 2),
        ("street", "cascade", f"street.city_id -> city.city_id: {up}", 1), ("street", "kept", "", 2),
        ("house", "cascade", f"house.street_id -> street.street_id: street.city_id -> city.city_id: {up}", 1),
        ("house", "cascade", "house.street_id -> street.street_id: absent", 1), ("house", "kept", "", 3),
        ("office", "kept", "", 4), ("office", "restrict", f"office.city_id -> city.city_id: {up}", 1),
        ("office", "restrict", "office.city_id -> city.city_id: absent", 1)], key=str)
    done = Cascade(tables(spark), KEYS, gone)
    assert rows(done.violations(KEYS[3])) == [(6, 55, "office.city_id -> city.city_id: absent"), (7, 10, f"office.city_id -> city.city_id: {up}")]


def test_nothing_deleted_keeps_all_but_orphans(spark):
    left, _ = prune_orphans(tables(spark), KEYS)
    assert rows(left["house"]) == [(1, 100), (2, 101), (3, None), (5, 102)]
    assert rows(left["city"]) == rows(tables(spark)["city"])
    empty = {t: df.where("false") for t, df in tables(spark).items()}
    left, report = prune_orphans(empty, KEYS)
    assert all(df.count() == 0 for df in left.values()) and report.count() == 0


def test_a_parent_key_held_twice_lives_while_one_row_does(spark):
    keys = [ForeignKey("kid", "p", "par", "p")]
    par = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "p long, tag string")
    kid = spark.createDataFrame([(1,), (2,)], "p long")
    left, _ = prune_orphans({"kid": kid, "par": par}, keys, {"par": par.where("tag = 'a'").select("tag")})
    assert rows(left["kid"]) == [(1,)]


def test_circles_reach_a_fixed_point(spark):
    """Staff report to staff; teams and leaders point to each other."""
    chain = [ForeignKey("staff", "boss", "staff", "id"), ForeignKey("team", "lead", "staff", "id"), ForeignKey("staff", "team", "team", "team_id")]
    r = random.Random(1)
    staff = [(i, i - 1 if i % 10 else None, r.randint(0, 9) if r.random() < 0.3 else None) for i in range(60)]
    team = [(i, r.randint(0, 59)) for i in range(10)]
    got, _ = prune_orphans({"staff": spark.createDataFrame(staff, "id long, boss long, team long"), "team": spark.createDataFrame(team, "team_id long, lead long")},
                           chain, {"staff": spark.createDataFrame([(12,), (40,)], "id long")})
    dead, dead_teams, before = {12, 40}, set(), None
    while before != (len(dead), len(dead_teams)):
        before = (len(dead), len(dead_teams))
        dead |= {i for i, boss, t in staff if boss in dead or t in dead_teams}
        dead_teams |= {t for t, lead in team if lead in dead}
    assert rows(got["staff"]) == sorted([x for x in staff if x[0] not in dead], key=str)
    assert rows(got["team"]) == sorted([x for x in team if x[0] not in dead_teams], key=str)


def test_order_of_the_schema():
    keys = schema_keys()
    assert len(keys) == 19 and sum(k.cascade for k in keys) == 9
    order = [t for group in parents_first({t for k in keys for t in (k.child, k.parent)}, keys) for t in group]
    assert all(order.index(k.parent) < order.index(k.child) for k in keys)
