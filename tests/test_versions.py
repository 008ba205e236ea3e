"""A2, A3: a reload is published whole or not at all."""

import pytest

from headway.plans.pipeline import run_all
from headway.plans.registry import FIXTURE_CONFIG, migration
from headway.sources.catalog import SourceCatalog
from headway.sources.versions import CheckFailed, Versions, broken_rules

SF = "/root/testdata/sf0.001"


def table(spark, value, n=3):
    return spark.createDataFrame([(value,)] * n, "x long")


def tables(spark, value, n=12):
    return {f"t{i:02d}": table(spark, value) for i in range(n)}


def seen(store):
    """What a reader finds in every table."""
    version = store.current()
    return {r.x for i in range(12) for r in store.read(f"t{i:02d}", version).collect()}


def test_failure_after_table_ten_leaves_the_earlier_version(spark, tmp_path):
    store = Versions(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        store.read("t00")
    first = store.reload(tables(spark, 1))
    assert store.current() == first and seen(store) == {1}

    def fails():
        raise RuntimeError("injected")

    broken = tables(spark, 2)
    broken["t10"] = fails
    with pytest.raises(RuntimeError, match="injected"):
        store.reload(broken)
    assert (tmp_path / "versions" / "v00000002" / "t09").exists()      # ten tables were staged
    assert store.current() == first and seen(store) == {1}
    third = store.reload(tables(spark, 3))
    assert third == "v00000003" and seen(store) == {3}
    assert not (tmp_path / "versions" / "v00000002").exists()          # the dead reload is gone
    assert store.published() == [first, third]


def test_checks_hold_back_a_version(spark, tmp_path):
    store = Versions(spark, str(tmp_path))
    store.reload({"t": table(spark, 1)})
    with pytest.raises(CheckFailed, match="x=2"):
        store.reload({"t": table(spark, 2)}, checks=lambda staged: staged["t"].where("x = 2"))
    assert [r.x for r in store.read("t").collect()] == [1, 1, 1]


def test_old_versions_retire_and_pinned_readers_stay(spark, tmp_path):
    store = Versions(spark, str(tmp_path))
    names = [store.reload({"t": table(spark, i)}, keep=2) for i in range(4)]
    assert store.published() == names[-2:]
    assert {r.x for r in store.read("t", names[2]).collect()} == {2}
    assert sorted(p.name for p in (tmp_path / "versions").iterdir()) == names[-2:]


def test_two_reloads_at_once(spark, tmp_path):
    a, b = Versions(spark, str(tmp_path)), Versions(spark, str(tmp_path))
    one, two = a.claim(), b.claim()
    assert one != two
    table(spark, 2).write.parquet(b.path(two, "t"))
    b.publish(two)
    with pytest.raises(CheckFailed, match="older"):
        a.publish(one)                                                 # the slower, older one gives way
    with pytest.raises(CheckFailed):
        b.publish(two)
    assert a.current() == two


@pytest.fixture(scope="module")
def reloaded(spark, tmp_path_factory):
    """One published reload of all tables."""
    root = str(tmp_path_factory.mktemp("reload"))
    paths = run_all(spark, SourceCatalog.from_testdata(spark, SF), root, FIXTURE_CONFIG)
    return Versions(spark, root), paths


def test_full_reload_is_one_version(spark, reloaded):
    store, paths = reloaded
    assert store.published() == ["v00000001"] and paths["trips"] == store.path("v00000001", "trips")
    assert store.read("fare_rules").count() == migration(spark, SF).fare_rules.count()


def test_audits_gate_the_reload(spark, reloaded, tmp_path):
    done, paths = reloaded
    staged = {name: done.read(name) for name in paths}
    every = {r.rule: r.violations for r in broken_rules(staged).collect()}
    assert every and min(every.values()) > 0
    some = sorted(every)[0]
    assert {r.rule for r in broken_rules(staged, {some: every[some]}).collect()} == set(every) - {some}
    store = Versions(spark, str(tmp_path))
    with pytest.raises(CheckFailed, match="violations="):
        store.reload(staged, broken_rules)
    assert store.current() is None
    store.reload(staged, lambda tables: broken_rules(tables, {"*": max(every.values())}))
    assert store.current() == "v00000002"
