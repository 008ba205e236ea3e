"""Ids that last across reloads."""

import dataclasses

from headway.operators.keydict import KeyDictionary, fingerprint
from headway.plans.pipeline import Migration
from headway.plans.registry import FIXTURE_CONFIG
from headway.session import scratch_tables
from headway.sources.catalog import SourceCatalog

SF = "/root/testdata/sf0.001"


def keys(spark, values):
    return spark.createDataFrame([(v, None if v % 3 == 0 else f"k{v % 3}") for v in values], "a long, b string").repartition(3)


def ids(df):
    return {(r.a, r.b): r.id for r in df.collect()}


def test_known_keys_keep_their_ids(spark, tmp_path):
    book = KeyDictionary(spark, str(tmp_path), "things")
    first = ids(book.assign(keys(spark, range(5, 15)), ["a", "b"], "id"))
    assert sorted(first.values()) == list(range(1, 11)) and first[5, "k2"] == 1
    # smaller keys arrive, some go
    second = ids(book.assign(keys(spark, range(0, 12)), ["a", "b"], "id"))
    assert all(second[k] == i for k, i in first.items() if k in second)
    assert sorted(i for k, i in second.items() if k not in first) == [11, 12, 13, 14, 15] and second[0, None] == 11
    # a key that was away finds its id again, and nothing new is numbered
    third = ids(book.assign(keys(spark, range(5, 15)), ["a", "b"], "id"))
    assert third == first and len(book.generations()) == 3
    assert book.known().count() == book.known().select("_hw_id").distinct().count() == 15


def test_unfinished_generation_is_written_again(spark, tmp_path):
    book = KeyDictionary(spark, str(tmp_path), "things")
    (tmp_path / "things" / "g00000001").mkdir(parents=True)
    (tmp_path / "things" / "g00000001" / "half.parquet").write_text("x")
    assert len(ids(book.assign(keys(spark, range(4)), ["a", "b"], "id"))) == 4
    assert book.generations() == ["g00000001"] and book.known().count() == 4


def test_null_is_part_of_the_key(spark):
    df = spark.createDataFrame([(None, 1), (1, None), (None, None), (0, 1), (1, 0)], "a long, b long")
    assert df.select(*fingerprint(["a", "b"])).distinct().count() == 5


KEYS = {"patterns": ("pattern_id", ["stops_pattern", "route_id", "direction_id"]),
        "timed_patterns": ("timed_pattern_id", ["stops_pattern", "arrival_time_intervals", "departure_time_intervals", "agency_id", "route_id", "direction_id"]),
        "trips": ("trip_id", None)}


def test_two_reloads_over_grown_input(spark, tmp_path):
    """The first reload lacks a sixth of the agencies; what it numbered keeps its ids in the second, and a third changes nothing."""
    cfg = dataclasses.replace(FIXTURE_CONFIG, key_dictionary=str(tmp_path))
    small = dataclasses.replace(cfg, skip_agencies=(*cfg.skip_agencies, 1, 5, 9, 13))

    def reload(config):
        m = Migration(spark, SourceCatalog.from_testdata(spark, SF), config)
        with scratch_tables(spark):
            found = {"patterns": m.stop_patterns, "timed_patterns": m.timed_pattern_rows.drop("rows"), "trips": m.trips}
            out = {}
            for kind, df in found.items():
                name, key = KEYS[kind]
                key = key or [c for c in df.columns if c != name]       # all of a trip; the ids inside it last as well
                pdf = df.select(name, *key).toPandas()
                out[kind] = {r[0]: tuple("-" if v != v or v is None else str(v) for v in r[1:]) for r in pdf.itertuples(index=False)}
                assert len(out[kind]) == len(pdf)
            return out

    before, after, again = reload(small), reload(cfg), reload(cfg)
    for kind in KEYS:
        old, new = before[kind], after[kind]
        assert len(old) < len(new)
        assert all(new[i] == k for i, k in old.items())
        assert sorted(set(new) - set(old)) == list(range(max(old) + 1, max(old) + 1 + len(new) - len(old)))
    assert again == after
