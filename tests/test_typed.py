"""A1: typed source tables with rejects."""

import pytest

from headway.plans.cli import SOURCE_TABLES
from headway.sources.catalog import SourceCatalog
from headway.sources.schemas import SOURCE_SCHEMAS
from headway.sources.typed import MissingColumns, TypedSource, typed

SF = "/root/testdata/sf0.001"


def test_every_source_table_has_a_schema():
    assert set(SOURCE_SCHEMAS) == set(SOURCE_TABLES)


def test_csv_with_wrong_types_and_ragged_rows(spark, tmp_path):
    (tmp_path / "stops.csv").write_text(
        "stop_id,stop_name,stop_lon,stop_lat,publish_status,zone_id,extra\n"
        "1,One,10.5,50.25,true,100,x\n"
        "two,Two,10.5,50.25,true,100,x\n"
        "3,Three,east,50.25,maybe,100,x\n"
        ",Four,1,2,false,,x\n"
        "5,\"Five, the fifth\",1,2,false,99999999999,x\n"
        "6,Six,1,2\n"
        "7,Seven,1,2,false,7,x,y\n"
        "8,Eight,-1.5,2,,,\n")
    (tmp_path / "zones.csv").write_text("zone_id,zone_name\n1,A\n1.5,B\n")
    src = TypedSource(spark, str(tmp_path), "csv", ["stops", "zones"])
    stops = src.catalog()["stops"]
    assert stops.schema["stop_id"].dataType.simpleString() == "bigint" and "extra" not in stops.columns
    good = {r.stop_id: r for r in stops.collect()}
    assert sorted(good) == [1, 8]
    assert (good[1].stop_lon, good[1].publish_status, good[1].zone_id, good[1].city) == (10.5, True, 100, None)
    assert (good[8].publish_status, good[8].zone_id) == (None, None)
    counts = {(r.table_name, r.reason): r.n_rows for r in src.write_rejects(str(tmp_path / "rejects")).collect()}
    assert counts == {("stops", "stop_id: not a bigint"): 1, ("stops", "stop_lon: not a double"): 1, ("stops", "publish_status: not a boolean"): 1,
                      ("stops", "stop_id: missing"): 1, ("stops", "zone_id: not a int"): 1, ("stops", "fields don't match the header"): 2,
                      ("zones", "zone_id: not a int"): 1}
    rejected = src.rejects().where("table_name = 'stops'").collect()
    assert len(rejected) == 6 and any('"Five, the fifth"' in r.row for r in rejected)
    assert stops.count() + len(rejected) == 8


def test_parquet_with_drifted_types(spark, tmp_path):
    drift = spark.createDataFrame([(1.0, "7", "2024-01-02"), (2.5, "x", "later"), (None, None, None)], "zone_id double, agency_id string, last_modified string")
    good, rejects = typed(drift, "zones")
    row = good.collect()
    assert [(r.zone_id, r.agency_id, str(r.last_modified)) for r in row] == [(1, 7, "2024-01-02")]
    assert sorted(sorted(r.reasons) for r in rejects.collect()) == [
        ["agency_id: not a int", "last_modified: not a date", "zone_id: not a int"], ["zone_id: missing"]]


def test_missing_columns(spark):
    with pytest.raises(MissingColumns, match="trips: no column trip_id"):
        typed(spark.createDataFrame([(1,)], "route_id long"), "trips")
    good, rejects = typed(spark.createDataFrame([(1,)], "trip_id long"), "trips")
    assert good.columns[0] == "trip_id" and good.first().route_id is None and rejects.count() == 0
    empty, none = typed(spark.createDataFrame([], "trip_id string"), "trips")
    assert empty.count() == 0 and none.count() == 0
    with pytest.raises(ValueError, match="format"):
        TypedSource(spark, "/nowhere", "xml", ["trips"])


def test_csv_equals_the_derived_tables(spark, tmp_path):
    """Source tables written as CSV come back with the same types and rows."""
    derived = SourceCatalog.from_testdata(spark, SF)
    tables = ["agency", "fare_rules", "routes", "fare_attributes"]
    for name in tables:
        derived[name].write.option("header", True).csv(f"{tmp_path}/{name}.csv")
    src = TypedSource(spark, str(tmp_path), "csv", tables)
    assert src.rejects().count() == 0
    for name in tables:
        a, b = src.catalog()[name], derived[name].select(src.catalog()[name].columns)
        assert a.dtypes == b.dtypes
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
