"""Source catalogs: name -> DataFrame for the schedule tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.sources.fixtures import BASE_TABLES, FIXTURE_VIEWS

# Columns the jobs read that a source may lack; they are added as typed
# NULLs so every job sees one fixed schema.
OPTIONAL_COLUMNS: dict[str, list[tuple[str, str]]] = {
    "stop_times": [("drop_off_type", "int"), ("headsign_id", "bigint")],
    "agency_groups": [("feed_contact_email", "string"), ("feed_contact_url", "string"), ("feed_license", "string"),
                      ("last_modified", "timestamp")],
    "agency": [("agency_id_import", "string"), ("agency_url", "string"), ("agency_timezone", "string"),
               ("agency_lang_id", "int"), ("agency_short_name", "string"), ("agency_phone", "string"),
               ("agency_fare_url", "string"), ("agency_info", "string"), ("query_tracking", "boolean"),
               ("last_modified", "timestamp"), ("no_frequencies", "boolean")],
    "zones": [("last_modified", "timestamp"), ("zone_id_import", "string")],
    "stops": [("stop_code", "string"), ("platform_code", "string"), ("location_type", "int"), ("parent_station", "bigint"),
              ("stop_desc", "string"), ("stop_comments", "string"), ("city", "string"), ("direction_id", "int"),
              ("stop_url", "string")],
    "routes": [("route_text_color", "string"), ("route_desc", "string"), ("route_type", "int"), ("route_url", "string"),
               ("route_bikes_allowed", "int"), ("route_id_import", "string"), ("last_modified", "timestamp")],
    "calendar_dates": [("last_modified", "timestamp")],
    "calendar_date_service_exceptions": [("last_modified", "timestamp")],
    "fare_attributes": [("transfers", "int"), ("transfer_duration", "int"), ("last_modified", "timestamp"),
                        ("fare_id_import", "string")],
    "fare_rules": [("last_modified", "timestamp"), ("fare_id_import", "string"), ("route_id_import", "string"),
                   ("origin_id_import", "string"), ("destination_id_import", "string"), ("contains_id_import", "string")],
    "transfers": [("min_transfer_time", "int"), ("last_modified", "timestamp"), ("from_stop_id_import", "string"),
                  ("to_stop_id_import", "string")],
    "users": [("pass", "string"), ("first_name", "string"), ("last_name", "string"), ("active", "boolean"),
              ("registration_date", "timestamp"), ("language_id", "int"), ("last_modified", "timestamp")],
    "user_permissions": [("last_modified", "timestamp")],
    "shape_segments": [("last_modified", "timestamp")],
}


def conform(name: str, df: DataFrame) -> DataFrame:
    present = set(df.columns)
    for col, typ in OPTIONAL_COLUMNS.get(name, []):
        if col not in present:
            df = df.withColumn(col, F.lit(None).cast(typ))
    return df


class SourceCatalog:
    """Lazily built, memoised mapping of source table name -> DataFrame."""

    def __init__(self, spark: SparkSession, loaders: dict[str, Callable[[], DataFrame]],
                 persist: tuple[str, ...] = ()):
        self.spark = spark
        self._loaders = loaders
        self._persist = set(persist)
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            df = conform(name, self._loaders[name]())
            if name in self._persist:
                # derived sources read by several jobs of one run
                df = df.persist(StorageLevel.MEMORY_AND_DISK)
            self._cache[name] = df
        return self._cache[name]

    __getitem__ = table

    def names(self) -> list[str]:
        return sorted(self._loaders)

    @classmethod
    def from_parquet(cls, spark: SparkSession, root: str,
                     names: list[str]) -> "SourceCatalog":
        """Production layout: one parquet dataset per source table."""
        loaders = {n: (lambda n=n: spark.read.parquet(f"{root}/{n}.parquet")) for n in names}
        return cls(spark, loaders)

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str) -> "SourceCatalog":
        """Source tables derived from the driver's base tables (FIXTURES)."""
        frames: dict[str, DataFrame] = {}
        # temporary views of this catalog's own, kept for the session: dropping a view (as ``spark.sql`` does with
        # DataFrame arguments) plans every persisted table anew that reads it, one by one, without the others' caches
        prefix = f"headway_{uuid.uuid4().hex}"

        def view_of(ref):
            if f"view {ref}" not in frames:
                frames[f"view {ref}"] = base(ref) if ref in BASE_TABLES else loaders_by_fixture[ref]()
                frames[f"view {ref}"].createOrReplaceTempView(f"{prefix}_{ref}")
            return f"{prefix}_{ref}"

        def base(name):
            if name not in frames:
                frames[name] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
            return frames[name]

        def view(name, body):
            def load():
                if name not in frames:
                    text = body
                    for ref in list(BASE_TABLES) + [n for n, _ in FIXTURE_VIEWS]:
                        if ref != name and re.search(rf"\b{ref}\b", text):
                            text = re.sub(rf"\b{ref}\b", view_of(ref), text)
                    frames[name] = spark.sql(text)
                return frames[name]
            return load

        loaders_by_fixture = {name: view(name, body) for name, body in FIXTURE_VIEWS}
        loaders = {}
        for name, load in loaders_by_fixture.items():
            short = name[4:] if name.startswith("src_") else name
            loaders[short] = load
        # the per-trip table is the only reader of stop_times that runs share, and is persisted itself
        return cls(spark, loaders, persist=("trips",))
