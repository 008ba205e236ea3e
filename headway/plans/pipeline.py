"""The migration as one lazily built DAG of DataFrames (``run_all``).

``Migration`` exposes every target table as a memoised DataFrame built in
data-flow order.  Shared intermediates are persisted once (the per-trip
table, the wide table, patterns, stops, fare rules, ...); ``dense_id``
writes its numbered rows as a table under the checkpoint folder, so a lost
executor never renumbers rows.  With ``materialize_per_trip`` the per-trip
table is written there too, bucketed by trip_id.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from headway.config import MigrateConfig
from headway.operators import (audits, fares, naming, patterns as pat, reference_tables as ref,
                               spatial, trips as trp)
from headway.operators.keydict import KeyDictionary
from headway.operators.losses import Losses
from headway.session import ensure_checkpoint_dir, note_scratch, scratch_tables
from headway.sources.catalog import SourceCatalog
from headway.sources.versions import Versions, broken_rules


def _keep(df: DataFrame) -> DataFrame:
    """Persist an intermediate read by several target tables (spills to
    disk; recomputed from lineage if an executor is lost)."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def bucketed_table(df: DataFrame, key: str, label: str) -> DataFrame:
    """Write ``df`` once as a parquet table bucketed and sorted by ``key``
    under the session's checkpoint folder and read it back: the lineage is
    cut, and joins on ``key`` can use the bucketing instead of a shuffle."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    name = f"headway_{label}_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (df.write.bucketBy(n, key).sortBy(key).option("path", f"{root}/{name}")
     .mode("overwrite").saveAsTable(name))
    note_scratch(f"{root}/{name}", name)
    return spark.table(name)


def _release(m: "Migration") -> None:
    """Unpersist every intermediate a migration cached."""
    for value in list(vars(m).values()):
        if isinstance(value, DataFrame) and value.is_cached:
            value.unpersist()


class Migration:
    def __init__(self, spark: SparkSession, src: SourceCatalog, cfg: MigrateConfig | None = None):
        self.spark = spark
        self.src = src
        self.cfg = cfg or MigrateConfig()
        self.losses = Losses()

    def _dictionary(self, kind: str) -> KeyDictionary | None:
        """The ids of earlier reloads, where the run names their folder."""
        return KeyDictionary(self.spark, self.cfg.key_dictionary, kind) if self.cfg.key_dictionary else None

    # ---- B: reference tables --------------------------------------------
    @cached_property
    def agencies(self) -> DataFrame:
        return _keep(ref.agencies(self.src, self.cfg))

    @cached_property
    def feeds(self) -> DataFrame:
        return ref.feeds(self.src, self.cfg)

    @cached_property
    def zones(self) -> DataFrame:
        return _keep(ref.zones(self.src, self.cfg))

    @cached_property
    def stops_base(self) -> DataFrame:
        """Migrated stops before the time zone step (names and ids only are
        needed by pattern names and shapes)."""
        return _keep(ref.stops_base(self.src, self.agencies))

    @cached_property
    def stops(self) -> DataFrame:
        return _keep(spatial.assign_timezones(self.stops_base, self.src["tz_polygons"], self.cfg))

    @cached_property
    def routes(self) -> DataFrame:
        return _keep(ref.routes(self.src, self.agencies))

    @cached_property
    def headsigns(self) -> DataFrame:
        return ref.headsigns(self.src, self.agencies)

    @cached_property
    def directions(self) -> DataFrame:
        return naming.directions(self.wide_patterns, self.agencies)

    @cached_property
    def calendars(self) -> DataFrame:
        return ref.calendars(self.src, self.agencies)

    @cached_property
    def calendar_bounds(self) -> DataFrame:
        return ref.calendar_bounds(self.src, self.agencies, self.calendars)

    @cached_property
    def calendar_dates(self) -> DataFrame:
        return ref.calendar_dates(self.src, self.agencies)

    def service_exceptions(self, mode: str | None = None) -> DataFrame:
        return ref.service_exceptions(self.src, self.agencies, self.calendars, self.calendar_dates,
                                      mode or self.cfg.service_exception_mode)

    @cached_property
    def blocks(self) -> DataFrame:
        return naming.assign_block_colors(ref.blocks(self.src, self.agencies), self.src["sample_colors"])

    @cached_property
    def fare_attributes(self) -> DataFrame:
        return ref.fare_attributes(self.src, self.agencies)

    def fare_rider_categories(self, mode: str | None = None) -> DataFrame:
        return ref.fare_rider_categories(self.src, self.agencies, self.fare_attributes,
                                         mode or self.cfg.rider_category_mode)

    @cached_property
    def transfers(self) -> DataFrame:
        return ref.transfers(self.src, self.agencies)

    @cached_property
    def users(self) -> DataFrame:
        return ref.users(self.src)

    @cached_property
    def user_permissions(self) -> DataFrame:
        return ref.user_permissions(self.src, self.agencies, self.users)

    @cached_property
    def custom_shape_segments(self) -> DataFrame:
        return ref.custom_shape_segments(self.spark)

    # ---- C: patterns ------------------------------------------------------
    @cached_property
    def per_trip(self) -> DataFrame:
        rows = pat.trip_stop_rows(self.src, self.agencies, self.cfg)
        if self.cfg.materialize_per_trip:
            return bucketed_table(rows, "trip_id", "per_trip")
        return rows.persist(StorageLevel.MEMORY_AND_DISK)

    @cached_property
    def pattern_time_intervals(self) -> DataFrame:
        return pat.pattern_time_intervals(self.per_trip, self.agencies)

    @cached_property
    def timed_pattern_keys(self) -> DataFrame:
        return pat.timed_pattern_keys(self.pattern_time_intervals, self._dictionary("timed_patterns"), self.losses)

    @cached_property
    def timed_pattern_rows(self) -> DataFrame:
        return pat.representative_rows(self.timed_pattern_keys, self.per_trip)

    @cached_property
    def stop_patterns(self) -> DataFrame:
        return pat.stop_patterns(self.per_trip, self.agencies, self._dictionary("patterns"))

    @cached_property
    def resolved_patterns(self) -> DataFrame:
        return pat.resolve_patterns(self.timed_pattern_rows, self.stop_patterns, self.src, self.losses)

    @cached_property
    def wide_patterns(self) -> DataFrame:
        """The wide table's columns without stop rows; the tables of ids need no more."""
        return _keep(pat.wide_patterns(self.resolved_patterns, self.src))

    @cached_property
    def tpsn(self) -> DataFrame:
        return pat.assemble_tpsn(self.timed_pattern_rows, self.resolved_patterns, self.src).persist(StorageLevel.MEMORY_AND_DISK)

    @cached_property
    def pattern_members(self) -> DataFrame:
        return pat.pattern_members(self.per_trip, self.timed_pattern_keys, self.agencies)

    @cached_property
    def patterns_base(self) -> DataFrame:
        return _keep(pat.pattern_headsigns(pat.patterns(self.wide_patterns), self.wide_patterns))

    @cached_property
    def pattern_stops(self) -> DataFrame:
        return _keep(pat.pattern_stops(self.tpsn, self.agencies))

    @cached_property
    def timed_patterns(self) -> DataFrame:
        return _keep(pat.timed_patterns_table(self.wide_patterns))

    @cached_property
    def timed_pattern_stops(self) -> DataFrame:
        return pat.timed_pattern_stops(self.tpsn)

    # ---- D: trips -----------------------------------------------------------
    @cached_property
    def first_arrivals(self) -> DataFrame:
        return trp.first_arrivals(self.per_trip, self.cfg).persist(StorageLevel.MEMORY_AND_DISK)

    @cached_property
    def patterns_trips(self) -> DataFrame:
        return trp.patterns_trips(self.pattern_members, self.wide_patterns, self.agencies).persist(
            StorageLevel.MEMORY_AND_DISK)

    @cached_property
    def trip_rows(self) -> DataFrame:
        """The trips without ids, which counting them doesn't need."""
        return _keep(trp.trip_rows(self.src, self.agencies, self.first_arrivals, self.patterns_trips, self.losses))

    @cached_property
    def trips(self) -> DataFrame:
        return trp.trips(self.trip_rows, self._dictionary("trips"))

    @cached_property
    def legacy_lists(self) -> DataFrame:
        """Trip lists with based-on trips, of timed patterns in the wide table."""
        members = pat.pattern_members(self.per_trip, self.timed_pattern_keys, self.agencies, children=True)
        return trp.patterns_trips(members, self.wide_patterns, self.agencies)

    # ---- E: naming and ordering --------------------------------------------
    @cached_property
    def pattern_trip_counts(self) -> DataFrame:
        return naming.pattern_trip_counts(self.trip_rows, self.timed_patterns, self.patterns_base)

    @cached_property
    def primary_patterns(self) -> DataFrame:
        return _keep(naming.primary_patterns(self.pattern_trip_counts))

    @cached_property
    def pattern_stop_difference(self) -> DataFrame:
        return _keep(naming.pattern_stop_difference(self.patterns_base, self.primary_patterns, self.pattern_stops))

    @cached_property
    def patterns(self) -> DataFrame:
        return naming.pattern_names(self.patterns_base, self.pattern_stop_difference, self.stops_base)

    @cached_property
    def routes_ordered(self) -> DataFrame:
        return naming.order_routes(self.routes)

    # ---- F: fares -----------------------------------------------------------
    @cached_property
    def fare_rules(self) -> DataFrame:
        return _keep(fares.fare_rules(self.src, self.zones, self.agencies, self.cfg))

    @cached_property
    def fares_symmetric(self) -> DataFrame:
        return _keep(fares.symmetric(self.fare_rules))

    @cached_property
    def fares_asymmetric(self) -> DataFrame:
        return fares.asymmetric(self.fare_rules, self.fares_symmetric)

    # ---- I: shapes -----------------------------------------------------------
    @cached_property
    def shape_segments(self) -> DataFrame:
        return _keep(spatial.shape_segments(self.src, self.stops_base))

    def dropped_rows(self) -> DataFrame:
        """Timed patterns and trips that vanish, by step and reason, as counted by the passes that write
        the resolved patterns and the trips."""
        self.resolved_patterns, self.trips
        return self.losses.report(self.spark)

    # ---- everything -----------------------------------------------------------
    def targets(self, names: set[str] | None = None) -> dict[str, DataFrame]:
        """The target tables by name; only the named ones are built."""
        build = {
            "feeds": lambda: self.feeds,
            "agencies": lambda: self.agencies,
            "zones": lambda: self.zones,
            "stops": lambda: self.stops,
            "routes": lambda: self.routes_ordered,
            "headsigns": lambda: self.headsigns,
            "directions": lambda: self.directions,
            "calendars": lambda: self.calendars,
            "calendar_bounds": lambda: self.calendar_bounds,
            "calendar_dates": lambda: self.calendar_dates,
            "calendar_date_service_exceptions": lambda: self.service_exceptions(),
            "blocks": lambda: self.blocks,
            "fare_attributes": lambda: self.fare_attributes,
            "fare_rider_categories": lambda: self.fare_rider_categories(),
            "transfers": lambda: self.transfers,
            "users": lambda: self.users,
            "user_permissions": lambda: self.user_permissions,
            "pattern_custom_shape_segments": lambda: self.custom_shape_segments,
            "timed_pattern_stops_nonnormalized": lambda: self.tpsn,
            "patterns": lambda: self.patterns,
            "pattern_stops": lambda: self.pattern_stops,
            "timed_patterns": lambda: self.timed_patterns,
            "timed_pattern_stops": lambda: self.timed_pattern_stops,
            "snap_first_arrivals_for_trip": lambda: self.first_arrivals,
            "dev_patterns_trips": lambda: self.patterns_trips,
            "trips": lambda: self.trips,
            "fare_rules": lambda: self.fare_rules,
            "shape_segments": lambda: self.shape_segments,
        }
        return {name: make() for name, make in build.items() if names is None or name in names}

    def audits(self) -> dict[str, DataFrame]:
        return {"fk_audit": audits.fk_audit(self), "key_audit": audits.key_audit(self),
                "check_audit": audits.check_audit(self)}


def run_all(spark: SparkSession, src: SourceCatalog, out_root: str, cfg: MigrateConfig | None = None,
            accepted: dict[str, int] | None = None, keep: int = 3) -> dict[str, str]:
    """Full reload: every target table is rebuilt and published as one new version under ``out_root``.

    With ``accepted`` the staged tables must pass the audits J1-J3 first
    (violations accepted by rule, see ``versions.broken_rules``); otherwise
    the audits are left to the caller.  Returns the published paths by table.
    """
    m = Migration(spark, src, cfg)
    store = Versions(spark, out_root)
    checks = None if accepted is None else (lambda tables: broken_rules(tables, accepted))
    with scratch_tables(spark):
        try:
            names = m.targets()
            version = store.reload(names, checks, keep)
            return {name: store.path(version, name) for name in names}
        finally:
            _release(m)
