"""Run parameters (the settings file of a migration run)."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class MigrateConfig:
    # Agencies never migrated; none unless the run names them (NULL agency
    # ids are dropped as well, three-valued NOT IN).
    skip_agencies: tuple[int, ...] = ()
    # Trips left out of the first-arrival table; none unless named.
    skip_trips: tuple[int, ...] = ()
    # Fare rule combinability (fixed values): agencies whose rules are never
    # combinable, and agencies whose zone-bound rules are not combinable.
    never_combinable_agencies: tuple[int, ...] = (42, 175)
    zone_rules_not_combinable_agencies: tuple[int, ...] = (19,)
    # "intent" follows the foreign keys; "literal" reproduces the name
    # binding of the original statements (see README, traps T5/T6).
    service_exception_mode: str = "intent"
    rider_category_mode: str = "intent"
    # Timestamp written where the original used now(): the wildcard zone and
    # rules added by fare edits.
    run_ts: _dt.datetime = field(default_factory=lambda: _dt.datetime(2024, 1, 1))
    # Side (degrees) of the coarsest grid cells that cover the polygons, and
    # how often a cell that many edges cut is split into four.
    tz_cell_degrees: float = 5.0
    tz_cover_levels: int = 6
    # Salt buckets spread the points of a crowded cell over several tasks.
    tz_band_salt: int = 4
    # Write the per-trip table (about the size of stop_times) as a table
    # bucketed by trip_id under spark.checkpoint.dir instead of persisting
    # it: a lost executor re-reads files instead of redoing the shuffle.
    materialize_per_trip: bool = False
    # Folder of the key dictionaries that keep pattern, timed pattern and
    # trip ids the same over reloads; without it every reload numbers anew.
    key_dictionary: str | None = None
