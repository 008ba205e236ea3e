"""Full reload from the command line.

    python -m headway.plans.cli --testdata /root/testdata/sf0.1 --out /shared/migrate
    python -m headway.plans.cli --source /shared/gtfs_src --out /shared/migrate

``--source`` expects one parquet dataset per source table
(``<source>/<table>.parquet``); ``--testdata`` derives the source tables
from the driver's TPC-H style tables.  The target tables are published as
one new version under ``--out``; readers keep the earlier one until then.
"""

from __future__ import annotations

import argparse
import json

from headway.config import MigrateConfig
from headway.plans.pipeline import run_all
from headway.session import build_session
from headway.sources.catalog import SourceCatalog

SOURCE_TABLES = ["agency", "agency_group_assoc", "agency_groups", "blocks", "calendar",
                 "calendar_date_service_exceptions", "calendar_dates", "directions", "fare_attributes",
                 "fare_rider_categories", "fare_rules", "frequencies", "headsigns", "routes", "sample_colors",
                 "service_schedule_bounds", "service_schedule_groups", "shape_points", "shape_segments",
                 "stop_times", "stops", "transfers", "trips", "tz_polygons", "user_permissions", "users", "zones"]


def main(argv=None) -> None:
    ap = argparse.ArgumentParser()
    g = ap.add_mutually_exclusive_group(required=True)
    g.add_argument("--source")
    g.add_argument("--testdata")
    ap.add_argument("--out", required=True)
    ap.add_argument("--master", default="local[*]")
    ap.add_argument("--skip-agencies", default="", help="agency ids that are not migrated, comma-separated")
    ap.add_argument("--skip-trips", default="", help="trip ids without a first arrival, comma-separated")
    ap.add_argument("--key-dictionary", help="folder of the ids that last across reloads")
    ap.add_argument("--keep", type=int, default=3, help="published versions that stay")
    ap.add_argument("--accept", type=int, help="run the audits before publishing; violations accepted of every rule")
    ap.add_argument("--cluster", action="store_true", help="use the large-cluster settings (session.CLUSTER_CONF)")
    a = ap.parse_args(argv)
    spark = build_session(master=a.master, cluster=a.cluster)
    src = (SourceCatalog.from_parquet(spark, a.source, SOURCE_TABLES) if a.source
           else SourceCatalog.from_testdata(spark, a.testdata))
    agencies, trips = (tuple(int(x) for x in text.split(",") if x.strip()) for text in (a.skip_agencies, a.skip_trips))
    cfg = MigrateConfig(skip_agencies=agencies, skip_trips=trips, materialize_per_trip=a.cluster,
                        key_dictionary=a.key_dictionary)
    accepted = None if a.accept is None else {"*": a.accept}
    print(json.dumps(run_all(spark, src, a.out, cfg, accepted, a.keep)))


if __name__ == "__main__":
    main()
