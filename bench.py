"""Benchmark: headline queries on $BENCH_SF_DIR (default sf0.1) on
local[$BENCH_CPUS]; prints one JSON line.

The source tables are first derived from the driver's tables and stored
as parquet in a fresh scratch folder -- the production input layout, one
dataset per source table (reported as ``source_prep_sec``, not part of
``value``).  Each headline query runs on a fresh migration over those stored
tables, with Spark's cache cleared, and is executed completely through the
``noop`` sink: once to warm up, then $BENCH_RUNS times (default 1), of which
the median counts.
``full_reload`` builds all target tables of one migration, once.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from headway.plans import registry  # noqa: E402
from headway.plans.cli import SOURCE_TABLES  # noqa: E402
from headway.plans.pipeline import Migration  # noqa: E402
from headway.session import build_session  # noqa: E402
from headway.sources.catalog import SourceCatalog  # noqa: E402

HEADLINE = ["tpsn", "trips_all", "pattern_names", "fares_symmetric", "stop_timezones",
            "fare_edits_applied", "routes_ordered"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus), app="headway-bench")
    prep_dir = tempfile.mkdtemp(prefix="headway-bench-src-")
    t0 = time.perf_counter()
    derived = SourceCatalog.from_testdata(spark, sf_dir)
    for name in SOURCE_TABLES:
        derived[name].write.mode("overwrite").parquet(f"{prep_dir}/{name}.parquet")
    prep = round(time.perf_counter() - t0, 3)

    def fresh() -> Migration:
        registry._MIGRATIONS.clear()
        spark.catalog.clearCache()
        m = Migration(spark, SourceCatalog.from_parquet(spark, prep_dir, SOURCE_TABLES), registry.FIXTURE_CONFIG)
        registry._MIGRATIONS[registry._key(spark, sf_dir)] = m
        return m

    fresh()
    run(registry.QUERIES["agencies"](spark, sf_dir))  # warm-up: JVM, codegen, footers
    times: dict[str, float] = {}
    repeats = int(os.environ.get("BENCH_RUNS", "1"))
    for name in HEADLINE:
        runs = []
        for _ in range(1 + repeats):
            fresh()
            t0 = time.perf_counter()
            run(registry.QUERIES[name](spark, sf_dir))
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs[1:]), 3)
    m = fresh()
    t0 = time.perf_counter()
    for df in m.targets().values():
        run(df)
    times["full_reload"] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "source_prep_sec": prep}))


if __name__ == "__main__":
    main()
