"""Ranking, naming and ordering."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.functions.columns import array_minus, ordered_join
from headway.operators.ids import rank_within
from headway.operators.scope import in_migrated_agencies


def directions(tpsn: DataFrame, dst_agencies: DataFrame) -> DataFrame:
    """``DISTINCT ON (direction_id) ... ORDER BY direction_id, agency_id``
    as a partial aggregate: the smallest (agency, name) per direction, NULLs last."""
    t = in_migrated_agencies(tpsn, dst_agencies)
    best = t.groupBy("direction_id").agg(
        F.min(F.struct(F.col("agency_id").isNull().alias("za"), F.col("agency_id").alias("a"),
                       F.col("direction_name").isNull().alias("zn"), F.col("direction_name").alias("n"))).alias("_m"))
    return best.select(F.col("_m.a").alias("agency_id"), "direction_id", F.col("_m.n").alias("name"))


def assign_block_colors(blocks: DataFrame, colors: DataFrame) -> DataFrame:
    """Colour looked up by ``color_id = block_id``; unmatched stays NULL."""
    c = colors.select(F.col("color_id").alias("block_id"), "color")
    return blocks.join(c.hint("merge"), "block_id", "left").select("agency_id", "block_id", "name", "color")


def _trip_weight():
    """1 per scheduled trip, ``floor(1 + (end - start) / headway)`` per
    frequency row (E1)."""
    return F.when(F.col("headway_secs").isNull() | F.col("end_time").isNull(), F.lit(1).cast("bigint")) \
        .otherwise(F.floor(1 + (F.col("end_time") - F.col("start_time")) / F.col("headway_secs")).cast("bigint"))


def pattern_trip_counts(trips: DataFrame, timed_patterns: DataFrame, patterns: DataFrame) -> DataFrame:
    tp = timed_patterns.select("timed_pattern_id", "pattern_id")
    p = patterns.select("pattern_id", "route_id", "direction_id")
    t = trips.select("timed_pattern_id", "start_time", "end_time", "headway_secs")
    return (tp.join(p.hint("merge"), "pattern_id").join(t.hint("merge"), "timed_pattern_id")
            .groupBy("route_id", "direction_id", "pattern_id")
            .agg(F.sum(_trip_weight()).cast("bigint").alias("num_trips")))


def primary_patterns(counts: DataFrame) -> DataFrame:
    """Per route and direction the pattern with most trips, ties to the
    smallest pattern id -- a partial aggregate, not a window."""
    return counts.groupBy("route_id", "direction_id").agg(
        F.max_by("pattern_id", F.struct(F.col("num_trips"), -F.col("pattern_id"))).alias("primary_pattern_id"))


def _stop_arrays(pattern_stops: DataFrame) -> DataFrame:
    # NULL stop ids are kept (array_agg keeps them); arrays are per pattern.
    return pattern_stops.groupBy("pattern_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("stop_id"))), lambda s: s["stop_id"]).alias("stop_ids"))


def pattern_stop_difference(patterns: DataFrame, primary: DataFrame, pattern_stops: DataFrame) -> DataFrame:
    """Stops added to / removed from the route's primary pattern."""
    arrays = _stop_arrays(pattern_stops)
    prim = arrays.select(F.col("pattern_id").alias("primary_pattern_id"), F.col("stop_ids").alias("primary_stop_ids"))
    j = (patterns.select("route_id", "direction_id", "pattern_id")
         .join(primary.hint("merge"), ["route_id", "direction_id"])
         .join(prim.hint("merge"), "primary_pattern_id")
         .join(arrays.hint("merge"), "pattern_id"))           # last: the names group by pattern_id, in place
    added = array_minus("stop_ids", "primary_stop_ids")
    removed = array_minus("primary_stop_ids", "stop_ids")
    return j.select(
        "route_id", "pattern_id", "primary_pattern_id",
        F.size("stop_ids").cast("bigint").alias("n_stops"),
        F.coalesce(F.size(added), F.lit(0)).cast("bigint").alias("n_added_stops"),
        F.coalesce(F.size(removed), F.lit(0)).cast("bigint").alias("n_removed_stops"),
        added.alias("added_stop_ids"), removed.alias("removed_stop_ids"))


def _stop_names(diff: DataFrame, col: str, n_col: str, stops: DataFrame, sep: str, name: str) -> DataFrame:
    """Names of the listed stops (only where 1..3 of them), joined by ``sep``
    in stop_id order; NULL when none is a known stop (trap T8)."""
    small = diff.where(F.col(n_col).between(1, 3)).select("pattern_id", F.explode(col).alias("stop_id"))
    named = small.join(stops.select("stop_id", "name"), "stop_id")
    return named.groupBy("pattern_id").agg(
        ordered_join(F.transform(F.array_sort(F.collect_list(F.struct("stop_id", "name"))), lambda s: s["name"]),
                     sep).alias(name))


def generated_names(diff: DataFrame, stops: DataFrame) -> DataFrame:
    """E4: 'Primary', else '+ N stops' / '+ a + b' then ' - N stops' / ' - a - b'.
    ``concat`` propagates NULL exactly like ``||``.  One row per pattern, also
    where several agencies share it."""
    diff = diff.groupBy("pattern_id").agg(F.min(F.struct(*[c for c in diff.columns if c != "pattern_id"])).alias("_d")) \
        .select("pattern_id", "_d.*")
    added = _stop_names(diff, "added_stop_ids", "n_added_stops", stops, " + ", "_added")
    removed = _stop_names(diff, "removed_stop_ids", "n_removed_stops", stops, " - ", "_removed")
    d = diff.join(added.hint("merge"), "pattern_id", "left").join(removed.hint("merge"), "pattern_id", "left")
    n_add, n_rem = F.col("n_added_stops"), F.col("n_removed_stops")
    plus = F.when((n_add > 3) | (n_add == 0), F.concat(F.lit("+ "), n_add.cast("string"), F.lit(" stops"))) \
        .otherwise(F.concat(F.lit("+ "), F.col("_added")))
    minus = F.when((n_rem > 3) | (n_rem == 0), F.concat(F.lit(" - "), n_rem.cast("string"), F.lit(" stops"))) \
        .otherwise(F.concat(F.lit(" - "), F.col("_removed")))
    name = F.when(F.col("pattern_id") == F.col("primary_pattern_id"), F.lit("Primary")) \
        .otherwise(F.concat(plus, minus))
    return d.select("route_id", "pattern_id", "primary_pattern_id", "n_added_stops", "n_removed_stops",
                    name.alias("generated_name"))


def pattern_names(patterns: DataFrame, diff: DataFrame, stops: DataFrame) -> DataFrame:
    """Patterns with their generated name (NULL where no primary exists)."""
    names = generated_names(diff, stops).select("pattern_id", F.col("generated_name").alias("name"))
    return patterns.join(names.hint("merge"), "pattern_id", "left")


def pattern_names_endpoints(patterns: DataFrame, pattern_stops: DataFrame, src_stops: DataFrame) -> DataFrame:
    """E5: '<first stop> to <last stop> x<number of stops>'; of several stops
    that share the first or last place the one with the smallest id."""
    ends = pattern_stops.groupBy("pattern_id").agg(
        F.count(F.lit(1)).alias("number_of_stops"), F.min_by("stop_id", F.struct("stop_order", "stop_id")).alias("_first_id"),
        F.max_by("stop_id", F.struct(F.col("stop_order"), -F.col("stop_id"))).alias("_last_id"))
    s = src_stops.select("stop_id", "stop_name")
    first = s.select(F.col("stop_id").alias("_first_id"), F.col("stop_name").alias("_first"))
    last = s.select(F.col("stop_id").alias("_last_id"), F.col("stop_name").alias("_last"))
    j = patterns.select("pattern_id").join(ends, "pattern_id").join(first, "_first_id").join(last, "_last_id")
    return j.select("pattern_id", F.concat(F.col("_first"), F.lit(" to "), F.col("_last"), F.lit(" x"),
                                           F.col("number_of_stops").cast("string")).alias("generated_name"))


def unordered_agencies(routes: DataFrame) -> DataFrame:
    """Agencies whose routes lack a full sort order."""
    return (routes.groupBy("agency_id")
            .agg(F.countDistinct("route_sort_order").alias("n_sort_orders"), F.count("route_id").alias("n_routes"))
            .where(F.col("n_sort_orders") != F.col("n_routes")))


def order_routes(routes: DataFrame) -> DataFrame:
    """Routes of those agencies renumbered alphabetically (long name,
    short name, route id; NULLs last); other routes unchanged."""
    todo = routes.join(unordered_agencies(routes).select("agency_id"), "agency_id", "left_semi")
    ranked = rank_within(todo.select("agency_id", "route_id", "route_long_name", "route_short_name"),
                         ["agency_id"], ["route_long_name", "route_short_name", "route_id"], "_alpha")
    new = ranked.select("route_id", "_alpha")
    return (routes.join(new, "route_id", "left")
            .withColumn("route_sort_order", F.coalesce(F.col("_alpha"), F.col("route_sort_order")))
            .drop("_alpha").select(*routes.columns))
