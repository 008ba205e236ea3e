"""Fare rules: deduplication, zone validity, symmetric pairs and batch
edits through the symmetric view (F1-F8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.config import MigrateConfig
from headway.functions.columns import null_means_all as nma
from headway.operators.ids import dense_id, next_id
from headway.operators.scope import in_migrated_agencies

RULE_KEY = ["agency_id", "fare_id", "route_id", "origin_id", "destination_id", "contains_id"]
RULE_COLUMNS = ["fare_rule_id", "fare_id", "route_id", "origin_id", "destination_id", "contains_id",
                "agency_id", "is_combinable", "last_modified", "fare_id_import", "route_id_import", "origin_id_import",
                "destination_id_import", "contains_id_import"]
SYM_COLUMNS = ["agency_id", "fare_id", "zone_id_a", "zone_id_b", "route_id", "contains_id", "is_combinable"]


def newest_fare_rules(rules: DataFrame) -> DataFrame:
    """the newest rule (largest id) of each duplicate group, NULLs
    equal; group size and oldest id reported instead of an unbounded list."""
    return rules.groupBy(*RULE_KEY).agg(
        F.max("fare_rule_id").alias("newest_fare_rule_id"),
        F.min("fare_rule_id").alias("oldest_fare_rule_id"),
        F.count(F.lit(1)).alias("n_rules"))


def valid_zones(rules: DataFrame, zones: DataFrame) -> DataFrame:
    """origin, destination and contains are NULL or a known zone."""
    z = zones.select(F.col("zone_id").cast("bigint").alias("_z")).distinct()
    out = rules
    for col in ("origin_id", "destination_id", "contains_id"):
        flag = "_ok_" + col
        zz = z.select(F.col("_z").alias("_z_" + col), F.lit(True).alias(flag))
        out = out.join(zz, out[col] == zz["_z_" + col], "left")
        out = out.where(F.col(col).isNull() | F.col(flag)).drop("_z_" + col, flag)
    return out


def set_combinable(rules: DataFrame, cfg: MigrateConfig) -> DataFrame:
    """default true; false for listed agencies, and for zone-bound rules
    of the second list.  A NULL condition leaves the default."""
    agency = F.col("agency_id")
    never = agency.isin(*cfg.never_combinable_agencies) if cfg.never_combinable_agencies else F.lit(False)
    zoned = (agency.isin(*cfg.zone_rules_not_combinable_agencies)
             & (F.col("origin_id").isNotNull() | F.col("destination_id").isNotNull())) \
        if cfg.zone_rules_not_combinable_agencies else F.lit(False)
    return rules.withColumn("is_combinable", ~F.coalesce(never | zoned, F.lit(False)))


def fare_rules(src, dst_zones: DataFrame, dst_agencies: DataFrame, cfg: MigrateConfig) -> DataFrame:
    """F3 (+F4): newest rules with valid zones of migrated agencies."""
    rules = src["fare_rules"]
    newest = newest_fare_rules(rules).select(F.col("newest_fare_rule_id").alias("fare_rule_id"))
    r = rules.join(newest.hint("merge"), "fare_rule_id", "left_semi")
    r = in_migrated_agencies(valid_zones(r, dst_zones), dst_agencies)
    return set_combinable(r, cfg).select(*RULE_COLUMNS)


def _with_keys(rules: DataFrame) -> DataFrame:
    return rules.select("*", nma("origin_id").alias("_o"), nma("destination_id").alias("_d"),
                        nma("route_id").alias("_rt"), nma("contains_id").alias("_c"))


def symmetric(rules: DataFrame) -> DataFrame:
    """rules with a mirrored partner (equal fare, agency, route and
    contains under null-means-all), seen from the side with origin <
    destination.  ``last_modified`` is the greatest of the two sides.

    No pair of rules is ever materialised: the partner side is reduced to
    one row per key (its smallest timestamp) and its distinct timestamps,
    which is enough to form every distinct GREATEST value exactly.
    NULL timestamps count as the smallest value (GREATEST skips NULL)."""
    r = _with_keys(rules)
    key = ["agency_id", "fare_id", "_o", "_d", "_rt", "_c"]
    side1 = r.where(F.col("_o") < F.col("_d")).select(
        *key, F.col("origin_id").alias("zone_id_a"), F.col("destination_id").alias("zone_id_b"),
        "route_id", "contains_id", "is_combinable", "last_modified")
    # partner rows, mirrored so that their key lines up with side1's
    side2 = r.where(F.col("_o") > F.col("_d")).select(
        "agency_id", "fare_id", F.col("_d").alias("_o"), F.col("_o").alias("_d"), "_rt", "_c", "last_modified")
    s2_agg = side2.groupBy(*key).agg(
        F.max(F.col("last_modified").isNull()).alias("_p_null"), F.min("last_modified").alias("_p_min"))
    s2_vals = side2.select(*key, F.col("last_modified").alias("_p_lm")).distinct()
    out_cols = SYM_COLUMNS

    def reaches(value, has_null, low):
        # some partner value is <= ``value`` (NULL being the smallest)
        return F.when(value.isNull(), has_null).otherwise(has_null | (low <= value))

    part_a = (side1.join(s2_agg, key)
              .where(reaches(F.col("last_modified"), F.col("_p_null"), F.col("_p_min")))
              .select(*out_cols, "last_modified"))
    s1_agg = side1.groupBy(*key, *out_cols).agg(
        F.max(F.col("last_modified").isNull()).alias("_s_null"), F.min("last_modified").alias("_s_min"))
    part_b = (s1_agg.join(s2_vals, key)
              .where(reaches(F.col("_p_lm"), F.col("_s_null"), F.col("_s_min")))
              .select(*out_cols, F.col("_p_lm").alias("last_modified")))
    return part_a.unionByName(part_b).distinct()


def asymmetric(rules: DataFrame, sym: DataFrame) -> DataFrame:
    """rules with no symmetric counterpart (matched on least/greatest
    of their zones)."""
    r = _with_keys(rules)
    r = r.select("*", F.least("_o", "_d").alias("_lo"), F.greatest("_o", "_d").alias("_hi"))
    s = sym.select("agency_id", "fare_id", nma("route_id").alias("_rt"), nma("zone_id_a").alias("_lo"),
                   nma("zone_id_b").alias("_hi"), nma("contains_id").alias("_c")).distinct()
    return r.join(s, ["agency_id", "fare_id", "_rt", "_lo", "_hi", "_c"], "left_anti").select(*rules.columns)


def fare_balance(rules: DataFrame, sym: DataFrame, asym: DataFrame) -> DataFrame:
    """``count(rules) - 2 count(symmetric) - count(asymmetric)``; zero
    once duplicates are gone."""
    parts = (sym.select(F.lit("s").alias("k")).unionByName(asym.select(F.lit("a").alias("k")))
             .unionByName(rules.select(F.lit("r").alias("k"))))
    agg = parts.groupBy().agg(
        F.sum(F.when(F.col("k") == "s", 1).otherwise(0)).cast("bigint").alias("n_symmetric"),
        F.sum(F.when(F.col("k") == "a", 1).otherwise(0)).cast("bigint").alias("n_asymmetric"),
        F.sum(F.when(F.col("k") == "r", 1).otherwise(0)).cast("bigint").alias("n_rules"))
    return agg.select("*", (F.col("n_rules") - 2 * F.col("n_symmetric") - F.col("n_asymmetric")).alias("residue"))


# ---- F8: edits through the symmetric view, applied as a batch ----------------

EDIT_COLUMNS = ["seq", "op", "old_fare_id", "old_agency_id", "old_route_id", "old_zone_id_a", "old_zone_id_b",
                "old_contains_id", "new_fare_id", "new_agency_id", "new_route_id", "new_zone_id_a",
                "new_zone_id_b", "new_contains_id", "new_is_combinable"]


def derive_edits(rules: DataFrame) -> DataFrame:
    """Edit stream read off the rules (fixture rule, FIXTURES.md): one edit
    per rule whose id ends in 0; by ``floor(id / 10) % 5``: 0 INSERT (new =
    old), 1 UPDATE (destination + 1), 2 DELETE, 3-4 none.  Inserts and
    updates whose new zones coincide are skipped."""
    r = rules.where(F.col("fare_rule_id") % 10 == 0)
    kind = F.floor(F.col("fare_rule_id") / 10) % 5
    op = F.when(kind == 0, "INSERT").when(kind == 1, "UPDATE").when(kind == 2, "DELETE")
    new_b = F.when(kind == 1, F.col("destination_id") + 1).otherwise(F.col("destination_id"))
    e = r.select(
        F.col("fare_rule_id").alias("seq"), op.alias("op"),
        F.col("fare_id").alias("old_fare_id"), F.col("agency_id").alias("old_agency_id"),
        F.col("route_id").alias("old_route_id"), F.col("origin_id").alias("old_zone_id_a"),
        F.col("destination_id").alias("old_zone_id_b"), F.col("contains_id").alias("old_contains_id"),
        F.col("fare_id").alias("new_fare_id"), F.col("agency_id").alias("new_agency_id"),
        F.col("route_id").alias("new_route_id"), F.col("origin_id").alias("new_zone_id_a"),
        new_b.alias("new_zone_id_b"), F.col("contains_id").alias("new_contains_id"),
        F.col("is_combinable").alias("new_is_combinable"))
    same = nma("new_zone_id_a") == nma("new_zone_id_b")
    return e.where(F.col("op").isNotNull() & ~((F.col("op") != "DELETE") & same))


def _pair_key(fare, agency, route, a, b, contains):
    return [fare.alias("_kf"), agency.alias("_ka"), nma(route).alias("_kr"),
            F.least(nma(a), nma(b)).alias("_klo"), F.greatest(nma(a), nma(b)).alias("_khi"), nma(contains).alias("_kc")]


NULL_KEY = -(1 << 62)       # stands for a missing fare or agency in a bucket's hash
_KEY = ["_kf", "_ka", "_kr", "_klo", "_khi", "_kc"]


def pair_bucket(buckets: int, side: str | None = None):
    """Bucket of a rule's pair key, or of the ``old`` or ``new`` key of an edit."""
    if side is None:
        cols = [F.col(c) for c in ("fare_id", "agency_id", "route_id", "origin_id", "destination_id", "contains_id")]
    else:
        cols = [F.col(f"{side}_{c}") for c in ("fare_id", "agency_id", "route_id", "zone_id_a", "zone_id_b", "contains_id")]
    key = [F.coalesce(k.cast("bigint"), F.lit(NULL_KEY)) for k in _pair_key(*cols)]
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def apply_edits(rules: DataFrame, edits: DataFrame, first_new_id: int | None = None, run_ts=None) -> DataFrame:
    """F8: DELETE removes both directions of OLD; INSERT removes both
    directions of NEW, then adds forward and reverse rows; UPDATE does both
    (OLD first).  The final state of a key is decided by the last edit
    touching it (``max_by`` over (seq, step), a partial aggregate); new rows
    get ids after the current maximum, ``run_ts`` as their modification time
    and no import ids."""
    deletes = edits.where(F.col("op").isin("DELETE", "UPDATE")).select(
        *_pair_key(F.col("old_fare_id"), F.col("old_agency_id"), F.col("old_route_id"),
                   F.col("old_zone_id_a"), F.col("old_zone_id_b"), F.col("old_contains_id")),
        F.col("seq"), F.lit(0).alias("step"), F.lit(False).alias("ins"),
        *[F.lit(None).cast(edits.schema[c].dataType).alias(c) for c in EDIT_COLUMNS[8:]])
    inserts = edits.where(F.col("op").isin("INSERT", "UPDATE")).select(
        *_pair_key(F.col("new_fare_id"), F.col("new_agency_id"), F.col("new_route_id"),
                   F.col("new_zone_id_a"), F.col("new_zone_id_b"), F.col("new_contains_id")),
        F.col("seq"), F.lit(1).alias("step"), F.lit(True).alias("ins"), *EDIT_COLUMNS[8:])
    touches = deletes.unionByName(inserts)
    last = touches.groupBy(*_KEY).agg(F.max_by(
        F.struct("ins", "seq", *EDIT_COLUMNS[8:]), F.struct("seq", "step")).alias("_last"))
    keyed = rules.select("*", *_pair_key(F.col("fare_id"), F.col("agency_id"), F.col("route_id"),
                                         F.col("origin_id"), F.col("destination_id"), F.col("contains_id")))
    kept = keyed.join(last.select(*_KEY), _KEY, "left_anti").select(*rules.columns)
    live = last.where(F.col("_last.ins")).select("_last.*")
    pairs = live.select(
        "seq", F.explode(F.array(
            F.struct(F.lit(0).alias("dir"), F.col("new_zone_id_a").alias("o"), F.col("new_zone_id_b").alias("d")),
            F.struct(F.lit(1).alias("dir"), F.col("new_zone_id_b").alias("o"), F.col("new_zone_id_a").alias("d")))).alias("p"),
        *EDIT_COLUMNS[8:])
    start = first_new_id if first_new_id is not None else next_id(rules, "fare_rule_id")
    new_rows = dense_id(pairs.select("seq", F.col("p.dir").alias("dir"), "p.o", "p.d", *EDIT_COLUMNS[8:]),
                        ["seq", "dir"], "fare_rule_id", offset=start - 1)
    added = new_rows.select(
        "fare_rule_id", F.col("new_fare_id").alias("fare_id"), F.col("new_route_id").alias("route_id"),
        F.col("o").alias("origin_id"), F.col("d").alias("destination_id"),
        F.col("new_contains_id").alias("contains_id"), F.col("new_agency_id").alias("agency_id"),
        F.col("new_is_combinable").alias("is_combinable"),
        F.lit(run_ts).cast(rules.schema["last_modified"].dataType).alias("last_modified"))
    added = added.select("*", *[F.lit(None).cast(rules.schema[c].dataType).alias(c)
                                for c in rules.columns if c not in added.columns])
    return kept.unionByName(added.select(*rules.columns))
