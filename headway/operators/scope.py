"""Run scope: which agencies and trips take part."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scope_skip(df: DataFrame, ids, col: str = "agency_id") -> DataFrame:
    """``col NOT IN (ids)``: rows with a NULL ``col`` are dropped as well."""
    if not ids:
        return df.where(F.col(col).isNotNull())
    return df.where(~F.col(col).isin(*ids))


def not_skipped(col, ids):
    """Boolean Column for ``col NOT IN (ids)`` with NULL -> false."""
    c = F.col(col) if isinstance(col, str) else col
    if not ids:
        return c.isNotNull()
    return F.coalesce(~c.isin(*ids), F.lit(False))


def in_migrated_agencies(df: DataFrame, agencies: DataFrame, col: str = "agency_id") -> DataFrame:
    """Keep rows whose ``col`` names a migrated agency (A7).  The agency
    table is a small dimension; the optimizer broadcasts it by size."""
    ids = agencies.select(F.col("agency_id").alias("_hw_aid"))
    return df.join(ids, df[col] == ids["_hw_aid"], "left_semi")


def scope_only(src, agency_id: int) -> list[int]:
    """Skip list that keeps a single agency: every other agency id (A5).
    The list is an agency dimension, small by nature."""
    rows = src["agency"].where(F.col("agency_id") != agency_id).select("agency_id").distinct().collect()
    return sorted(r["agency_id"] for r in rows)


def sample_agencies(src, must_have: list[int], n: int, skip: list[int]) -> DataFrame:
    """Legacy test sample (A8): must-have agencies united with agencies not
    marked deprecated, the first ``n`` by id, minus a block list.  The
    limit is the feature (a sample of ``n`` agencies)."""
    agency = src["agency"]
    must = agency.where(F.col("agency_id").isin(*must_have)).select("agency_id") if must_have \
        else agency.limit(0).select("agency_id")
    live = agency.where(~F.coalesce(F.col("agency_name"), F.lit("")).like("%DEPRECATED%")).select("agency_id")
    picked = must.union(live).distinct().orderBy("agency_id").limit(n)
    return picked.where(~F.col("agency_id").isin(*skip)) if skip else picked
