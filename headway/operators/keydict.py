"""Ids that last across reloads.

A key dictionary is a table (fingerprint, id) kept under a shared folder.  A
reload looks its keys up: known keys keep their id, keys not seen before are
numbered densely from the high-water mark in the order given (``dense_id``) and
are appended as a new generation.  Old generations are never rewritten, and a
key that is missing from one reload finds its id again in the next.

The fingerprint is 128 bits of hash over the key columns and their null flags;
at 10**10 keys the odds that any two collide are below 2e-19.  Rows with one
key get one id.  A generation without its ``_SUCCESS`` file is a reload that
died while writing it, and is overwritten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.operators.ids import dense_id
from headway.sources.files import Files

_PRINT = ["_hw_f1", "_hw_f2"]


def fingerprint(columns: list[str]) -> list:
    """Two hash columns over ``columns``; NULL differs from every value (the hash alone skips NULLs)."""
    parts = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(*parts).alias(_PRINT[0]), F.xxhash64(F.lit("second"), *parts).alias(_PRINT[1])]


def lasting_ids(keys: DataFrame, columns: list[str], name: str, known: DataFrame, order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """``keys`` with the column ``name``, and the dictionary rows of the keys that are new.

    ``keys`` has one row per distinct value of ``columns``; ``known`` is the
    dictionary so far (``_hw_f1, _hw_f2, _hw_id``).
    """
    marked = keys.select("*", *fingerprint(columns))
    mark = known.agg(F.max("_hw_id").alias("m")).first()["m"] or 0           # one value: the high-water mark
    found = marked.join(known, _PRINT)
    fresh = dense_id(marked.join(known, _PRINT, "left_anti"), order or columns, "_hw_id", offset=int(mark))
    every = found.select(*keys.columns, F.col("_hw_id").alias(name)).unionByName(fresh.select(*keys.columns, F.col("_hw_id").alias(name)))
    return every, fresh.select(*_PRINT, "_hw_id")


class KeyDictionary:
    """The dictionary of one kind of id under ``root``: generations ``g00000001``, ``g00000002``, ..."""

    SCHEMA = "_hw_f1 long, _hw_f2 long, _hw_id long"

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark = spark
        self.path = f"{root.rstrip('/')}/{name}"

    def generations(self) -> list[str]:
        """Complete generations, oldest first."""
        return Files(self.spark, self.path).complete("", "g")

    def known(self) -> DataFrame:
        done = [f"{self.path}/{n}" for n in self.generations()]
        return self.spark.read.schema(self.SCHEMA).parquet(*done) if done else self.spark.createDataFrame([], self.SCHEMA)

    def assign(self, keys: DataFrame, columns: list[str], name: str, order: list[str] | None = None) -> DataFrame:
        """``keys`` with lasting ids; the new ones are stored before the frame is returned."""
        done = self.generations()
        known = self.known()
        every, fresh = lasting_ids(keys, columns, name, known, order)
        target = f"{self.path}/g{int(done[-1][1:]) + 1 if done else 1:08d}"
        fresh.write.mode("overwrite").parquet(target)
        return every
