"""Why rows vanish, counted while the jobs that drop them run.

A step gives every row the reason it is dropped for (NULL: it stays) before it
filters.  ``Losses.drop`` observes the counts by reason on that frame, so they
come out of the pass that writes the step's table; no row is read again.  The
counts are ready once that table is written.  Like every observed metric they
count a row twice when a lost executor forces a part of the pass to be redone
within one stage attempt.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

SCHEMA = "step string, reason string, n_rows long, n_trips long"
REASON = "_hw_reason"


def first_reason(reasons: dict[str, Column]) -> Column:
    """The name of the first condition that holds, else NULL."""
    out = F.lit(None).cast("string")
    for name, holds in reversed(reasons.items()):
        out = F.when(holds, F.lit(name)).otherwise(out)
    return out


@dataclass
class Losses:
    _watched: list[tuple[str, list[str], Observation]] = field(default_factory=list)

    def drop(self, df: DataFrame, step: str, reasons: dict[str, Column], trips: Column | None = None) -> DataFrame:
        """Rows of ``df`` that no condition of ``reasons`` holds for; the others are counted by the first that does.

        ``trips`` is the number of trips a row stands for, by default one.
        """
        seen = Observation(f"{step}-{uuid.uuid4().hex}")
        marked = df.withColumn(REASON, first_reason(reasons))
        weight = F.lit(1) if trips is None else trips
        counts = []
        for i, name in enumerate(reasons):
            counts.append(F.count_if(F.col(REASON) == name).alias(f"n{i}"))
            counts.append(F.sum(F.when(F.col(REASON) == name, weight).otherwise(0)).alias(f"t{i}"))
        self._watched.append((step, list(reasons), seen))
        return marked.observe(seen, *counts).where(F.col(REASON).isNull()).drop(REASON)

    def report(self, spark: SparkSession) -> DataFrame:
        """``step, reason, n_rows, n_trips`` of every step; waits for steps whose table is being written."""
        rows = []
        for step, reasons, seen in self._watched:
            got = seen.get
            rows += [(step, name, int(got.get(f"n{i}") or 0), int(got.get(f"t{i}") or 0)) for i, name in enumerate(reasons)]
        return spark.createDataFrame(rows, SCHEMA)


def drop(df: DataFrame, losses: Losses | None, step: str, reasons: dict[str, Column], trips: Column | None = None) -> DataFrame:
    """``Losses.drop``, or the plain filter where nobody counts."""
    if losses is not None:
        return losses.drop(df, step, reasons, trips)
    return df.where(first_reason(reasons).isNull())
