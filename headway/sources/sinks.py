"""Targets are replaced wholesale on every run (truncate-and-reload)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_target(df: DataFrame, root: str, name: str, partition_by: list[str] | None = None) -> str:
    """Overwrite ``root/name`` with ``df`` (never append across runs).

    A run writes a fresh output version; callers must not read and
    overwrite the same path in one job.
    """
    path = f"{root}/{name}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_all(tables: dict[str, DataFrame], root: str) -> dict[str, str]:
    return {name: write_target(df, root, name) for name, df in tables.items()}
