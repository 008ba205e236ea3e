"""Deletes carried along the foreign keys of the target schema.

Tables are worked off parents first.  A row goes when it is named in the
deletes, or when a CASCADE key of it points to a parent that is gone or never
was there; a NULL key points nowhere and holds.  A row whose RESTRICT key
points to such a parent stays and is reported.  Every row that goes carries
the chain of keys that took it, read from the child upwards and ending in
``deleted`` or ``absent``; of several chains the smallest text counts.

A parent key is gone when no surviving row holds it, so the parent's side of
every join has one row per key and is never larger than the parent table.
Tables whose keys form a circle (or point to their own table) are repeated
until no further row goes.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.operators.audits import FOREIGN_KEYS, RESTRICT_KEYS, _union

CHAIN = "_hw_chain"


@dataclass(frozen=True)
class ForeignKey:
    child: str
    column: str
    parent: str
    parent_column: str
    cascade: bool = True

    @property
    def name(self) -> str:
        return f"{self.child}.{self.column} -> {self.parent}.{self.parent_column}"


def schema_keys() -> list[ForeignKey]:
    """The foreign keys of the target schema with what a delete of the parent does."""
    return [ForeignKey(*key, cascade=key[:2] not in RESTRICT_KEYS) for key in FOREIGN_KEYS]


def parents_first(tables: Iterable[str], keys: list[ForeignKey]) -> list[list[str]]:
    """Groups of tables, parents before children; a group of several tables is a circle of keys."""
    tables = list(tables)
    up = {t: {k.parent for k in keys if k.child == t and k.parent in tables} for t in tables}
    reach = {t: set(up[t]) for t in tables}
    for via in tables:
        for t in tables:
            if via in reach[t]:
                reach[t] |= reach[via]
    groups: list[list[str]] = []
    for t in tables:
        for g in groups:
            if g[0] in reach[t] and t in reach[g[0]]:
                g.append(t)
                break
        else:
            groups.append([t])
    placed: set[str] = set()
    ordered = []
    while groups:
        ready = next(g for g in groups if all(reach[t] - set(g) <= placed for t in g))
        groups.remove(ready)
        placed.update(ready)
        ordered.append(ready)
    return ordered


def _parent_state(parent: DataFrame, column: str) -> DataFrame:
    """One row per key of the parent: whether a surviving row holds it, and why not."""
    return (parent.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("bigint").alias("_hw_key"))
            .agg(F.max(F.col(CHAIN).isNull()).alias("_hw_alive"), F.min(CHAIN).alias("_hw_why")))


def _broken(child: DataFrame, key: ForeignKey, parent: DataFrame) -> tuple[DataFrame, Column]:
    """The child with the state of its parent beside it, and the chain of a broken key (else NULL)."""
    state = _parent_state(parent, key.parent_column)
    joined = child.join(state, F.col(key.column).cast("bigint") == F.col("_hw_key"), "left")
    gone = F.col(key.column).isNotNull() & ~F.coalesce(F.col("_hw_alive"), F.lit(False))
    return joined, F.when(gone, F.concat(F.lit(key.name + ": "), F.coalesce(F.col("_hw_why"), F.lit("absent"))))


def _mark(rows: DataFrame, key: ForeignKey, parent: DataFrame) -> DataFrame:
    joined, chain = _broken(rows, key, parent)
    columns = [c for c in rows.columns if c != CHAIN]
    return joined.select(*columns, F.least(F.col(CHAIN), chain).alias(CHAIN))


def _deleted(rows: DataFrame, named: DataFrame | None) -> DataFrame:
    if named is None:
        return rows.withColumn(CHAIN, F.lit(None).cast("string"))
    keys = named.columns
    hit = named.distinct().select(*[F.col(c).alias("_hw_" + c) for c in keys], F.lit("deleted").alias(CHAIN))
    joined = rows.join(hit, [rows[c].eqNullSafe(hit["_hw_" + c]) for c in keys], "left")
    return joined.select(*rows.columns, CHAIN)


class Cascade:
    """Marked tables after the deletes: ``survivors`` and ``report``."""

    def __init__(self, tables: dict[str, DataFrame], keys: list[ForeignKey] | None = None,
                 deletes: dict[str, DataFrame] | None = None):
        self.keys = [k for k in (schema_keys() if keys is None else keys) if k.child in tables and k.parent in tables]
        deletes = deletes or {}
        if unknown := set(deletes) - set(tables):
            raise ValueError(f"deletes name unknown tables: {', '.join(sorted(unknown))}")
        self.marked = {t: _deleted(df, deletes.get(t)) for t, df in tables.items()}
        for group in parents_first(tables, self.keys):
            inside = [k for k in self.keys if k.cascade and k.child in group and k.parent in group]
            for k in self.keys:
                if k.cascade and k.child in group and k not in inside:
                    self.marked[k.child] = _mark(self.marked[k.child], k, self.marked[k.parent])
            if inside:
                self._repeat(group, inside)

    def _repeat(self, group: list[str], inside: list[ForeignKey]) -> None:
        """Keys within a circle of tables, until the number of rows that go stands still."""
        before = -1
        while True:
            for k in inside:
                child = _mark(self.marked[k.child], k, self.marked[k.parent])
                self.marked[k.child] = child.checkpoint()          # cuts the growing plan
            gone = sum(self.marked[t].where(F.col(CHAIN).isNotNull()).count() for t in group)
            if gone == before:
                return
            before = gone

    def survivors(self) -> dict[str, DataFrame]:
        return {t: df.where(F.col(CHAIN).isNull()).drop(CHAIN) for t, df in self.marked.items()}

    def violations(self, key: ForeignKey) -> DataFrame:
        """Surviving rows whose RESTRICT key points to a parent that is gone, with the ``chain``."""
        rows = self.marked[key.child].where(F.col(CHAIN).isNull()).drop(CHAIN)
        joined, chain = _broken(rows, key, self.marked[key.parent])
        return joined.select(*rows.columns, chain.alias("chain")).where(F.col("chain").isNotNull())

    def report(self) -> DataFrame:
        """``table_name, action, chain, n_rows``: rows kept, rows gone by chain, RESTRICT violations by chain."""
        parts = [df.groupBy(F.lit(t).alias("table_name"),
                            F.when(F.col(CHAIN).isNull(), "kept").when(F.col(CHAIN) == "deleted", "deleted").otherwise("cascade").alias("action"),
                            F.coalesce(CHAIN, F.lit("")).alias("chain")).agg(F.count(F.lit(1)).alias("n_rows"))
                 for t, df in self.marked.items()]
        parts += [self.violations(k).groupBy(F.lit(k.child).alias("table_name"), F.lit("restrict").alias("action"), "chain")
                  .agg(F.count(F.lit(1)).alias("n_rows")) for k in self.keys if not k.cascade]
        return _union(parts)


def prune_orphans(tables: dict[str, DataFrame], keys: list[ForeignKey] | None = None,
                  deletes: dict[str, DataFrame] | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """The surviving rows of every table and the report; ``deletes`` names keys to delete, by table."""
    done = Cascade(tables, keys, deletes)
    return done.survivors(), done.report()
