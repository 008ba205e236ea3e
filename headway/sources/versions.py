"""Published versions of the target tables (A2, A3).

A reload never touches what readers see.  It claims the next version number,
writes every table under ``versions/v00000012/``, holds the staged tables
against its checks, and publishes them by creating one empty file,
``published/v00000012``: a single create, atomic on every file system, with
the version in the name, so a reader can't see half of it.  Readers take the
newest published name.  A reload that dies leaves its folder unpublished; the
next successful one removes it together with the versions beyond ``keep``.

Files are named through Hadoop's file system interface, so the root may be on
any store that Spark can write.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.operators import audits
from headway.sources.files import Files
from headway.sources.sinks import write_target


class CheckFailed(RuntimeError):
    """The staged tables broke a rule; nothing was published."""


class Versions:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._files = Files(spark, root)

    def _names(self, folder: str) -> list[str]:
        return self._files.names(folder, "v")

    def published(self) -> list[str]:
        """Published versions, oldest first."""
        staged = set(self._names("versions"))
        return [v for v in self._names("published") if v in staged]

    def path(self, version: str, table: str | None = None) -> str:
        return f"{self.root}/versions/{version}" + (f"/{table}" if table else "")

    def current(self) -> str | None:
        done = self.published()
        return done[-1] if done else None

    def read(self, table: str, version: str | None = None) -> DataFrame:
        """A table of a published version, by default the newest one."""
        version = version or self.current()
        if version is None:
            raise FileNotFoundError(f"nothing is published under {self.root}")
        return self.spark.read.parquet(self.path(version, table))

    def claim(self) -> str:
        """The next version number, claimed by creating a file that only one reload can create."""
        taken = [*self._names("claimed"), *self._names("published"), *self._names("versions")]
        number = max((int(v[1:]) for v in taken), default=0)
        while True:
            number += 1
            version = f"v{number:08d}"
            if self._files.create(f"claimed/{version}"):
                return version

    def publish(self, version: str) -> None:
        newest = self.current()
        if newest is not None and newest >= version:
            raise CheckFailed(f"{version} is older than the published {newest}")
        if not self._files.create(f"published/{version}"):
            raise CheckFailed(f"{version} is already published")

    def retire(self, keep: int) -> list[str]:
        """Removes all but the newest ``keep`` published versions, and unpublished ones older than the newest."""
        done = self.published()
        if not done:
            return []
        stay = set(done[-max(1, keep):])
        gone = [v for v in self._names("versions") if v not in stay and v < done[-1]]
        for v in gone:
            # readers stop finding the version before its files go
            for name in (f"published/{v}", f"versions/{v}", f"claimed/{v}"):
                self._files.delete(name)
        return gone

    def reload(self, tables: dict[str, Callable[[], DataFrame] | DataFrame],
               checks: Callable[[dict[str, DataFrame]], DataFrame] | None = None, keep: int = 3) -> str:
        """Stages ``tables``, checks them, publishes them and returns the version.

        ``checks`` gets the staged tables as they can be read back and returns
        the rules they broke (any rows); the rows are the error's text, and
        nothing is published.
        """
        version = self.claim()
        for name, df in tables.items():
            write_target(df() if callable(df) else df, self.path(version), name)
        staged = {name: self.spark.read.parquet(self.path(version, name)) for name in tables}
        if checks is not None:
            broken = checks(staged).limit(20).collect()                 # the limit is the error text's
            if broken:
                raise CheckFailed(f"{version}: " + "; ".join(", ".join(f"{k}={v}" for k, v in r.asDict().items()) for r in broken))
        self.publish(version)
        self.retire(keep)
        return version


class StagedTables:
    """Staged tables in the shape that the audits take."""

    def __init__(self, tables: dict[str, DataFrame]):
        self._tables = tables

    def targets(self, names: set[str] | None = None) -> dict[str, DataFrame]:
        return {n: df for n, df in self._tables.items() if names is None or n in names}


def broken_rules(tables: dict[str, DataFrame], accepted: dict[str, int] | None = None) -> DataFrame:
    """Rules of the audits J1-J3 that the tables break more often than ``accepted`` says (by rule; 0 elsewhere).

    ``accepted`` may also hold ``*``, the number accepted of every rule not named.
    """
    m = StagedTables(tables)
    found = (audits.fk_audit(m).select(F.col("constraint_name").alias("rule"), F.col("orphan_rows").alias("violations"))
             .unionByName(audits.key_audit(m).select(F.concat_ws("", F.col("table_name"), F.lit(" unique "), F.col("key_columns")).alias("rule"),
                                                     F.col("duplicate_keys").alias("violations")))
             .unionByName(audits.check_audit(m)))
    accepted = dict(accepted or {})
    limit = F.lit(accepted.pop("*", 0))
    for rule, n in accepted.items():
        limit = F.when(F.col("rule") == rule, F.lit(n)).otherwise(limit)
    return found.where(F.col("violations") > limit).orderBy("rule")
