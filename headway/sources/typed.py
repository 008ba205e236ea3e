"""A1: source tables read against their declared schema, from Parquet or CSV.

Every column is brought to its declared type.  A row with a value that doesn't
fit (a text that is no number, a fraction where a whole number is due, a number
beyond the type's range), with a missing key, or with more or fewer fields
than its CSV header names, doesn't reach the jobs: it goes to the table's
rejects with every reason and the row as JSON.  A column the source lacks is
added as NULL when a row can do without it, otherwise reading fails before
any job runs.  Columns that aren't declared are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.sources.catalog import SourceCatalog
from headway.sources.schemas import REQUIRED, SOURCE_SCHEMAS

_CORRUPT = "_hw_corrupt"
_REASONS = "_hw_reasons"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


class MissingColumns(ValueError):
    """A source lacks columns that its rows can't do without."""


def _raw(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    if fmt == "parquet":
        return spark.read.parquet(path)
    if fmt != "csv":
        raise ValueError(f"unknown source format: {fmt}")
    header = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in header] + [T.StructField(_CORRUPT, T.StringType())])
    # an unquoted empty field (or \N) is NULL, a quoted one the empty text; rows are held against the header whole
    return (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT)
            .option("nullValue", "\\N").option("columnPruning", False).csv(path))


def _misfit(field: T.StructField, source: T.DataType) -> Column:
    """Whether a value is there but has no equal in the declared type."""
    col = F.col(f"`{field.name}`")
    cast = col.try_cast(field.dataType)
    lost = col.isNotNull() & cast.isNull()
    if isinstance(field.dataType, _WHOLE) and isinstance(source, (T.FractionalType, T.DecimalType)):
        lost = lost | (col != F.floor(col))
    return F.coalesce(lost, F.lit(False))


def typed(raw: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """The rows that fit the declared schema, and the rejects (``table_name, reasons, row``)."""
    schema = T.StructType.fromDDL(SOURCE_SCHEMAS[table])
    needed = REQUIRED.get(table, [])
    if lacking := [c for c in needed if c not in raw.columns]:
        raise MissingColumns(f"{table}: no column {', '.join(lacking)}")
    reasons = []
    if _CORRUPT in raw.columns:
        reasons.append(F.when(F.col(_CORRUPT).isNotNull(), F.lit("fields don't match the header")))
    out = []
    for field in schema.fields:
        if field.name not in raw.columns:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        col, source = F.col(f"`{field.name}`"), raw.schema[field.name].dataType
        out.append(col.try_cast(field.dataType).alias(field.name))
        if source != field.dataType:
            reasons.append(F.when(_misfit(field, source), F.lit(f"{field.name}: not a {field.dataType.simpleString()}")))
        if field.name in needed:
            reasons.append(F.when(col.isNull(), F.lit(f"{field.name}: missing")))
    if not reasons:
        return raw.select(*out), raw.sparkSession.createDataFrame([], "table_name string, reasons array<string>, row string")
    marked = raw.withColumn(_REASONS, F.filter(F.array(*reasons), lambda r: r.isNotNull()))
    shown = [F.col(f"`{c}`") for c in raw.columns]
    rejects = marked.where(F.size(_REASONS) > 0).select(F.lit(table).alias("table_name"), F.col(_REASONS).alias("reasons"),
                                                        F.to_json(F.struct(*shown)).alias("row"))
    return marked.where(F.size(_REASONS) == 0).select(*out), rejects


class TypedSource:
    """Source tables under ``root`` (``<root>/<table>.parquet`` or ``.csv``) with their rejects."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet", tables: list[str] | None = None):
        self.spark = spark
        self.tables = list(SOURCE_SCHEMAS if tables is None else tables)
        self._read = {t: typed(_raw(spark, f"{root.rstrip('/')}/{t}.{fmt}", fmt), t) for t in self.tables}

    def catalog(self) -> SourceCatalog:
        return SourceCatalog(self.spark, {t: (lambda t=t: self._read[t][0]) for t in self.tables})

    def rejects(self) -> DataFrame:
        """All rejected rows."""
        out = None
        for t in self.tables:
            out = self._read[t][1] if out is None else out.unionByName(self._read[t][1])
        return out

    def write_rejects(self, path: str) -> DataFrame:
        """Stores the rejects by table and returns their count by table and reason."""
        self.rejects().write.mode("overwrite").partitionBy("table_name").parquet(path)
        schema = "reasons array<string>, row string, table_name string"
        return (self.spark.read.schema(schema).parquet(path).select("table_name", F.explode("reasons").alias("reason"))
                .groupBy("table_name", "reason").agg(F.count(F.lit(1)).alias("n_rows")))
