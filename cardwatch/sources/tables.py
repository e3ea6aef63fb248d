"""Source tables (S4): accounts, cards, clients in their current state.

Any DataFrame works as a source; these helpers read the usual kinds so that
the watermark filter of :func:`~cardwatch.operators.extract.incremental_extract`
(a literal) reaches the storage: parquet row-group statistics, a catalog
table's partitions, or the WHERE clause Spark's JDBC source sends to the
database.  A JDBC read is split into ``num_partitions`` range queries over a
numeric column when one is given, so no single connection pulls the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cardwatch import schemas as S
from cardwatch.functions import empty_as_null

SOURCE_SCHEMAS: dict[str, T.StructType] = {
    "accounts": S.SRC_ACCOUNTS,
    "cards": S.SRC_CARDS,
    "clients": S.SRC_CLIENTS,
}


def _typed(df: DataFrame, kind: str, names: dict[str, str] | None = None) -> DataFrame:
    """Source columns in the warehouse's types; '' read as NULL (the source
    dialect cannot store an empty string)."""
    names = names or {}
    out = []
    for f in SOURCE_SCHEMAS[kind].fields:
        c = df[names.get(f.name.lower(), f.name)].cast(f.dataType)
        out.append((empty_as_null(c) if isinstance(f.dataType, T.StringType) else c).alias(f.name))
    return df.select(*out)


def source_parquet(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return _typed(spark.read.schema(SOURCE_SCHEMAS[kind]).parquet(path), kind)


def source_table(spark: SparkSession, name: str, kind: str) -> DataFrame:
    return _typed(spark.table(name), kind)


def source_jdbc(spark: SparkSession, url: str, table: str, kind: str, properties: dict[str, str] | None = None,
                partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
                num_partitions: int | None = None) -> DataFrame:
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", num_partitions or 8))
    df = r.load()
    return _typed(df, kind, {c.lower(): c for c in df.columns})
