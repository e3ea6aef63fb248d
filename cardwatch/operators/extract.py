"""Incremental extract, key snapshots and load watermarks."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch import schemas as S
from cardwatch.functions import ts_lit

Watermark = _dt.datetime | Column


def _wm(value: Watermark) -> Column:
    return value if isinstance(value, Column) else ts_lit(value)


def change_ts(update_col: str = "update_dt", create_col: str = "create_dt") -> Column:
    return F.coalesce(F.col(update_col), F.col(create_col))


def incremental_extract(
    source: DataFrame, watermark: Watermark, update_col: str = "update_dt", create_col: str = "create_dt"
) -> DataFrame:
    """Rows changed after the watermark: ``coalesce(update_dt, create_dt) > wm`` (strict).

    The exact predicate is not pushable (``coalesce``), so the implied
    ``update_dt > wm OR create_dt > wm`` is added: it reaches the parquet scan
    (or the JDBC query) and skips row groups; the exact test runs after it.
    Pass the watermark as a Python value so it is a literal in the plan.
    """
    wm = _wm(watermark)
    implied = (F.col(update_col) > wm) | (F.col(create_col) > wm)
    return source.filter(implied).filter(change_ts(update_col, create_col) > wm)


def key_snapshot(source: DataFrame, key: str, alias: str | None = None) -> DataFrame:
    """Every key now present in the source (for delete detection by anti join)."""
    return source.select(F.col(key).alias(alias or key))


# --- load watermarks ----------------------------------------------------------------

def seed_watermarks(spark: SparkSession, dbname: str = S.META_DB) -> DataFrame:
    """The six watermark rows, all at the beginning of time."""
    rows = [(S.BEGINNING, dbname, t) for t in S.WATERMARK_TABLES]
    return spark.createDataFrame(rows, S.META_DATA)


def read_watermark(meta: DataFrame, table_name: str, dbname: str = S.META_DB) -> DataFrame:
    """One-row frame with the watermark of ``table_name``."""
    return meta.filter((F.col("dbname") == dbname) & (F.col("table_name") == table_name)).select(
        "table_name", "last_update_dt"
    )


def read_watermark_value(meta: DataFrame, table_name: str, dbname: str = S.META_DB) -> _dt.datetime:
    """The watermark as a Python value, so that a later filter on it is a literal
    that reaches the scan.  Exactly one row is expected (the source fetches one)."""
    rows = read_watermark(meta, table_name, dbname).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected one watermark row for {dbname}.{table_name}, found {len(rows)}")
    value = rows[0]["last_update_dt"]
    if value is None:
        raise ValueError(f"watermark of {dbname}.{table_name} is NULL")
    return value


def advance_watermarks(
    meta: DataFrame,
    dim_deltas: Mapping[str, DataFrame],
    terminals_dt_next: _dt.datetime | None,
    blacklist_stage: DataFrame | None,
    transactions_stage: DataFrame | None,
    literal: bool = False,
    dbname: str = S.META_DB,
) -> DataFrame:
    """New watermark rows after a load.

    * dimensions: ``max(coalesce(update_dt, create_dt))`` of their delta, kept
      unchanged when the delta is empty;
    * terminals: the day after the load date;
    * facts: the newest staged ``entry_dt`` / ``transaction_date``.  The source
      assigns that max even when the feed is empty, i.e. NULL; ``literal=True``
      keeps that, the default keeps the old value instead.

    Each new value is a global aggregate (partial per task, one row out), so the
    frame joined back to ``meta`` has at most six rows by construction.
    """
    spark = meta.sparkSession
    parts: list[DataFrame] = []

    def one(table: str, value: Column, guarded: bool) -> DataFrame:
        return value.alias("new_dt"), F.lit(table).alias("table_name"), F.lit(guarded).alias("guarded")

    for table, delta in dim_deltas.items():
        parts.append(delta.agg(*one(table, F.max(change_ts()), True)))
    if terminals_dt_next is not None:
        parts.append(spark.range(1).select(*one(S.WM_TERMINALS, ts_lit(terminals_dt_next), True)))
    if blacklist_stage is not None:
        parts.append(blacklist_stage.agg(*one(S.WM_BLACKLIST, F.max("entry_dt"), not literal)))
    if transactions_stage is not None:
        parts.append(transactions_stage.agg(*one(S.WM_TRANSACTIONS, F.max("transaction_date"), not literal)))
    if not parts:
        return meta
    updates = parts[0]
    for p in parts[1:]:
        updates = updates.unionByName(p)
    updates = updates.withColumn("dbname", F.lit(dbname))

    m = meta.alias("m").join(F.broadcast(updates.alias("u")), ["dbname", "table_name"], "left")
    new_value = (
        F.when(F.col("u.guarded").isNull(), F.col("m.last_update_dt"))
        .when(F.col("u.guarded") & F.col("u.new_dt").isNull(), F.col("m.last_update_dt"))
        .otherwise(F.col("u.new_dt"))
    )
    return m.select(new_value.alias("last_update_dt"), "dbname", "table_name")


def advance_watermarks_to(
    meta: DataFrame, reached: Mapping[str, _dt.datetime | None], literal: bool = False, dbname: str = S.META_DB
) -> DataFrame:
    """As :func:`advance_watermarks`, from the newest times that the load itself observed (six at most).

    A table that is not in ``reached`` keeps its watermark; one without a newest
    time (nothing was loaded) keeps it too, but for the facts with ``literal``.
    """
    value = F.col("last_update_dt")
    for table, newest in reached.items():
        own = (F.col("dbname") == dbname) & (F.col("table_name") == table)
        if newest is not None:
            value = F.when(own, ts_lit(newest)).otherwise(value)
        elif literal and table in (S.WM_BLACKLIST, S.WM_TRANSACTIONS):
            value = F.when(own, F.lit(None).cast("timestamp_ntz")).otherwise(value)
    return meta.select(value.alias("last_update_dt"), "dbname", "table_name")
