"""Per-operation rules R1, R2 and the classifier R5.

Rules are Column expressions over a row of the dimension chain; R3/R4 live in
``velocity`` and ``probing`` and enter the classifier as a membership test
(per card) or as the source's single global timestamp (literal).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch import schemas as S
from cardwatch.functions import ts_lit
from cardwatch.operators.joins import own_exchange


def flag_blacklisted(clients: DataFrame, blacklist: DataFrame) -> DataFrame:
    """``_bl_listed``: the passport is in the blacklist (NULL and no match are
    both FALSE, as a CASE branch takes them), computed on the clients
    dimension: once per client version instead of once per operation.  A left
    join to the distinct list, so clients that share one passport can be split."""
    listed = own_exchange(blacklist.select(F.col("passport_num").alias("_bl_passport")).distinct())
    return (
        clients.join(listed, F.col("passport_num") == F.col("_bl_passport"), "left")
        .withColumn("_bl_listed", F.col("_bl_passport").isNotNull())
        .drop("_bl_passport")
    )


def rule_passport_listed(load_dt: _dt.datetime) -> Column:
    """R1 as written, over rows carrying ``_bl_listed`` (see :func:`flag_blacklisted`)."""
    return (F.col("passport_valid_to").isNotNull() & F.col("_bl_listed")) | (
        F.col("passport_valid_to") < ts_lit(load_dt))


def blacklist_since(blacklist: DataFrame) -> DataFrame:
    """First listing date per passport: one row per passport, so a join on it
    never fans out, and it is much smaller than the feed history."""
    return blacklist.groupBy(F.col("passport_num").alias("_bl_passport")).agg(F.min("entry_dt").alias("_bl_since"))


def with_blacklist_since(df: DataFrame, blacklist: DataFrame) -> DataFrame:
    """Adds ``_bl_since``; apply it to the clients dimension before the fact join."""
    b = own_exchange(blacklist_since(blacklist))
    return df.join(b, df.passport_num == b._bl_passport, "left").drop("_bl_passport")


def rule_passport_corrected(ts_col: str = "trans_date") -> Column:
    """R1 as meant: listed at the operation time, or expired before it.
    Needs ``_bl_since`` from :func:`with_blacklist_since`."""
    ts = F.col(ts_col)
    return (F.col("_bl_since") <= ts) | (F.col("passport_valid_to") < ts)


def rule_contract(load_dt: _dt.datetime) -> Column:
    """R2 as written: the account's contract ended before the load date."""
    return F.col("valid_to") < ts_lit(load_dt)


def rule_contract_corrected(ts_col: str = "trans_date") -> Column:
    """R2 as meant: the contract ended before the operation."""
    return F.col("valid_to") < F.col(ts_col)


def classify(r1: Column, r2: Column, r3: Column, r4: Column) -> Column:
    """The first rule that holds names the event (CASE: NULL is not true)."""
    return (
        F.when(r1, F.lit(S.EventType.PASSPORT_INVALID))
        .when(r2, F.lit(S.EventType.CONTRACT_EXPIRED))
        .when(r3, F.lit(S.EventType.CITY_VELOCITY))
        .when(r4, F.lit(S.EventType.AMOUNT_PROBING))
        .otherwise(F.lit(S.EventType.OK))
    )


def event_label(code: Column) -> Column:
    """Map event codes to the source's labels."""
    m = F.create_map(*[x for k, v in S.EventType.LABELS.items() for x in (F.lit(k), F.lit(v))])
    return m[code]
