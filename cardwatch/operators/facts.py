"""Append-only facts."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch import schemas as S
from cardwatch.functions import ts_lit


def load_fact_transactions(stage: DataFrame) -> DataFrame:
    """Staged transactions -> fact rows: renames, the id as an integer, the
    amount as decimal(10,2), and the fact's column order (amount after type).

    The id cast follows the session's ANSI mode: with it (Spark's default) a
    non-numeric id fails the load, as the source's cast does; see
    :func:`transaction_rejects` for a non-failing check.
    """
    return stage.select(
        F.col("transaction_id").cast("bigint").alias("trans_id"),
        F.col("transaction_date").alias("trans_date"),
        "card_num",
        "oper_type",
        F.col("amount").cast(S.AMOUNT).alias("amt"),
        "oper_result",
        "terminal",
    )


def transaction_rejects(stage: DataFrame) -> DataFrame:
    """Staged rows whose id or amount would not cast."""
    bad_id = F.col("transaction_id").isNotNull() & F.expr("try_cast(transaction_id AS BIGINT)").isNull()
    bad_amt = F.col("amount").isNotNull() & F.expr("try_cast(amount AS DECIMAL(10,2))").isNull()
    return stage.filter(bad_id | bad_amt)


def load_fact_blacklist(feed: DataFrame, watermark: _dt.datetime, date_col: str = "entry_dt",
                        passport_col: str = "passport_num") -> DataFrame:
    """Blacklist rows newer than the fact's watermark (the feed is cumulative)."""
    return feed.filter(F.col(date_col) > ts_lit(watermark)).select(
        F.col(date_col).alias("entry_dt"), F.col(passport_col).alias("passport_num")
    )
