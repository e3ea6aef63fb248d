"""Plain forms that the package's operators are held against."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.functions import ts_lit
from cardwatch.operators.joins import CLIENT_COLS, card_key, valid_at


def _versions(dim: DataFrame, key: str, cols: list[str], prefix: str) -> DataFrame:
    return dim.select(
        F.col(key).alias(f"{prefix}key"),
        *[F.col(c).alias(f"{prefix}{c}") for c in cols],
        F.col("effective_from").alias(f"{prefix}effective_from"),
        F.col("effective_to").alias(f"{prefix}effective_to"),
        F.col("deleted_flg").alias(f"{prefix}deleted_flg"),
    )


def asof_join(left: DataFrame, dim: DataFrame, left_key: Column, dim_key: str, ts_col: str,
              cols: list[str], prefix: str) -> DataFrame:
    """Left join to the dimension version valid at ``left[ts_col]``.

    An equi-join on the key with the validity test as its residual condition:
    each key has few versions, so the residual costs a handful of comparisons.
    """
    v = _versions(dim, dim_key, cols, prefix)
    cond = (left_key == F.col(f"{prefix}key")) & valid_at(F.col(ts_col), prefix)
    out = left.join(v, cond, "left")
    return out.drop(f"{prefix}key", f"{prefix}effective_to", f"{prefix}deleted_flg")


def asof_dim_chain_sequential(tx: DataFrame, cards_hist: DataFrame, accounts_hist: DataFrame,
                              clients_hist: DataFrame, ts_col: str = "trans_date",
                              extra: tuple[str, ...] = ()) -> DataFrame:
    """The dimension chain as of the operation time, one as-of join per
    dimension (the fact is shuffled once per dimension).  """
    j = asof_join(tx, cards_hist.withColumn("card_num", card_key("card_num")), F.col("card_num"),
                  "card_num", ts_col, ["account_num"], "c_")
    j = asof_join(j, accounts_hist, F.col("c_account_num"), "account_num", ts_col, ["valid_to", "client"], "a_")
    j = asof_join(j, clients_hist, F.col("a_client"), "client_id", ts_col, list(CLIENT_COLS + tuple(extra)), "l_")
    return j.select(
        *tx.columns,
        F.col("c_account_num").alias("account_num"),
        F.col("a_valid_to").alias("valid_to"),
        *[F.col(f"l_{c}").alias(c) for c in CLIENT_COLS + tuple(extra)],
        F.col("l_effective_from").alias("client_effective_from"),
    )


def rule_passport(blacklist: DataFrame, load_dt: _dt.datetime) -> Column:
    """R1 as written: ``valid_to IS NOT NULL AND passport IN (blacklist) OR
    valid_to < load date`` (AND binds tighter: a listed passport without
    expiry date is not flagged)."""
    listed = F.col("passport_num").isin(blacklist.select("passport_num"))
    return (F.col("passport_valid_to").isNotNull() & listed) | (F.col("passport_valid_to") < ts_lit(load_dt))
