"""Joins of the report: the dimension chain, its as-of form, key-set joins.

No broadcast hints: every dimension here grows with the data.  Spark itself
broadcasts a side only when its size is bounded: statically when the plan's
size estimate is under ``spark.sql.autoBroadcastJoinThreshold``, or at run
time when AQE has *measured* the side's shuffle output under
``spark.sql.adaptive.autoBroadcastJoinThreshold``.  Otherwise both sides
shuffle on the join key, and a card that holds a large share of the
operations is split by AQE's skew-join handling (the fact side of a left
join may be split; the dimension side has one row per key).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch import schemas as S
from cardwatch.functions import plus_days, ts_lit

CLIENT_COLS = ("client_id", "last_name", "first_name", "patronymic", "passport_num", "passport_valid_to", "phone")


def card_key(c: str | Column = "card_num") -> Column:
    """The source pads card numbers with blanks; the report joins on RTRIM."""
    return F.rtrim(F.col(c) if isinstance(c, str) else c)


def dimension_chain(cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                    extra: tuple[str, ...] = ()) -> DataFrame:
    """cards -> accounts -> clients, keyed by the trimmed card number.

    Joined among themselves first: ``tx ⟕ (cards ⟕ acc ⟕ cl)`` equals the
    source's ``((tx ⟕ cards) ⟕ acc) ⟕ cl`` because both later join predicates
    reject NULLs on the inner side, and the large fact then shuffles once
    instead of three times.  Every version of every dimension row takes part
    (the source applies no version filter), so several versions fan out.
    ``extra`` client columns (e.g. a blacklist flag computed per client) are
    carried along, so per-client facts are derived once per client, not per
    operation.
    """
    c = cards.select(card_key("card_num").alias("_card_key"), F.col("card_num").alias("dim_card_num"),
                     F.col("account_num").alias("_acc"))
    a = accounts.select(F.col("account_num").alias("_acc"), "valid_to", F.col("client").alias("_client"))
    cl = clients.select(F.col("client_id").alias("_client"), *[F.col(x) for x in CLIENT_COLS + tuple(extra)])
    return (
        c.join(a, "_acc", "left")
        .join(cl, "_client", "left")
        .select("_card_key", "dim_card_num", F.col("_acc").alias("account_num"), "valid_to", *CLIENT_COLS, *extra)
    )


def dim_chain_join(tx: DataFrame, cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                   extra: tuple[str, ...] = ()) -> DataFrame:
    """Every operation with its card, account and client (left joins)."""
    dims = dimension_chain(cards, accounts, clients, extra)
    return tx.join(dims, tx.card_num == dims._card_key, "left").drop("_card_key")


def trimmed_key_join(tx: DataFrame, cards: DataFrame) -> DataFrame:
    """``tx.card_num = RTRIM(cards.card_num)``, trimmed on the dimension
    side before the join so that it stays a hash-partitionable equi-join."""
    c = cards.select(card_key("card_num").alias("_card_key"), "account_num")
    return tx.join(c, tx.card_num == c._card_key, "left").drop("_card_key")


def valid_at(ts: Column, prefix: str = "") -> Column:
    """Version valid at ``ts``: ends are inclusive at day grain (a version that
    ends on day D covers all of D), and tombstones never match."""
    ef, et, fl = (F.col(f"{prefix}effective_from"), F.col(f"{prefix}effective_to"), F.col(f"{prefix}deleted_flg"))
    return (ts >= ef) & (ts < plus_days(et, 1)) & (fl == F.lit(S.FLAG_LIVE))


# time bounds of the gap versions (beyond any date the warehouse stores)
_T_MIN = _dt.datetime(1, 1, 1)
_T_MAX = _dt.datetime(9999, 12, 31)


def _timeline(dim: DataFrame, key: Column, cols: list[str], fill_gaps: bool = True) -> DataFrame:
    """Live versions of ``dim`` as half-open intervals ``[_from, _until)`` per
    ``_k``; with ``fill_gaps``, plus NULL "gap" versions for every stretch of a
    key's timeline that no live version covers, so the timeline of each key is
    covered completely.

    Gaps come from a running maximum of the earlier versions' ends, per key
    (a key has a handful of versions, so these windows are small)."""
    live = dim.filter(F.col("deleted_flg") == F.lit(S.FLAG_LIVE)).select(
        key.alias("_k"), *[F.col(c) for c in cols],
        F.col("effective_from").alias("_from"), plus_days("effective_to", 1).alias("_until"),
        F.col("effective_from").alias("_version_from"),
    ).filter(F.col("_from") < F.col("_until"))
    if not fill_gaps:
        return live
    order = Window.partitionBy("_k").orderBy("_from", "_until")
    x = live.select(
        "*",
        F.max("_until").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("_prev_end"),
        F.max("_until").over(Window.partitionBy("_k")).alias("_max_end"),
        F.lead("_from").over(order).isNull().alias("_last"),
    )
    nulls = [F.lit(None).cast(dim.schema[c].dataType).alias(c) for c in cols]
    no_version = F.lit(None).cast("timestamp_ntz").alias("_version_from")
    version = F.struct(*[F.col(c) for c in cols], "_from", "_until", "_version_from")
    gap_before = F.struct(*nulls, F.coalesce("_prev_end", ts_lit(_T_MIN)).alias("_from"),
                          F.col("_from").alias("_until"), no_version)
    gap_after = F.when(F.col("_last"), F.struct(*nulls, F.col("_max_end").alias("_from"),
                                                 ts_lit(_T_MAX).alias("_until"), no_version))
    # one pass: each version is emitted with the gap before it (and the last one with the gap after)
    out = x.select("_k", F.explode(F.array(version, gap_before, gap_after)).alias("_v"))
    return out.filter(F.col("_v").isNotNull()).select("_k", "_v.*").filter(F.col("_from") < F.col("_until"))


def _overlay(left: DataFrame, right: DataFrame, left_key: str, right_prefix: str) -> DataFrame:
    """Left join of two timelines on key and overlapping intervals; the result
    interval is the intersection (or the left interval when nothing matches)."""
    r = right.select([F.col(c).alias(f"{right_prefix}{c}") for c in right.columns])
    rf, ru = F.col(f"{right_prefix}_from"), F.col(f"{right_prefix}_until")
    cond = (F.col(left_key) == F.col(f"{right_prefix}_k")) & (F.col("_from") < ru) & (rf < F.col("_until"))
    j = left.join(r, cond, "left")
    matched = F.col(f"{right_prefix}_k").isNotNull()
    return (
        j.withColumn("_from", F.when(matched, F.greatest("_from", rf)).otherwise(F.col("_from")))
        .withColumn("_until", F.when(matched, F.least("_until", ru)).otherwise(F.col("_until")))
        .drop(f"{right_prefix}_k", f"{right_prefix}_from", f"{right_prefix}_until")
    )


def asof_dimension_chain(cards_hist: DataFrame, accounts_hist: DataFrame, clients_hist: DataFrame,
                         extra: tuple[str, ...] = ()) -> DataFrame:
    """cards -> accounts -> clients as of any time: one row per card and
    interval in which the combination of live versions is constant.

    Accounts and clients get gap versions (a card live while its account is
    not must still yield a row with NULL account); cards need none, because a
    time without a live card version finds no row and the fact's left join
    yields the NULLs itself."""
    c = _timeline(cards_hist, card_key("card_num"), ["account_num"], fill_gaps=False)
    a = _timeline(accounts_hist, F.col("account_num"), ["valid_to", "client"])
    cl = _timeline(clients_hist, F.col("client_id"), list(CLIENT_COLS + tuple(extra)))
    ca = _overlay(c.drop("_version_from"), a.drop("_version_from"), "account_num", "a_")
    cal = _overlay(ca, cl, "a_client", "l_")
    return cal.select(
        F.col("_k").alias("_card_key"), "_from", "_until", "account_num", F.col("a_valid_to").alias("valid_to"),
        *[F.col(f"l_{x}").alias(x) for x in CLIENT_COLS + tuple(extra)],
        F.col("l__version_from").alias("client_effective_from"),
    )


def asof_dim_chain(tx: DataFrame, cards_hist: DataFrame, accounts_hist: DataFrame, clients_hist: DataFrame,
                   ts_col: str = "trans_date", extra: tuple[str, ...] = ()) -> DataFrame:
    """The dimension chain with each dimension taken as of the operation time.

    The three dimension timelines are overlaid among themselves first (each
    key's timeline is completed with NULL gap versions, so a stretch without
    a live version still yields the left join's NULLs), and the fact is then
    joined once, on the card and the interval holding the operation time: one
    shuffle of the fact instead of three.  Equal to
    one as-of join per dimension, overlapping versions included.
    """
    dims = asof_dimension_chain(cards_hist, accounts_hist, clients_hist, extra)
    ts = F.col(ts_col)
    cond = (F.col("card_num") == F.col("_card_key")) & (ts >= F.col("_from")) & (ts < F.col("_until"))
    return tx.join(dims, cond, "left").drop("_card_key", "_from", "_until")


def missing_keys(hist: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Open live versions whose key is gone from the source (anti join)."""
    from cardwatch.operators.scd2 import is_live_open

    k = keys.select(F.col(keys.columns[0]).alias(key)).distinct()
    return hist.filter(is_live_open()).join(k, key, "left_anti")


def own_exchange(keys: DataFrame) -> DataFrame:
    """A de-duplicated key set as the build side of a join that AQE can split.

    A join on the key an aggregate is partitioned by reuses the aggregate's
    exchange, and AQE then leaves a hot key of the other side in one task.
    Dealing the key set out again, in as many partitions as AQE finds its size
    to need, gives the join an exchange of its own.
    """
    return keys.hint("rebalance")


def in_list_flag(df: DataFrame, value_col: str, values: DataFrame, alias: str = "in_list") -> DataFrame:
    """``value IN (SELECT ...)`` as a three-valued column.

    TRUE for a listed value; FALSE for any value against an empty list; NULL
    for a NULL value, and for an unlisted one when the list holds a NULL;
    else FALSE.  (Spark projects an IN-subquery as a two-valued existence
    test.)  A left join to the distinct list never fans out, and AQE may split
    a hot value; the two facts about the list are one one-row aggregate."""
    listed = values.select(F.col(values.columns[0]).alias("_listed"))
    of_list = listed.agg(F.struct(F.count("*").alias("rows"), F.count(F.when(F.col("_listed").isNull(), 1)).alias("nulls")).alias("f")).scalar()
    rows, nulls = of_list["rows"], of_list["nulls"]
    keys = own_exchange(listed.filter(F.col("_listed").isNotNull()).distinct())
    flag = (
        F.when(F.col("_listed").isNotNull(), F.lit(True))
        .when(rows == 0, F.lit(False))
        .when(F.col(value_col).isNull() | (nulls > 0), F.lit(None).cast("boolean"))
        .otherwise(F.lit(False))
    )
    return df.join(keys, F.col(value_col) == F.col("_listed"), "left").withColumn(alias, flag).drop("_listed")
