"""The driver's TPC-H-style tables reshaped into the warehouse's inputs.

The driver ships no card data, so each warehouse input is a projection of a
driver table (SURVEY §7.3): events are the card operations, supplier+nation
the terminals, customer the cards/clients/blacklist, orders the accounts.
``plans/sql_checks.py`` holds the same projections in DuckDB SQL; keep both
in step.  All projections are narrow selects over full tables: the work grows
with the data and the scans prune columns.
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch import schemas as S
from cardwatch.functions import epoch_us, from_epoch_us, plus_days, plus_years, ts_lit

# Fixed parameters of the driver-table scenario: the events span
# 2024-01-01 .. 2024-01-30, so the load date is in the middle.
LOAD_DT = _dt.datetime(2024, 1, 15)
CLIENTS_WATERMARK = _dt.datetime(2024, 1, 1)
BLACKLIST_WATERMARK = _dt.datetime(2024, 1, 10)
# A 20-minute probing window finds nothing in the driver tables; one day does.
PROBE_WINDOW_TESTDATA = _dt.timedelta(days=1)


def _mod(c: str, m: int) -> Column:
    return F.col(c) % F.lit(m)


def _key(c: str) -> Column:
    return F.col(c).cast("string")


class DriverTables:
    """Lazy warehouse-shaped views over ``{sf_dir}/{table}.parquet``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- card operations -------------------------------------------------------
    def _ops(self) -> DataFrame:
        ev = self.table("events")
        n_terminals = self.table("supplier").select(F.count(F.lit(1))).scalar()
        return ev.select(
            F.col("event_id"),
            F.col("ts"),
            _key("user_id").alias("card_num"),
            F.col("event_type").alias("oper_type"),
            F.col("value").cast(S.AMOUNT).alias("amt"),
            F.when(F.col("event_type") == "error", F.lit(S.RESULT_REJECT))
            .otherwise(F.lit(S.RESULT_SUCCESS))
            .alias("oper_result"),
            (F.col("event_id") % n_terminals).cast("string").alias("terminal"),
        )

    @cached_property
    def tx(self) -> DataFrame:
        """fact_transactions shape."""
        o = self._ops()
        return o.select(
            F.col("event_id").alias("trans_id"),
            F.col("ts").alias("trans_date"),
            "card_num",
            "oper_type",
            "amt",
            "oper_result",
            "terminal",
        )

    @cached_property
    def stg_tx(self) -> DataFrame:
        """stg_transactions shape (text id, as the feed delivers it)."""
        o = self._ops()
        return o.select(
            F.col("event_id").cast("string").alias("transaction_id"),
            F.col("ts").alias("transaction_date"),
            F.col("amt").alias("amount"),
            "card_num",
            "oper_type",
            "oper_result",
            "terminal",
        )

    # -- terminals ---------------------------------------------------------------
    @cached_property
    def term(self) -> DataFrame:
        sup = self.table("supplier")
        nat = self.table("nation")
        return sup.join(nat, sup.s_nationkey == nat.n_nationkey, "inner").select(
            _key("s_suppkey").alias("terminal_id"),
            F.when(_mod("s_suppkey", 3) == 0, F.lit("ATM")).otherwise(F.lit("POS")).alias("terminal_type"),
            F.col("n_name").alias("terminal_city"),
            F.col("s_name").alias("terminal_address"),
        )

    def _term_ids(self) -> DataFrame:
        return self.term.withColumn("_id", F.col("terminal_id").cast("long"))

    @cached_property
    def term_hist(self) -> DataFrame:
        t = self._term_ids().filter(F.col("_id") % 5 != 0)
        cur = t.select(
            "terminal_id", "terminal_type", "terminal_city", "terminal_address",
            ts_lit("2024-01-01").alias("effective_from"),
            ts_lit(S.OPEN_END).alias("effective_to"),
            F.lit(S.FLAG_LIVE).alias("deleted_flg"),
        )
        old = t.filter(F.col("_id") % 4 == 0).select(
            "terminal_id", "terminal_type",
            F.concat(F.lit("OLD_"), F.col("terminal_city")).alias("terminal_city"),
            "terminal_address",
            ts_lit("2023-01-01").alias("effective_from"),
            ts_lit("2023-12-31").alias("effective_to"),
            F.lit(S.FLAG_LIVE).alias("deleted_flg"),
        )
        return cur.unionByName(old)

    @cached_property
    def term_file(self) -> DataFrame:
        t = self._term_ids().filter(F.col("_id") % 6 != 0)
        return t.select(
            "terminal_id", "terminal_type",
            F.when(F.col("_id") % 7 == 0, F.concat(F.lit("NEW_"), F.col("terminal_city")))
            .otherwise(F.col("terminal_city")).alias("terminal_city"),
            "terminal_address",
        )

    # -- cards and accounts --------------------------------------------------------
    @cached_property
    def cards(self) -> DataFrame:
        """Cards; odd numbers arrive blank-padded, as the source's do."""
        c = self.table("customer")
        return c.select(
            F.concat(_key("c_custkey"), F.when(_mod("c_custkey", 2) == 1, F.lit("  ")).otherwise(F.lit("")))
            .alias("card_num"),
            (F.col("c_custkey") * 10).cast("string").alias("account_num"),
        )

    @cached_property
    def cards_src(self) -> DataFrame:
        c = self.table("customer")
        return c.select(
            F.concat(_key("c_custkey"), F.when(_mod("c_custkey", 2) == 1, F.lit("  ")).otherwise(F.lit("")))
            .alias("card_num"),
            (F.col("c_custkey") * 10).cast("string").alias("account"),
            plus_days(ts_lit("2020-01-01"), (F.col("c_custkey") % 1000).cast("int")).alias("create_dt"),
            F.when(_mod("c_custkey", 4) == 0, ts_lit("2024-01-11 08:00:00")).alias("update_dt"),
        )

    @cached_property
    def acc(self) -> DataFrame:
        o = self.table("orders")
        return o.select(
            _key("o_orderkey").alias("account_num"),
            plus_years("o_orderdate", 26).alias("valid_to"),
            _key("o_custkey").alias("client"),
        )

    @cached_property
    def acc_src(self) -> DataFrame:
        o = self.table("orders")
        return o.select(
            _key("o_orderkey").alias("account"),
            plus_years("o_orderdate", 26).alias("valid_to"),
            _key("o_custkey").alias("client"),
            F.col("o_orderdate").alias("create_dt"),
            F.when(_mod("o_orderkey", 9) == 0, ts_lit("2024-01-13 10:30:00")).alias("update_dt"),
        )

    # -- clients ----------------------------------------------------------------
    def _client_cols(self, c: DataFrame, updated: Column | None = None) -> list[Column]:
        valid_to = F.when(_mod("c_custkey", 11) == 0, F.lit(None).cast("timestamp_ntz")).otherwise(
            plus_days(ts_lit("2023-06-01"), ((F.col("c_custkey") * 53) % 800).cast("int"))
        )
        if updated is not None:
            valid_to = F.when(updated, plus_days(valid_to, 400)).otherwise(valid_to)
        return [
            _key("c_custkey").alias("client_id"),
            F.col("c_mktsegment").alias("last_name"),
            F.when(_mod("c_custkey", 19) == 0, F.lit(None).cast("string")).otherwise(F.col("c_name")).alias("first_name"),
            F.when(_mod("c_custkey", 3) == 0, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("N"), _key("c_nationkey"))).alias("patronymic"),
            plus_days(ts_lit("1950-01-01"), ((F.col("c_custkey") * 37) % 18000).cast("int")).alias("date_of_birth"),
            F.col("c_name").alias("passport_num"),
            valid_to.alias("passport_valid_to"),
            F.concat(F.lit("+7"), F.lpad(_key("c_custkey"), 10, "0")).alias("phone"),
        ]

    @cached_property
    def cl(self) -> DataFrame:
        c = self.table("customer")
        return c.select(*self._client_cols(c))

    @cached_property
    def bl(self) -> DataFrame:
        """Passport blacklist feed / fact."""
        c = self.table("customer").filter(_mod("c_custkey", 17) == 0)
        return c.select(
            plus_days(ts_lit("2024-01-01"), (F.col("c_custkey") % 30).cast("int")).alias("entry_dt"),
            F.col("c_name").alias("passport_num"),
        )

    @cached_property
    def hist(self) -> DataFrame:
        """dim_clients_hist before the load: every 10th customer is not there yet."""
        c = self.table("customer").filter(_mod("c_custkey", 10) != 0)
        return c.select(
            *self._client_cols(c),
            ts_lit("2020-01-01").alias("effective_from"),
            ts_lit(S.OPEN_END).alias("effective_to"),
            F.lit(S.FLAG_LIVE).alias("deleted_flg"),
        )

    @cached_property
    def src(self) -> DataFrame:
        """Client source table: every 13th customer deleted, some new, some changed."""
        return self.src_all.filter(F.col("client_id").cast("long") % 13 != 0)

    @cached_property
    def src_all(self) -> DataFrame:
        """Client source table before any deletion."""
        c = self.table("customer")
        updated = (_mod("c_custkey", 10) != 0) & (_mod("c_custkey", 7) == 0)
        return c.select(
            *self._client_cols(c, updated),
            F.when(_mod("c_custkey", 10) == 0, ts_lit("2024-01-10")).otherwise(ts_lit("2020-01-01")).alias("create_dt"),
            F.when(updated, ts_lit("2024-01-12")).alias("update_dt"),
        )

    @cached_property
    def tx_dense(self) -> DataFrame:
        """Operations with their times compressed 72-fold (a day becomes 20 minutes)."""
        start = epoch_us(ts_lit("2024-01-01"))
        us = start + F.floor((epoch_us("trans_date") - start) / 72)
        return self.tx.withColumn("trans_date", from_epoch_us(us))

    # -- single-version dims for the as-of report -----------------------------------
    @cached_property
    def cards_hist(self) -> DataFrame:
        return self.cards.select(
            "card_num", "account_num",
            ts_lit("2020-01-01").alias("effective_from"),
            ts_lit(S.OPEN_END).alias("effective_to"),
            F.lit(S.FLAG_LIVE).alias("deleted_flg"),
        )

    @cached_property
    def acc_hist(self) -> DataFrame:
        return self.acc.select(
            "account_num", "valid_to", "client",
            ts_lit("2020-01-01").alias("effective_from"),
            ts_lit(S.OPEN_END).alias("effective_to"),
            F.lit(S.FLAG_LIVE).alias("deleted_flg"),
        )

    @cached_property
    def term_dim(self) -> DataFrame:
        """Terminal dimension for the rules: one open version per supplier."""
        return self.term.select(
            "terminal_id", "terminal_type", "terminal_city", "terminal_address",
            ts_lit("2020-01-01").alias("effective_from"),
            ts_lit(S.OPEN_END).alias("effective_to"),
            F.lit(S.FLAG_LIVE).alias("deleted_flg"),
        )

    @cached_property
    def meta_seed(self) -> DataFrame:
        from cardwatch.operators.extract import seed_watermarks

        return seed_watermarks(self.spark)
