"""Registered queries: every operator of the inventory run on the driver tables.

Each builder takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
full tables (``sources.testdata.DriverTables``).  ``sql_checks`` holds the
same queries as plain SQL for DuckDB, written the way the source writes them
(self-joins, LEFT JOIN ... IS NULL, correlated subqueries), so the check is
independent of the Spark formulation.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from cardwatch import schemas as S
from cardwatch.functions import concat_nullable, ts_lit
from cardwatch.operators.extract import (
    advance_watermarks,
    incremental_extract,
    key_snapshot,
    read_watermark,
)
from cardwatch.operators.facts import load_fact_blacklist, load_fact_transactions
from cardwatch.operators.digests import missing_keys_by_digest, scd2_delete_by_digest
from cardwatch.operators.joins import asof_dim_chain, dim_chain_join, in_list_flag, missing_keys, trimmed_key_join
from cardwatch.operators.probing import probing_anchor, probing_ids
from cardwatch.operators.rules import (
    rule_contract,
    rule_contract_corrected,
    flag_blacklisted,
    rule_passport_corrected,
    rule_passport_listed,
    with_blacklist_since,
)
from cardwatch.operators.scd2 import (
    ACCOUNTS,
    CARDS,
    CLIENTS,
    TERMINALS,
    scd2_close,
    scd2_delete,
    scd2_insert,
    scd2_load,
    snapshot_scd2,
    snapshot_scd2_corrected,
)
from cardwatch.operators.velocity import city_ops, velocity_anchor, velocity_ids
from cardwatch.plans.report import Windows, classified, fraud_report, fraud_report_asof
from cardwatch.sources.feeds import BLACKLIST_FILE, FEED_OPTIONS, clean, load_date_column
from cardwatch.sources.testdata import (
    BLACKLIST_WATERMARK,
    CLIENTS_WATERMARK,
    LOAD_DT,
    PROBE_WINDOW_TESTDATA,
    DriverTables,
)
from cardwatch.sources.workbook import to_workbooks, workbook_rows

Query = Callable[[SparkSession, str], DataFrame]
WINDOWS = Windows(probe=PROBE_WINDOW_TESTDATA)


def _t(spark: SparkSession, sf_dir: str) -> DriverTables:
    return DriverTables(spark, sf_dir)


def _delta(t: DriverTables) -> DataFrame:
    return incremental_extract(t.src, CLIENTS_WATERMARK)


def _keys(t: DriverTables) -> DataFrame:
    return key_snapshot(t.src, "client_id")


def _clients_after_load(t: DriverTables) -> DataFrame:
    return scd2_load(t.hist, _delta(t), _keys(t), LOAD_DT, CLIENTS)


def _chain(t: DriverTables) -> DataFrame:
    return dim_chain_join(t.tx, t.cards, t.acc, t.cl)


def _advanced_meta(t: DriverTables) -> DataFrame:
    deltas = {
        S.WM_ACCOUNTS: incremental_extract(t.acc_src, S.BEGINNING),
        S.WM_CARDS: incremental_extract(t.cards_src, S.BEGINNING),
        S.WM_CLIENTS: incremental_extract(t.src_all, S.BEGINNING),
    }
    return advance_watermarks(
        t.meta_seed, deltas, LOAD_DT + _dt.timedelta(days=1),
        load_fact_blacklist(t.bl, S.BEGINNING), t.stg_tx,
    )


def q_incremental_extract(spark, d):
    return _delta(_t(spark, d))


def q_parse_transactions(spark, d):
    """Feed lines (``;``, decimal comma) rendered from the operations and parsed with the feed readers' options,
    with the load date of their file's name."""
    stamp = F.date_format("transaction_date", "yyyy-MM-dd HH:mm:ss")
    amount = F.regexp_replace(F.col("amount").cast("string"), r"\.", ",")
    line = F.concat_ws(";", "transaction_id", stamp, amount, "card_num", "oper_type", "oper_result", "terminal")
    name = F.concat(F.lit("transactions_"), F.date_format("transaction_date", "ddMMyyyy"), F.lit(".txt"))
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.STG_TRANSACTIONS.fields)
    rows = _t(spark, d).stg_tx.select(F.from_csv(line, ddl, FEED_OPTIONS).alias("r"), load_date_column(name).alias("load_dt"))
    return rows.select("r.*", "load_dt")


def q_parse_terminals(spark, d):
    """Terminal workbooks made of the terminal file's rows, read back (S3)."""
    files = to_workbooks(_t(spark, d).term_file.select(*S.STG_TERMINALS.fieldNames()))
    return clean(workbook_rows(files, S.STG_TERMINALS))


def q_parse_blacklist(spark, d):
    """Blacklist workbooks made of the list's rows, dates as serials, read back."""
    rows = _t(spark, d).bl.select(F.col("entry_dt").cast("timestamp_ntz").alias("date"), F.col("passport_num").alias("passport"))
    listed = clean(workbook_rows(to_workbooks(rows), BLACKLIST_FILE))
    return listed.select(F.col("date").alias("entry_dt"), F.col("passport").alias("passport_num"))


def q_key_snapshot(spark, d):
    return key_snapshot(_t(spark, d).src_all, "client_id")


def q_scd2_insert(spark, d):
    t = _t(spark, d)
    return scd2_insert(t.hist, _delta(t), CLIENTS)


def q_scd2_close(spark, d):
    t = _t(spark, d)
    return scd2_close(t.hist, _delta(t), CLIENTS)


def q_scd2_delete(spark, d):
    t = _t(spark, d)
    return scd2_delete(t.hist, _keys(t), LOAD_DT, CLIENTS)


def q_scd2_delete_by_digest(spark, d):
    """C5 again; rows whose group of keys agrees with the source pass through without a shuffle."""
    t = _t(spark, d)
    return scd2_delete_by_digest(t.hist, _keys(t), LOAD_DT, CLIENTS)


def q_scd2_delete_corrected(spark, d):
    t = _t(spark, d)
    return scd2_delete(t.hist, _keys(t), LOAD_DT, CLIENTS, corrected=True)


def q_scd2_full(spark, d):
    return _clients_after_load(_t(spark, d))


def q_scd2_full_corrected(spark, d):
    t = _t(spark, d)
    return scd2_load(t.hist, _delta(t), _keys(t), LOAD_DT, CLIENTS, corrected=True)


def q_snapshot_scd2(spark, d):
    t = _t(spark, d)
    return snapshot_scd2(t.term_hist, t.term_file, LOAD_DT)


def q_snapshot_scd2_corrected(spark, d):
    t = _t(spark, d)
    return snapshot_scd2_corrected(t.term_hist, t.term_file, LOAD_DT)


def q_load_fact_transactions(spark, d):
    return load_fact_transactions(_t(spark, d).stg_tx)


def q_load_fact_blacklist(spark, d):
    return load_fact_blacklist(_t(spark, d).bl, BLACKLIST_WATERMARK)


def q_advance_watermarks(spark, d):
    return _advanced_meta(_t(spark, d))


def q_read_watermark(spark, d):
    return read_watermark(_advanced_meta(_t(spark, d)), S.WM_CLIENTS)


def q_dim_chain_join(spark, d):
    return _chain(_t(spark, d)).select(
        "trans_id", "trans_date", "card_num", "dim_card_num", "account_num", "valid_to",
        "client_id", "passport_num", "passport_valid_to", "phone",
    )


def q_asof_join(spark, d):
    t = _t(spark, d)
    j = asof_dim_chain(t.tx, t.cards_hist, t.acc_hist, _clients_after_load(t))
    return j.select("trans_id", "trans_date", "account_num", "client_id", "passport_valid_to",
                    "client_effective_from")


def q_asof_join_versions(spark, d):
    """The as-of chain over cards, accounts and clients that all went through an SCD2 load: several versions
    per key, overlaps of the literal delete, tombstones."""
    j = asof_dim_chain(_t(spark, d).tx, q_scd2_full_cards(spark, d), q_scd2_full_accounts(spark, d),
                       _clients_after_load(_t(spark, d)))
    return j.select("trans_id", "trans_date", "account_num", "client_id", "passport_valid_to", "client_effective_from")


def q_advance_watermarks_empty_feed(spark, d):
    """Literal form: a fact feed without new rows sets its watermark to NULL."""
    t = _t(spark, d)
    return advance_watermarks(t.meta_seed, {}, None, load_fact_blacklist(t.bl, S.OPEN_END), t.stg_tx, literal=True)


def q_anti_join_missing_keys(spark, d):
    t = _t(spark, d)
    return missing_keys(t.hist, _keys(t), "client_id").select("client_id", "effective_from")


def q_missing_keys_by_digest(spark, d):
    """J2 again; only keys of groups whose digests differ are joined."""
    t = _t(spark, d)
    return missing_keys_by_digest(t.hist, _keys(t), "client_id").select("client_id", "effective_from")


def q_in_blacklist_flag(spark, d):
    t = _t(spark, d)
    return in_list_flag(t.cl.select("client_id", "passport_num"), "passport_num", t.bl.select("passport_num"),
                        "in_blacklist")


def q_in_list_with_nulls(spark, d):
    """NULL values against a list that holds NULLs: TRUE or NULL, never FALSE."""
    t = _t(spark, d)
    late = F.when(F.col("entry_dt") > ts_lit(BLACKLIST_WATERMARK), F.col("passport_num"))
    return in_list_flag(t.cl.select("client_id", "first_name"), "first_name", t.bl.select(late.alias("p")), "listed")


def q_in_empty_list(spark, d):
    """Any value, NULL included, against an empty list: FALSE."""
    t = _t(spark, d)
    none = t.bl.filter(F.col("entry_dt") > ts_lit(S.OPEN_END)).select("passport_num")
    return in_list_flag(t.cl.select("client_id", "first_name"), "first_name", none, "listed")


def q_rule_amount_probing_20min(spark, d):
    return probing_anchor(_t(spark, d).tx_dense, S.PROBE_WINDOW)


def q_rule_amount_probing_20min_per_card(spark, d):
    return probing_ids(_t(spark, d).tx_dense, S.PROBE_WINDOW)


def _kept(src: DataFrame, key: str) -> DataFrame:
    """A source from which every 13th key was deleted."""
    return src.filter(F.rtrim(key).cast("long") % 13 != 0)


def q_scd2_full_accounts(spark, d):
    t = _t(spark, d)
    src = _kept(t.acc_src, "account")
    return scd2_load(t.acc_hist, incremental_extract(src, CLIENTS_WATERMARK), key_snapshot(src, "account"), LOAD_DT, ACCOUNTS)


def q_scd2_full_cards(spark, d):
    t = _t(spark, d)
    src = _kept(t.cards_src, "card_num")
    return scd2_load(t.cards_hist, incremental_extract(src, CLIENTS_WATERMARK), key_snapshot(src, "card_num"), LOAD_DT, CARDS)


def q_terminals_full(spark, d):
    t = _t(spark, d)
    hist = snapshot_scd2(t.term_hist, t.term_file, LOAD_DT)
    return scd2_delete(hist, key_snapshot(t.term_file, "terminal_id"), LOAD_DT, TERMINALS)


def q_rule_passport(spark, d):
    t = _t(spark, d)
    j = dim_chain_join(t.tx, t.cards, t.acc, flag_blacklisted(t.cl, t.bl), extra=("_bl_listed",))
    return j.filter(rule_passport_listed(LOAD_DT)).select("trans_id")


def q_rule_passport_corrected(spark, d):
    t = _t(spark, d)
    j = dim_chain_join(t.tx, t.cards, t.acc, with_blacklist_since(t.cl, t.bl), extra=("_bl_since",))
    return j.filter(rule_passport_corrected()).select("trans_id")


def q_rule_contract(spark, d):
    return _chain(_t(spark, d)).filter(rule_contract(LOAD_DT)).select("trans_id")


def q_rule_contract_corrected(spark, d):
    return _chain(_t(spark, d)).filter(rule_contract_corrected()).select("trans_id")


def q_rule_city_velocity(spark, d):
    t = _t(spark, d)
    return velocity_anchor(city_ops(t.tx, t.term_dim), WINDOWS.city, WINDOWS.sub_bins)


def q_rule_city_velocity_per_card(spark, d):
    t = _t(spark, d)
    return velocity_ids(city_ops(t.tx, t.term_dim), WINDOWS.city, WINDOWS.sub_bins)


def q_rule_amount_probing(spark, d):
    return probing_anchor(_t(spark, d).tx, WINDOWS.probe)


def q_rule_amount_probing_per_card(spark, d):
    return probing_ids(_t(spark, d).tx, WINDOWS.probe)


def _classified(spark, d, per_card: bool) -> DataFrame:
    t = _t(spark, d)
    rows = classified(t.tx, t.cards, t.acc, t.cl, t.term_dim, t.bl, LOAD_DT, WINDOWS, per_card=per_card)
    return rows.select("trans_id", "event_type")


def q_classify(spark, d):
    return _classified(spark, d, per_card=False)


def q_classify_per_card(spark, d):
    return _classified(spark, d, per_card=True)


def q_fraud_report(spark, d):
    t = _t(spark, d)
    return fraud_report(t.tx, t.cards, t.acc, t.cl, t.term_dim, t.bl, LOAD_DT, WINDOWS)


def q_fraud_report_asof(spark, d):
    t = _t(spark, d)
    return fraud_report_asof(t.tx, t.cards_hist, t.acc_hist, _clients_after_load(t), t.term_dim, t.bl,
                             LOAD_DT, WINDOWS)


def q_fio_concat_nulls(spark, d):
    cl = _t(spark, d).cl
    return cl.select("client_id", concat_nullable("last_name", "first_name", "patronymic").alias("fio"))


def q_trimmed_key_join(spark, d):
    t = _t(spark, d)
    return trimmed_key_join(t.tx, t.cards).select("trans_id", "account_num")


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
