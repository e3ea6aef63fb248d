"""The daily fraud report (C12 as written, C13 as meant).

Both take the whole warehouse as DataFrames but only read what the day needs:

* report rows are operations after the load date, so the chain join sees
  ``trans_date > load date`` (Catalyst pushes it to the fact scan);
* blacklist membership is a property of the client, so it is computed on the
  clients dimension and carried through the single fact join;
* the per-card rules R3/R4 can only flag a report row from operations less
  than one window before it, so they read ``trans_date > load date - W``;
* the literal R3/R4 compare with one global maximum; a report row can only
  equal it when the maximum is after the load date, and any pattern whose
  first operation is after the load date lies wholly after it, so the
  maximum over ``trans_date > load date`` labels exactly the same rows.

The daily cost therefore follows the day's operations (plus one window of
history), not the size of the fact table.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch import schemas as S
from cardwatch.functions import concat_nullable, plus_days, ts_lit
from cardwatch.operators.joins import asof_dim_chain, dim_chain_join
from cardwatch.operators.probing import probing_anchor, probing_hits
from cardwatch.operators.rules import (
    classify,
    event_label,
    flag_blacklisted,
    rule_contract,
    rule_contract_corrected,
    rule_passport_corrected,
    rule_passport_listed,
    with_blacklist_since,
)
from cardwatch.operators.velocity import city_ops, velocity_anchor, velocity_ids


@dataclass(frozen=True)
class Windows:
    city: _dt.timedelta = S.CITY_WINDOW
    probe: _dt.timedelta = S.PROBE_WINDOW
    sub_bins: int = 60


def _after(df: DataFrame, ts: _dt.datetime) -> DataFrame:
    return df.filter(F.col("trans_date") > ts_lit(ts))


def rule_hits(tx: DataFrame, terminals: DataFrame, load_dt: _dt.datetime, windows: Windows,
              asof_terminals: bool = False) -> DataFrame:
    """(trans_id, _r3, _r4): operations that R3 or R4 flag per card, one row each."""
    recent3 = _after(tx, load_dt - windows.city)
    recent4 = _after(tx, load_dt - windows.probe)
    v = velocity_ids(city_ops(recent3, terminals, asof=asof_terminals), windows.city, windows.sub_bins)
    p = probing_hits(recent4, windows.probe)
    one = v.select("trans_id", F.lit(True).alias("_r3"), F.lit(False).alias("_r4")).unionByName(
        p.select("trans_id", F.lit(False).alias("_r3"), F.lit(True).alias("_r4")))
    return one.groupBy("trans_id").agg(F.max("_r3").alias("_r3"), F.max("_r4").alias("_r4"))


def with_rules(rows: DataFrame, tx: DataFrame, terminals: DataFrame, load_dt: _dt.datetime, windows: Windows,
               per_card: bool, asof_terminals: bool = False) -> DataFrame:
    """``rows`` with R3 and R4 as the boolean columns ``_r3`` and ``_r4``.

    Per card: one left join by operation id to the flagged operations."""
    if per_card:
        hits = rule_hits(tx, terminals, load_dt, windows, asof_terminals)
        return rows.join(hits, "trans_id", "left").fillna(False, ["_r3", "_r4"])
    recent = _after(tx, load_dt)
    a3 = velocity_anchor(city_ops(recent, terminals, asof=asof_terminals), windows.city, windows.sub_bins)
    a4 = probing_anchor(recent, windows.probe)
    return rows.withColumns({"_r3": F.col("trans_date") == a3.scalar(), "_r4": F.col("trans_date") == a4.scalar()})


def _report(rows: DataFrame, event_type: Column, load_dt: _dt.datetime) -> DataFrame:
    out = rows.select(
        F.col("trans_date").alias("event_dt"),
        F.col("passport_num").alias("passport"),
        concat_nullable("last_name", "first_name", "patronymic").alias("fio"),
        "phone",
        event_type.alias("event_type"),
        plus_days(ts_lit(load_dt), 1).alias("report_dt"),
    )
    return out.filter(F.col("event_type") != F.lit(S.EventType.OK))


def classified(tx: DataFrame, cards: DataFrame, accounts: DataFrame, clients: DataFrame, terminals: DataFrame,
               blacklist: DataFrame, load_dt: _dt.datetime, windows: Windows = Windows(),
               per_card: bool = False) -> DataFrame:
    """Operations after the load date with their event type (source's R1/R2)."""
    clients = flag_blacklisted(clients, blacklist)
    rows = dim_chain_join(_after(tx, load_dt), cards, accounts, clients, extra=("_bl_listed",))
    rows = with_rules(rows, tx, terminals, load_dt, windows, per_card)
    et = classify(rule_passport_listed(load_dt), rule_contract(load_dt), F.col("_r3"), F.col("_r4"))
    return rows.withColumn("event_type", et).drop("_r3", "_r4")


def fraud_report(tx: DataFrame, cards: DataFrame, accounts: DataFrame, clients: DataFrame, terminals: DataFrame,
                 blacklist: DataFrame, load_dt: _dt.datetime, windows: Windows = Windows(),
                 per_card: bool = False) -> DataFrame:
    """rep_fraud rows for one load date, as the source builds them.

    ``per_card=True`` swaps the global-timestamp R3/R4 for the per-card ones."""
    rows = classified(tx, cards, accounts, clients, terminals, blacklist, load_dt, windows, per_card)
    return _report(rows, F.col("event_type"), load_dt)


def _valid_after(hist: DataFrame, ts: _dt.datetime) -> DataFrame:
    """Versions that can be valid at some time after ``ts`` (they end on or
    after the day before it).  A literal bound on the column, so parquet skips
    the row groups of long-closed versions."""
    return hist.filter(F.col("effective_to") >= ts_lit(ts - _dt.timedelta(days=1)))


def classified_asof(tx: DataFrame, cards_hist: DataFrame, accounts_hist: DataFrame, clients_hist: DataFrame,
                    terminals_hist: DataFrame, blacklist: DataFrame, load_dt: _dt.datetime,
                    windows: Windows = Windows()) -> DataFrame:
    # report rows are after the load date; R3 also looks one window further back
    cards_hist, accounts_hist, clients_hist = (
        _valid_after(h, load_dt) for h in (cards_hist, accounts_hist, clients_hist))
    terminals_hist = _valid_after(terminals_hist, load_dt - windows.city)
    clients_hist = with_blacklist_since(clients_hist, blacklist)
    rows = asof_dim_chain(_after(tx, load_dt), cards_hist, accounts_hist, clients_hist, extra=("_bl_since",))
    rows = with_rules(rows, tx, terminals_hist, load_dt, windows, per_card=True, asof_terminals=True)
    et = classify(rule_passport_corrected(), rule_contract_corrected(), F.col("_r3"), F.col("_r4"))
    return rows.withColumn("event_type", et).drop("_r3", "_r4")


def fraud_report_asof(tx: DataFrame, cards_hist: DataFrame, accounts_hist: DataFrame, clients_hist: DataFrame,
                      terminals_hist: DataFrame, blacklist: DataFrame, load_dt: _dt.datetime,
                      windows: Windows = Windows()) -> DataFrame:
    """Each dimension as of the operation time (live versions only),
    rules against the operation time, blacklist entries dated, R3/R4 per card."""
    rows = classified_asof(tx, cards_hist, accounts_hist, clients_hist, terminals_hist, blacklist, load_dt, windows)
    return _report(rows, F.col("event_type"), load_dt)


def with_labels(report: DataFrame) -> DataFrame:
    """Replace the event codes by the sentences the source stores."""
    return report.withColumn("event_type", event_label(F.col("event_type")))
