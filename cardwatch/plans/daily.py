"""The daily batch (C14): feeds and source tables in, new warehouse state out.

Order as in the source (SURVEY §3.1): stage the feeds and the changed source
rows, load the dimensions (insert, close), the facts, the tombstones, advance
the watermarks, build the report; then commit.  Every step is a lazy plan;
each table is written once into the run's directory and read back from the
files, so a lost executor recomputes from written data, not from the whole
lineage.  Nothing is visible to readers until the commit-log entry is written.

``semantics="corrected"`` (default) uses the corrected operators (C5c, C7,
guarded fact watermarks, the as-of report); ``"literal"`` reproduces the
source statement by statement, for parity runs.
"""

from __future__ import annotations

import dataclasses
import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch import schemas as S
from cardwatch.operators.extract import advance_watermarks_to, change_ts, incremental_extract, key_snapshot
from cardwatch.operators.facts import load_fact_blacklist, load_fact_transactions
from cardwatch.operators.scd2 import (
    ACCOUNTS,
    CARDS,
    CLIENTS,
    TERMINALS,
    DimSpec,
    scd2_delete,
    scd2_load,
    snapshot_scd2,
    snapshot_scd2_corrected,
)
from cardwatch.plans.late import load_late
from cardwatch.plans.report import Windows, fraud_report, fraud_report_asof
from cardwatch.sources.feeds import LEDGER, DayFeeds
from cardwatch.sources.store import Run, Store


@dataclass(frozen=True)
class Sources:
    """Current state of the three source tables (parquet, a catalog table or JDBC)."""

    accounts: DataFrame
    cards: DataFrame
    clients: DataFrame


_DIM_LOADS: tuple[tuple[str, str, DimSpec, str], ...] = (
    ("dim_accounts_hist", S.WM_ACCOUNTS, ACCOUNTS, "accounts"),
    ("dim_cards_hist", S.WM_CARDS, CARDS, "cards"),
    ("dim_clients_hist", S.WM_CLIENTS, CLIENTS, "clients"),
)


def run_daily(spark: SparkSession, store: Store, feeds: DayFeeds, sources: Sources,
              semantics: str = "corrected", windows: Windows = Windows()) -> Run:
    """Load one delivery of one date.

    * A new date, or the newest one again: a full load.  A second delivery of
      the date is loaded together with what the date brought before (the union
      of the transaction files); a rerun over a superset of its transaction
      files replaces them.  Either way the new run supersedes the earlier one.
    * A date older than the newest load: a late delivery.  Its rows go where they
      would stand had they come in time, and what they alter in later dates is
      rebuilt (see ``plans.late``).  Files of an old date that are already loaded
      can't be run again.
    """
    if semantics not in ("corrected", "literal"):
        raise ValueError("semantics must be 'corrected' or 'literal'")
    load_dt = feeds.load_dt
    effective = store.effective()
    version = store.read_version()
    same = [r for r in effective if r.load_dt == load_dt]
    later = [r for r in effective if r.load_dt > load_dt]
    known = _files(store, same)
    new = [f for f in feeds.files if f not in known]
    if later:
        if len(new) != len(feeds.files) or not new:
            raise ValueError(f"{len(later)} later load(s) already committed; rerun them after this date")
        return _late(spark, store, feeds, semantics, windows, effective, version)
    base = [r for r in effective if r.load_dt < load_dt]
    run = Run(store.new_run_id(load_dt), load_dt, supersedes=tuple(r.run_id for r in same), reports=(load_dt,),
              read_version=version)
    return _full_load(spark, store, _with_earlier(store, feeds, same, known), sources, semantics, windows, base, run)


def _files(store: Store, runs: list[Run]) -> set[tuple[str, str]]:
    """(feed, file_name) that runs of one date consumed."""
    return {(r["feed"], r["file_name"]) for r in store.ledger(runs).collect()}


def _with_earlier(store: Store, feeds: DayFeeds, same: list[Run], known: set[tuple[str, str]]) -> DayFeeds:
    """A delivery of the newest date completed by what earlier deliveries of the date staged."""
    if not same:
        missing = [k for k in ("transactions", "terminals", "blacklist") if getattr(feeds, k) is None]
        if missing:
            raise ValueError(f"feeds {missing} missing for {feeds.load_dt:%Y-%m-%d}")
        return feeds
    old_tx = {f for f in known if f[0] == "transactions"}
    new_tx = {f for f in feeds.files if f[0] == "transactions"}
    tx, bl, term = feeds.transactions, feeds.blacklist, feeds.terminals
    if not new_tx >= old_tx:
        if new_tx & old_tx:
            raise ValueError("a second delivery must hold none or all of the transaction files loaded for its date")
        earlier = store.staged("stg_transactions", S.STG_TRANSACTIONS, same)
        tx = earlier if tx is None else earlier.unionByName(tx)
    earlier = store.staged("stg_passport_blacklist", S.FACT_PASSPORT_BLACKLIST, same)
    # the list is cumulative: rows of both deliveries are the same entries
    bl = earlier if bl is None else earlier.unionByName(bl.select(*earlier.columns)).distinct()
    if term is None:
        term = store.staged("stg_terminals", S.STG_TERMINALS, same)
    rejects = feeds.rejects
    kept = [r for r in same if "rejects" in r.feeds]
    if kept and not new_tx >= old_tx:  # what the earlier deliveries left out stays on record
        rejects = store.rejects(kept) if rejects is None else store.rejects(kept).unionByName(rejects)
    return dataclasses.replace(feeds, transactions=tx, blacklist=bl, terminals=term, rejects=rejects,
                               files=sorted(known | set(feeds.files)))


def _late(spark: SparkSession, store: Store, feeds: DayFeeds, semantics: str, windows: Windows,
          effective: list[Run], version: int) -> Run:
    """Put a late delivery where it belongs and rebuild what it alters (``plans.late``)."""
    run = Run(store.new_run_id(feeds.load_dt), feeds.load_dt, kind="late", reports=(feeds.load_dt,),
              feeds=("transactions",) if feeds.transactions is not None else (), read_version=version)
    tx = feeds.transactions
    stg, run = _staged(store, run, tx if tx is not None else spark.createDataFrame([], S.STG_TRANSACTIONS))
    store.write("fact_transactions", run, load_fact_transactions(stg))
    # written again below if the delivery brings entries
    store.write("fact_passport_blacklist", run, spark.createDataFrame([], S.FACT_PASSPORT_BLACKLIST))
    run = _quarantined(store, run, feeds, [stg])
    if semantics == "literal":
        facts = [r for r in effective if r.load_dt <= run.load_dt] + [run]
        return _publish(spark, store, run, feeds.files, semantics, windows, facts, effective)
    run = load_late(store, run, stg, feeds.terminals, feeds.blacklist, effective, windows)
    _record(spark, store, run, feeds.files)
    return store.commit(run, semantics)


def _quarantined(store: Store, run: Run, feeds: DayFeeds, staged: list[DataFrame]) -> Run:
    """Write the lines left out next to the staged rows; too large a share fails the load."""
    if feeds.rejects is None:
        return run
    bad = store.write("rejects", run, feeds.rejects).count()
    good = sum(df.count() for df in staged)
    if bad > feeds.max_reject_share * (bad + good):
        raise ValueError(f"{bad} of {bad + good} lines of {feeds.load_dt:%Y-%m-%d} do not parse, over the limit of {feeds.max_reject_share:.1%}")
    return dataclasses.replace(run, feeds=(*run.feeds, "rejects"))


def _staged(store: Store, run: Run, tx: DataFrame) -> tuple[DataFrame, Run]:
    """The staged operations, and the run with the range of their times."""
    date = F.col("transaction_date")
    stg, seen = store.write_observed("stg_transactions", run, tx, lo=F.min(date), hi=F.max(date))
    return stg, dataclasses.replace(run, tx_min=seen["lo"], tx_max=seen["hi"])


def _publish(spark: SparkSession, store: Store, run: Run, files: list[tuple[str, str]], semantics: str,
             windows: Windows, facts: list[Run], dims: list[Run]) -> Run:
    """Report over the facts and dimensions of the given runs, ledger, commit.

    Runs that hold no operation after (load date - longest rule window) are not opened.
    """
    load_dt = run.load_dt
    horizon = load_dt - max(windows.city, windows.probe)
    tx = store.fact("fact_transactions", facts, trans_after=horizon)
    bl = store.fact("fact_passport_blacklist", facts)
    hist = {t: store.dim(t, dims).drop("_closed_before") for t, *_ in _DIM_LOADS}
    terms = store.dim("dim_terminals_hist", dims).drop("_closed_before")
    args = (tx, hist["dim_cards_hist"], hist["dim_accounts_hist"], hist["dim_clients_hist"], terms, bl, load_dt)
    report = fraud_report if semantics == "literal" else fraud_report_asof
    store.write("rep_fraud", run, report(*args, windows=windows))
    _record(spark, store, run, files)
    return store.commit(run, semantics)


def _record(spark: SparkSession, store: Store, run: Run, files: list[tuple[str, str]]) -> None:
    store.write("ledger", run, spark.createDataFrame([(f, n, run.load_dt, run.run_id) for f, n in files], LEDGER))


def _full_load(spark: SparkSession, store: Store, feeds: DayFeeds, sources: Sources, semantics: str,
               windows: Windows, base: list[Run], run: Run) -> Run:
    literal, load_dt = semantics == "literal", feeds.load_dt
    meta = store.meta(base)
    wm = {r["table_name"]: r["last_update_dt"] for r in meta.collect()}   # six rows
    missing = [t for t in (S.WM_ACCOUNTS, S.WM_CARDS, S.WM_CLIENTS, S.WM_BLACKLIST) if wm.get(t) is None]
    if missing:
        # the source leaves a NULL fact watermark after an empty feed and then fails here
        raise ValueError(f"watermark missing or NULL for {missing}")

    # staging: what this run reads, written once so every step sees the same rows
    reached: dict[str, _dt.datetime | None] = {S.WM_TERMINALS: load_dt + _dt.timedelta(days=1)}
    stg_tx, run = _staged(store, run, feeds.transactions)
    listed = load_fact_blacklist(feeds.blacklist, wm[S.WM_BLACKLIST])
    stg_bl, seen = store.write_observed("stg_passport_blacklist", run, listed, newest=F.max("entry_dt"))
    reached |= {S.WM_TRANSACTIONS: run.tx_max, S.WM_BLACKLIST: seen["newest"]}
    stg_term = store.write("stg_terminals", run, feeds.terminals)

    run = _quarantined(store, run, feeds, [stg_tx, stg_term])

    for table, wm_name, spec, src_name in _DIM_LOADS:
        src = getattr(sources, src_name)
        changed = incremental_extract(src, wm[wm_name])
        delta, seen = store.write_observed(f"stg_{src_name}", run, changed, newest=F.max(change_ts()))
        keys = store.write(f"stg_{src_name}_del", run, key_snapshot(src, spec.source_key))
        reached[wm_name] = seen["newest"]
        hist = store.dim(table, base)
        store.write_dim(table, run, scd2_load(hist, delta, keys, load_dt, spec, corrected=not literal))

    term_hist = store.dim("dim_terminals_hist", base)
    snap = snapshot_scd2 if literal else snapshot_scd2_corrected
    terms = snap(term_hist, stg_term, load_dt, TERMINALS)
    terms = scd2_delete(terms, key_snapshot(stg_term, "terminal_id"), load_dt, TERMINALS, corrected=not literal)
    store.write_dim("dim_terminals_hist", run, terms)

    store.write("fact_passport_blacklist", run, stg_bl.select("entry_dt", "passport_num"))
    store.write("fact_transactions", run, load_fact_transactions(stg_tx))

    store.write("meta_data", run, advance_watermarks_to(meta, reached, literal=literal))
    return _publish(spark, store, run, feeds.files, semantics, windows, base + [run], base + [run])


def report_of(store: Store, load_dt: _dt.datetime) -> DataFrame:
    """The committed report of one load date, ordered by event time."""
    runs = [r for r in store.effective() if r.load_dt == load_dt]
    return store.reports(runs).orderBy("event_dt")


def current_state(store: Store) -> dict[str, DataFrame]:
    runs = store.effective()
    out = {t: store.dim(t, runs).drop("_closed_before") for t in
           ("dim_accounts_hist", "dim_cards_hist", "dim_clients_hist", "dim_terminals_hist")}
    out["fact_transactions"] = store.fact("fact_transactions", runs)
    out["fact_passport_blacklist"] = store.fact("fact_passport_blacklist", runs)
    out["meta_data"] = store.meta(runs)
    out["rep_fraud"] = store.reports(runs)
    return out

