"""Late deliveries (C14): files of a date older than the newest load, in any order of arrival.

What a late file says is put where it would stand had it come in time, and what
it alters in later dates is rebuilt, no more:

* *transactions* are appended.  An operation decides its own report row and, by R3
  and R4, those of the same card less than one window later.
* *blacklist* entries are compared with the watermark of their own date.  Entries
  of later dates at or below a late entry's date fall, as they would have; the
  table takes the place of the earlier ones (``Run.rebased``).  An entry added or
  taken away decides the rows of the cards of its passport.
* *terminals*: the snapshot is inserted into the history.  Only ids whose row
  differs from the version valid on that date can change; their later history is
  rebuilt from the later dates' staged snapshots in one window pass.  An id that
  changed decides the R3 rows of the cards used there.

These cards and times are joined to the operations of later loads and
give the (card, load date) pairs the file can alter; the reports of those dates
are written again.  Reports without such a pair keep their folders.

The state equals that of loads in order of date, as far as files decide it (a
property test over orders of arrival).  Accounts, cards and clients come from the
source's present state, which no file carries; they stay those of the full
loads.  Only for the corrected semantics: the literal load's history depends on
the order by design, and its late files rebuild their own date's report alone.
"""

from __future__ import annotations

import datetime as _dt
import dataclasses
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch import schemas as S
from cardwatch.functions import differs_null_safe, epoch_us, minus_days, ts_lit, window_us
from cardwatch.operators.extract import seed_watermarks
from cardwatch.operators.scd2 import TERMINALS, DimSpec, is_open
from cardwatch.operators.velocity import floor_div
from cardwatch.plans.report import Windows, fraud_report_asof
from cardwatch.sources.store import LOADED, Run, Store, loaded_until

_DAY = _dt.timedelta(days=1)


# --- history ------------------------------------------------------------------------------

def as_of(hist: DataFrame, before: _dt.datetime) -> DataFrame:
    """A snapshot dimension's history as the loads of dates before ``before`` left it.

    A load of date L starts versions at L and closes them at L - 1 day, so later
    starts go and later ends open again.
    """
    end = F.when(F.col("effective_to") >= ts_lit(before - _DAY), ts_lit(S.OPEN_END)).otherwise(F.col("effective_to"))
    return hist.filter(F.col("effective_from") < ts_lit(before)).withColumn("effective_to", end)


def _valid_on(hist: DataFrame, date: _dt.datetime) -> DataFrame:
    """Live versions on a date, as its load left them."""
    return hist.filter((F.col("effective_from") <= ts_lit(date)) & (F.col("effective_to") >= ts_lit(date)) & (F.col("deleted_flg") == S.FLAG_LIVE))


def altered_keys(hist: DataFrame, snapshot: DataFrame, date: _dt.datetime, spec: DimSpec = TERMINALS) -> DataFrame:
    """Keys whose row in the snapshot differs from the version valid on its date (or that only one of them has)."""
    old = _valid_on(hist, date).select(spec.key, *[F.col(c).alias(f"_o_{c}") for c in spec.attrs], F.lit(True).alias("_old"))
    new = snapshot.select(F.col(spec.source_key).alias(spec.key), *[F.col(s).alias(h) for s, h in zip(spec.source_attrs, spec.attrs)], F.lit(True).alias("_new"))
    differs = reduce(Column.__or__, (differs_null_safe(c, f"_o_{c}") for c in spec.attrs))
    both = old.join(new, spec.key, "full_outer")
    return both.filter(F.col("_old").isNull() | F.col("_new").isNull() | differs).select(spec.key).distinct()


def insert_snapshot(hist: DataFrame, snapshots: DataFrame, dates: list[_dt.datetime], keys: DataFrame, spec: DimSpec = TERMINALS) -> DataFrame:
    """The history after the snapshots of ``dates`` (ascending) on top of what earlier dates left, for ``keys``; other keys keep theirs.

    ``snapshots`` holds the rows of all those dates (column ``_loaded``).  Per key,
    the state of the first date's eve and what each snapshot shows are one
    sequence; a version starts where it changes and ends the day before the
    next change, an absence after a presence is a tombstone.
    """
    mine, others = hist.join(keys, spec.key, "left_semi"), hist.join(keys, spec.key, "left_anti")
    eve = as_of(mine, dates[0])
    state = F.struct(*spec.attrs)
    day = F.explode(F.array(*(ts_lit(d) for d in dates))).alias(LOADED)  # one row per key and later load
    seen = snapshots.select(F.col(spec.source_key).alias(spec.key), LOADED, F.struct(*[F.col(s).alias(h) for s, h in zip(spec.source_attrs, spec.attrs)]).alias("_state"))
    grid = keys.select(spec.key, day).join(seen, [spec.key, LOADED], "left")
    first = eve.filter(is_open() & (F.col("deleted_flg") == S.FLAG_LIVE)).select(spec.key, ts_lit(S.BEGINNING).alias(LOADED), state.alias("_state"))
    order = Window.partitionBy(spec.key).orderBy(LOADED)
    moves = (
        grid.unionByName(first)
        .withColumn("_before", F.lag("_state").over(order))
        .filter((F.col(LOADED) > ts_lit(S.BEGINNING)) & ~F.col("_state").eqNullSafe(F.col("_before")))
        .withColumn("_next", F.lead(LOADED).over(order))
    )
    ends = F.coalesce(minus_days("_next", 1), ts_lit(S.OPEN_END))
    shown = F.coalesce("_state", "_before")
    versions = moves.select(
        spec.key, *[shown[c].alias(c) for c in spec.attrs], F.col(LOADED).alias("effective_from"), ends.alias("effective_to"),
        F.when(F.col("_state").isNull(), S.FLAG_DELETED).otherwise(S.FLAG_LIVE).alias("deleted_flg"),
    )
    # the version open on the eve ends with the key's first change
    change = moves.groupBy(spec.key).agg(F.min(LOADED).alias("_first"))
    closes = F.when(is_open() & F.col("_first").isNotNull(), minus_days("_first", 1)).otherwise(F.col("effective_to"))
    older = eve.join(change, spec.key, "left").withColumn("effective_to", closes).drop("_first")
    return others.unionByName(older.select(*hist.columns)).unionByName(versions.select(*hist.columns))


# --- blacklist ----------------------------------------------------------------------------

def ordered_blacklist(staged: DataFrame, seed: _dt.datetime) -> DataFrame:
    """(entry_dt, passport_num, _loaded): the entries that loads in order of date keep.

    A load keeps what is newer than all entries of earlier dates.  The maxima
    are one row per load date.
    """
    most = staged.groupBy(LOADED).agg(F.max("entry_dt").alias("m"))
    earlier = Window.orderBy(LOADED).rowsBetween(Window.unboundedPreceding, -1)
    mark = most.select(F.col(LOADED).alias("_d"), F.coalesce(F.greatest(F.max("m").over(earlier), ts_lit(seed)), ts_lit(seed)).alias("_mark"))
    rows = staged.join(F.broadcast(mark), F.col(LOADED) == F.col("_d"))
    return rows.filter(F.col("entry_dt") > F.col("_mark")).select("entry_dt", "passport_num", LOADED)


# --- what a late file can alter -------------------------------------------------------------

def cards_of_passports(passports: DataFrame, clients: DataFrame, accounts: DataFrame, cards: DataFrame) -> DataFrame:
    """Card numbers that lead to a client who ever had one of the passports."""
    c = clients.join(passports, "passport_num", "left_semi").select(F.col("client_id").alias("client")).distinct()
    a = accounts.join(c, "client", "left_semi").select("account_num").distinct()
    return cards.join(a, "account_num", "left_semi").select(F.rtrim("card_num").alias("card_num")).distinct()


def altered_dates(ops: DataFrame, points: DataFrame | None, cards: DataFrame | None, dates: list[_dt.datetime], since: _dt.datetime,
                  reach: _dt.timedelta) -> list[_dt.datetime]:
    """Load dates from ``since`` on whose report can change: those of the (card, date) pairs that a late file touches.

    ``ops`` are (card_num, trans_date, _loaded).  A point (card_num, ts) touches the card's operations in
    [ts, ts + reach); a card all of its own.  An operation stands in the report of every load date L with
    ``_loaded <= L < trans_date``.  The points of a card in one time bin of width ``reach`` act as one interval,
    and operations are joined by card and bin, so a busy card meets at most two intervals an operation.
    """
    later = [d for d in dates if d >= since]
    if not later:
        return []
    day = F.explode(F.array(*(ts_lit(d) for d in later))).alias("load_dt")
    pairs = ops.select("*", day).filter((F.col(LOADED) <= F.col("load_dt")) & (F.col("load_dt") < F.col("trans_date")))
    found = []
    width = window_us(reach)
    if points is not None:
        at = points.withColumn("_t", epoch_us("ts")).withColumn("_bin", floor_div("_t", width))
        spans = at.groupBy("card_num", "_bin").agg(F.min("_t").alias("lo"), F.max("_t").alias("hi"))
        spans = spans.select("card_num", F.explode(F.array("_bin", F.col("_bin") + 1)).alias("_bin"), "lo", "hi")
        own = pairs.withColumn("_t", epoch_us("trans_date")).withColumn("_bin", floor_div("_t", width))
        touched = own.join(spans, ["card_num", "_bin"]).filter((F.col("_t") >= F.col("lo")) & (F.col("_t") < F.col("hi") + width))
        found.append(touched.select("load_dt").distinct())
    if cards is not None:
        found.append(pairs.select("card_num", "load_dt").distinct().join(cards, "card_num", "left_semi").select("load_dt").distinct())
    # one row per load date
    return sorted({r["load_dt"] for f in found for r in f.collect()})


# --- the run ------------------------------------------------------------------------------

def load_late(store: Store, run: Run, stg_tx: DataFrame, terminals: DataFrame | None, blacklist: DataFrame | None,
              effective: list[Run], windows: Windows) -> Run:
    """Write what a late run alters; ``fact_transactions`` of the run is written already.  Returns the run to commit."""
    date, newest = run.load_dt, max(r.load_dt for r in effective)
    old = sorted(effective, key=lambda r: r.run_id)
    last = [r for r in old if r.load_dt == newest and r.kind == "full"][-1]
    run = dataclasses.replace(run, feeds=run.feeds + tuple(k for k, v in (("terminals", terminals), ("blacklist", blacklist)) if v is not None))
    points, cards = stg_tx.select("card_num", F.col("transaction_date").alias("ts")), None
    rebased: list[str] = []
    beside = f"{run.run_id}-newest"
    if terminals is not None:
        used = _terminals(store, run, terminals, old, newest, beside, rebased)
        points = points if used is None else points.unionByName(used)
    if blacklist is not None:
        cards = _blacklist(store, run, blacklist, old, newest, beside, rebased)
    run = dataclasses.replace(run, rebased=tuple(rebased), replaces=((last.run_id, beside),) if rebased else ())
    runs = sorted([*old, run], key=lambda r: r.run_id)
    reach = max(windows.city, windows.probe)
    ops = store.fact_with_dates("fact_transactions", runs, trans_after=date).filter(F.col("trans_date") > ts_lit(date))
    dates = sorted({r.load_dt for r in runs})
    ops = ops.select("card_num", "trans_date", LOADED)
    again = sorted({date, *altered_dates(ops, points, cards, dates, date, reach)})
    _reports(store, run, runs, again, windows)
    return dataclasses.replace(run, reports=tuple(again))


def _terminals(store: Store, run: Run, terminals: DataFrame, old: list[Run], newest: _dt.datetime, beside: str, rebased: list[str]) -> DataFrame | None:
    """Insert a snapshot into the history; (card_num, ts) of the operations at terminals that changed."""
    table, date = "dim_terminals_hist", run.load_dt
    snapshot = store.write("stg_terminals", run, terminals)
    hist = store.dim(table, old).drop("_closed_before")
    keys = store.write("stg_terminals_altered", run, altered_keys(hist, snapshot, date))
    if not keys.take(1):
        return None
    # the snapshot of a date is the one delivered last
    by_date = {r.load_dt: r for r in sorted(old, key=lambda r: r.version) if "terminals" in r.feeds and r.load_dt > date}
    later = store.staged_with_dates("stg_terminals", S.STG_TERMINALS, list(by_date.values()))
    shown = snapshot.withColumn(LOADED, ts_lit(date)).unionByName(later).join(keys, "terminal_id", "left_semi")
    new = store.write("stg_terminals_history", run, insert_snapshot(hist, shown, [date, *sorted(by_date)], keys))
    store.write_dim(table, run, as_of(new, newest))
    store.write_dim(table, beside, new.filter(F.col("effective_to") >= ts_lit(newest - _DAY)))
    rebased.append(table)
    # operations at an altered terminal since the date
    runs = [*old, run]
    ops = store.fact("fact_transactions", runs, trans_after=date - _DAY).join(keys, F.col("terminal") == F.col("terminal_id"), "left_semi")
    return ops.filter(F.col("trans_date") >= ts_lit(date - _DAY)).select("card_num", F.col("trans_date").alias("ts"))


def _blacklist(store: Store, run: Run, blacklist: DataFrame, old: list[Run], newest: _dt.datetime, beside: str, rebased: list[str]) -> DataFrame:
    """Insert a list into the lists loaded; the cards of the passports added or taken away."""
    table, date = "fact_passport_blacklist", run.load_dt
    seed = {r["table_name"]: r["last_update_dt"] for r in seed_watermarks(store.spark).collect()}[S.WM_BLACKLIST]  # six rows
    feed = store.write("stg_passport_blacklist", run, blacklist.select("entry_dt", "passport_num"))
    mine = [r for r in old if "blacklist" in r.feeds and r.load_dt == date]
    staged = store.staged_with_dates("stg_passport_blacklist", S.FACT_PASSPORT_BLACKLIST, [r for r in old if "blacklist" in r.feeds])
    late = feed.withColumn(LOADED, ts_lit(date))
    if mine:  # deliveries of one date are the same list
        own = staged.filter(F.col(LOADED) == ts_lit(date)).unionByName(late).distinct()
        staged, late = staged.filter(F.col(LOADED) != ts_lit(date)), own
    before = store.fact_with_dates(table, old)
    after = store.write("stg_blacklist_history", run, ordered_blacklist(staged.unionByName(late), seed))
    store.write(table, run, after.filter(F.col(LOADED) < ts_lit(newest)))
    store.write(table, beside, after.filter(F.col(LOADED) == ts_lit(newest)))
    rebased.append(table)
    _watermarks(store, run, after, old, newest, beside, rebased)
    keyed = lambda df: df.groupBy("entry_dt", "passport_num", LOADED).agg(F.count("*").alias("n"))
    changed = keyed(after).unionByName(keyed(before)).groupBy("entry_dt", "passport_num", LOADED).agg(F.count("*").alias("sides"), F.min("n").alias("lo"), F.max("n").alias("hi"))
    passports = changed.filter("sides = 1 OR lo <> hi").select("passport_num").distinct()
    hist = {t: store.dim(t, old).drop("_closed_before") for t in ("dim_clients_hist", "dim_accounts_hist", "dim_cards_hist")}
    return cards_of_passports(passports, hist["dim_clients_hist"], hist["dim_accounts_hist"], hist["dim_cards_hist"])


def _watermarks(store: Store, run: Run, blacklist: DataFrame, old: list[Run], newest: _dt.datetime, beside: str, rebased: list[str]) -> None:
    """The blacklist's watermark before the newest date and after it, as ordered loads leave it."""
    bounds = blacklist.agg(F.max(F.when(F.col(LOADED) < ts_lit(newest), F.col("entry_dt"))).alias("eve"), F.max("entry_dt").alias("now")).first()
    eve = [r for r in old if r.load_dt < newest]
    for folder, runs, mark in ((run.run_id, eve, bounds["eve"]), (beside, old, bounds["now"])):
        meta = store.meta(runs)
        if mark is not None:
            meta = meta.withColumn("last_update_dt", F.when(F.col("table_name") == S.WM_BLACKLIST, ts_lit(mark)).otherwise(F.col("last_update_dt")))
        store.write("meta_data", folder, meta)
    rebased.append("meta_data")


def _reports(store: Store, run: Run, runs: list[Run], dates: list[_dt.datetime], windows: Windows) -> None:
    """The reports of ``dates`` over what their loads knew, into the run's folder."""
    listed = store.fact_with_dates("fact_passport_blacklist", runs)
    hist = {t: store.dim(t, runs).drop("_closed_before") for t in ("dim_cards_hist", "dim_accounts_hist", "dim_clients_hist", "dim_terminals_hist")}
    folder = store.run_dir("rep_fraud", run.run_id)
    for k, d in enumerate(dates):
        tx = loaded_until(store.fact_with_dates("fact_transactions", runs, trans_after=d - max(windows.city, windows.probe)), d).drop(LOADED)
        report = fraud_report_asof(tx, *hist.values(), loaded_until(listed, d).drop(LOADED), d, windows=windows)
        report.write.mode("append" if k else "overwrite").parquet(folder)
