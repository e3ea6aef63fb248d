"""The store's open/closed split gives the same history as folding the pure
operators over the same days, and the corrected history keeps its invariants."""

import datetime as dt
import random

import pytest

from cardwatch import schemas as S
from cardwatch.operators.extract import incremental_extract, key_snapshot
from cardwatch.operators.scd2 import (
    ACCOUNTS,
    TERMINALS,
    scd2_delete,
    scd2_load,
    snapshot_scd2,
    snapshot_scd2_corrected,
)
from cardwatch.plans.daily import Sources, current_state, run_daily
from cardwatch.plans.report import Windows
from cardwatch.sources.feeds import next_day
from cardwatch.sources.store import Store

START = dt.datetime(2024, 5, 1)
FAR = dt.datetime(2030, 1, 1)


def day_inputs(rnd, day, state):
    load_dt = START + dt.timedelta(days=day)
    for i in range(8):
        k = f"A{i}"
        x = rnd.random()
        if k not in state and x < 0.6:
            state[k] = (load_dt - dt.timedelta(hours=rnd.randint(1, 20)), None, f"C{rnd.randint(0, 2)}")
        elif k in state and x < 0.2:
            del state[k]
        elif k in state and x < 0.5:
            c, _, cl = state[k]
            state[k] = (c, load_dt - dt.timedelta(hours=rnd.randint(1, 20)), f"C{rnd.randint(0, 2)}")
    accounts = [(k, FAR, cl, c, u) for k, (c, u, cl) in sorted(state.items())]
    terminals = [(f"T{i}", rnd.choice(["ATM", "POS"]), rnd.choice(["X", "Y"]), "addr")
                 for i in range(5) if rnd.random() < 0.8]
    return load_dt, accounts, terminals


def write_day(folder, load_dt, terminals):
    tag = load_dt.strftime("%d%m%Y")
    (folder / f"transactions_{tag}.txt").write_text(
        "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"
        f"{load_dt.day};{load_dt:%Y-%m-%d} 10:00:00;1,00;K1;PAYMENT;SUCCESS;T0\n")
    (folder / f"terminals_{tag}.csv").write_text(
        "terminal_id;terminal_type;terminal_city;terminal_address\n" + "".join(";".join(t) + "\n" for t in terminals))
    # one entry per day: an empty feed leaves the literal fact watermark NULL
    (folder / f"passport_blacklist_{tag}.csv").write_text(f"date;passport\n{load_dt:%Y-%m-%d} 00:00:00;P{load_dt.day}\n")


def rows(df):
    cols = [c for c in df.columns if not c.startswith("_")]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.mark.parametrize("semantics", ["corrected", "literal"])
def test_store_equals_pure_fold(spark, tmp_path, semantics):
    corrected = semantics == "corrected"
    rnd = random.Random(21)
    feeds = tmp_path / "feeds"
    feeds.mkdir()
    store = Store(spark, str(tmp_path / "wh"))
    cards = spark.createDataFrame([("K1", "A0", START, None)], S.SRC_CARDS)
    clients = spark.createDataFrame([("C0", "L", "F", None, START, "P", FAR, "+7", START, None)], S.SRC_CLIENTS)
    acc_hist = spark.createDataFrame([], S.DIM_ACCOUNTS_HIST)
    term_hist = spark.createDataFrame([], S.DIM_TERMINALS_HIST)
    wm = S.BEGINNING
    state = {}
    for day in range(5):
        load_dt, accounts, terminals = day_inputs(rnd, day, state)
        write_day(feeds, load_dt, terminals)
        src = spark.createDataFrame(accounts, S.SRC_ACCOUNTS)
        f = next_day(spark, str(feeds), store.ledger(store.effective()))
        assert f.load_dt == load_dt
        run_daily(spark, store, f, Sources(src, cards, clients), semantics, Windows())
        # the same day folded in memory
        acc_hist = scd2_load(acc_hist, incremental_extract(src, wm), key_snapshot(src, "account"), load_dt,
                             ACCOUNTS, corrected=corrected)
        acc_hist = spark.createDataFrame(acc_hist.collect(), S.DIM_ACCOUNTS_HIST)
        changes = [u or c for _k, (c, u, _cl) in state.items() if (u or c) > wm]
        wm = max([wm] + changes)
        tf = spark.createDataFrame(terminals, S.STG_TERMINALS)
        snap = snapshot_scd2_corrected if corrected else snapshot_scd2
        term_hist = snap(term_hist, tf, load_dt, TERMINALS)
        term_hist = scd2_delete(term_hist, tf.select("terminal_id"), load_dt, TERMINALS, corrected=corrected)
        term_hist = spark.createDataFrame(term_hist.collect(), S.DIM_TERMINALS_HIST)

    st = current_state(store)
    assert rows(st["dim_accounts_hist"]) == rows(acc_hist)
    assert rows(st["dim_terminals_hist"]) == rows(term_hist)
    if not corrected:
        return
    for name, key in (("dim_accounts_hist", "account_num"), ("dim_terminals_hist", "terminal_id")):
        open_per_key = {}
        for r in st[name].collect():
            if r["effective_to"] == S.OPEN_END:
                open_per_key[r[key]] = open_per_key.get(r[key], 0) + 1
        assert all(n == 1 for n in open_per_key.values()), (name, open_per_key)
