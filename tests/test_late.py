"""Late deliveries: any order of arrival gives the state of loads in order of date; only what a file alters is rebuilt."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from cardwatch import schemas as S
from cardwatch.operators.scd2 import TERMINALS, scd2_delete, snapshot_scd2_corrected

from cardwatch.plans.daily import report_of, run_daily
from cardwatch.plans.late import altered_dates, altered_keys, as_of, insert_snapshot, ordered_blacklist
from cardwatch.sources.feeds import next_day
from cardwatch.sources.store import LOADED, Store
from tests.test_daily import D, snapshot, sources, write_feeds

DAY = dt.timedelta(days=1)


def fold(spark, shots, upto=None):
    """The history by the loads' own operators, one after the other."""
    hist = spark.createDataFrame([], S.DIM_TERMINALS_HIST)
    for date in sorted(shots):
        if upto is None or date < upto:
            f = spark.createDataFrame(shots[date], S.STG_TERMINALS)
            hist = scd2_delete(snapshot_scd2_corrected(hist, f, date, TERMINALS), f.select("terminal_id"), date, TERMINALS, corrected=True)
            hist = spark.createDataFrame(hist.collect(), S.DIM_TERMINALS_HIST)
    return hist


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_snapshot_inserted_into_a_history(spark, seed):
    rnd = random.Random(seed)
    dates = [dt.datetime(2024, 3, 1) + rnd.choice([1, 1, 2]) * k * DAY for k in range(5)]
    dates = sorted(set(dates))
    shots = {d: [(f"T{i}", rnd.choice(["A", None]), rnd.choice("XY"), "a") for i in range(6) if rnd.random() < 0.7] for d in dates}
    whole = fold(spark, shots)
    for date in dates[:-1]:
        without = fold(spark, {d: s for d, s in shots.items() if d != date})
        mine = spark.createDataFrame(shots[date], S.STG_TERMINALS)
        keys = altered_keys(without, mine, date).cache()
        after = [d for d in dates if d >= date]
        shown = None
        for d in after:
            f = spark.createDataFrame(shots[d], S.STG_TERMINALS).withColumn(LOADED, F.lit(d).cast("timestamp_ntz"))
            shown = f if shown is None else shown.unionByName(f)
        got = insert_snapshot(without, shown.join(keys, "terminal_id", "left_semi"), after, keys)
        assert rows(got) == rows(whole), date
        assert keys.count() < 6 or seed
        assert rows(as_of(whole, date)) == rows(fold(spark, shots, date))


def test_blacklists_in_order(spark):
    t = lambda d: dt.datetime(2024, 3, d)
    staged = [(t(2), "a", t(3)), (t(3), "b", t(3)), (t(3), "c", t(4)), (t(5), "d", t(4)), (t(5), "e", t(6)), (t(6), "f", t(6)), (None, "g", t(6))]
    df = spark.createDataFrame(staged, "entry_dt timestamp_ntz, passport_num string, _loaded timestamp_ntz")
    assert sorted(r.passport_num for r in ordered_blacklist(df, t(1)).collect()) == ["a", "b", "d", "f"]
    assert sorted(r.passport_num for r in ordered_blacklist(df, t(2)).collect()) == ["b", "d", "f"]
    assert ordered_blacklist(df.limit(0), t(1)).count() == 0


def test_altered_pairs(spark):
    t = lambda d, h, m=0: dt.datetime(2024, 3, d, h, m)
    dates = [dt.datetime(2024, 3, d) for d in (1, 2, 3, 4)]
    ops = [("K1", t(1, 10), dates[0]), ("K1", t(2, 0, 20), dates[1]), ("K2", t(3, 5), dates[2]), ("K1", t(3, 5), dates[1]), ("K3", t(4, 9), dates[3])]
    df = spark.createDataFrame(ops, "card_num string, trans_date timestamp_ntz, _loaded timestamp_ntz")
    at = lambda *p: spark.createDataFrame(list(p), "card_num string, ts timestamp_ntz")
    hour = dt.timedelta(hours=1)
    got = lambda p, c, since=dates[0]: [d.day for d in altered_dates(df, p, c, dates, since, hour)]
    assert got(at(("K1", t(1, 9, 30))), None) == [1]
    assert got(at(("K1", t(1, 23, 40))), None) == [2]          # reaches over midnight
    assert got(at(("K1", t(1, 23, 20))), None) == []           # an hour is not less than an hour
    assert got(at(("K9", t(1, 23, 40))), None) == []
    # loaded by date 2 and later than date 3's midnight: in both reports
    assert got(at(("K1", t(3, 4, 30))), None) == [2, 3]
    cards = spark.createDataFrame([("K3",), ("K2",)], "card_num string")
    assert got(None, cards) == [3, 4] and got(None, cards, dates[3]) == [4]


def world(folder, seed, days=3):
    """Files of some dates: operations around midnight, moving terminals, lists that do not only grow."""
    rnd = random.Random(seed)
    n = itertools.count(1)
    for k in range(days):
        day = D[0] + k * DAY
        tx = []
        for card in ("K1", "K2"):
            when = [day + dt.timedelta(minutes=m) for m in sorted(rnd.sample(range(5, 60), 3) + rnd.sample(range(1380, 1440), 3))]
            amounts = sorted((rnd.randint(1, 99) for _ in when), reverse=True)
            tx += [(next(n), w, f"{a},00", card, rnd.choice(["REJECT", "REJECT", "SUCCESS"]), f"T{rnd.randint(1, 4)}") for w, a in zip(when, amounts)]
        terms = [(f"T{i}", "POS", rnd.choice(["Moscow", "Kazan"]), "a") for i in range(1, 5) if rnd.random() < 0.8]
        listed = [(day - rnd.randint(-1, 2) * DAY, rnd.choice(["P1", "P2", "P9"])) for _ in range(rnd.randint(1, 2))]
        write_feeds(folder, day, tx, terms, listed)


@pytest.mark.parametrize(("seed", "orders"), [(1, [(2, 1, 0)]), (2, [(2, 0, 1)])])
def test_any_order_of_arrival_gives_the_same_state(spark, tmp_path, seed, orders):
    src = tmp_path / "all"
    src.mkdir()
    world(src, seed)
    states = {}
    for order in [(0, 1, 2), *orders]:
        folder, store = tmp_path / f"in-{order}", Store(spark, str(tmp_path / f"wh-{order}"))
        folder.mkdir()
        for k in order:
            tag = f"{D[0] + k * DAY:%d%m%Y}"
            for p in src.glob(f"*_{tag}.*"):
                (folder / p.name).write_bytes(p.read_bytes())
            day = next_day(spark, str(folder), store.ledger(store.effective()))
            assert day.load_dt == D[0] + k * DAY
            run_daily(spark, store, day, sources(spark, 0))
        states[order] = snapshot(store)
    first = states[0, 1, 2]
    assert len(first["rep_fraud"]) > 3
    for order, state in states.items():
        for table in first:
            assert state[table] == first[table], (order, table)


def test_reports_that_a_late_file_cannot_alter_stay(spark, tmp_path):
    folder, store = tmp_path / "in", Store(spark, str(tmp_path / "wh"))
    folder.mkdir()
    world(folder, 5)
    while (day := next_day(spark, str(folder), store.ledger(store.effective()))) is not None:
        run_daily(spark, store, day, sources(spark, 0))
    before = {d: rows(report_of(store, d)) for d in D}
    name = f"transactions_b_{D[0]:%d%m%Y}.txt"
    (folder / name).write_text(
        "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"
        f"900;{D[0]:%Y-%m-%d} 12:00:00;1,00;K2;PAYMENT;SUCCESS;T1\n")
    run = run_daily(spark, store, next_day(spark, str(folder), store.ledger(store.effective())), sources(spark, 0))
    assert run.kind == "late" and run.reports == (D[0],) and run.rebased == ()
    after = {d: rows(report_of(store, d)) for d in D}
    assert after[D[1]] == before[D[1]] and after[D[2]] == before[D[2]] and set(after[D[0]]) > set(before[D[0]])
