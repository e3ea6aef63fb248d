"""Newest times observed by the pass that writes: the same watermarks, no second scan."""

import datetime as dt

import pytest

from cardwatch import schemas as S
from cardwatch.operators.extract import advance_watermarks, advance_watermarks_to, seed_watermarks
from cardwatch.plans.daily import run_daily
from cardwatch.sources.feeds import next_day
from cardwatch.sources.store import Store
from pyspark.sql import functions as F
from tests.test_daily import D, day_files, sources

GAP = dt.datetime(2024, 3, 10, 2, 30, 0, 120000)  # does not exist in New York


def test_observed_times_are_wall_clock(spark, tmp_path):
    store = Store(spark, str(tmp_path / "wh"))
    rows = spark.createDataFrame([(GAP,), (dt.datetime(1899, 1, 1),), (None,), (dt.datetime(5999, 12, 31),)], "t timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        out, seen = store.write_observed("x", "r1", rows.filter("t < timestamp_ntz'2100-01-01'"), lo=F.min("t"), hi=F.max("t"))
        assert seen == {"lo": dt.datetime(1899, 1, 1), "hi": GAP} and out.count() == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    for none in (rows.limit(0), rows.filter("t IS NULL"), rows.filter("false"), spark.createDataFrame([], "t timestamp_ntz")):
        assert store.write_observed("y", "r1", none, hi=F.max("t"))[1] == {"hi": None}


@pytest.mark.parametrize("literal", [False, True])
@pytest.mark.parametrize("empty", [False, True])
def test_same_watermarks_as_the_aggregates(spark, literal, empty):
    meta = advance_watermarks_to(seed_watermarks(spark), {S.WM_BLACKLIST: D[0], S.WM_CARDS: D[0]})
    one = lambda col, t: spark.createDataFrame([] if empty else [(t,)], f"{col} timestamp_ntz")
    delta = one("update_dt", GAP).withColumn("create_dt", F.lit(None).cast("timestamp_ntz"))
    want = advance_watermarks(meta, {S.WM_CARDS: delta}, D[0], one("entry_dt", GAP), one("transaction_date", D[0]), literal=literal)
    reached = {S.WM_TERMINALS: D[0], S.WM_CARDS: GAP, S.WM_BLACKLIST: GAP, S.WM_TRANSACTIONS: D[0]}
    if empty:
        reached = dict.fromkeys(reached) | {S.WM_TERMINALS: D[0]}
    got = advance_watermarks_to(meta, reached, literal=literal)
    assert got.schema.names == want.schema.names
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_run_records_the_range_of_its_operations(spark, tmp_path):
    feeds = tmp_path / "feeds"
    feeds.mkdir()
    day_files(feeds)
    store = Store(spark, str(tmp_path / "wh"))
    run = run_daily(spark, store, next_day(spark, str(feeds), store.ledger([])), sources(spark, 0))
    bounds = store.fact("fact_transactions", store.effective()).agg(F.min("trans_date"), F.max("trans_date")).first()
    assert (run.tx_min, run.tx_max) == tuple(bounds)
    newest = {r.table_name: r.last_update_dt for r in store.meta(store.effective()).collect()}
    assert newest[S.WM_TRANSACTIONS] == run.tx_max
