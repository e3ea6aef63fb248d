"""SCD2 hand scenarios (FIXTURES.md §3.1) and invariants of the corrected forms."""

import datetime as dt

from pyspark.sql import functions as F

from cardwatch import schemas as S
from cardwatch.operators.extract import advance_watermarks, incremental_extract, seed_watermarks
from cardwatch.operators.scd2 import (
    ACCOUNTS,
    TERMINALS,
    scd2_load,
    snapshot_scd2,
    snapshot_scd2_corrected,
)

D1, D2, D3 = dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 2), dt.datetime(2024, 3, 3)
OPEN = S.OPEN_END


def src(spark, rows):
    return spark.createDataFrame(rows, S.SRC_ACCOUNTS)


def empty_hist(spark, schema=S.DIM_ACCOUNTS_HIST):
    return spark.createDataFrame([], schema)


def load(spark, hist, source, wm, load_dt, corrected=False):
    delta = incremental_extract(source, wm)
    keys = source.select("account")
    return scd2_load(hist, delta, keys, load_dt, ACCOUNTS, corrected=corrected)


def rows(df, key="account_num"):
    return sorted((r[key], r["effective_from"], r["effective_to"], r["deleted_flg"]) for r in df.collect())


def test_new_changed_unchanged(spark):
    v = dt.datetime(2030, 1, 1)
    day1 = src(spark, [("A", v, "C1", D1, None), ("B", v, "C2", D1, None)])
    h1 = load(spark, empty_hist(spark), day1, S.BEGINNING, D1)
    assert rows(h1) == [("A", D1, OPEN, "N"), ("B", D1, OPEN, "N")]
    noon = D2 + dt.timedelta(hours=12)
    day2 = src(spark, [("A", v, "C9", D1, noon), ("B", v, "C2", D1, None)])
    h2 = load(spark, h1, day2, D1, D2)
    assert rows(h2) == [
        ("A", D1, D1 + dt.timedelta(hours=12), "N"),   # one day before, time of day kept
        ("A", noon, OPEN, "N"),
        ("B", D1, OPEN, "N"),                          # unchanged: not in the delta, untouched
    ]


def test_watermark_tie_not_extracted(spark):
    s = src(spark, [("A", None, "C", D1, None), ("B", None, "C", D1 + dt.timedelta(seconds=1), None)])
    assert [r["account"] for r in incremental_extract(s, D1).collect()] == ["B"]


def test_delete_literal_and_corrected(spark):
    v = dt.datetime(2030, 1, 1)
    h = load(spark, empty_hist(spark), src(spark, [("A", v, "C", D1, None), ("B", v, "C", D1, None)]),
             S.BEGINNING, D1)
    day2 = src(spark, [("B", v, "C", D1, None)])
    lit = load(spark, h, day2, D1, D2)
    assert rows(lit) == [("A", D1, D3, "N"), ("A", D2, OPEN, "Y"), ("B", D1, OPEN, "N")]   # 2-day overlap
    cor = load(spark, h, day2, D1, D2, corrected=True)
    assert rows(cor) == [("A", D1, D1, "N"), ("A", D2, OPEN, "Y"), ("B", D1, OPEN, "N")]


def test_back_after_delete(spark):
    v = dt.datetime(2030, 1, 1)
    h = load(spark, empty_hist(spark), src(spark, [("A", v, "C", D1, None)]), S.BEGINNING, D1)
    h = load(spark, h, spark.createDataFrame([], S.SRC_ACCOUNTS), D1, D2)
    back = src(spark, [("A", v, "C", D3, None)])
    lit = load(spark, h, back, D1, D3)
    open_rows = [r for r in rows(lit) if r[2] == OPEN]
    assert open_rows == [("A", D2, OPEN, "Y"), ("A", D3, OPEN, "N")]          # literal: both stay open
    h_c = load(spark, load(spark, empty_hist(spark), src(spark, [("A", v, "C", D1, None)]), S.BEGINNING, D1),
               spark.createDataFrame([], S.SRC_ACCOUNTS), D1, D2, corrected=True)
    cor = load(spark, h_c, back, D1, D3, corrected=True)
    assert [r for r in rows(cor) if r[2] == OPEN] == [("A", D3, OPEN, "N")]   # corrected: tombstone closed


def test_empty_delta_keeps_dim_watermark(spark):
    meta = seed_watermarks(spark)
    empty = spark.createDataFrame([], S.SRC_ACCOUNTS)
    bl = spark.createDataFrame([], S.FACT_PASSPORT_BLACKLIST)
    stg = spark.createDataFrame([], S.STG_TRANSACTIONS)
    new = {r["table_name"]: r["last_update_dt"] for r in
           advance_watermarks(meta, {S.WM_ACCOUNTS: empty}, D2, bl, stg).collect()}
    assert new[S.WM_ACCOUNTS] == S.BEGINNING
    assert new[S.WM_TERMINALS] == D2
    assert new[S.WM_BLACKLIST] == S.BEGINNING          # corrected: kept
    lit = {r["table_name"]: r["last_update_dt"] for r in
           advance_watermarks(meta, {S.WM_ACCOUNTS: empty}, D2, bl, stg, literal=True).collect()}
    assert lit[S.WM_BLACKLIST] is None and lit[S.WM_TRANSACTIONS] is None   # literal: NULL on an empty feed


def terms(spark, rows):
    return spark.createDataFrame(rows, S.STG_TERMINALS)


def run_terms(spark, files, corrected):
    from cardwatch.operators.scd2 import scd2_delete

    h = spark.createDataFrame([], S.DIM_TERMINALS_HIST)
    for day, f in files:
        snap = snapshot_scd2_corrected if corrected else snapshot_scd2
        h = snap(h, f, day, TERMINALS)
        h = scd2_delete(h, f.select("terminal_id"), day, TERMINALS, corrected=corrected)
        h = spark.createDataFrame(h.collect(), S.DIM_TERMINALS_HIST)   # keep plans small in the test
    return h


def test_terminals_same_moved_type(spark):
    files = [
        (D1, terms(spark, [("T1", "ATM", "A", "x"), ("T2", "ATM", "A", "x"), ("T3", "ATM", "A", "x")])),
        (D2, terms(spark, [("T1", "ATM", "A", "x"), ("T2", "ATM", "B", "x"), ("T3", "POS", "A", "x")])),
        (D3, terms(spark, [("T1", "ATM", "A", "x"), ("T2", "ATM", "B", "x"), ("T3", "POS", "A", "x")])),
    ]
    lit = run_terms(spark, files, corrected=False)
    open_lit = lit.filter(F.col("effective_to") == F.lit(OPEN)).groupBy("terminal_id").count().collect()
    n_open = {r[0]: r[1] for r in open_lit}
    assert "T1" not in n_open                       # listed every day: closed on day 2, never reopened
    assert n_open.get("T2", 0) >= 1                 # moved: a new row each day it differs from any version
    assert "T3" not in n_open                       # type only: no new version, closed like T1
    cor = run_terms(spark, files, corrected=True)
    versions = {}
    for r in cor.collect():
        versions.setdefault(r["terminal_id"], []).append((r["effective_from"], r["effective_to"], r["terminal_city"],
                                                          r["terminal_type"]))
    assert versions["T1"] == [(D1, OPEN, "A", "ATM")]
    assert sorted(versions["T2"]) == [(D1, D1, "A", "ATM"), (D2, OPEN, "B", "ATM")]
    assert sorted(versions["T3"]) == [(D1, D1, "A", "ATM"), (D2, OPEN, "A", "POS")]


def test_corrected_invariants_random(spark):
    """At most one open row per key, no overlapping versions, from <= to."""
    import random

    rnd = random.Random(7)
    v = dt.datetime(2030, 1, 1)
    keys = [f"K{i}" for i in range(30)]
    state = {}
    hist = empty_hist(spark)
    wm = S.BEGINNING
    for day in range(6):
        load_dt = D1 + dt.timedelta(days=day)
        for k in keys:
            x = rnd.random()
            if k not in state and x < 0.5:
                state[k] = (load_dt + dt.timedelta(hours=rnd.randint(0, 20)), None)
            elif k in state and x < 0.15:
                del state[k]
            elif k in state and x < 0.4:
                state[k] = (state[k][0], load_dt + dt.timedelta(hours=rnd.randint(1, 20)))
        source = src(spark, [(k, v, "C", c, u) for k, (c, u) in state.items()])
        hist = load(spark, hist, source, wm, load_dt + dt.timedelta(days=1), corrected=True)
        hist = spark.createDataFrame(hist.collect(), S.DIM_ACCOUNTS_HIST)
        wm = max([wm] + [u or c for c, u in state.values()])
    by_key = {}
    for r in hist.collect():
        by_key.setdefault(r["account_num"], []).append(r)
    for k, vs in by_key.items():
        live_open = [r for r in vs if r["effective_to"] == OPEN]
        assert len(live_open) <= 1, (k, vs)
        vs = sorted(vs, key=lambda r: r["effective_from"])
        for r in vs:
            assert r["effective_from"] <= r["effective_to"] + dt.timedelta(days=1), r
        for a, b in zip(vs, vs[1:]):
            assert a["effective_to"] < b["effective_from"], (k, a, b)


def test_ambiguous_merge_raises(spark):
    """More than one delta row (or file row) per key makes the MERGE ambiguous."""
    import pytest

    v = dt.datetime(2030, 1, 1)
    h = load(spark, empty_hist(spark), src(spark, [("A", v, "C", D1, None)]), S.BEGINNING, D1)
    dup = src(spark, [("A", v, "C", D1, D2), ("A", v, "C2", D1, D3)])
    from cardwatch.operators.scd2 import scd2_close

    with pytest.raises(Exception, match="more than one"):
        scd2_close(h, dup, ACCOUNTS).collect()
    th = run_terms(spark, [(D1, terms(spark, [("T1", "ATM", "A", "x")]))], corrected=False)
    two = terms(spark, [("T1", "ATM", "A", "x"), ("T1", "ATM", "B", "x")])
    with pytest.raises(Exception, match="more than one"):
        snapshot_scd2(th, two, D2, TERMINALS).collect()
    with pytest.raises(Exception, match="duplicate key"):
        snapshot_scd2_corrected(th, two, D2, TERMINALS).collect()


def test_read_watermark_value(spark):
    from cardwatch.operators.extract import read_watermark_value

    meta = seed_watermarks(spark)
    assert read_watermark_value(meta, S.WM_CLIENTS) == S.BEGINNING
    import pytest

    with pytest.raises(ValueError):
        read_watermark_value(meta, "no_such_table")
