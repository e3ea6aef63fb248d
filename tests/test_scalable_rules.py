"""The binned R3/R4 forms equal the source's self-joins on random data with a
hot card, equal timestamps, NULL cities and repeated amounts (SURVEY §5.4)."""

import datetime as dt
from decimal import Decimal

import duckdb
import numpy as np
import pandas as pd
import pytest

from cardwatch.operators.probing import probing_anchor, probing_ids
from cardwatch.operators.velocity import velocity_anchor, velocity_ids

BASE = dt.datetime(2024, 1, 10)


def random_ops(seed: int, n: int = 700):
    rng = np.random.default_rng(seed)
    # card "hot" holds about half of all rows
    cards = np.where(rng.random(n) < 0.5, "hot", rng.choice(["c1", "c2", "c3", "c4"], n))
    # minute resolution over ~10 hours: many ties and many pairs within a window
    minutes = rng.integers(0, 600, n)
    secs = rng.choice([0, 0, 0, 30], n)
    ts = [BASE + dt.timedelta(minutes=int(m), seconds=int(s)) for m, s in zip(minutes, secs)]
    city = rng.choice(["X", "Y", "Z", None], n, p=[0.5, 0.3, 0.15, 0.05])
    amt = rng.choice([100, 150, 200, 250, 300, 350], n)
    res = rng.choice(["REJECT", "SUCCESS", "OTHER"], n, p=[0.55, 0.4, 0.05])
    return pd.DataFrame({
        "trans_id": np.arange(n, dtype=np.int64), "card_num": cards, "trans_date": ts, "city": city,
        "amt": [Decimal(int(a)) for a in amt], "oper_result": res,
    })


def brute_velocity(pdf, window_min):
    con = duckdb.connect()
    con.register("o", pdf)
    ids = con.execute(f"""SELECT DISTINCT b.trans_id FROM o a JOIN o b ON a.card_num = b.card_num
        AND a.trans_date < b.trans_date WHERE a.city <> b.city
        AND b.trans_date - a.trans_date < INTERVAL {window_min} MINUTE""").fetchall()
    anchor = con.execute(f"""SELECT max(a.trans_date) FROM o a JOIN o b ON a.card_num = b.card_num
        AND a.trans_date < b.trans_date WHERE a.city <> b.city
        AND b.trans_date - a.trans_date < INTERVAL {window_min} MINUTE""").fetchall()[0][0]
    return sorted(r[0] for r in ids), anchor


def brute_probing(pdf, window_min):
    con = duckdb.connect()
    con.register("t", pdf)
    q = f"""FROM t a JOIN t b ON a.card_num = b.card_num AND a.trans_date < b.trans_date
        JOIN t c ON b.card_num = c.card_num AND b.trans_date < c.trans_date
        WHERE a.oper_result = 'REJECT' AND b.oper_result = 'REJECT' AND c.oper_result = 'SUCCESS'
          AND a.amt > b.amt AND b.amt > c.amt AND c.trans_date - a.trans_date < INTERVAL {window_min} MINUTE"""
    ids = con.execute(f"SELECT DISTINCT c.trans_id {q}").fetchall()
    anchor = con.execute(f"SELECT max(a.trans_date) {q}").fetchall()[0][0]
    return sorted(r[0] for r in ids), anchor


def to_spark(spark, pdf):
    rows = [(int(r.trans_id), r.card_num, r.trans_date.to_pydatetime(), r.city, r.amt, r.oper_result)
            for r in pdf.itertuples(index=False)]
    return spark.createDataFrame(
        rows,
        "trans_id long, card_num string, trans_date timestamp_ntz, city string, amt decimal(10,2), "
        "oper_result string",
    )


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("window_min,k", [(60, 1), (60, 12), (45, 5)])
def test_velocity_matches_self_join(spark, seed, window_min, k):
    pdf = random_ops(seed)
    want_ids, want_anchor = brute_velocity(pdf, window_min)
    df = to_spark(spark, pdf)
    w = dt.timedelta(minutes=window_min)
    got = sorted(r[0] for r in velocity_ids(df, w, k).collect())
    assert got == want_ids and len(got) > 0
    assert velocity_anchor(df, w, k).collect()[0][0] == want_anchor


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("window_min", [20, 90])
def test_probing_matches_triple_join(spark, seed, window_min):
    pdf = random_ops(seed, n=500)
    want_ids, want_anchor = brute_probing(pdf, window_min)
    df = to_spark(spark, pdf)
    w = dt.timedelta(minutes=window_min)
    got = sorted(r[0] for r in probing_ids(df, w).collect())
    assert got == want_ids and len(got) > 0
    assert probing_anchor(df, w).collect()[0][0] == want_anchor


def test_pile_of_copies(spark):
    """A third of the rows are copies of one operation: results stay exact and
    the copies are aggregated before the first shuffle."""
    import contextlib
    import io

    pdf = random_ops(5, n=450)
    copy = pdf.iloc[0].copy()
    copy["card_num"], copy["oper_result"], copy["city"] = "hot", "REJECT", "X"
    extra = pd.DataFrame([copy] * 225)
    extra["trans_id"] = np.arange(1000, 1225)
    pdf = pd.concat([pdf, extra], ignore_index=True)
    df = to_spark(spark, pdf)
    assert sorted(r[0] for r in velocity_ids(df, dt.timedelta(minutes=60), 12).collect()) == \
        brute_velocity(pdf, 60)[0]
    assert sorted(r[0] for r in probing_ids(df, dt.timedelta(minutes=20)).collect()) == brute_probing(pdf, 20)[0]
    for plan_df in (velocity_ids(df, dt.timedelta(minutes=60), 12), probing_ids(df, dt.timedelta(minutes=20))):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            plan_df.explain()
        # partial (map-side) aggregate on the point keys below the first exchange
        assert "HashAggregate(keys=[card_num" in buf.getvalue()
