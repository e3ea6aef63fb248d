"""R4 in bins that are too large for one task: equal to the triple join and to the sweep, and no group with a large share."""

import datetime as dt
from decimal import Decimal

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cardwatch.functions import epoch_us, window_us
from cardwatch.operators import probing
from cardwatch.operators.probing import probing_anchor, probing_ids
from tests.test_scalable_rules import BASE, brute_probing, random_ops, to_spark

W = dt.timedelta(minutes=20)


@pytest.fixture()
def split_all(monkeypatch):
    """Every bin counts as hot."""
    monkeypatch.setattr(probing, "SPLIT_OVER", 0)
    monkeypatch.setattr(probing, "HOT_SHARE", 10**9)


def one_window(seed, n, amounts, spread_s=1199):
    """All operations of one card in one window."""
    rng = np.random.default_rng(seed)
    return pd.DataFrame({
        "trans_id": np.arange(n, dtype=np.int64), "card_num": "hot",
        "trans_date": [BASE + dt.timedelta(seconds=int(s)) for s in rng.integers(0, spread_s, n)], "city": "X",
        "amt": [Decimal(int(a)) for a in rng.choice(amounts, n)],
        "oper_result": rng.choice(["REJECT", "SUCCESS"], n),
    })


@pytest.mark.parametrize(("seed", "blocks"), [(1, 2), (2, 5), (3, 64)])
def test_split_bins_match_the_triple_join(spark, split_all, monkeypatch, seed, blocks):
    monkeypatch.setattr(probing, "BLOCKS", blocks)
    pdf = random_ops(seed, n=500)
    for minutes in (20, 90):
        w = dt.timedelta(minutes=minutes)
        want_ids, want_anchor = brute_probing(pdf, minutes)
        assert sorted(r[0] for r in probing_ids(to_spark(spark, pdf), w).collect()) == want_ids and want_ids
        assert probing_anchor(to_spark(spark, pdf), w).collect()[0][0] == want_anchor


@pytest.mark.parametrize("amounts", [list(range(1, 2000)), [1, 2, 3], [5] * 9 + [4, 6], [7]])
def test_one_card_in_one_window(spark, split_all, monkeypatch, amounts):
    monkeypatch.setattr(probing, "BLOCKS", 8)
    pdf = one_window(len(amounts), 400, amounts)
    assert sorted(r[0] for r in probing_ids(to_spark(spark, pdf), W).collect()) == brute_probing(pdf, 20)[0]
    at_once = pdf.assign(trans_date=[BASE + dt.timedelta(seconds=int(i % 3)) for i in range(len(pdf))])
    assert sorted(r[0] for r in probing_ids(to_spark(spark, at_once), W).collect()) == brute_probing(at_once, 20)[0]


def hot_frame(spark, n):
    """n operations of one card inside one bin, next to ordinary cards."""
    hot = spark.range(n).select(
        F.col("id").alias("trans_id"), F.when(F.col("id") % 10 == 0, F.concat(F.lit("c"), F.col("id") % 500)).otherwise("hot").alias("card_num"),
        (F.lit(BASE).cast("timestamp_ntz") + F.make_dt_interval(secs=F.pmod(F.xxhash64("id"), F.lit(1_000_000)).cast("decimal(18,6)") / 1000)).alias("trans_date"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100_000)) / 100).cast("decimal(10,2)").alias("amt"),
        F.when(F.pmod(F.xxhash64("id", F.lit(2)), F.lit(2)) == 0, "REJECT").otherwise("SUCCESS").alias("oper_result"),
    )
    return hot


def test_split_equals_the_sweep_at_size(spark, monkeypatch):
    df = hot_frame(spark, 60_000)
    split = sorted(r[0] for r in probing_ids(df, W).collect())
    assert [k[0] for k in probing.hot_bins(probing._points(df, window_us(W))[0], window_us(W))] == ["hot", "hot"]
    monkeypatch.setattr(probing, "SPLIT_OVER", 10**9)
    assert split == sorted(r[0] for r in probing_ids(df, W).collect()) and split


def test_no_group_holds_a_large_share(spark):
    """With a third of all rows at one amount and a third at one instant."""
    df = hot_frame(spark, 30_000).withColumns({
        "amt": F.when(F.col("trans_id") % 3 == 0, F.lit(77)).otherwise(F.col("amt")).cast("decimal(10,2)"),
        "trans_date": F.when(F.col("trans_id") % 3 == 1, F.lit(BASE).cast("timestamp_ntz")).otherwise(F.col("trans_date")),
    })
    rows = df.select("card_num", F.lit(0).cast("long").alias("_bin"), epoch_us("trans_date").alias("_t"),
                     (F.col("amt") * 100).cast("long").alias("_cents"), F.lit(True).alias("_rej"), F.lit(False).alias("_halo")).filter("card_num = 'hot'")
    total = rows.count()
    blocks = probing._by_block(probing._with_blocks(rows)).groupBy("side", "block").count()
    assert blocks.agg(F.max("count")).first()[0] < 3 * total / probing.BLOCKS
    assert blocks.filter("block % 2 = 1").count() == 0
