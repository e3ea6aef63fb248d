"""The one-shuffle as-of chain equals the sequential as-of joins, including
overlapping versions, tombstones, gaps between versions and missing keys."""

import datetime as dt
import random

import pytest

from cardwatch import schemas as S
from cardwatch.operators.joins import asof_dim_chain
from tests.reference_forms import asof_dim_chain_sequential

BASE = dt.datetime(2024, 1, 1)


def versions(rnd, keys, attrs_fn):
    rows = []
    for k in keys:
        start = BASE + dt.timedelta(days=rnd.randint(-3, 3), hours=rnd.randint(0, 23))
        for _ in range(rnd.randint(0, 3)):
            length = dt.timedelta(days=rnd.randint(0, 4), hours=rnd.randint(0, 23))
            end = start + length if rnd.random() < 0.8 else S.OPEN_END
            flag = "Y" if rnd.random() < 0.15 else "N"
            rows.append((k, *attrs_fn(), start, end, flag))
            # next version: overlapping, adjacent or after a gap
            start = start + dt.timedelta(days=rnd.randint(-1, 4), hours=rnd.randint(0, 12))
    return rows


@pytest.mark.parametrize("seed", [3, 11])
def test_asof_chain_equals_sequential(spark, seed):
    rnd = random.Random(seed)
    cards_k = [f"K{i}" for i in range(12)]
    acc_k = [f"A{i}" for i in range(8)]
    cl_k = [f"C{i}" for i in range(6)]
    cards = spark.createDataFrame(
        [(k + "  " * (i % 2), *rest) for i, (k, *rest) in
         enumerate(versions(rnd, cards_k, lambda: (rnd.choice(acc_k + ["A99", None]),)))],
        S.DIM_CARDS_HIST)
    accounts = spark.createDataFrame(
        versions(rnd, acc_k, lambda: (BASE + dt.timedelta(days=rnd.randint(-5, 5)), rnd.choice(cl_k + [None]))),
        S.DIM_ACCOUNTS_HIST)
    clients = spark.createDataFrame(
        versions(rnd, cl_k, lambda: ("L", rnd.choice(["F", None]), None, BASE, f"P{rnd.randint(0, 3)}",
                                     BASE + dt.timedelta(days=rnd.randint(-2, 8)), "+7")),
        S.DIM_CLIENTS_HIST)
    tx = spark.createDataFrame(
        [(i, BASE + dt.timedelta(days=rnd.randint(-4, 10), hours=rnd.randint(0, 23), minutes=rnd.randint(0, 59)),
          rnd.choice(cards_k + ["K77"])) for i in range(400)],
        "trans_id long, trans_date timestamp_ntz, card_num string")
    got = sorted(map(tuple, asof_dim_chain(tx, cards, accounts, clients).collect()), key=repr)
    want = sorted(map(tuple, asof_dim_chain_sequential(tx, cards, accounts, clients).collect()), key=repr)
    assert len(want) >= 400
    assert got == want
