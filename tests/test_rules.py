"""Hand scenarios for the four rules and the classifier (FIXTURES.md §3.2)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardwatch import schemas as S
from cardwatch.operators.probing import probing_anchor, probing_ids
from tests.reference_forms import rule_passport
from cardwatch.operators.rules import (
    classify,
    rule_contract,
    rule_passport_corrected,
    with_blacklist_since,
)
from cardwatch.operators.velocity import velocity_anchor, velocity_flags, velocity_ids

T0 = dt.datetime(2024, 1, 10, 12, 0, 0)
DT = dt.datetime(2024, 1, 15)


def ops(spark, rows):
    """rows: (trans_id, card, ts, city)"""
    return spark.createDataFrame(rows, "trans_id long, card_num string, trans_date timestamp_ntz, city string")


def ids(df):
    return sorted(r[0] for r in df.collect())


@pytest.mark.parametrize("k", [1, 4, 12])
def test_city_velocity_boundaries(spark, k):
    s = dt.timedelta(seconds=1)
    rows = [
        (1, "A", T0, "X"), (2, "A", T0 + 59 * 60 * s + 59 * s, "Y"),          # 59:59 later, other city: hit
        (3, "B", T0, "X"), (4, "B", T0 + 3600 * s, "Y"),                      # exactly 1 h: no hit
        (5, "C", T0, "X"), (6, "C", T0, "Y"),                                 # same instant: no hit
        (7, "D", T0, "X"), (8, "D", T0 + 60 * s, "X"),                        # same city: no hit
        (9, "E", T0, "X"), (10, "F", T0 + 60 * s, "Y"),                       # other card: no hit
        (11, "G", T0, None), (12, "G", T0 + 60 * s, "Y"),                     # NULL city: unknown, no hit
        (13, "H", T0, "X"), (14, "H", T0 + 30 * 60 * s, "X"), (15, "H", T0 + 89 * 60 * s, "Y"),  # 59 min after 14
    ]
    o = ops(spark, rows)
    assert ids(velocity_ids(o, dt.timedelta(hours=1), k)) == [2, 15]
    # the earlier end of a pair (the literal rule's MAX(a.trans_date))
    earlier = velocity_flags(o, dt.timedelta(hours=1), k, reverse=True)
    assert sorted({r.trans_id for r in earlier.collect()}) == [1, 14]
    anchor = velocity_anchor(o, dt.timedelta(hours=1), k).collect()[0][0]
    assert anchor == T0 + dt.timedelta(minutes=30)


def test_city_velocity_empty_anchor_is_null(spark):
    o = ops(spark, [(1, "A", T0, "X"), (2, "A", T0 + dt.timedelta(hours=2), "Y")])
    assert velocity_anchor(o).collect()[0][0] is None


def tx(spark, rows):
    """rows: (trans_id, card, ts, amt, result)"""
    df = spark.createDataFrame(
        [(i, c, t, Decimal(str(a)) if a is not None else None, r) for i, c, t, a, r in rows],
        "trans_id long, card_num string, trans_date timestamp_ntz, amt decimal(10,2), oper_result string",
    )
    return df


def test_amount_probing_boundaries(spark):
    m = dt.timedelta(minutes=1)
    s = dt.timedelta(seconds=1)
    rows = [
        # hit: 300, 200, 100 within 19:59
        (1, "A", T0, 300, "REJECT"), (2, "A", T0 + 5 * m, 200, "REJECT"), (3, "A", T0 + 19 * m + 59 * s, 100, "SUCCESS"),
        # exactly 20 minutes: no hit
        (4, "B", T0, 300, "REJECT"), (5, "B", T0 + 5 * m, 200, "REJECT"), (6, "B", T0 + 20 * m, 100, "SUCCESS"),
        # equal amounts: no hit
        (7, "C", T0, 300, "REJECT"), (8, "C", T0 + m, 300, "REJECT"), (9, "C", T0 + 2 * m, 100, "SUCCESS"),
        # success amount not below: no hit
        (10, "D", T0, 300, "REJECT"), (11, "D", T0 + m, 200, "REJECT"), (12, "D", T0 + 2 * m, 250, "SUCCESS"),
        # another row in between: still a hit
        (13, "E", T0, 300, "REJECT"), (14, "E", T0 + m, 999, "SUCCESS"), (15, "E", T0 + 2 * m, 200, "REJECT"),
        (16, "E", T0 + 3 * m, 100, "SUCCESS"),
        # last is a REJECT: no hit
        (17, "F", T0, 300, "REJECT"), (18, "F", T0 + m, 200, "REJECT"), (19, "F", T0 + 2 * m, 100, "REJECT"),
        # order broken (rising): no hit
        (20, "G", T0, 200, "REJECT"), (21, "G", T0 + m, 300, "REJECT"), (22, "G", T0 + 2 * m, 100, "SUCCESS"),
        # equal times of a and b: no hit
        (23, "H", T0, 300, "REJECT"), (24, "H", T0, 200, "REJECT"), (25, "H", T0 + m, 100, "SUCCESS"),
    ]
    t = tx(spark, rows)
    assert ids(probing_ids(t, dt.timedelta(minutes=20))) == [3, 16]
    assert probing_anchor(t, dt.timedelta(minutes=20)).collect()[0][0] == T0


def test_amount_probing_across_bins(spark):
    # the pattern spans a bin boundary of the 20-minute grid
    base = dt.datetime(2024, 1, 10, 12, 15)
    m = dt.timedelta(minutes=1)
    t = tx(spark, [(1, "A", base, 300, "REJECT"), (2, "A", base + 4 * m, 200, "REJECT"),
                   (3, "A", base + 10 * m, 100, "SUCCESS"), (4, "A", base + 21 * m, 50, "SUCCESS")])
    assert ids(probing_ids(t, dt.timedelta(minutes=20))) == [3]


def chain_rows(spark, rows):
    return spark.createDataFrame(
        rows, "trans_id long, trans_date timestamp_ntz, passport_num string, passport_valid_to timestamp_ntz, "
              "valid_to timestamp_ntz")


def test_passport_and_contract(spark):
    bl = spark.createDataFrame([(dt.datetime(2024, 1, 20), "P1"), (dt.datetime(2024, 1, 1), "P2")],
                               "entry_dt timestamp_ntz, passport_num string")
    later, before = dt.datetime(2025, 1, 1), dt.datetime(2024, 1, 1)
    ts = dt.datetime(2024, 1, 16)
    j = chain_rows(spark, [
        (1, ts, "P1", later, later),        # listed, expiry after dt: literal hit; corrected: listed 01-20 > ts
        (2, ts, "P9", before, later),       # expired before dt: hit
        (3, ts, "P2", None, later),         # listed, NULL expiry: literal no hit; corrected hit
        (4, ts, "P9", DT, later),           # expiry = dt: literal no hit; corrected (vs ts) hit
        (5, ts, "P9", later, before),       # contract ended before dt
        (6, ts, "P9", later, DT),           # contract ends at dt: no hit
        (7, ts, "P9", later, None),         # NULL contract end: no hit
    ])
    lit = j.filter(rule_passport(bl, DT)).select("trans_id")
    assert ids(lit) == [1, 2]
    cor = with_blacklist_since(j, bl).filter(rule_passport_corrected()).select("trans_id")
    assert ids(cor) == [2, 3, 4]
    assert ids(j.filter(rule_contract(DT)).select("trans_id")) == [5]


def test_precedence(spark):
    df = spark.createDataFrame([(True, True, True, True), (None, True, False, True), (False, None, None, True),
                                (None, None, None, None)], "a boolean, b boolean, c boolean, d boolean")
    got = [r[0] for r in df.select(classify(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).collect()]
    assert got == [S.EventType.PASSPORT_INVALID, S.EventType.CONTRACT_EXPIRED, S.EventType.AMOUNT_PROBING,
                   S.EventType.OK]


def test_report_event_filter_boundary(spark):
    """trans_date = dt 00:00:00 is excluded, dt 00:00:01 included, the day before excluded."""
    from cardwatch.plans.report import Windows, fraud_report

    sec = dt.timedelta(seconds=1)
    tx = spark.createDataFrame(
        [(1, DT, "K1", "P", Decimal("1.00"), "SUCCESS", "T1"),
         (2, DT + sec, "K1", "P", Decimal("1.00"), "SUCCESS", "T1"),
         (3, DT - dt.timedelta(days=1), "K1", "P", Decimal("1.00"), "SUCCESS", "T1")],
        S.FACT_TRANSACTIONS)
    cards = spark.createDataFrame([("K1 ", "A1")], "card_num string, account_num string")
    acc = spark.createDataFrame([("A1", dt.datetime(2020, 1, 1), "C1")], "account_num string, valid_to timestamp_ntz, client string")
    cl = spark.createDataFrame(
        [("C1", "Doe", "Jan", None, "P1", dt.datetime(2030, 1, 1), "+7")],
        "client_id string, last_name string, first_name string, patronymic string, passport_num string, "
        "passport_valid_to timestamp_ntz, phone string")
    terms = spark.createDataFrame([("T1", "POS", "X", "a", dt.datetime(2020, 1, 1), S.OPEN_END, "N")],
                                  S.DIM_TERMINALS_HIST)
    bl = spark.createDataFrame([], S.FACT_PASSPORT_BLACKLIST)
    rep = fraud_report(tx, cards, acc, cl, terms, bl, DT, Windows()).collect()
    # the contract ended in 2020, so every reported row is CONTRACT_EXPIRED; only id 2 is after dt
    assert [(r["event_dt"], r["event_type"], r["fio"], r["report_dt"]) for r in rep] == [
        (DT + sec, S.EventType.CONTRACT_EXPIRED, "Doe Jan ", DT + dt.timedelta(days=1))]
