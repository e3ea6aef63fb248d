"""Formats and dialect semantics (FIXTURES.md §3.3)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardwatch.functions import concat_nullable, epoch_us, from_epoch_us
from cardwatch.operators.joins import trimmed_key_join
from cardwatch.sources.feeds import load_date_from_name, read_blacklist, read_terminals, read_transactions


def test_decimal_comma_csv(spark, tmp_path):
    p = tmp_path / "transactions_01032021.txt"
    p.write_text(
        "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal\n"
        "1;2021-03-01 00:00:01;1234,56;4000 1;PAYMENT;SUCCESS;T1\n"
        "2;2021-03-01 10:20:30;7,5;4000 2;WITHDRAW;REJECT;\n"
    )
    rows = read_transactions(spark, str(p)).orderBy("transaction_id").collect()
    assert rows[0]["amount"] == Decimal("1234.56")
    assert rows[1]["amount"] == Decimal("7.50")
    assert rows[0]["transaction_date"] == dt.datetime(2021, 3, 1, 0, 0, 1)
    assert rows[1]["terminal"] is None


def test_header_mismatch_fails(spark, tmp_path):
    p = tmp_path / "terminals_01032021.csv"
    p.write_text("terminal_id;terminal_kind;terminal_city;terminal_address\nT1;POS;X;Y\n")
    with pytest.raises(Exception):
        read_terminals(spark, str(p)).collect()


def test_blacklist_columns(spark, tmp_path):
    p = tmp_path / "passport_blacklist_01032021.csv"
    p.write_text("date;passport\n2021-03-01 00:00:00;1234 567890\n")
    r = read_blacklist(spark, str(p)).collect()[0]
    assert r["entry_dt"] == dt.datetime(2021, 3, 1) and r["passport_num"] == "1234 567890"


def test_load_date_from_name():
    assert load_date_from_name("Plain_files/terminals_03032021.csv") == dt.datetime(2021, 3, 3)
    with pytest.raises(ValueError):
        load_date_from_name("terminals.csv")


def test_padded_card_join(spark):
    txs = spark.createDataFrame([(1, "4000 1")], "trans_id long, card_num string")
    cards = spark.createDataFrame([("4000 1   ", "ACC1")], "card_num string, account_num string")
    assert trimmed_key_join(txs, cards).collect()[0]["account_num"] == "ACC1"


def test_null_concat(spark):
    df = spark.createDataFrame([("Doe", "Jan", None), (None, None, None)], "l string, f string, p string")
    got = [r[0] for r in df.select(concat_nullable("l", "f", "p")).collect()]
    assert got == ["Doe Jan ", "  "]


def test_epoch_roundtrip_is_zone_independent(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.sql("SELECT timestamp_ntz'2024-03-10 02:30:00.123456' AS ts")
        r = df.select(epoch_us("ts").alias("us"), from_epoch_us(epoch_us("ts")).alias("back")).collect()[0]
        assert r["us"] == 1710037800123456
        assert r["back"] == dt.datetime(2024, 3, 10, 2, 30, 0, 123456)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert F is not None


def test_undated_feed_file_is_reported(spark, tmp_path):
    from cardwatch.sources.feeds import next_day

    (tmp_path / "transactions_final.txt").write_text("transaction_id;transaction_date\n")
    ledger = spark.createDataFrame([], "feed string, file_name string, load_dt timestamp_ntz, run_id string")
    with pytest.raises(ValueError, match="without a _DDMMYYYY date"):
        next_day(spark, str(tmp_path), ledger)


def test_transaction_rejects(spark):
    from cardwatch.operators.facts import load_fact_transactions, transaction_rejects

    stg = spark.createDataFrame(
        [("1", dt.datetime(2021, 3, 1), Decimal("1.00"), "c", "t", "SUCCESS", "T"),
         ("x2", dt.datetime(2021, 3, 1), Decimal("2.00"), "c", "t", "SUCCESS", "T")],
        "transaction_id string, transaction_date timestamp_ntz, amount decimal(10,2), card_num string, "
        "oper_type string, oper_result string, terminal string")
    assert [r["transaction_id"] for r in transaction_rejects(stg).collect()] == ["x2"]
    assert load_fact_transactions(stg.filter("transaction_id = '1'")).collect()[0]["trans_id"] == 1


def test_source_table_types_and_empty_strings(spark):
    from cardwatch import schemas as S
    from cardwatch.sources.tables import source_table

    spark.createDataFrame(
        [("A1", "2030-01-01 00:00:00", "", "2024-01-01 00:00:00", None)],
        "account string, valid_to string, client string, create_dt string, update_dt string",
    ).createOrReplaceTempView("src_accounts_view")
    df = source_table(spark, "src_accounts_view", "accounts")
    assert df.schema == S.SRC_ACCOUNTS
    r = df.collect()[0]
    assert r["client"] is None and r["valid_to"] == dt.datetime(2030, 1, 1)
