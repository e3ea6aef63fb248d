"""Second, late and split deliveries of a date add to it; the report comes out whole."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from cardwatch import schemas as S
from cardwatch.__main__ import main
from cardwatch.plans.daily import current_state, report_of, run_daily
from cardwatch.sources.feeds import next_day
from cardwatch.sources.store import Run, Store
from cardwatch.streaming.feed_stream import start
from tests.test_daily import D, day_files, sources, write_feeds

HEADER = "transaction_id;transaction_date;amount;card_num;oper_type;oper_result;terminal"


def add_file(folder, day, name, rows):
    lines = [HEADER] + [f"{i};{ts:%Y-%m-%d %H:%M:%S};1,00;K1;PAYMENT;SUCCESS;T1" for i, ts in rows]
    (folder / f"{name}_{day:%d%m%Y}.txt").write_text("\n".join(lines) + "\n")


def load_rest(spark, store, folder, day_index):
    n = 0
    while (f := next_day(spark, str(folder), store.ledger(store.effective()))) is not None:
        run_daily(spark, store, f, sources(spark, day_index(f.load_dt)))
        n += 1
        assert n < 6
    return n


def ids(store):
    return sorted(r["trans_id"] for r in current_state(store)["fact_transactions"].collect())


def test_second_and_late_files_add_up(spark, tmp_path):
    folder = tmp_path / "feeds"
    folder.mkdir()
    day_files(folder)
    (folder / "late").mkdir()
    index = {d: i for i, d in enumerate(D)}
    store = Store(spark, str(tmp_path / "wh"))
    assert store.committed() == [] and not os.path.exists(tmp_path / "wh")   # a read writes nothing
    assert load_rest(spark, store, folder, index.get) == 3
    before = current_state(store)["dim_clients_hist"].count()
    # a second file of the newest date, alone
    add_file(folder, D[2], "trans_second", [(20, D[2] + dt.timedelta(hours=11))])
    assert load_rest(spark, store, folder, index.get) == 1
    assert ids(store) == list(range(1, 11)) + [20]
    # a late file of the first date: an operation in another city within the hour
    add_file(folder, D[0], "trans_late", [(21, D[0] + dt.timedelta(hours=10, minutes=59))])
    assert report_of(store, D[0]).count() == 4
    assert load_rest(spark, store, folder, index.get) == 1
    assert ids(store) == list(range(1, 11)) + [20, 21]
    assert report_of(store, D[0]).count() == 5
    assert current_state(store)["rep_fraud"].filter(F.col("report_dt") == F.lit(D[1]).cast("timestamp_ntz")).count() == 5
    # a whole date that arrives late, before every load
    early = D[0] - dt.timedelta(days=3)
    write_feeds(folder, early, [(30, early + dt.timedelta(hours=9), "1,00", "K1", "SUCCESS", "T1")],
                [("T1", "POS", "Moscow", "a1")], [(early, "P9")])
    assert load_rest(spark, store, folder, lambda d: 0) == 1
    assert ids(store) == list(range(1, 11)) + [20, 21, 30]
    assert current_state(store)["dim_clients_hist"].count() == before
    assert next_day(spark, str(folder), store.ledger(store.effective())) is None
    # the next new date loads on top of it all
    after = D[2] + dt.timedelta(days=1)
    write_feeds(folder, after, [(40, after + dt.timedelta(hours=9), "1,00", "K1", "SUCCESS", "T1")],
                [("T1", "POS", "Moscow", "a1")], [(D[1], "P1")])
    assert load_rest(spark, store, folder, lambda d: 1) == 1
    assert ids(store) == list(range(1, 11)) + [20, 21, 30, 40]


def test_complete_second_delivery_does_not_alternate(spark, tmp_path):
    folder = tmp_path / "feeds"
    folder.mkdir()
    t, b = [("T1", "POS", "Moscow", "a1")], [(D[0], "P9")]
    write_feeds(folder, D[0], [(1, D[0] + dt.timedelta(hours=9), "1,00", "K1", "SUCCESS", "T1")], t, b)
    store = Store(spark, str(tmp_path / "wh"))
    assert load_rest(spark, store, folder, lambda d: 0) == 1
    for kind in ("transactions", "terminals", "passport_blacklist"):
        ext = "txt" if kind == "transactions" else "csv"
        text = (folder / f"{kind}_{D[0]:%d%m%Y}.{ext}").read_text().replace("\n1;", "\n2;")
        (folder / f"{kind}_b_{D[0]:%d%m%Y}.{ext}").write_text(text)
    assert load_rest(spark, store, folder, lambda d: 0) == 1
    assert ids(store) == [1, 2]
    assert current_state(store)["fact_passport_blacklist"].count() == 1


@pytest.mark.parametrize("batch", [1, None])
def test_stream_splits_a_date(spark, tmp_path, batch):
    folder = tmp_path / "feeds"
    folder.mkdir()
    day_files(folder)
    add_file(folder, D[0], "trans_more", [(50, D[0] + dt.timedelta(hours=20))])
    store = Store(spark, str(tmp_path / "wh"))
    index = {d: i for i, d in enumerate(D)}

    def run():
        q = start(spark, store, str(folder), lambda d: sources(spark, index[d]), max_files_per_trigger=batch)
        q.awaitTermination(600)
        assert q.exception() is None

    # order of arrival decides the batches
    for n, name in enumerate(sorted(p.name for p in folder.iterdir() if p.name.startswith("tra"))):
        os.utime(folder / name, (time.time() - 100 + n, time.time() - 100 + n))
    run()
    assert ids(store) == list(range(1, 11)) + [50]
    add_file(folder, D[2], "trans_b", [(51, D[2] + dt.timedelta(hours=20))])
    run()
    assert ids(store) == list(range(1, 11)) + [50, 51]


def test_stream_rejects_a_swapped_header(spark, tmp_path):
    folder = tmp_path / "feeds"
    folder.mkdir()
    day_files(folder)
    path = folder / f"transactions_{D[0]:%d%m%Y}.txt"
    path.write_text(path.read_text().replace("oper_type;oper_result", "oper_result;oper_type"))
    with pytest.raises(Exception):
        next_day(spark, str(folder), Store(spark, str(tmp_path / "w1")).ledger([])).transactions.collect()
    store = Store(spark, str(tmp_path / "wh"))
    q = start(spark, store, str(folder), lambda d: sources(spark, 0))
    with pytest.raises(Exception):
        q.awaitTermination(600)
    assert store.committed() == []


def test_dates_compare_without_a_time_zone(spark, tmp_path, monkeypatch):
    folder = tmp_path / "feeds"
    folder.mkdir()
    day_files(folder)
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        day = next_day(spark, str(folder), Store(spark, str(tmp_path / "wh")).ledger([]))
    finally:
        monkeypatch.undo()
        time.tzset()
    assert day.load_dt == D[0] and len(day.files) == 3


def test_report_has_no_row_limit(spark, tmp_path, capsys):
    store = Store(spark, str(tmp_path / "wh"))
    run = Run(store.new_run_id(D[0]), D[0])
    rows = spark.range(2500).select(
        (F.lit(D[0]).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))).alias("event_dt"),
        F.col("id").cast("string").alias("passport"), F.lit("x").alias("fio"), F.lit("y").alias("phone"),
        F.lit("CITY_VELOCITY").alias("event_type"), F.lit(D[1]).cast("timestamp_ntz").alias("report_dt"))
    store.write("rep_fraud", run, rows.select(*[F.col(f.name).cast(f.dataType) for f in S.REP_FRAUD.fields]))
    store.commit(run, "corrected")
    args = ["report", "--warehouse", str(tmp_path / "wh"), "--date", D[0].date().isoformat()]
    assert main(args) == 0
    assert len(capsys.readouterr().out.strip().split("\n")) == 2501
    assert main([*args, "--out", str(tmp_path / "out"), "--format", "parquet"]) == 0
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2500
