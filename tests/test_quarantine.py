"""Bad feed lines: by default the load fails; quarantined, they are on record with file and text and the rest loads."""

import pytest

from cardwatch.plans.daily import report_of, run_daily
from cardwatch.sources.feeds import QUARANTINE, next_day, quarantined_transactions
from cardwatch.sources.store import Store
from tests.test_daily import D, day_files, sources
from tests.test_deliveries import add_file


def spoil(folder):
    """A short line, a date and an amount that do not parse, an id that is no number; a bad date in the blacklist."""
    tx = folder / f"transactions_{D[0]:%d%m%Y}.txt"
    bad = ["77;2024-03-01 10:00:00;1,00", "78;yesterday;1,00;K1;PAYMENT;SUCCESS;T1", "79;2024-03-01 11:00:00;a lot;K1;PAYMENT;SUCCESS;T1", "x80;2024-03-01 12:00:00;1,50;K1;PAYMENT;SUCCESS;T1"]
    tx.write_text(tx.read_text() + "\n".join(bad) + "\n")
    bl = folder / f"passport_blacklist_{D[0]:%d%m%Y}.csv"
    bl.write_text(bl.read_text() + "some day;P7\n")
    return tx.name, bad, bl.name


@pytest.fixture()
def folder(tmp_path):
    out = tmp_path / "feeds"
    out.mkdir()
    day_files(out)
    return out


def test_bad_lines_are_on_record_and_the_rest_loads(spark, tmp_path, folder):
    clean = Store(spark, str(tmp_path / "clean"))
    run_daily(spark, clean, next_day(spark, str(folder), clean.ledger(clean.effective())), sources(spark, 0))
    tx, bad, bl = spoil(folder)
    store = Store(spark, str(tmp_path / "wh"))
    with pytest.raises(Exception):
        run_daily(spark, store, next_day(spark, str(folder), store.ledger([])), sources(spark, 0))
    with pytest.raises(ValueError, match="5 of 15 lines"):
        run_daily(spark, store, next_day(spark, str(folder), store.ledger([]), bad_rows=QUARANTINE), sources(spark, 0))
    assert store.effective() == []
    day = next_day(spark, str(folder), store.ledger([]), bad_rows=QUARANTINE, max_reject_share=0.5)
    run = run_daily(spark, store, day, sources(spark, 0))
    assert "rejects" in run.feeds
    got = sorted(map(tuple, store.rejects(store.effective()).collect()))
    assert [g[:3] for g in got if g[3] == "malformed"] == sorted([("blacklist", bl, "some day;P7"), *(("transactions", tx, x) for x in bad[:3])])
    other = [g for g in got if g[3] != "malformed"]
    assert len(other) == 1 and other[0][3] == "transaction_id" and other[0][2].startswith("x80;2024-03-01 12:00:00;1.50;K1")
    for s in (clean, store):
        s.effective()
    assert sorted(map(tuple, report_of(store, D[0]).collect())) == sorted(map(tuple, report_of(clean, D[0]).collect()))
    assert store.fact("fact_transactions", store.effective()).count() == 7
    # a second delivery adds its own; what the first one left out stays on record
    add_file(folder, D[0], "trans_b", [(81, D[0].replace(hour=20))])
    p = folder / f"trans_b_{D[0]:%d%m%Y}.txt"
    p.write_text(p.read_text() + "82;never;1,00;K1;PAYMENT;SUCCESS;T1\n")
    run_daily(spark, store, next_day(spark, str(folder), store.ledger(store.effective()), bad_rows=QUARANTINE, max_reject_share=0.5), sources(spark, 0))
    assert len(store.effective()) == 1 and store.rejects(store.effective()).count() == 6
    assert store.fact("fact_transactions", store.effective()).count() == 8


def test_another_header_still_fails(spark, folder):
    tx = folder / f"transactions_{D[0]:%d%m%Y}.txt"
    tx.write_text(tx.read_text().replace("oper_type;oper_result", "oper_result;oper_type"))
    with pytest.raises(Exception):
        quarantined_transactions(spark, str(tx))[0].collect()
