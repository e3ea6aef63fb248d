"""File-stream intake drives the daily load; a second start finds nothing new."""

from cardwatch.plans.daily import current_state, report_of
from cardwatch.sources.store import Store
from cardwatch.streaming.feed_stream import start
from tests.test_daily import D, day_files, sources


def test_stream_available_now(spark, tmp_path):
    feeds = tmp_path / "feeds"
    feeds.mkdir()
    day_files(feeds)
    store = Store(spark, str(tmp_path / "wh"))
    by_day = {d: i for i, d in enumerate(D)}
    q = start(spark, store, str(feeds), lambda d: sources(spark, by_day[d]))
    q.awaitTermination(600)
    assert q.exception() is None
    assert [r.load_dt for r in store.effective()] == D
    assert current_state(store)["fact_transactions"].count() == 10
    assert report_of(store, D[0]).count() == 4
    # restart from the checkpoint: no new files, no new runs
    n = len(store.committed())
    q2 = start(spark, store, str(feeds), lambda d: sources(spark, by_day[d]))
    q2.awaitTermination(600)
    assert len(store.committed()) == n
