"""The command line loads every feed day and prints a report."""

from cardwatch import schemas as S
from cardwatch.__main__ import main
from tests.test_daily import D, day_files, sources


def test_cli_load_and_report(spark, tmp_path, capsys):
    feeds = tmp_path / "feeds"
    feeds.mkdir()
    day_files(feeds)
    src = sources(spark, 0)
    paths = {}
    for kind in ("accounts", "cards", "clients"):
        p = str(tmp_path / kind)
        getattr(src, kind).write.parquet(p)
        paths[kind] = p
    wh = str(tmp_path / "wh")
    assert main(["load", "--feeds", str(feeds), "--warehouse", wh, "--accounts", paths["accounts"],
                 "--cards", paths["cards"], "--clients", paths["clients"]]) == 0
    out = capsys.readouterr().out
    assert out.count("loaded ") == 3
    assert main(["report", "--warehouse", wh, "--date", D[0].date().isoformat(), "--labels"]) == 0
    out = capsys.readouterr().out
    assert S.EventType.LABELS["AMOUNT_PROBING"] in out
