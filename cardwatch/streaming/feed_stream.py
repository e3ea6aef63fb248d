"""Feed intake with Structured Streaming.

The transactions feed is read as a file stream; every micro-batch holds the
rows of newly arrived files.  ``foreachBatch`` splits the batch by the date in
the file name and runs the daily load for each date in order, reading that
date's terminals and blacklist files next to it.  With
``trigger(availableNow=True)`` the query processes whatever has arrived and
stops, which is how a scheduler would start it once a day; without it the
query keeps watching the folder.

Delivery: the file source and its checkpoint make each file part of exactly
one committed micro-batch; a batch replayed after a crash is recognised by
the store's ledger (files already consumed are skipped), so the warehouse sees
each file once.  A date split over several batches, or a second file of a date,
adds to what the date brought before (see ``run_daily``).  ``clean_source="archive"``
moves consumed files away only after their batch commits (the source moves
them first and loses them on failure).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cardwatch import schemas as S
from cardwatch.functions import ts_lit
from cardwatch.plans.daily import Sources, run_daily
from cardwatch.plans.report import Windows
from cardwatch.sources.feeds import (
    GLOBS,
    TRANSACTIONS_GLOB,
    DayFeeds,
    check_complete,
    clean,
    feed_files,
    load_date_column,
    newest_load,
    read_blacklist,
    read_terminals,
    text_options,
    unconsumed,
)
from cardwatch.sources.store import Store


def transactions_stream(spark: SparkSession, directory: str, clean_source: str | None = None,
                        archive_dir: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Rows of new transaction files, with their file name and load date."""
    r = text_options(spark.readStream, S.STG_TRANSACTIONS, decimal_comma=True).option("pathGlobFilter", TRANSACTIONS_GLOB)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if clean_source:
        r = r.option("cleanSource", clean_source)
        if archive_dir:
            r = r.option("sourceArchiveDir", archive_dir)
    df = r.csv(directory)
    name = F.col("_metadata.file_name")
    return clean(df, name.alias("_file_name"), load_date_column(name).alias("_load_dt"))


def daily_batches(store: Store, directory: str, sources: Callable[[_dt.datetime], Sources],
                  semantics: str = "corrected", windows: Windows = Windows(), terminals_fmt: str = "auto",
                  blacklist_fmt: str = "auto") -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: one daily load per file date in the batch.

    ``sources(load_dt)`` returns the source tables as of that load.  Only the
    distinct (date, file) pairs of the batch reach the driver, never rows.
    """

    def handle(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        ledger = store.ledger(store.effective())
        arrived = batch.select(F.lit("transactions").alias("feed"), F.col("_file_name").alias("file_name"), "_load_dt").distinct()
        by_day: dict[_dt.datetime, list[str]] = {}
        for r in unconsumed(arrived, ledger).collect():
            by_day.setdefault(r["_load_dt"], []).append(r["file_name"])
        if None in by_day:
            raise ValueError(f"feed files without a _DDMMYYYY date: {sorted(by_day[None])[:5]}")
        newest = newest_load(ledger)
        for load_dt in sorted(by_day):
            files = by_day[load_dt]
            paths: dict[str, list[str]] = {"transactions": files}
            names = [("transactions", f) for f in files]
            for feed in ("terminals", "blacklist"):
                listed = feed_files(spark, directory, GLOBS[feed], feed).filter(F.col("load_dt") == ts_lit(load_dt))
                for r in unconsumed(listed, ledger).select("path", "file_name").collect():
                    paths.setdefault(feed, []).append(r["path"])
                    names.append((feed, r["file_name"]))
            check_complete(paths, load_dt, newest)
            feeds = DayFeeds(
                load_dt=load_dt,
                transactions=batch.filter(F.col("_file_name").isin(files)).drop("_file_name", "_load_dt"),
                terminals=read_terminals(spark, paths["terminals"], terminals_fmt) if "terminals" in paths else None,
                blacklist=read_blacklist(spark, paths["blacklist"], blacklist_fmt) if "blacklist" in paths else None,
                files=names,
            )
            run_daily(spark, store, feeds, sources(load_dt), semantics, windows)

    return handle


def start(spark: SparkSession, store: Store, directory: str, sources: Callable[[_dt.datetime], Sources],
          checkpoint: str | None = None, available_now: bool = True, semantics: str = "corrected",
          windows: Windows = Windows(), clean_source: str | None = None,
          archive_dir: str | None = None, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the intake query; its checkpoint lives next to the warehouse."""
    stream = transactions_stream(spark, directory, clean_source, archive_dir, max_files_per_trigger)
    w = (
        stream.writeStream.foreachBatch(daily_batches(store, directory, sources, semantics, windows))
        .option("checkpointLocation", checkpoint or f"{store.root}/_stream_checkpoint")
    )
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
