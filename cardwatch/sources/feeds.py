"""Daily flat-file feeds.

* transactions: ``;``-separated text with a header and a decimal *comma*;
* terminals: full snapshot of the terminal list, one workbook (or text or parquet file) per day;
* passport blacklist: cumulative list of (date, passport), in the same formats.

Files carry their date as ``..._DDMMYYYY.<ext>``.  Readers take explicit
schemas, fail fast on a malformed row, and check the header against the
schema.  Instead of moving consumed files away (the source renames them into
an archive before loading, and loses them if the load fails), consumption is
recorded in a ledger committed together with the run; unconsumed
files are found with a ``left_anti`` join against it.
"""

from __future__ import annotations

import datetime as _dt
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch import schemas as S
from cardwatch.functions import empty_as_null, ts_lit
from cardwatch.sources.workbook import read_workbook

# Feed name patterns and the date format inside file names.
TRANSACTIONS_GLOB = "tra*"
TERMINALS_GLOB = "ter*"
BLACKLIST_GLOB = "pas*"
FILE_DATE = re.compile(r"_(\d{2})(\d{2})(\d{4})\.[^./]+$")
FILE_DATE_SQL = r"_(\d{8})\.[^./]+$"

_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
_DATE_FORMAT = "yyyy-MM-dd"


def load_date_from_name(path: str) -> _dt.datetime:
    """Load date of a feed file: ``terminals_03032021.csv`` -> 2021-03-03."""
    m = FILE_DATE.search(path)
    if not m:
        raise ValueError(f"no _DDMMYYYY date in feed file name {path!r}")
    d, mth, y = (int(x) for x in m.groups())
    return _dt.datetime(y, mth, d)


def load_date_column(file_name: Column | None = None) -> Column:
    """The same, per row, from the scan's file metadata."""
    name = file_name if file_name is not None else F.col("_metadata.file_name")
    digits = F.regexp_extract(name, FILE_DATE_SQL, 1)
    # a name without a date gives NULL (parsing '' would fail under ANSI mode)
    return F.when(digits != "", F.to_timestamp_ntz(digits, F.lit("ddMMyyyy")))


#: The feed dialect's options.  With a comma-decimal locale "1234,56" parses as 1234.56; under the default locale it
#: would silently become 123456.00.
TEXT_OPTIONS = {"sep": ";", "mode": "FAILFAST", "timestampNTZFormat": _TS_FORMAT, "dateFormat": _DATE_FORMAT}
FEED_OPTIONS = TEXT_OPTIONS | {"locale": "de-DE"}


def text_options(reader, schema: T.StructType, decimal_comma: bool = False):
    """The feed dialect on a batch or stream reader: explicit schema, checked header, fail fast."""
    options = FEED_OPTIONS if decimal_comma else TEXT_OPTIONS
    return reader.schema(schema).options(header=True, enforceSchema=False, **options)


#: What happens to a line that does not parse: the load fails, or the line goes to the rejects and the rest is loaded.
FAIL, QUARANTINE = "fail", "quarantine"
_CORRUPT, _FILE = "_corrupt", "_file"


def permissive_text(spark: SparkSession, path: str | list[str], schema: T.StructType, feed: str, decimal_comma: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of ``;`` text: lines that fit the schema, and those that do not, with their file and text.

    The header is checked as ever: a file with other columns fails.
    """
    reader = text_options(spark.read, T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType(), True)]), decimal_comma)
    raw = reader.options(mode="PERMISSIVE", columnNameOfCorruptRecord=_CORRUPT).csv(path).select("*", F.col("_metadata.file_name").alias(_FILE))
    # the scan must be asked for its columns too (always true): it may not be read for the corrupt lines alone
    read = F.length(F.concat_ws("", *[F.col(f.name).cast("string") for f in schema.fields])) >= 0
    bad = raw.filter(F.col(_CORRUPT).isNotNull() & read).select(
        F.lit(feed).alias("feed"), F.col(_FILE).alias("file_name"), F.col(_CORRUPT).alias("line"), F.lit("malformed").alias("reason")
    )
    return raw.filter(F.col(_CORRUPT).isNull()).drop(_CORRUPT), bad


def clean(df: DataFrame, *more: Column) -> DataFrame:
    """The warehouse dialect stores '' as NULL; ``more`` columns are added."""
    return df.select(*[
        empty_as_null(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ], *more)


def read_transactions(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """stg_transactions rows from ``;`` text with a decimal comma."""
    return clean(text_options(spark.read, S.STG_TRANSACTIONS, decimal_comma=True).csv(path))


def quarantined_transactions(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of the transactions feed: malformed lines, and lines whose id is no whole number."""
    rows, bad = permissive_text(spark, path, S.STG_TRANSACTIONS, "transactions", decimal_comma=True)
    names = S.STG_TRANSACTIONS.fieldNames()
    no_id = F.col("transaction_id").isNotNull() & F.expr("try_cast(transaction_id AS BIGINT)").isNull()
    rows = clean(rows)
    line = F.to_csv(F.struct(*names), {"sep": ";", "timestampNTZFormat": _TS_FORMAT})
    other = rows.filter(no_id).select(F.lit("transactions").alias("feed"), F.col(_FILE).alias("file_name"), line.alias("line"), F.lit("transaction_id").alias("reason"))
    return rows.filter(~F.coalesce(no_id, F.lit(False))).select(*names), bad.unionByName(other)


FORMATS = ("auto", "csv", "parquet", "xlsx")


def _format_of(path: str) -> str:
    ext = path.rpartition(".")[2].lower()
    return ext if ext in ("parquet", "xlsx") else "csv"


def _read(spark: SparkSession, path: str | list[str], schema: T.StructType, fmt: str, feed: str, rejects: list[DataFrame] | None) -> DataFrame:
    """Files of one feed, each in the format given, or (``auto``) in that of its extension.

    With a list ``rejects`` bad lines of text files are added to it instead of failing the load.
    """
    if fmt not in FORMATS:
        raise ValueError(f"feed format must be one of {FORMATS}")
    by_format: dict[str, list[str]] = {}
    for p in [path] if isinstance(path, str) else path:
        by_format.setdefault(_format_of(p) if fmt == "auto" else fmt, []).append(p)
    parts = []
    for kind, paths in sorted(by_format.items()):
        if kind == "xlsx":
            parts.append(read_workbook(spark, paths, schema))
        elif kind == "parquet":
            parts.append(spark.read.schema(schema).parquet(*paths))
        elif rejects is not None:
            rows, bad = permissive_text(spark, paths, schema, feed)
            parts.append(rows.drop(_FILE))
            rejects.append(bad)
        else:
            parts.append(text_options(spark.read, schema).csv(paths))
    return clean(reduce(DataFrame.unionByName, parts))


def read_terminals(spark: SparkSession, path: str | list[str], fmt: str = "auto", rejects: list[DataFrame] | None = None) -> DataFrame:
    """stg_terminals rows (S3) of workbooks, ``;`` text or parquet."""
    return _read(spark, path, S.STG_TERMINALS, fmt, "terminals", rejects)


#: Columns of the blacklist's files.
BLACKLIST_FILE = T.StructType([
    T.StructField("date", T.TimestampNTZType(), True),
    T.StructField("passport", T.StringType(), True),
])


def read_blacklist(spark: SparkSession, path: str | list[str], fmt: str = "auto", rejects: list[DataFrame] | None = None) -> DataFrame:
    """(entry_dt, passport_num) from the blacklist file's (date, passport) (S2): a workbook, ``;`` text or parquet."""
    df = _read(spark, path, BLACKLIST_FILE, fmt, "blacklist", rejects)
    return df.select(F.col("date").alias("entry_dt"), F.col("passport").alias("passport_num"))


# --- discovery and the consumption ledger --------------------------------------------

LEDGER = T.StructType([
    T.StructField("feed", T.StringType(), False),
    T.StructField("file_name", T.StringType(), False),
    T.StructField("load_dt", T.TimestampNTZType(), True),
    T.StructField("run_id", T.StringType(), True),
])


def feed_files(spark: SparkSession, directory: str, glob: str, feed: str) -> DataFrame:
    """(feed, file_name, path, load_dt) of the files matching ``glob``.

    Lists paths only: the ``binaryFile`` source prunes the unread content column.
    """
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", False)
        .load(directory).select("path")
    )
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.select(
        F.lit(feed).alias("feed"), name.alias("file_name"), "path", load_date_column(name).alias("load_dt")
    )


def unconsumed(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files not yet recorded as consumed (S7 as a ledger anti join)."""
    return files.join(ledger.select("feed", "file_name"), ["feed", "file_name"], "left_anti")


@dataclass(frozen=True)
class DayFeeds:
    """What arrived for one date; a feed is None when a second or late delivery lacks it."""

    load_dt: _dt.datetime
    transactions: DataFrame | None
    terminals: DataFrame | None
    blacklist: DataFrame | None
    files: list[tuple[str, str]]   # (feed, file_name) consumed by this day
    rejects: DataFrame | None = None   # lines left out (``S.REJECTS``); None: a bad line fails the load
    max_reject_share: float = 0.01     # of a delivery's lines; more fail the load


GLOBS = {"transactions": TRANSACTIONS_GLOB, "terminals": TERMINALS_GLOB, "blacklist": BLACKLIST_GLOB}


def newest_load(ledger: DataFrame) -> _dt.datetime | None:
    return ledger.agg(F.max("load_dt").alias("d")).first()["d"]


def check_complete(by_feed: dict, load_dt: _dt.datetime, newest: _dt.datetime | None) -> None:
    """A date newer than every load needs all three feeds; a second or late delivery may bring any of them."""
    missing = [f for f in GLOBS if f not in by_feed]
    if missing and (newest is None or load_dt > newest):
        raise ValueError(f"feeds {missing} missing for {load_dt:%Y-%m-%d}")


def next_day(spark: SparkSession, directory: str, ledger: DataFrame, terminals_fmt: str = "auto",
             blacklist_fmt: str = "auto", bad_rows: str = FAIL, max_reject_share: float = 0.01) -> DayFeeds | None:
    """The earliest day with unconsumed files, and all of its unconsumed files.

    The source takes an arbitrary first match per feed and the date from the
    terminals file alone; here the day is explicit and the feeds must agree.
    Only the file names of one day reach the driver, never rows.
    """
    found = None
    for feed, g in GLOBS.items():
        f = feed_files(spark, directory, g, feed)
        found = f if found is None else found.unionByName(f)
    todo = unconsumed(found, ledger)
    undated = todo.filter(F.col("load_dt").isNull()).select("file_name").limit(5).collect()
    if undated:
        raise ValueError(f"feed files without a _DDMMYYYY date: {[r['file_name'] for r in undated]}")
    first = todo.agg(F.min("load_dt").alias("d")).collect()[0]["d"]
    if first is None:
        return None
    day = todo.filter(F.col("load_dt") == ts_lit(first)).select("feed", "file_name", "path").collect()
    by_feed: dict[str, list[str]] = {}
    for r in day:
        by_feed.setdefault(r["feed"], []).append(r["path"])
    check_complete(by_feed, first, newest_load(ledger))
    paths = by_feed.get
    rejects: list[DataFrame] | None = [] if bad_rows == QUARANTINE else None
    if paths("transactions") and rejects is not None:
        transactions, bad = quarantined_transactions(spark, paths("transactions"))
        rejects.append(bad)
    else:
        transactions = read_transactions(spark, paths("transactions")) if paths("transactions") else None
    return DayFeeds(
        load_dt=first,
        transactions=transactions,
        terminals=read_terminals(spark, paths("terminals"), terminals_fmt, rejects) if paths("terminals") else None,
        blacklist=read_blacklist(spark, paths("blacklist"), blacklist_fmt, rejects) if paths("blacklist") else None,
        files=[(r["feed"], r["file_name"]) for r in day],
        rejects=None if rejects is None else reduce(DataFrame.unionByName, rejects, spark.createDataFrame([], S.REJECTS)),
        max_reject_share=max_reject_share,
    )
