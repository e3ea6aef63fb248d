"""Exact dedup by a tree merge of sorted digest runs.

*Digests.*  A text, with each run of white space replaced by one space, becomes
its SHA-256 and its length; the row gets a number.  These rows are written, so
the texts are read once.

*Runs.*  The rows of a partition, sorted by digest, shrink to one entry per
digest: the smallest doc_id and its row, and the number of rows.  ``FAN`` to the
power of the rounds is the number of places; a partition's run starts at its
number modulo the places.

*Rounds.*  Three binomial exchanges at a time (``FAN`` = 8): in round r the
partitions whose places differ in the r-th digit only exchange parts of their
runs, so that an entry goes to the place whose r-th digit is the r-th digit of
its digest.  The parts that meet are merged, sorted again, and each digest keeps
its smallest doc_id.  After the last round a place holds all that is known of its
digests.  A group of copies enters a round with one entry per place at most, so
a group that holds a third of all rows is never in one task.  Every level is
written to the shared folder, and its row total is verified against the level
before: an entry lost or counted twice is an error.

*Answer.*  Groups of two or more go back to the rows by digest.  A group with
more than one ``HOT_SHARE``-th of all rows is broadcast (there are at most
``HOT_SHARE`` such groups), the others are joined.

A null text is empty; empty texts equal each other and texts of white space only
equal " ".  A null doc_id comes after every other: it stays only where its whole
group has none.  Of rows that repeat a doc_id and a text, one stays.  An empty
table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.spark_io import text_columns, written

FAN = 8
#: Entries of a place after the last round, about.
PLACE_ROWS = 250_000
LEAST_ROUNDS = 2
HOT_SHARE = 2000

RUN_SCHEMA = "place int, digest binary, chars long, first_id long, first_row long, n long"
_RUN = pa.schema([("place", pa.int32()), ("digest", pa.binary()), ("chars", pa.int64()), ("first_id", pa.int64()), ("first_row", pa.int64()), ("n", pa.int64())])


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, chars, row) of every row, written."""
    texts = text_columns(docs).select("doc_id", normalised(F.col("text")).alias("t"))
    return written(
        texts.select(
            "doc_id", F.unhex(F.sha2("t", 256)).alias("digest"), F.length("t").cast("long").alias("chars"), F.monotonically_increasing_id().alias("row")
        ),
        "digests",
    )


def rounds_for(rows: int) -> int:
    """How many rounds leave about PLACE_ROWS entries in a place."""
    n = LEAST_ROUNDS
    while FAN**n * PLACE_ROWS < rows:
        n += 1
    return n


def _groups(b: pa.RecordBatch) -> np.ndarray:
    """First rows of the stretches of equal (place, digest, chars)."""
    n = b.num_rows
    new = np.ones(n, dtype=bool)
    if n > 1:
        key = np.frombuffer(b"".join(b.column("digest").to_pylist()), dtype=">u8").reshape(n, 4)
        new[1:] = (key[1:] != key[:-1]).any(axis=1)
        for name in ("place", "chars"):
            v = b.column(name).to_numpy(zero_copy_only=False)
            new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def _combined(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted entries, those of one digest merged: the first one holds the smallest doc_id.  One entry is held over between batches."""
    held = None
    for b in batches:
        if not b.num_rows:
            continue
        b = pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(b.columns, _RUN, strict=True)], schema=_RUN)
        if held is not None:
            b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
        first = _groups(b)
        n = np.add.reduceat(b.column("n").to_numpy(), first)
        out = b.take(pa.array(first)).set_column(5, "n", pa.array(n))
        held = out.slice(out.num_rows - 1)
        if out.num_rows > 1:
            yield out.slice(0, out.num_rows - 1)
    if held is not None:
        yield held


def merged_runs(runs: DataFrame) -> DataFrame:
    """One sorted run per partition, merged from the runs in it."""
    order = ["place", "digest", "chars", F.col("first_id").asc_nulls_last(), "first_row"]
    return runs.sortWithinPartitions(*order).mapInArrow(_combined, RUN_SCHEMA)


def _digit(place: Column, r: int) -> Column:
    return F.pmod(F.floor(place / F.lit(FAN**r)).cast("int"), F.lit(FAN))


def exchanged(runs: DataFrame, r: int, places: int) -> DataFrame:
    """Entries moved to the place whose r-th digit is that of the digest."""
    home = F.pmod(F.conv(F.substring(F.hex("digest"), 1, 15), 16, 10).cast("long"), F.lit(places)).cast("int")
    place = F.col("place") + (_digit(home, r) - _digit(F.col("place"), r)) * F.lit(FAN**r)
    return runs.withColumn("place", place.cast("int")).repartitionById(places, "place")


def groups(rows: DataFrame, rounds: int | None = None) -> DataFrame:
    """(digest, chars, first_id, first_row, n) of the distinct digests of ``digests``."""
    total = rows.count()
    rounds = rounds_for(total) if rounds is None else rounds
    places = FAN**rounds
    runs = rows.select(
        F.pmod(F.shiftright("row", 33), F.lit(places)).cast("int").alias("place"), "digest", "chars",
        F.col("doc_id").alias("first_id"), F.col("row").alias("first_row"), F.lit(1).cast("long").alias("n"),
    )
    runs = merged_runs(runs)
    for r in range(rounds):
        runs = written(merged_runs(exchanged(runs, r, places)), f"runs-{r}")
        counted = runs.agg(F.sum("n")).first()[0] or 0
        if counted != total:
            raise RuntimeError(f"round {r} of the tree merge counts {counted} of {total} rows")
    return runs.drop("place")


def exact_duplicates(docs: DataFrame, rounds: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    rows = digests(docs)
    found = groups(rows, rounds)
    many = found.filter("n > 1").select("digest", "chars", "first_id", "first_row", "n")
    total = rows.count()
    hot = many.filter(F.col("n") * HOT_SHARE > total)
    cold = many.filter(F.col("n") * HOT_SHARE <= total)
    out = rows.select("doc_id", "digest", "chars", "row")
    names = {"first_id": "hot_id", "first_row": "hot_row", "n": "hot_n"}
    out = out.join(F.broadcast(hot.withColumnsRenamed(names)), ["digest", "chars"], "left")
    alone = out.filter("hot_n IS NULL").join(cold, ["digest", "chars"], "left")
    in_hot = out.filter("hot_n IS NOT NULL").withColumns({"first_id": F.col("hot_id"), "first_row": F.col("hot_row"), "n": F.col("hot_n")})
    return alone.unionByName(in_hot).select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("first_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("first_row") == F.col("row"), F.lit(True)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def exact_dedup(docs: DataFrame) -> DataFrame:
    """The rows that stay, with their own columns; of rows that repeat a doc_id and a text, one."""
    stay = exact_duplicates(docs).filter("kept").select(F.col("doc_id").alias("__keep_id"), F.col("text_sha256").alias("__keep_digest"))
    keyed = docs.withColumn("__digest", F.sha2(normalised(docs["text"]), 256))
    same = keyed["__digest"].eqNullSafe(F.col("__keep_digest")) & keyed["doc_id"].eqNullSafe(F.col("__keep_id"))
    return keyed.join(stay, same, "left_semi").dropDuplicates(["__digest", "doc_id"]).drop("__digest")
