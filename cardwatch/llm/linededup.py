"""Line dedup by a suffix array over line ids, built by distributed prefix doubling.

The lines of a document that hold a word form its sequence.  Rank 0 orders the
distinct lines that occur more than once (a line that occurs once ends every
repeat and drops out).  A doubling step orders the runs of 2h lines by the pair
(rank of the first h, rank of the next h), each found in the same document; the
ranks come from a range partition sorted within, so they order the suffixes by
their first 2h lines.  Suffixes of equal rank are an interval of the suffix
array whose longest common prefix has 2h lines or more.  A run that occurs once
drops out, so the table shrinks to the repeats.

A maximal repeated run of ``min_words`` words or more, of any number of lines, is
kept where it stands first (smallest doc_id, then line) and is deleted everywhere
else.  Each line of such a run lies in a window of the run that has
``min_words`` words and loses them without its first or without its last line,
so it is enough to judge those windows: at most two a line, of at most
``min_words`` lines, so doubling stops there.  A window of h to 2h lines is the
pair of ranks of its first and its last h lines.  Shorter runs are judged by
their documents too: windows of ``SHARED_WORDS`` words that stand in
``SHARED_DOCS`` documents or more are boilerplate, and later copies go; below
both floors repeats may be chance and stay.

A line, run or window may hold a third of all rows.  The tables of runs carry
their number of places; those with more than one ``HOT_SHARE``-th of all (at
most ``HOT_SHARE`` of them) are copied ``SALTS`` times, and their places are dealt
over the copies by doc_id.

Lines without a word are neither compared nor deleted.  Lines are equal when
their bytes are.  A null text stays null, an empty one empty; rows without a
doc_id pass through.  Rows that repeat a doc_id are the same document.  An
empty table gives an empty table; further columns are kept as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.llm import scan as S
from cardwatch.llm.spark_io import text_columns, written

MIN_WORDS = 20
SHARED_WORDS, SHARED_DOCS = 5, 20
HOT_SHARE, SALTS = 2000, 64
ADDED = {"n_lines": "long", "n_removed": "long", "n_runs": "long", "text_sha256": "string"}
LINE_SCHEMA = "doc_id long, line int, hash long, bytes int, windows array<struct<lines: int, long: boolean>>"


def worded_lines(c: S.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Byte spans of the lines that hold a word, their word counts, and the text of each."""
    w = S.words_of(c, hashes=False)
    start, end = S.runs_of(S.LINES[c.buf])
    words = np.searchsorted(w.start, end) - np.searchsorted(w.start, start)
    keep = words > 0
    start, end = start[keep], end[keep]
    return start, end, words[keep], np.searchsorted(c.start, start, side="right") - 1


def _number(text: np.ndarray, n: int) -> np.ndarray:
    """Number of each line in its text."""
    return np.arange(len(text)) - np.searchsorted(text, np.arange(n))[text]


def least_windows(words: np.ndarray, text: np.ndarray, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """First lines and lengths of the windows of a text that have ``floor`` words, but not without the first or not without the last line."""
    n = len(words)
    total, line = np.concatenate(([0], np.cumsum(words))), np.arange(n)
    after = np.searchsorted(text, text, side="right")
    end = np.searchsorted(total, total[:-1] + floor)  # the shortest from each line on
    first = np.searchsorted(total, total[1:] - floor, side="right") - 1  # the shortest up to each line
    fits, reaches = end <= after, first >= np.searchsorted(text, text)
    start = np.concatenate((line[fits], first[reaches]))
    size = np.concatenate(((end - line)[fits], (line + 1 - first)[reaches]))
    return start, size


def windows_of(words: np.ndarray, text: np.ndarray, min_words: int) -> pa.ListArray:
    """By first line: the windows of ``min_words`` and of SHARED_WORDS words, and which have ``min_words``."""
    total = np.concatenate(([0], np.cumsum(words)))
    parts = [least_windows(words, text, floor) for floor in {min_words, min(min_words, SHARED_WORDS)}]
    start, size = np.unique(np.concatenate([np.stack(p) for p in parts], axis=1), axis=1)
    ends = pa.array(np.searchsorted(start, np.arange(len(words) + 1)).astype(np.int32))
    long = total[start + size] - total[start] >= min_words
    return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([pa.array(size.astype(np.int32)), pa.array(long)], names=["lines", "long"]))


def _lines(batches: Iterable[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    for c in S.chunks(batches):
        start, end, words, text = worded_lines(c)
        yield pa.RecordBatch.from_arrays(
            [
                c.ids.take(pa.array(text)),
                pa.array(_number(text, len(c)).astype(np.int32)),
                pa.array(S.hash_runs(c.buf, start, end).astype(np.int64)),
                pa.array((end - start).astype(np.int32)),
                windows_of(words, text, min_words),
            ],
            names=["doc_id", "line", "hash", "bytes", "windows"],
        )


def _salted_join(places: DataFrame, runs: DataFrame, keys: list[str]) -> DataFrame:
    """Places joined to their runs (written, one row a key, with ``n`` places); places of a hot run spread over its copies."""
    total = runs.agg(F.sum("n")).first()[0] or 0
    is_hot = F.col("n") * HOT_SHARE > total
    hot = runs.filter(is_hot).select(*keys, F.lit(True).alias("__hot"))
    salt = F.when(F.col("__hot"), F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).otherwise(F.lit(0).cast("long"))
    places = places.join(F.broadcast(hot), keys, "left").withColumn("__salt", salt).drop("__hot")
    copies = F.when(is_hot, F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    return places.join(runs.withColumn("__salt", F.explode(copies)).drop("n"), [*keys, "__salt"]).drop("__salt")


def _ranked(runs: DataFrame, keys: list[str]) -> DataFrame:
    """(doc_id, line, rank, windows) of the runs that occur more than once; rank follows the order of the keys."""
    place = F.struct("doc_id", "line")
    repeats = runs.groupBy(*keys).agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count("*").alias("n")).filter("first != last")
    ranks = written(
        repeats.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*keys, "n", F.monotonically_increasing_id().alias("rank")),
        "ranks",
    )
    return written(_salted_join(runs, ranks, keys).select("doc_id", "line", "rank", "windows"), "suffixes")


def _doubled(suffixes: DataFrame, length: int) -> DataFrame:
    """The ranked runs of 2 * length lines, from those of length lines."""
    next_run = Window.partitionBy("doc_id").orderBy("line").rangeBetween(length, length)
    pairs = suffixes.select(
        "doc_id", "line", F.col("rank").alias("rank1"), F.max("rank").over(next_run).alias("rank2"), "windows"
    ).filter("rank2 IS NOT NULL")
    return _ranked(pairs, ["rank1", "rank2"])


def _window_ranks(suffixes: DataFrame, length: int) -> DataFrame:
    """(doc_id, line, lines, long, rank1, rank2) of the windows of length to 2 * length - 1 lines whose first and last ``length`` lines are repeated."""
    reach = Window.partitionBy("doc_id").orderBy("line").rangeBetween(0, length - 1)
    sizes = F.filter("windows", lambda w: (w["lines"] >= length) & (w["lines"] < 2 * length))
    last = F.filter("ahead", lambda x: x["line"] == F.col("line") + F.col("lines") - length)
    return (
        suffixes.withColumn("ahead", F.collect_set(F.struct("line", "rank")).over(reach))
        .select("doc_id", "line", "rank", "ahead", F.inline(sizes))
        .select("doc_id", "line", "lines", "long", F.col("rank").alias("rank1"), F.array_max(F.transform(last, lambda x: x["rank"])).alias("rank2"))
        .filter("rank2 IS NOT NULL")
    )


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, line, lines): windows that cover every maximal run that stands earlier too and has min_words words or more, or SHARED_WORDS in SHARED_DOCS documents."""
    lines = text_columns(docs).filter("doc_id IS NOT NULL").mapInArrow(lambda batches: _lines(batches, min_words), LINE_SCHEMA)
    suffixes, length = _ranked(lines, ["hash", "bytes"]), 1
    found = _window_ranks(suffixes, length)
    while 2 * length <= min_words and suffixes.take(1):
        suffixes, length = _doubled(suffixes, length), 2 * length
        found = found.union(_window_ranks(suffixes, length))
    found = written(found, "windows")
    keys, place = ["lines", "rank1", "rank2"], F.struct("doc_id", "line")
    by_doc = found.groupBy(*keys, "doc_id").agg(
        F.min("line").alias("line"), F.max("line").alias("end"), F.max("long").alias("long"), F.count("*").alias("n")
    )
    firsts = by_doc.groupBy(*keys).agg(
        F.min(place).alias("first"), F.max(F.struct("doc_id", "end")).alias("last"), F.max("long").alias("long"), F.count("*").alias("n_docs"), F.sum("n").alias("n")
    ).filter((F.col("n_docs") >= SHARED_DOCS) | (F.col("long") & (F.col("first") != F.col("last"))))
    firsts = written(firsts.select(*keys, "first", "n"), "firsts")
    return _salted_join(found.drop("long"), firsts, keys).filter(F.col("first") < place).select("doc_id", "line", "lines")


def _without(text: bytes, runs: list) -> tuple[int, int, int, bytes]:
    """Worded lines, deleted lines, deleted stretches, and the text left."""
    rows = text.split(b"\n")
    c = S.chunk_of(np.zeros(1, np.int64), [text])
    start = worded_lines(c)[0]
    at = np.searchsorted(np.cumsum([0] + [len(r) + 1 for r in rows])[:-1], start, side="right") - 1
    delta = np.zeros(len(at) + 1, dtype=np.int64)
    for line, n in runs:
        delta[line] += 1
        delta[line + n] -= 1
    gone = np.cumsum(delta[:-1]) > 0
    stretches = int(np.count_nonzero(gone & ~np.concatenate(([False], gone[:-1]))))
    drop = set(at[gone].tolist())
    return len(at), len(drop), stretches, b"\n".join(r for i, r in enumerate(rows) if i not in drop)


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with later copies of repeated line runs deleted from ``text``, and the columns ADDED (which replace input columns of that name)."""
    runs = repeated_runs(docs, min_words).groupBy(F.col("doc_id").alias("__run_doc")).agg(
        F.collect_set(F.struct("line", "lines")).alias("__line_runs")
    )
    names = [c for c in docs.columns if c not in ADDED]
    with_id, without = docs.filter("doc_id IS NOT NULL"), docs.filter("doc_id IS NULL")
    both = (
        with_id.join(runs, with_id["doc_id"] == runs["__run_doc"], "left")
        .select(*(with_id[c] for c in names), "__line_runs")
        .union(without.select(*names, F.lit(None).cast(runs.schema["__line_runs"].dataType)))
    )
    types = dict(docs.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in names), *(f"{c} {t}" for c, t in ADDED.items())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").cast(pa.large_binary()).to_pylist()
            marks = b.column("__line_runs").to_pylist()
            got = [_without(t or b"", [(m["line"], m["lines"]) for m in r or []]) for t, r in zip(texts, marks, strict=True)]
            new = [None if t is None else (g[3] if r else t) for t, g, r in zip(texts, got, marks, strict=True)]
            left = pa.array(new, pa.binary()).cast(pa.string())
            digests = pa.array([hashlib.sha256(t or b"").hexdigest() for t in new], pa.string())
            yield pa.RecordBatch.from_arrays(
                [left if c == "text" else b.column(c) for c in names]
                + [pa.array([g[k] for g in got], pa.int64()) for k in range(3)]
                + [digests],
                names=[*names, *ADDED],
            )

    return both.mapInArrow(run, schema)
