"""Exact substring dedup by fixed-block anchors.

A window is ``WINDOW`` consecutive words of one document.  Every word covered by
a window whose word sequence also starts anywhere else (same document included)
is removed, first copies too.

Any window of 35 words holds a whole block of ``BLOCK`` = 18 words that begins
at a multiple of 18 in its document, so a window that stands at two places
shares that block with both.  Three passes over the documents, in chunks of
whole texts, of ``CHUNK_BYTES`` or one longer text each:

1. Every chunk sends the hashes of its non-overlapping blocks (the index) and of
   its rolling 18-word windows (the probes), distinct per chunk, to buckets of
   the hash space.  A bucket finds the probes that meet an indexed block and
   stand at two places or more, and returns them to their chunks: the anchors.
   A false anchor only costs a check.
2. Round each anchor the chunk extends the hit: the 35-word windows that hold it
   are sent with their 64-bit hashes to buckets, which return those found at two
   places or more.  Neighbouring windows that pass make up the maximal repeat.
3. The chunk marks the words covered by a repeated window and rebuilds its texts.

What is shuffled per word is at most 4 bytes in pass 1, and 8 bytes per window
near an anchor in pass 2; a value that a chunk holds many times is sent once,
with a flag.  Texts are written once, bucketed by chunk, and never shuffled.  There
are so many buckets that one stands for ``BUCKET_BYTES`` of text at most.  Two different
windows are taken for equal with a chance of 2^-64 a pair.

Null and empty texts have no words and no kept text; texts shorter than a
window keep all; copies of a row are copies of the text, so windows of 35 words
are removed from both; an empty table gives an empty table; further columns are
ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm import scan as S
from cardwatch.llm.spark_io import scratch, text_columns

WINDOW = 35
BLOCK = (WINDOW + 1) // 2
CHUNK_BYTES, CHUNK_ROWS = 2 << 20, 1024
#: Buckets of the hash space for each shuffle partition, at least; text that one bucket's values come from, at most.
BUCKETS, BUCKET_BYTES = 4, 64 << 20

_LOW = 30
_LOW_MASK = S.U64((1 << _LOW) - 1)
_AGAIN, _ANCHOR = np.uint32(1), np.uint32(2)


def _keys(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket and low bits of a hash in one number."""
    return ((h >> S.U64(32)) % S.U64(buckets)) << S.U64(_LOW) | (h & _LOW_MASK)


def _rows(chunk: int, keys: np.ndarray, bucket: np.ndarray, blobs: np.ndarray) -> pa.RecordBatch:
    """One row for each bucket; ``blobs`` are sorted by bucket."""
    at = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))) if len(bucket) else np.zeros(0, np.int64)
    raw, size = blobs.tobytes(), blobs.dtype.itemsize
    offsets = np.append(at, len(bucket)) * size
    column = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(raw)])
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket[at].astype(np.int32)), pa.array(np.full(len(at), chunk, np.int64)), column.cast(pa.binary())],
        names=["bucket", "chunk", "blob"],
    )


def _by_chunk(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, S.Chunk]]:
    for b in batches:
        chunk = b.column("chunk").to_numpy(zero_copy_only=False)
        if not len(chunk):
            continue
        at = np.flatnonzero(np.concatenate(([True], chunk[1:] != chunk[:-1])))
        for i, j in zip(at, np.append(at[1:], len(chunk)), strict=True):
            for c in S.table_chunks(b.column("doc_id")[i:j], b.column("text")[i:j]):
                yield int(chunk[i]), c


def probes(c: S.Chunk, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of the rolling windows, and flags: found again in this chunk, begins an indexed block."""
    w = S.words_of(c)
    at = np.flatnonzero(S.whole(w.first, BLOCK, len(w.hash)))
    # a text without a whole window can't take part
    text = w.text_of()[at]
    at = at[w.count[text] >= WINDOW]
    place = at - w.first[w.text_of()[at]]
    keys = _keys(S.ngrams(w.hash, BLOCK)[at], buckets) if len(at) else np.zeros(0, np.uint64)
    order = np.argsort(keys, kind="stable")
    keys, block = keys[order], (place % BLOCK == 0)[order]
    begin = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    n = np.diff(np.append(begin, len(keys)))
    anchored = np.logical_or.reduceat(block, begin) if len(begin) else np.zeros(0, bool)
    return keys[begin], (n > 1) * _AGAIN + anchored * _ANCHOR


def _probe_rows(buckets: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, c in _by_chunk(batches):
            keys, flags = probes(c, buckets)
            low = (keys & _LOW_MASK).astype(np.uint32) << np.uint32(2) | flags.astype(np.uint32)
            yield _rows(chunk, keys, (keys >> S.U64(_LOW)).astype(np.int32), low)

    return run


def _blobs(t: pa.Table, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    parts = [np.frombuffer(x, dtype=dtype) for x in t.column("blob").to_pylist()]
    return np.concatenate(parts) if parts else np.zeros(0, dtype), np.array([len(p) for p in parts], dtype=np.int64)


def _returned(t: pa.Table, values: np.ndarray, sizes: np.ndarray, good: np.ndarray) -> pa.Table:
    """The good values of each row, to its chunk."""
    ends = np.cumsum(sizes)
    rows = [i for i, (a, b) in enumerate(zip(ends - sizes, ends, strict=True)) if good[a:b].any()]
    blobs = [values[ends[i] - sizes[i] : ends[i]][good[ends[i] - sizes[i] : ends[i]]].tobytes() for i in rows]
    return pa.table({
        "bucket": t.column("bucket").combine_chunks().take(pa.array(rows, pa.int64())),
        "chunk": t.column("chunk").combine_chunks().take(pa.array(rows, pa.int64())),
        "blob": pa.array(blobs, pa.binary()),
    })


def _meet(key: np.ndarray, again: np.ndarray, anchor: np.ndarray | None) -> np.ndarray:
    """Mask of the keys that stand at two places or more and, if asked for, meet an indexed block."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    begin = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
    n = np.diff(np.append(begin, len(k)))
    ok = (n > 1) | np.logical_or.reduceat(again[order], begin)
    if anchor is not None:
        ok &= np.logical_or.reduceat(anchor[order], begin)
    good = np.zeros(len(key), dtype=bool)
    good[order] = np.repeat(ok, n)
    return good


def _anchors(t: pa.Table) -> pa.Table:
    v, sizes = _blobs(t, "<u4")
    good = _meet(v >> np.uint32(2), (v & _AGAIN) > 0, (v & _ANCHOR) > 0)
    return _returned(t, v >> np.uint32(2), sizes, good)


def _repeats(t: pa.Table) -> pa.Table:
    v, sizes = _blobs(t, "<u8")
    # a value that its chunk holds more than once is sent twice
    return _returned(t, v, sizes, _meet(v, np.zeros(len(v), bool), None))


def _texts(t: pa.Table) -> Iterator[S.Chunk]:
    yield from S.table_chunks(t.column("doc_id").combine_chunks(), t.column("text").combine_chunks())


def windows_near(c: S.Chunk, anchors: np.ndarray, buckets: int) -> np.ndarray:
    """64-bit hashes of the windows that hold an anchor."""
    w = S.words_of(c)
    total = len(w.hash)
    ok = S.whole(w.first, WINDOW, total)
    if not len(ok):
        return np.zeros(0, np.uint64)
    hit = np.isin(_keys(S.ngrams(w.hash, BLOCK), buckets), anchors) & S.whole(w.first, BLOCK, total)
    near = np.concatenate(([0], np.cumsum(hit)))
    near = near[WINDOW - BLOCK + 1 :][: len(ok)] - near[: len(ok)] > 0
    return S.ngrams(w.hash, WINDOW)[ok & near]


def _extend(buckets: int):
    def run(key, docs: pa.Table, hits: pa.Table) -> pa.Table:
        low, sizes = _blobs(hits, "<u4")
        bucket = np.repeat(hits.column("bucket").to_numpy().astype(np.uint64), sizes)
        anchors = np.unique(bucket << S.U64(_LOW) | low)
        out = []
        if len(anchors) and docs.num_rows:
            h = np.concatenate([windows_near(c, anchors, buckets) for c in _texts(docs)])
            h, n = np.unique(h, return_counts=True)
            h = np.repeat(h, np.minimum(n, 2))
            spread = (S.mix(h) % S.U64(buckets)).astype(np.int32)
            order = np.argsort(spread, kind="stable")
            out = [_rows(key[0].as_py(), h[order], spread[order], h[order])]
        return pa.Table.from_batches(out, schema=_ROW)

    return run


_ROW = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("blob", pa.binary())])


def strip(c: S.Chunk, repeats: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Word counts, removed words, and the kept words of every text joined by one space."""
    w = S.words_of(c)
    total = len(w.hash)
    ok = S.whole(w.first, WINDOW, total)
    mark = ok & np.isin(S.ngrams(w.hash, WINDOW), repeats) if len(ok) and len(repeats) else np.zeros(len(ok), bool)
    gone = S.covered(mark, WINDOW, total) if len(mark) else np.zeros(total, bool)
    keep = ~gone
    size = (w.end - w.start + 1) * keep
    at = np.concatenate(([0], np.cumsum(size)))
    index = np.repeat((w.start - at[:-1])[keep], size[keep]) + np.arange(int(at[-1]))
    text = c.buf[index]
    text[at[1:][keep] - 1] = 0x20
    raw, cut = text.tobytes(), at[w.first]
    return w.count, S.per_text(gone, w.first), [raw[a : max(a, b - 1)] for a, b in zip(cut[:-1], cut[1:], strict=True)]


def _finish(with_text: bool):
    def run(key, docs: pa.Table, hits: pa.Table) -> pa.Table:
        repeats = np.unique(_blobs(hits, "<u8")[0])
        out = []
        for c in _texts(docs):
            n, removed, kept = strip(c, repeats)
            cols = {
                "doc_id": c.ids, "n_words": pa.array(n), "n_removed": pa.array(removed),
                "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
            }
            if with_text:
                cols["kept"] = pa.array([x.decode("utf-8", "replace") for x in kept], pa.string())
            out.append(pa.table(cols))
        return pa.concat_tables(out) if out else _DONE.empty_table()

    return run


_DONE = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])


def _numbered(most: int):
    """The rows with a chunk number: a chunk ends with CHUNK_ROWS rows or before the text that takes it over ``most`` bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, rows, held = TaskContext.get().partitionId() << 33, 0, 0
        for b in batches:
            numbers = []
            for size in pc.fill_null(pc.binary_length(b.column("text")), 0).to_pylist():
                if rows and (rows == CHUNK_ROWS or held + size > most):
                    chunk, rows, held = chunk + 1, 0, 0
                rows, held = rows + 1, held + size
                numbers.append(chunk)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(numbers, pa.int64())], names=["doc_id", "text", "chunk"])

    return run


def _chunked(docs: DataFrame, n: int) -> DataFrame:
    """The texts with a chunk number, written to the shared folder bucketed by chunk, so that later passes need no shuffle of them."""
    name = f"llm_chunks_{uuid.uuid4().hex}"
    (
        text_columns(docs)
        .mapInArrow(_numbered(CHUNK_BYTES), "doc_id long, text string, chunk long")
        .write.bucketBy(n, "chunk")
        .option("path", scratch(docs.sparkSession, "chunks"))
        .format("parquet")
        .saveAsTable(name)
    )
    return docs.sparkSession.table(name)


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """One row per document: words, removed words, digest of the kept words (and the kept text)."""
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = _chunked(docs, n)
    size = d.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    buckets = max(BUCKETS * n, -(-size // BUCKET_BYTES))
    row = "bucket int, chunk long, blob binary"
    by_chunk = d.groupBy("chunk")
    anchors = d.mapInArrow(_probe_rows(buckets), row).groupBy("bucket").applyInArrow(_anchors, row)
    near = by_chunk.cogroup(anchors.groupBy("chunk")).applyInArrow(_extend(buckets), row)
    repeats = near.groupBy("bucket").applyInArrow(_repeats, row)
    done = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text
    return by_chunk.cogroup(repeats.groupBy("chunk")).applyInArrow(_finish(with_text), done)
