"""Vectorised text scanning shared by the operators: words, lines, rolling hashes.

A batch of texts is laid out as one byte array, texts separated by a newline.
Words are the runs of bytes outside a separator set (all separators used here
are ASCII, so splitting UTF-8 bytes equals splitting code points).  Each word
becomes a 64-bit hash; n-grams are polynomial hashes over the word hashes.
Memory is a small multiple of the batch's text: batches are cut by bytes.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: White space of the contracts: space and the control characters 9 to 13.
SPACES = np.array([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D], dtype=np.uint8)
CHUNK_BYTES = 4 << 20
#: Runs of more bytes (a text without white space) are hashed by a library call each.
LONG_RUN = 2048

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)
_SEED = U64(0x2545F4914F6CDD1D)
NGRAM_BASE = U64(0xD6E8FEB86659FD93)

_fold = np.arange(256, dtype=np.uint8)
_fold[0x41:0x5B] += 0x20
ASCII_LOWER = _fold


def space_words() -> np.ndarray:
    """Byte table of the word class ``[^\\x20\\x09-\\x0D]+``."""
    t = np.ones(256, dtype=bool)
    t[SPACES] = False
    return t


def alnum_words() -> np.ndarray:
    """Byte table of lower-cased ASCII letters, digits and every non-ASCII byte."""
    t = np.zeros(256, dtype=bool)
    t[0x30:0x3A] = True
    t[0x61:0x7B] = True
    t[0x80:] = True
    return t


def line_bytes() -> np.ndarray:
    t = np.ones(256, dtype=bool)
    t[0x0A] = False
    return t


SPACE_WORDS, ALNUM_WORDS, LINES = space_words(), alnum_words(), line_bytes()


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (every input bit reaches every output bit)."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h = h * U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


def runs_of(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of True."""
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    first, last = bool(inside[0]) if len(inside) else False, bool(inside[-1]) if len(inside) else False
    edge = np.concatenate(([0] if first else [], edge, [len(inside)] if last else [])).astype(np.int64)
    return edge[0::2], edge[1::2]


_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)


def hash_runs(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each run, eight bytes at a step."""
    left = ends - starts
    h = mix(left.astype(np.uint64) * _BASE + _SEED)
    if not len(starts):
        return h
    eights = np.ndarray(len(buf), dtype="<u8", buffer=np.concatenate((buf, np.zeros(8, np.uint8))), strides=(1,))
    long = np.flatnonzero(left > LONG_RUN)
    at, rows = (starts, None) if not len(long) else (starts[left <= LONG_RUN], np.flatnonzero(left <= LONG_RUN))
    left = left if rows is None else left[rows]
    for k in long:
        h[k] = int.from_bytes(hashlib.blake2b(buf[starts[k] : ends[k]].tobytes(), digest_size=8).digest(), "little")
    while len(at):
        v = eights[at] & _MASKS[np.minimum(left, 8)]
        if rows is None:
            h = _step(h, v)
        else:
            h[rows] = _step(h[rows], v)
        more = np.flatnonzero(left > 8)
        rows = more if rows is None else rows[more]
        at, left = at[more] + 8, left[more] - 8
    return mix(h)


def _step(h: np.ndarray, v: np.ndarray) -> np.ndarray:
    h = (h ^ v) * _BASE
    return h ^ (h >> U64(32))


@dataclass
class Chunk:
    """Some whole texts: ``buf`` holds them one after the other, each followed by a newline."""

    ids: np.ndarray
    texts: list[bytes]
    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def __len__(self) -> int:
        return len(self.texts)


def chunk_of(ids: np.ndarray, texts: list[bytes]) -> Chunk:
    buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    lens = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    start = np.cumsum(lens + 1) - (lens + 1)
    return Chunk(ids, texts, buf, start, start + lens)


def table_chunks(ids: np.ndarray, column: pa.ChunkedArray | pa.Array, most: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a string column into chunks of about ``most`` bytes (one text at least); null texts are empty."""
    texts = [b"" if t is None else t for t in column.cast(pa.large_binary()).to_pylist()]
    i, n = 0, len(texts)
    while i < n:
        size, j = 0, i
        while j < n and (j == i or size + len(texts[j]) <= most):
            size += len(texts[j]) + 1
            j += 1
        yield chunk_of(ids[i:j], texts[i:j])
        i = j


def chunks(batches: Iterable[pa.RecordBatch], most: int = CHUNK_BYTES, key: str = "doc_id", text: str = "text") -> Iterator[Chunk]:
    for b in batches:
        if b.num_rows:
            yield from table_chunks(b.column(key), b.column(text), most)
    give_back()


def give_back() -> None:
    """Hand freed memory back to the system: a worker serves many tasks, of several operators, and keeps its high-water mark."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError):  # another C library: nothing to trim
    _trim = None


@dataclass
class Words:
    """The words of a chunk: byte spans, hashes, and the first word of each text (one more entry at the end)."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """Index of the text of every word."""
        return np.repeat(np.arange(len(self.first) - 1), self.count)


def words_of(c: Chunk, table: np.ndarray = SPACE_WORDS, fold: np.ndarray | None = None, hashes: bool = True) -> Words:
    buf = c.buf if fold is None else fold[c.buf]
    start, end = runs_of(table[buf])
    first = np.append(np.searchsorted(start, c.start), len(start)).astype(np.int64)
    return Words(start, end, hash_runs(buf, start, end) if hashes else np.zeros(0, np.uint64), first)


def ngrams(h: np.ndarray, n: int, base: np.uint64 = NGRAM_BASE) -> np.ndarray:
    """Hash of the n words from each position; the last n - 1 positions are left out."""
    if len(h) < n:
        return np.zeros(0, dtype=np.uint64)
    done, length = h, 0
    have, step, power = h, 1, base  # have: hashes of ``step`` words, a power of two
    while True:
        if n & step:
            if length == 0:
                done, length = have, step
            else:
                m = len(h) - (length + step) + 1
                done = done[:m] * power_of(base, step) + have[length : length + m]
                length += step
        if length == n:
            return mix(done)
        have = have[: len(have) - step] * power + have[step:]
        step *= 2
        power = power_of(base, step)


def power_of(base: np.uint64, n: int) -> np.uint64:
    return U64(pow(int(base), n, 1 << 64))


def whole(first: np.ndarray, n: int, total: int) -> np.ndarray:
    """Mask over the n-gram positions of a chunk: the n words lie in one text."""
    m = max(0, total - n + 1)
    ok = np.zeros(m, dtype=bool)
    if m:
        lo, hi = first[:-1], np.maximum(first[:-1], first[1:] - n + 1)
        delta = np.zeros(m + 1, dtype=np.int64)
        keep = lo < hi
        np.add.at(delta, lo[keep], 1)
        np.add.at(delta, hi[keep], -1)
        ok = np.cumsum(delta[:-1]) > 0
    return ok


def covered(marks: np.ndarray, n: int, total: int) -> np.ndarray:
    """Mask of the words inside an n-word window that starts at a mark."""
    delta = np.zeros(total + 1, dtype=np.int32)
    delta[: len(marks)] += marks
    ends = marks if len(marks) <= total + 1 - n else marks[: total + 1 - n]
    delta[n : n + len(ends)] -= ends
    return np.cumsum(delta[:-1]) > 0


def per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each text's words."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[first[1:]] - total[first[:-1]]


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether it occurs twice or more, and whether an equal key stands before it."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    same = np.concatenate(([False], k[1:] == k[:-1]))
    twice, later = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
    twice[order] = same | np.append(same[1:], False)
    later[order] = same
    return twice, later
