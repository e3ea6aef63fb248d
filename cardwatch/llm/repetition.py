"""Quality rules by repetition coverage (numpy rolling hashes of several n-gram lengths).

For every text the operator measures the share of its word characters that lie
inside n-grams found more than once in that text (n = 5..10), and inside lines
equal to an earlier line.  A text fails when it is very short, when too many of
its words lie in repeated 5-word windows, or when a coverage passes its limit.

Words are ``[^\\x20\\x09-\\x0D]+``.  Each case has a defined result: a null or
empty text has no words and fails the length rule; a text shorter than n words
has no n-gram and coverage 0; copies of a row give the same row again; an empty
table gives an empty table; further input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame

from cardwatch.llm import scan as S
from cardwatch.llm.spark_io import text_columns

MIN_WORDS = 10
WINDOW = 5
REPEAT_PERCENT = 20
#: Largest share of word characters inside repeated n-grams, by n, and inside repeated lines.
NGRAM_LIMITS = {5: 0.25, 6: 0.24, 7: 0.23, 8: 0.22, 9: 0.21, 10: 0.20}
LINE_LIMIT = 0.30

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, dup_line_share double, "
    + ", ".join(f"dup_{n}gram_share double" for n in NGRAM_LIMITS)
)


def _by_text(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[end] - total[start]


def measure(c: S.Chunk) -> dict[str, np.ndarray]:
    """The measures of every text of a chunk."""
    w = S.words_of(c)
    n_words, text, total = w.count, w.text_of(), len(w.hash)
    leads = (c.buf & 0xC0) != 0x80  # the first byte of every code point
    before = np.concatenate(([0], np.cumsum(leads, dtype=np.int64)))
    chars = before[w.end] - before[w.start]
    word_chars = S.per_text(chars, w.first)
    own = S.mix(text.astype(np.uint64) + S.U64(1))  # windows are compared inside one text only

    def windows(n: int) -> np.ndarray:
        g = S.ngrams(w.hash, n)
        twice = np.zeros(len(g), dtype=bool)
        if len(g):
            ok = np.flatnonzero(S.whole(w.first, n, total))
            twice[ok] = S.repeated(g[ok] ^ own[ok])[0]
        return S.covered(twice, n, total)

    repeats = windows(WINDOW)
    out = {"n_words": n_words, "word_chars": word_chars, "n_symbols": _by_text(_SYMBOLS[c.buf], c.start, c.end)}

    ls, le = S.runs_of(S.LINES[c.buf])
    lo, hi = np.searchsorted(w.start, ls), np.searchsorted(w.start, le)
    worded = lo < hi
    ls, le, lo, hi = ls[worded], le[worded], lo[worded], hi[worded]
    line_text = np.searchsorted(c.start, ls, side="right") - 1
    later = S.repeated(S.hash_runs(c.buf, ls, le) ^ S.mix(line_text.astype(np.uint64) + S.U64(1)))[1]
    out["n_dup_lines"] = np.bincount(line_text[later], minlength=len(c))
    total_chars = np.concatenate(([0], np.cumsum(chars)))
    line_chars = total_chars[hi] - total_chars[lo]
    out["n_repeat_words"] = S.per_text(repeats, w.first)
    failed = (n_words < MIN_WORDS) | (100 * out["n_repeat_words"] > REPEAT_PERCENT * n_words)
    out["base_failed"] = failed

    share = lambda x: x / np.maximum(word_chars, 1)
    kept = ~failed
    out["kept"] = kept
    out["dup_line_share"] = share(np.bincount(line_text[later], weights=line_chars[later], minlength=len(c)))
    over = out["dup_line_share"] > LINE_LIMIT
    for n, limit in NGRAM_LIMITS.items():
        inside = repeats if n == WINDOW else windows(n)
        out[f"dup_{n}gram_share"] = share(S.per_text(chars * inside, w.first))
        over |= out[f"dup_{n}gram_share"] > limit
    out["kept"] = ~failed & ~over
    return out


def _run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for c in S.chunks(batches):
        m = measure(c)
        yield pa.RecordBatch.from_arrays(
            [c.ids] + [pa.array(v if v.dtype.kind in "bf" else v.astype(np.int64)) for v in m.values()],
            names=["doc_id", *m],
        )


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per document with its measures and the verdict; no shuffle."""
    return text_columns(docs).mapInArrow(_run, SCHEMA)
