"""Token counts by section, from the offsets of one encoding of the whole document.

A document is encoded once.  Tokens carry their character spans; sections are
spans that tile the text (default: its lines, each with its newline).  An
interval join of the two sorted span lists, inside each document, attributes
every token to a section.  A token that crosses a boundary is allocated by an
explicit rule:

* ``first`` (default): to the section of its first character;
* ``most``: to the section with most of its characters, the earlier on a tie.

A token that holds part of a character spans the whole character.  The counts
of a document's sections add up to its token count under either rule.

A null or empty text has one empty section without tokens; a text without a
newline is one section; copies of a row give the same rows again; an empty
table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame

from cardwatch.llm import scan as S
from cardwatch.llm.bpe import Automaton, automaton
from cardwatch.llm.spark_io import text_columns

RULES = ("first", "most")
SCHEMA = (
    "doc_id long, section int, start_char long, end_char long, n_tokens long, n_crossing long, doc_tokens long"
)


def line_sections(text: bytes) -> np.ndarray:
    """Byte position where every line of a text begins."""
    raw = np.frombuffer(text, dtype=np.uint8)
    begins = np.flatnonzero(raw == 0x0A) + 1
    return np.concatenate(([0], begins[begins < len(raw)])).astype(np.int64)


def attribute(text: bytes, token_bytes: np.ndarray, begins: np.ndarray, rule: str) -> tuple[np.ndarray, ...]:
    """Section spans in characters, and each section's tokens and crossing tokens."""
    raw = np.frombuffer(text, dtype=np.uint8)
    char = np.cumsum((raw & 0xC0) != 0x80)  # characters begun up to and with each byte
    chars = int(char[-1]) if len(raw) else 0
    start = np.concatenate(([0], char))[begins]
    start = np.where(begins > 0, start, 0)
    end = np.append(start[1:], chars)
    stop_byte = np.cumsum(token_bytes)
    lo = char[stop_byte - token_bytes] - 1 if len(token_bytes) else np.zeros(0, np.int64)
    hi = char[stop_byte - 1] if len(token_bytes) else lo  # exclusive
    own = np.searchsorted(start, lo, side="right") - 1
    last = np.searchsorted(start, hi - 1, side="right") - 1
    crossing = own != last
    held = own.copy()
    if rule == "most":
        for t in np.flatnonzero(crossing).tolist():
            cuts = np.concatenate(([lo[t]], start[own[t] + 1 : last[t] + 1], [hi[t]]))
            held[t] = own[t] + int(np.argmax(np.diff(cuts)))
    n = len(start)
    return start, end, np.bincount(held, minlength=n), np.bincount(held[crossing], minlength=n)


def token_counts(docs: DataFrame, rule: str = "first", vocabulary: str | None = None, sections=line_sections) -> DataFrame:
    """One row per document and section; no shuffle."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    machine = automaton(docs.sparkSession, vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: Automaton = machine.value
        for c in S.chunks(batches):
            ids = a.encode(c.texts)
            parts = [attribute(t, a.label_len[x], sections(t), rule) for t, x in zip(c.texts, ids, strict=True)]
            n = np.array([len(p[0]) for p in parts])
            doc = np.repeat(np.arange(len(c)), n)
            flat = [np.concatenate([p[k] for p in parts]).astype(np.int64) for k in range(4)]
            number = (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)).astype(np.int32)
            total = np.array([len(x) for x in ids], dtype=np.int64)[doc]
            yield pa.RecordBatch.from_arrays(
                [c.ids.take(pa.array(doc)), pa.array(number), *map(pa.array, flat), pa.array(total)],
                names=["doc_id", "section", "start_char", "end_char", "n_tokens", "n_crossing", "doc_tokens"],
            )

    return text_columns(docs).mapInArrow(run, SCHEMA)
