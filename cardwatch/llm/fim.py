"""Fill-in-the-middle transformation by displacement scatter, and its inverse.

A text of n code points is cut at two of its n + 1 places, drawn from the hex
digits of ``sha256("1:" + doc_id)``: the prefix ends after the smaller, the middle
after the larger.  ``psm`` writes ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, ``spm``
writes ``<S>`` suffix ``<P>`` prefix ``<M>`` middle, and ``plain`` is the text itself:
an empty one, one that holds a marker, and every one whose draw says so.

*Scatter.*  A batch of texts is one array of bytes.  A byte's place in the output
is its place in the input plus a shift that is constant in each part, so the
difference array of the shifts has one entry per part: a cumulative sum gives
every byte its shift, one numpy scatter writes the batch's output, and the marker
bytes are scattered into the gaps.  The sum runs over blocks of ``BLOCK`` bytes
with a carry, so a very long text needs little more than its own two copies.

*Gather.*  The inverse reads an output and its form only: it finds the markers
(an output that is not plain holds each once), lays out the parts, and gathers
the bytes back through the same kind of difference array.

Each case has a defined result: a null text is empty and empty texts are plain;
n = 0 has no cut.  A null doc_id is drawn as the empty string.  Rows that repeat a
doc_id are cut by the same draws, each in its own text.  An empty table gives an
empty table; further columns are ignored (``fill_in_middle``) or kept
(``restore_middle``, but for one named ``restored``, which is replaced).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm import scan as S
from cardwatch.llm.spark_io import text_columns
from cardwatch.session import ship_package

SEED = "1:"
PLAIN_FROM, SPM_BELOW = 90, 20
#: Letters of the markers of the prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"PSM"
MARK = 3
BLOCK = 1 << 20
FORMS = np.array(["plain", "psm", "spm"])
SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def draws(ids: list) -> np.ndarray:
    """h1 to h4 of every doc_id: the first four 8-digit groups of its digest."""
    heads = b"".join(hashlib.sha256(f"{SEED}{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(heads, dtype=">u4").reshape(len(ids), 4).astype(np.int64)


def marker_starts(buf: np.ndarray) -> np.ndarray:
    """Places of ``<P>``, ``<S>`` and ``<M>``."""
    at = np.flatnonzero(buf[:-2] == ord("<")) if len(buf) > 2 else np.zeros(0, dtype=np.int64)
    letter = buf[at + 1] if len(at) else at
    return at[(buf[at + 2] == ord(">")) & ((letter == PREFIX) | (letter == SUFFIX) | (letter == MIDDLE))] if len(at) else at


def _moved(src: np.ndarray, start: np.ndarray, shift: np.ndarray, out: np.ndarray, gather: bool) -> None:
    """Move the parts that begin at ``start`` (ascending; the last begins at the end) by their shifts.

    Scatter writes out[i + shift] = src[i]; gather writes out[i] = src[i + shift].
    """
    delta = np.diff(shift, prepend=0)
    n, carry = int(start[-1]) if len(start) else 0, 0
    for lo in range(0, n, BLOCK):
        hi = min(n, lo + BLOCK)
        a, b = np.searchsorted(start, (lo, hi))
        change = np.zeros(hi - lo, dtype=np.int64)
        np.add.at(change, start[a:b] - lo, delta[a:b])
        change[0] += carry
        place = np.cumsum(change)
        carry = int(place[-1])
        place += np.arange(lo, hi)
        if gather:
            out[lo:hi] = src[place]
        else:
            out[place] = src[lo:hi]


def _split_places(c: S.Chunk, ids: list) -> tuple[np.ndarray, ...]:
    """Per text: n, form number, and byte and code point places of the two cuts."""
    leads = np.flatnonzero((c.buf & 0xC0) != 0x80)  # separators between texts are code points too
    first = np.searchsorted(leads, c.start)
    n = np.searchsorted(leads, c.end) - first
    h = draws(ids)
    one, two = h[:, 0] % (n + 1), h[:, 1] % (n + 1)
    low, high = np.minimum(one, two), np.maximum(one, two)
    form = np.where(h[:, 3] % 100 < SPM_BELOW, 2, 1)
    marked = np.zeros(len(c), dtype=bool)
    marked[np.searchsorted(c.start, marker_starts(c.buf), side="right") - 1] = True
    form[(n == 0) | marked | (h[:, 2] % 100 >= PLAIN_FROM)] = 0
    return n, form, low, high, leads[first + low], leads[first + high]


def _interleaved(*columns: np.ndarray) -> np.ndarray:
    return np.stack(columns, axis=1).ravel()


def scatter(c: S.Chunk, form: np.ndarray, cut1: np.ndarray, cut2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Output bytes of a chunk and the ends of its outputs."""
    size = c.end - c.start
    made = np.where(form == 0, size, size + 3 * MARK)
    end = np.cumsum(made)
    base = end - made
    prefix, middle, suffix = cut1 - c.start, cut2 - cut1, c.end - cut2
    # where each part begins in the output
    psm = (base + MARK, base + 3 * MARK + prefix + suffix, base + 2 * MARK + prefix)
    spm = (base + 2 * MARK + suffix, base + 3 * MARK + prefix + suffix, base + MARK)
    plain = (base, base + prefix, base + prefix + middle)
    to = [np.choose(form, parts) for parts in zip(plain, psm, spm, strict=True)]
    out = np.empty(int(end[-1]) if len(end) else 0, dtype=np.uint8)
    # a text's separator is a part of its own; it has no place in the output and is skipped
    texts = np.ones(len(c.buf), dtype=bool)
    texts[c.end] = False
    src, gone = c.buf[texts], np.arange(len(c))
    at = [c.start - gone, cut1 - gone, cut2 - gone]
    starts = np.append(_interleaved(*at), len(src))
    shifts = np.append(_interleaved(*(t - a for t, a in zip(to, at, strict=True))), 0)
    _moved(src, starts, shifts, out, gather=False)
    cut = form > 0
    for letter, place in zip((PREFIX, MIDDLE, SUFFIX), to, strict=True):
        p = place[cut] - MARK
        out[p], out[p + 1], out[p + 2] = ord("<"), letter, ord(">")
    return out, end


def gather(c: S.Chunk, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts that a chunk of outputs was made of, and their ends; reads outputs and forms only."""
    cut = np.flatnonzero(form > 0)
    marks = marker_starts(c.buf)
    text = np.searchsorted(c.start, marks, side="right") - 1
    marks = marks[form[text] > 0]
    if len(marks) != 3 * len(cut):
        raise ValueError("an output that is not plain holds each marker once")
    marks = marks.reshape(len(cut), 3)
    order = np.where(form[cut] == 1, PREFIX, SUFFIX), np.where(form[cut] == 1, SUFFIX, PREFIX), np.full(len(cut), MIDDLE)
    if (marks[:, 0] != c.start[cut]).any() or any((c.buf[marks[:, k] + 1] != order[k]).any() for k in range(3)):
        raise ValueError("the markers do not stand in the order of the form")
    size = c.end - c.start
    size[cut] -= 3 * MARK
    end = np.cumsum(size)
    base = end - size
    # parts in the order of the text: prefix, middle, suffix; a plain text is all prefix
    begin, length = np.stack([c.start, c.end, c.end]), np.stack([size, np.zeros_like(size), np.zeros_like(size)])
    psm = form[cut] == 1
    one = (marks[:, 0] + MARK, marks[:, 1] - marks[:, 0] - MARK)
    two = (marks[:, 1] + MARK, marks[:, 2] - marks[:, 1] - MARK)
    three = (marks[:, 2] + MARK, c.end[cut] - marks[:, 2] - MARK)
    for k, (a, b) in enumerate(((one, two), (three, three), (two, one))):
        begin[k, cut], length[k, cut] = np.where(psm, a[0], b[0]), np.where(psm, a[1], b[1])
    at = [base, base + length[0], base + length[0] + length[1]]
    out = np.empty(int(end[-1]) if len(end) else 0, dtype=np.uint8)
    starts = np.append(_interleaved(*at), len(out))
    shifts = np.append(_interleaved(*(b - a for b, a in zip(begin, at, strict=True))), 0)
    _moved(c.buf, starts, shifts, out, gather=True)
    return out, end


def _strings(out: np.ndarray, end: np.ndarray) -> pa.Array:
    """The pieces of a byte array as a string column."""
    offsets = np.concatenate(([0], end)).astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(end), [None, pa.py_buffer(offsets), pa.py_buffer(out)]).cast(pa.string())


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for c in S.chunks(batches):
        n, form, low, high, cut1, cut2 = _split_places(c, c.ids.to_pylist())
        out, end = scatter(c, form, cut1, cut2)
        plain = form == 0
        yield pa.RecordBatch.from_arrays(
            [
                c.ids, pa.array(n.astype(np.int64)), pa.array(FORMS[form].tolist(), pa.string()),
                pa.array(low, pa.int64(), mask=plain), pa.array(high - low, pa.int64(), mask=plain), _strings(out, end),
            ],
            names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
        )


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """One row per document: n, form, the lengths of prefix and middle (null: plain), and the output; no shuffle."""
    return text_columns(docs).mapInArrow(_cut, SCHEMA)


def _restore(batches: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        at = 0
        for c in S.chunks([b], key="form", text="output") if b.num_rows else ():
            form = np.array([{"psm": 1, "spm": 2}.get(f, 0) for f in c.ids.to_pylist()], dtype=np.int64)
            part = b.slice(at, len(c))
            at += len(c)
            yield pa.RecordBatch.from_arrays([*(part.column(x) for x in names), _strings(*gather(c, form))], names=[*names, "restored"])


def restore_middle(made: DataFrame) -> DataFrame:
    """The rows with column ``restored``: the text rebuilt from ``output`` and ``form`` alone; no shuffle."""
    ship_package(made.sparkSession)
    names = [x for x in made.columns if x != "restored"]
    types = dict(made.dtypes)
    schema = ", ".join([*(f"`{x}` {types[x]}" for x in names), "restored string"])
    return made.select(*names).mapInArrow(lambda batches: _restore(batches, names), schema)


def round_trip(docs: DataFrame) -> DataFrame:
    """The digests of the outputs and of the texts restored from them, one row per document."""
    made = fill_in_middle(docs)
    made = made.withColumn("output_sha256", F.sha2("output", 256))
    return restore_middle(made).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", F.sha2("restored", 256).alias("restored_sha256")
    )
