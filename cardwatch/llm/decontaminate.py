"""Benchmark decontamination: a BM25 index of test items, queried by every passage.

The test items are cut into entries of at most ``ENTRY`` words and indexed: a
term's postings carry BM25 impacts divided by the entry's score against itself,
so a passage that holds every word of an entry scores 1 (a passage is a set of
terms).  Entries are grouped in blocks of ``BLOCK``; a term keeps its largest
impact per block and overall.  The most frequent terms, as long as they can't add
more than ``COMMON`` to any entry, are not essential: a match needs the rest of
its score from other terms.

Every document is cut into passages of ``2 * ENTRY`` words that overlap by half,
so any run of ``ENTRY`` words lies in one.  Each passage is a query: (1) passages
whose essential terms' largest impacts don't add up to that rest are passed over,
(2) of the others only blocks whose block maxima add up to the threshold are
opened, (3) entries of open blocks are scored exactly, and all at the threshold
or above are retrieved.  The bounds never lose an entry.  This is block-max WAND with all
pivots of a batch of passages moved at once, in numpy.

A retrieved item is verified on the whole document: the shares of the 5-grams of
its question (all but the last line, or the last sentence) and of its answer
(the rest) found there must both reach ``OVERLAP``.  An answer of fewer than
``SHORT_ANSWER`` words may also be verified word by word: by the share of its
words that stand right behind a stretch of the question.  An item of fewer than
``SHORT_ITEM`` words must stand there whole, word by word.

The statistics are global: one aggregate counts the entries of every term, so an
entry's scores do not depend on how the benchmark is cut.  The items are dealt to
shards of about ``SHARD_BYTES`` of text; each shard's index is built by a task and
written to the shared folder.  The driver hands one index at a time to the
executors, so what it holds is bounded, and the documents are read once per shard.
Words are lower-cased runs of ASCII letters, digits and non-ASCII characters.
Items without a word match nothing, as do null or empty texts; repeated documents
give repeated rows, repeated items none; empty tables give an empty table; further
columns are ignored.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardwatch.llm import scan as S
from cardwatch.llm.spark_io import text_columns, written
from cardwatch.session import ship_package

ENTRY = 64
BLOCK = 8
K1, B = 1.2, 0.75
THRESHOLD = 0.5
COMMON = 0.25
GRAM = 5
OVERLAP = 0.6
SHORT_ITEM, SHORT_ANSWER = 8, 10
SHARD_BYTES = 8 << 20
#: Postings looked at together: their arrays stay in a core's cache.
BATCH = 1 << 16

SCHEMA = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double"


def _words(text: str) -> np.ndarray:
    return S.words_of(S.chunk_of(np.zeros(1, np.int64), [text.encode()]), S.ALNUM_WORDS, S.ASCII_LOWER).hash


def question_and_answer(text: str) -> tuple[str, str]:
    """All but the last line or sentence, and that; a text of one sentence is both."""
    for cut in (r"\n", r"(?<=[.!?])\s+"):
        parts = [p for p in re.split(cut, text) if len(_words(p))]
        if len(parts) > 1:
            return " ".join(parts[:-1]), parts[-1]
    return text, text


def _grams(h: np.ndarray) -> tuple[int, np.ndarray]:
    n = min(GRAM, len(h))
    return n, np.unique(S.ngrams(h, n))


def _entries(h: np.ndarray) -> list[np.ndarray]:
    return [h[at : at + ENTRY] for at in range(0, len(h), ENTRY)]


class Part:
    """What a document must hold of a question or answer: its n-grams, and the words of a short answer."""

    def __init__(self, h: np.ndarray, n: int, by_word: bool = False):
        self.n, self.grams = n, np.unique(S.ngrams(h, n))
        self.words, self.reach = (np.unique(h), 2 * len(h) + 2) if by_word else (None, 0)

    def share(self, grams: np.ndarray) -> float:
        return float(np.isin(self.grams, grams).mean())

    def share_behind(self, h: np.ndarray, question: Part) -> float:
        """Largest share of the words that stand within reach of the end of a stretch of the question's grams."""
        if self.words is None:
            return 0.0
        at = np.flatnonzero(np.isin(S.ngrams(h, question.n), question.grams))
        ends = at[np.append(np.diff(at) > 1, True)] + question.n if len(at) else at
        return max((float(np.isin(self.words, h[e : e + self.reach]).mean()) for e in ends.tolist()), default=0.0)


def _parts(text: str, h: np.ndarray) -> tuple[Part, Part]:
    if len(h) < SHORT_ITEM:
        whole = Part(h, len(h))
        return whole, whole
    question, answer = (_words(p) for p in question_and_answer(text))
    return Part(question, min(GRAM, len(question))), Part(answer, min(GRAM, len(answer)), len(answer) < min(SHORT_ANSWER, len(h)))


class Index:
    """Impact-ordered blocks over the entries of some test items, with the statistics of all of them."""

    def __init__(self, items: list[tuple[int | None, str]], counted: dict[int, int], n_entries: int, mean: float):
        self.ids, self.parts, entries, self.item = [], [], [], []
        for item_id, text in sorted({(i, t) for i, t in items if t}, key=lambda x: (x[0] is None, x[0] or 0, x[1])):
            h = _words(text)
            if not len(h):
                continue
            for e in _entries(h):
                entries.append(e)
                self.item.append(len(self.ids))
            self.ids.append(item_id)
            self.parts.append(_parts(text, h))
        self.item = np.array(self.item, dtype=np.int64)
        self.n = len(entries)
        if not self.n:
            return
        lens = np.array([len(e) for e in entries])
        self.vocab, term = np.unique(np.concatenate(entries), return_inverse=True)
        entry = np.repeat(np.arange(self.n), lens)
        pair, tf = np.unique(term * self.n + entry, return_counts=True)
        term, entry = pair // self.n, pair % self.n
        df = np.array([counted[h] for h in self.vocab.astype(np.int64).tolist()])
        idf = np.log(1 + (n_entries - df + 0.5) / (df + 0.5))
        impact = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lens[entry] / mean))
        own = np.bincount(entry, weights=impact, minlength=self.n)
        self.impact, self.entry = impact / own[entry], entry
        self.first = np.searchsorted(term, np.arange(len(self.vocab) + 1))
        self.most = np.maximum.reduceat(self.impact, self.first[:-1])
        self.essential, self.slack = self._essential(df)
        self.blocks = -(-self.n // BLOCK)
        key = term * self.blocks + entry // BLOCK
        begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        self.block, self.block_most = key[begin] % self.blocks, np.maximum.reduceat(self.impact, begin)
        self.block_first = np.searchsorted(key[begin] // self.blocks, np.arange(len(self.vocab) + 1))

    def _essential(self, df: np.ndarray) -> tuple[np.ndarray, float]:
        """Largest impacts of the essential terms (0 for the others), and what the others can add to an entry."""
        held, slack, most = np.zeros(self.n), 0.0, self.most.copy()
        for t in np.argsort(-df, kind="stable").tolist():
            post = slice(self.first[t], self.first[t + 1])
            if (held[self.entry[post]] + self.impact[post]).max() > COMMON:
                break
            held[self.entry[post]] += self.impact[post]
            most[t], slack = 0.0, float(held.max())
        return most, slack

    def terms(self, h: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.vocab, h), len(self.vocab) - 1)
        return np.where(self.vocab[at] == h, at, -1)

    def retrieve(self, term: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, entry, score) of all entries at the threshold or above, for passages [start, end) of a term array."""
        bound = np.concatenate(([0.0], np.cumsum(np.where(term >= 0, self.essential[term], 0.0))))
        live = np.flatnonzero(bound[end] - bound[start] >= THRESHOLD - self.slack - 1e-9)
        known = np.concatenate(([0], np.cumsum(term >= 0)))
        at = np.flatnonzero(term >= 0)
        out = []
        cost = np.cumsum(known[end[live]] - known[start[live]]) * max(1, len(self.block) // len(self.vocab))
        for part in np.split(live, np.searchsorted(cost, np.arange(BATCH, cost[-1] if len(cost) else 0, BATCH))):
            if len(part):
                out.append(self._open(part, term[at], known[start[part]], known[end[part]]))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def _open(self, passages: np.ndarray, term: np.ndarray, lo: np.ndarray, hi: np.ndarray):
        n = hi - lo
        row = np.repeat(np.arange(len(passages)), n)
        word = np.arange(int(n.sum())) + np.repeat(lo - (np.cumsum(n) - n), n)
        pair = np.unique(row * len(self.vocab) + term[word])
        row, term = pair // len(self.vocab), pair % len(self.vocab)
        blocks, score = self._sums(row, term, self.block_first, self.block, self.block_most, self.blocks)
        opened = blocks[score >= THRESHOLD - 1e-9]
        keep = np.isin(row, opened // self.blocks)
        found, score = self._sums(row[keep], term[keep], self.first, self.entry, self.impact, self.n, opened)
        ok = score >= THRESHOLD - 1e-9
        return passages[found[ok] // self.n], found[ok] % self.n, score[ok]

    def _sums(self, row, term, first, target, impact, size, opened=None) -> tuple[np.ndarray, np.ndarray]:
        """Sums of impacts by (row, target); with ``opened`` only targets in an open block of their row."""
        n = first[term + 1] - first[term]
        post = np.arange(int(n.sum())) + np.repeat(first[term] - (np.cumsum(n) - n), n)
        row, weight = np.repeat(row, n), impact[post]
        key = row * size + target[post]
        if opened is not None:
            keep = np.isin(row * self.blocks + target[post] // BLOCK, opened)
            key, weight = key[keep], weight[keep]
        unique, inverse = np.unique(key, return_inverse=True)
        return unique, np.bincount(inverse, weights=weight, minlength=len(unique))

    def search(self, c: S.Chunk) -> list[tuple[int, int, float, float, float]]:
        """(text, item, score, question overlap, answer overlap) of the verified items of a chunk."""
        w = S.words_of(c, S.ALNUM_WORDS, S.ASCII_LOWER)
        n = w.count
        passages = np.where(n > 0, np.maximum(1, -(-n // ENTRY) - 1), 0)
        text = np.repeat(np.arange(len(c)), passages)
        start = w.first[text] + ENTRY * (np.arange(len(text)) - np.repeat(np.cumsum(passages) - passages, passages))
        end = np.minimum(start + 2 * ENTRY, w.first[text + 1])
        passage, entry, score = self.retrieve(self.terms(w.hash), start, end)
        best: dict[tuple[int, int], float] = {}
        for t, i, s in zip(text[passage].tolist(), self.item[entry].tolist(), score.tolist(), strict=True):
            best[t, i] = max(s, best.get((t, i), 0.0))
        out, held = [], {}
        for (t, i), s in best.items():
            h, (question, answer) = w.hash[w.first[t] : w.first[t + 1]], self.parts[i]
            for size in {question.n, answer.n}:
                if (t, size) not in held:
                    held = {k: v for k, v in held.items() if k[0] == t} | {(t, size): np.unique(S.ngrams(h, size))}
            asked = question.share(held[t, question.n])
            if asked < OVERLAP:
                continue
            said = answer.share(held[t, answer.n])
            if said < OVERLAP:
                said = max(said, answer.share_behind(h, question))
            if said >= OVERLAP:
                out.append((t, i, s, asked, said))
        return out


def _counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, term, entries that hold it); the term null: entries and their words in all."""
    for b in batches:
        shard, term, n, words = [], [], [], []
        for s, text in zip(b.column("shard").to_pylist(), b.column("text").to_pylist(), strict=True):
            entries = _entries(_words(text))
            held, times = np.unique(np.concatenate([np.unique(e) for e in entries]), return_counts=True) if entries else ([], [])
            shard += [s] * (len(held) + 1)
            term += [*np.asarray(held, dtype=np.uint64).astype(np.int64).tolist(), None]
            n += [*np.asarray(times).tolist(), len(entries)]
            words += [0] * len(held) + [sum(map(len, entries))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(shard, pa.int32()), pa.array(term, pa.int64()), pa.array(n, pa.int64()), pa.array(words, pa.int64())],
            names=["shard", "term", "n", "words"],
        )


def _shards(docs: DataFrame, items: DataFrame) -> Iterator:
    """The index of each shard of the items, on every executor."""
    spark = docs.sparkSession
    items = items.select(items["item_id"].cast("long").alias("item_id"), items["text"].cast("string").alias("text"))
    items = items.filter("text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    items = written(items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)).cast("int")), "items")
    counted = items.select("shard", "text").mapInArrow(_counts, "shard int, term long, n long, words long")
    counted = written(counted.groupBy("shard", "term").agg(F.sum("n").alias("n"), F.sum("words").alias("words")), "terms")
    n_entries, words = counted.filter("term IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    mean = words / max(1, n_entries)
    terms = counted.filter("term IS NOT NULL").select("shard", "term", F.sum("n").over(Window.partitionBy("term")).alias("df"))

    def build(own: pa.Table, df: pa.Table) -> pa.Table:
        rows = list(zip(own.column("item_id").to_pylist(), own.column("text").to_pylist(), strict=True))
        held = dict(zip(df.column("term").to_pylist(), df.column("df").to_pylist(), strict=True))
        index = pickle.dumps(Index(rows, held, n_entries, mean))
        return pa.table({"shard": own.column("shard").slice(0, 1), "index": pa.array([index], pa.large_binary()).cast(pa.binary())})

    built = written(items.groupBy("shard").cogroup(terms.groupBy("shard")).applyInArrow(build, "shard int, index binary"), "indexes")
    for row in built.select("shard").sort("shard").collect():
        yield spark.sparkContext.broadcast(bytes(built.filter(F.col("shard") == row["shard"]).first()["index"]))


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document and test item it holds; one pass over the documents per shard, no shuffle."""
    docs = text_columns(docs)
    none = docs.sparkSession.createDataFrame([], SCHEMA)
    return reduce(DataFrame.union, [docs.mapInArrow(_search(index), SCHEMA) for index in _shards(docs, items)] or [none])


def _search(index):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Index = pickle.loads(index.value)
        for c in S.chunks(batches) if own.n else ():
            got = own.search(c)
            text, item, *numbers = [list(x) for x in zip(*got, strict=True)] if got else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    c.ids.take(pa.array(text, pa.int64())),
                    pa.array([own.ids[i] for i in item], pa.int64()),
                    *(pa.array(x, pa.float64()) for x in numbers),
                ],
                names=["doc_id", "item_id", "score", "question_overlap", "answer_overlap"],
            )

    return run


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no test item, with all their columns; one filter per shard, no shuffle."""
    ship_package(docs.sparkSession)
    for index in _shards(docs, items):
        docs = docs.mapInArrow(_clean(index), docs.schema)
    return docs


def _clean(index):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Index = pickle.loads(index.value)
        for b in batches:
            keep, at = np.ones(b.num_rows, dtype=bool), 0
            for c in S.chunks([b]) if own.n else ():
                keep[[at + hit[0] for hit in own.search(c)]] = False
                at += len(c)
            yield b.filter(pa.array(keep))

    return run
