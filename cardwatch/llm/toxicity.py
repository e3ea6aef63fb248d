"""Toxicity scores from a counterfactual-regularised classifier.

A logistic model over word features: every lower-cased word and its prefixes of
4 to 8 bytes, hashed to ``SLOTS`` slots, each slot at the levels "once or more",
"twice or more" and "four times or more" in the text.  It is fitted on a bounded
sample of labelled documents, ``SAMPLE`` of either class at most (those with the
smallest hashes of doc_id), weighted to equal shares; the ``FEATURES`` features
that tell the classes apart best are kept.

Counterfactual pairs: in a labelled text that names groups of people, every
identity term is swapped for others of the list and for a neutral word.  The fit
adds ``MU`` times the mean squared change of the score over these swaps, so that
a neutral mention of a group does not raise the score.

Rows whose crc32(doc_id as text) mod 3 is 1 are held out: their labels are never
read.  Only the text enters a score.  Null and empty texts score the model's
intercept.  Labels other than 0 and 1 are left out, and a doc_id labelled both
ways counts as 1; without labels of both classes every score is the intercept of
the class shares.  Repeated rows get the same score; an empty table gives an
empty table; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm import scan as S
from cardwatch.llm.spark_io import text_columns, written

SLOTS = 1 << 18
PREFIXES = (4, 5, 6, 7, 8)
LEVELS = (1, 2, 4)
SAMPLE = 6000
FEATURES = 4096
MIN_TOXIC = 3
RIDGE = 1e-4
MU = 1.0
STEPS = 300
RATE = 0.3
THRESHOLD = 0.7

#: Words that name groups of people, by language and word class, each list with a neutral word of its kind.
GROUPS = [
    (("women", "men", "girls", "boys"), "people"),
    (("christians", "muslims", "jews", "hindus", "buddhists", "atheists"), "believers"),
    (("immigrants", "refugees", "foreigners", "natives"), "residents"),
    (("gay", "lesbian", "transgender", "straight"), "ordinary"),
    (("black", "white", "asian", "latino"), "human"),
    (("disabled", "elderly", "young", "deaf"), "adult"),
    (("femmes", "hommes", "filles"), "personnes"),
    (("musulmans", "juifs", "chrétiens"), "croyants"),
    (("frauen", "männer", "mädchen"), "menschen"),
    (("muslime", "juden", "christen"), "gläubige"),
    (("mujeres", "hombres", "niñas"), "personas"),
    (("musulmanes", "judíos", "cristianos"), "creyentes"),
]
#: The next word of the same list, and the list's neutral word, of each term.
OTHER = {t: terms[(i + 1) % len(terms)] for terms, _ in GROUPS for i, t in enumerate(terms)}
NEUTRAL = {t: neutral for terms, neutral in GROUPS for t in terms}


def slots_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, slot) of every word and prefix of lower-cased texts."""
    c = S.chunk_of(np.arange(len(texts)), [t.decode("utf-8", "replace").lower().encode() for t in texts])
    w = S.words_of(c, S.ALNUM_WORDS)
    text = w.text_of()
    slots, owners = [w.hash], [text]
    size = w.end - w.start
    for n in PREFIXES:
        longer = size > n
        slots.append(S.hash_runs(c.buf, w.start[longer], w.start[longer] + n) + S.U64(n))
        owners.append(text[longer])
    return np.concatenate(owners), (np.concatenate(slots) % S.U64(SLOTS)).astype(np.int64)


def features_of(texts: list[bytes], wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of the features each text has; ``wanted`` masks the slots to look at."""
    owner, slot = slots_of(texts)
    if wanted is not None:
        keep = wanted[slot]
        owner, slot = owner[keep], slot[keep]
    key, n = np.unique(owner * SLOTS + slot, return_counts=True)
    parts = [(key[n >= least] // SLOTS, (key[n >= least] % SLOTS) * len(LEVELS) + i) for i, least in enumerate(LEVELS)]
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def swaps(text: str) -> list[str]:
    """The text with its identity terms swapped, once by another group of the same language and word class and once by a neutral word of them; none without a term."""
    low = text.lower()
    if not _TERMS.search(low):
        return []
    return [_TERMS.sub(lambda m, to=to: to[m.group()], low) for to in (OTHER, NEUTRAL)]


_TERMS = re.compile(r"\b(?:" + "|".join(OTHER) + r")\b")


def sample(docs: DataFrame, labels: DataFrame, size: int) -> DataFrame:
    """(doc_id, text, toxic): at most ``size`` labelled documents of either class that are not held out."""
    seen = labels.filter("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    seen = seen.filter(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    # labels without a document must not use up the bound
    seen = seen.join(docs.select("doc_id"), "doc_id", "left_semi")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = seen.filter("toxic = 1").orderBy(*order).limit(size).union(seen.filter("toxic = 0").orderBy(*order).limit(size))
    # at most 2 * size rows; of several texts of a document the smallest
    rows = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("toxic").alias("toxic"))
    return written(rows, "labelled")


def _feature_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, SLOTS * len(LEVELS)), dtype=np.int64)
    for b in batches:
        toxic = b.column("toxic").to_numpy(zero_copy_only=False)
        for c in S.chunks([b]):
            owner, feature = features_of(c.texts)
            at, toxic = toxic[: len(c)], toxic[len(c) :]
            for k in (0, 1):
                counts[k] += np.bincount(feature[at[owner] == k], minlength=counts.shape[1])
    some = np.flatnonzero(counts[1])
    yield pa.RecordBatch.from_arrays([some, counts[1][some], counts[0][some]], names=["feature", "toxic", "clean"])


def choose_features(rows: DataFrame, n_toxic: int, n_clean: int, count: int) -> np.ndarray:
    """The features found more often in toxic texts, by their chi-squared statistic."""
    f = rows.mapInArrow(_feature_counts, "feature long, toxic long, clean long").groupBy("feature").agg(
        F.sum("toxic").alias("t"), F.sum("clean").alias("c")
    )
    a, b = F.col("t") / n_toxic, F.col("c") / n_clean
    q = (F.col("t") + F.col("c")) / (n_toxic + n_clean)
    chi = (a - b) * (a - b) / F.greatest(q * (1 - q), F.lit(1e-9)) * (n_toxic * n_clean / (n_toxic + n_clean))
    # at most ``count`` rows
    best = f.filter((F.col("t") >= MIN_TOXIC) & (a > b)).withColumn("chi", chi).orderBy(F.desc("chi"), "feature").limit(count)
    return np.array(sorted(r["feature"] for r in best.select("feature").collect()), dtype=np.int64)


def _examples(chosen: np.ndarray):
    wanted = np.zeros(SLOTS, dtype=bool)
    wanted[chosen // len(LEVELS)] = True

    def only(texts: list[bytes]) -> list[list[int]]:
        owner, feature = features_of(texts, wanted)
        at = np.searchsorted(chosen, feature)
        ok = chosen[np.minimum(at, len(chosen) - 1)] == feature
        owner, at = owner[ok], at[ok]
        order = np.argsort(owner, kind="stable")
        cuts = np.searchsorted(owner[order], np.arange(len(texts) + 1))
        return [at[order[i:j]].tolist() for i, j in zip(cuts[:-1], cuts[1:], strict=True)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            toxic, done = b.column("toxic"), 0
            for c in S.chunks([b]):
                swapped = [swaps(t.decode("utf-8", "replace")) for t in c.texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        toxic.slice(done, len(c)),
                        pa.array(only(c.texts), pa.list_(pa.int32())),
                        pa.array([only([x.encode() for x in s]) if s else [] for s in swapped], pa.list_(pa.list_(pa.int32()))),
                    ],
                    names=["toxic", "features", "swapped"],
                )
                done += len(c)

    return run


def fit(toxic: pa.Array, features: pa.ListArray, swapped: pa.ListArray, n: int, mu: float = MU) -> tuple[np.ndarray, float]:
    """Weights and intercept by adaptive gradient steps over all examples: labels, features and the features of the swaps."""
    y = toxic.to_numpy(zero_copy_only=False).astype(float)
    positive, negative = int((y == 1).sum()), int((y == 0).sum())
    if not positive or not negative or not n:
        return np.zeros(n), math.log((positive + 0.5) / (negative + 0.5))
    row, col = pc.list_parent_indices(features).to_numpy(), pc.list_flatten(features).to_numpy().astype(np.int64)
    share = np.where(y == 1, 0.5 / positive, 0.5 / negative)
    pairs, changes, signs = 0, [], []
    for i in np.flatnonzero(pc.list_value_length(swapped).to_numpy(zero_copy_only=False)).tolist():
        x = np.array(features[i].as_py(), dtype=np.int64)
        for s in swapped[i].as_py():
            changes.append(np.setxor1d(x, np.array(s, dtype=np.int64)))
            signs.append(np.where(np.isin(changes[-1], x), 1.0, -1.0))
            pairs += 1
    d_row = np.repeat(np.arange(pairs), [len(x) for x in changes])
    d_col, d_val = (np.concatenate(x) if pairs else np.zeros(0, np.int64) for x in (changes, signs))
    w, b, g2, b2 = np.zeros(n), 0.0, np.full(n, 1e-8), 1e-8
    for _ in range(STEPS):
        z = np.bincount(row, weights=w[col], minlength=len(y)) + b
        e = (_sigmoid(z) - y) * share
        g = np.bincount(col, weights=e[row], minlength=n) + RIDGE * w
        if len(d_col):
            change = np.bincount(d_row, weights=d_val * w[d_col], minlength=pairs)
            g += np.bincount(d_col, weights=d_val * change[d_row], minlength=n) * (2 * mu / pairs)
        g2 += g * g
        w -= RATE * g / np.sqrt(g2)
        b2 += e.sum() ** 2
        b -= RATE * e.sum() / math.sqrt(b2)
    return w, b


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks else pa.array([], column.type)


def train(docs: DataFrame, labels: DataFrame, mu: float = MU, size: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, float]:
    """Chosen features, their weights, the intercept."""
    rows = sample(text_columns(docs), labels, size)
    counts = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    chosen = choose_features(rows, toxic, clean, FEATURES) if toxic and clean else np.zeros(0, np.int64)
    if not len(chosen):
        return chosen, np.zeros(0), math.log((toxic + 0.5) / (clean + 0.5))
    # at most 2 * size rows of at most FEATURES numbers each, and two swaps of them; four bytes a number, no Python object for each
    got = rows.mapInArrow(_examples(chosen), "toxic int, features array<int>, swapped array<array<int>>").toArrow().combine_chunks()
    w, b = fit(*(_one(got.column(c)) for c in ("toxic", "features", "swapped")), len(chosen), mu)
    del got
    S.give_back()
    return chosen, w, b


def score_texts(texts: list[bytes], weights: np.ndarray, wanted: np.ndarray, intercept: float) -> np.ndarray:
    owner, feature = features_of(texts, wanted)
    return _sigmoid(np.bincount(owner, weights=weights[feature], minlength=len(texts)) + intercept)


def _model(docs: DataFrame, labels: DataFrame, mu: float):
    """The broadcast weights (one number per feature) and the intercept."""
    chosen, w, intercept = train(docs, labels, mu)
    weights = np.zeros(SLOTS * len(LEVELS), dtype=np.float32)
    weights[chosen] = w
    return docs.sparkSession.sparkContext.broadcast(weights), intercept


def _scorer(model, intercept: float):
    weights = model.value
    wanted = weights.reshape(SLOTS, len(LEVELS)).any(axis=1)
    return lambda c: score_texts(c.texts, weights, wanted, intercept)


def toxicity_scores(docs: DataFrame, labels: DataFrame, mu: float = MU) -> DataFrame:
    """doc_id, held_out, score, predicted; the scores need no shuffle."""
    model, intercept = _model(docs, labels, mu)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scorer(model, intercept)
        for c in S.chunks(batches):
            yield pa.RecordBatch.from_arrays([c.ids, pa.array(score(c))], names=["doc_id", "score"])

    return (
        text_columns(docs)
        .mapInArrow(run, "doc_id long, score double")
        .select(
            "doc_id",
            F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out"),
            "score",
            (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        )
    )


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score under the threshold, with all their columns; no shuffle."""
    model, intercept = _model(docs, labels, MU)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = _scorer(model, intercept)
        for b in batches:
            scores = [score(c) for c in S.chunks([b])]
            if scores:
                yield b.filter(pa.array(np.concatenate(scores) < THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
