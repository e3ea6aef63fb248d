"""MinHash near-dedup: bottom-k sketches from one hash function.

1. *Sketch.*  Every document's distinct word shingles are hashed by one
   function; the ``SKETCH`` smallest values are its sketch, a digest of all of
   them its class.  Documents with equal sets share a class; the smallest
   doc_id represents it, and only representatives go on.
2. *Inverted lists.*  A list holds the documents that retain a value.  Linked
   sets share at least ``t`` retained values (below), so a document need only
   enter the lists of its ``k - t + 1`` rarest values: values that many
   documents share (boilerplate) stay out of the lists unless a document has
   nothing else.
3. *Pairs.*  Each list pairs its members with its smallest document, a long one
   also with two chosen by hash.  The links found make components.  Where the
   members then lie in several components, each one outside the largest is paired
   with one of it, another in every list.  What is left apart is paired with all
   others where a list has up to ``FEW_APART`` such members; the members of the
   other lists meet by the rarest shingles of their full sets (below).  Parity
   bitmaps rule pairs out before they are tested; so every pair of a list is joined
   already, ruled out by an exact bound, or tested.  No list is cut.
4. *Filter and verify.*  The bottom-k sketch of the union estimates the
   similarity of a pair; what passes is verified on the full sets.

``t``: the k smallest values of the union are each shared with probability J,
so with J at the threshold fewer than t of k are shared with a chance below
``MISS`` per pair, the only way to lose a link.  For sets smaller than k the
bound is exact.

Rarest shingles: a set of n shingles shares at least ``ceil(n * percent / 100)``
with a partner, so at least one of any other ``n - that + 1`` is among the shared
ones.  Each set takes its rarest ones, counted over the sets that are compared;
those that no other set holds take places and meet nothing.  Unlike members of a
list thus cost rows in proportion to their shingles, not to the pairs.  Sets that
consist of common shingles but for a few still meet each other.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z.  A text with fewer words
than a shingle has its whole sequence as one shingle; a null or empty text has
no set, is linked with nothing and is kept, as is a row without a doc_id.
Repeated rows are copies.  Rows that share a doc_id and differ in text are one
document: the one whose set has the smallest digest is compared, and copies of
any of them belong to it.  An empty table gives an empty table; further columns
are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator
from functools import partial, reduce
from operator import add

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm import scan as S
from cardwatch.llm.components import components
from cardwatch.llm.spark_io import text_columns, written

SKETCH = 48
MISS = 1e-10
LONG_LIST = 32
FEW_APART = 32
HOT_SHARE = 2000


def shared_at_least(k: int, percent: int) -> int:
    """The largest t such that fewer than t of k values are shared with a chance of at most MISS."""
    p, below = percent / 100, 0.0
    for t in range(k + 1):
        below += math.comb(k, t) * p**t * (1 - p) ** (k - t)
        if below > MISS:
            return max(1, t)
    return k


def shingle_sets(c: S.Chunk, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes (63 bits, ascending) of every text, and the first of each text (one more at the end)."""
    w = S.words_of(c, S.SPACE_WORDS, S.ASCII_LOWER)
    total = len(w.hash)
    at = np.flatnonzero(S.whole(w.first, words, total))
    text, h = w.text_of()[at], S.ngrams(w.hash, words)[at]
    for n in range(1, words):  # short texts: the whole sequence
        short = np.flatnonzero(w.count == n)
        if len(short):
            text = np.concatenate((text, short))
            h = np.concatenate((h, S.mix(S.ngrams(w.hash, n)[w.first[short]] + S.U64(n))))
    h = h >> S.U64(1)
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (text[1:] != text[:-1]))) if len(h) else np.zeros(0, bool)
    text, h = text[new], h[new]
    return h, np.searchsorted(text, np.arange(len(c) + 1))


def class_of(h: np.ndarray, first: np.ndarray) -> list[bytes]:
    """Digest of every set."""
    return [hashlib.blake2b(h[a:b].tobytes(), digest_size=16).digest() for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]


def _sketches(words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in S.chunks(batches):
            h, first = shingle_sets(c, words)
            spans = list(zip(first[:-1].tolist(), first[1:].tolist(), strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    c.ids,
                    pa.array(np.diff(first).astype(np.int64)),
                    pa.array(class_of(h, first), pa.binary()),
                    pa.array([h[a : min(b, a + SKETCH)].astype(np.int64) for a, b in spans], pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "class", "sketch"],
            )

    return run


def _sets(words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for c in S.chunks([b]):
                h, first = shingle_sets(c, words)
                wanted = b.column("class").slice(at, len(c)).to_pylist()
                at += len(c)
                sets = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(h.astype(np.int64)))
                out = pa.RecordBatch.from_arrays([c.ids, sets, *map(pa.array, parity(h, first))], names=["doc_id", "shingles", *PARITY])
                yield out.filter(pa.array([x == y for x, y in zip(class_of(h, first), wanted, strict=True)], pa.bool_()))

    return run


def parity(h: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Bitmaps of ``64 * len(PARITY)`` bits: whether an odd number of a set's hashes falls on the bit."""
    bit, word = S.U64(1) << (h & S.U64(63)), (h >> S.U64(6)) % S.U64(len(PARITY))
    some = np.flatnonzero(np.diff(first))
    out = []
    for k in range(len(PARITY)):
        own = np.zeros(len(first) - 1, dtype=np.uint64)
        if len(some):
            own[some] = np.bitwise_xor.reduceat(np.where(word == k, bit, S.U64(0)), first[some])
        out.append(own.view(np.int64))
    return out


PARITY = [f"p{k}" for k in range(8)]
SETS = "doc_id long, shingles array<long>, " + ", ".join(f"{p} long" for p in PARITY)


def _lists(reps: DataFrame, percent: int) -> DataFrame:
    """(value, id, n): the inverted lists of the rarest retained values, lists of one left out."""
    t = shared_at_least(SKETCH, percent)
    values = reps.select("id", F.explode("sketch").alias("value"))
    shared = written(values.groupBy("value").agg(F.count("*").alias("held")).filter("held > 1"), "held")
    # a set smaller than a sketch is retained whole, a partner at most its size * 100 / percent
    missed = F.greatest(F.floor(F.col("n") * 100 / percent) - SKETCH, F.lit(0))
    need = F.when(F.col("n") < SKETCH, F.ceil(F.col("n") * percent / 100) - missed).otherwise(F.lit(t))
    need = F.greatest(need, F.least(F.ceil(F.col("k") * percent / 100), F.lit(t)))
    return (
        values.join(shared, "value")
        .groupBy("id")
        .agg(F.sort_array(F.collect_list(F.struct("held", "value"))).alias("rare"))
        .join(reps.select("id", "n", F.size("sketch").alias("k")), "id")
        # values that no other document retains are the rarest, and are in no list
        .withColumn("take", (F.col("k") - need + 1) - (F.col("k") - F.size("rare")))
        .filter("take > 0")
        .select("id", "n", F.explode(F.slice("rare", F.lit(1), F.col("take").cast("int"))).alias("r"))
        .select(F.col("r.value").alias("value"), "id", "n")
    )


def _alike(n: str, m: str, percent: int):
    """Sizes that allow the similarity."""
    return (F.col(n) * 100 >= F.col(m) * percent) & (F.col(m) * 100 >= F.col(n) * percent)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _star_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Every member of a list with its smallest document, in a long list also with two chosen by hash."""
    member = F.struct("id", "n")
    heads = lists.groupBy("value").agg(
        F.count("*").alias("size"),
        F.min(member).alias("h0"),
        *(F.min_by(member, F.xxhash64("id", F.lit(s))).alias(f"h{s}") for s in (1, 2)),
    ).filter("size > 1")
    heads = heads.select(
        "value", F.when(F.col("size") > LONG_LIST, F.array("h0", "h1", "h2")).otherwise(F.array("h0")).alias("heads")
    )
    return _ordered(
        lists.join(heads, "value")
        .select(F.col("id").alias("x"), "n", F.explode(F.array_distinct("heads")).alias("head"))
        .select("x", "n", F.col("head.id").alias("y"), F.col("head.n").alias("m"))
        .filter((F.col("x") != F.col("y")) & _alike("n", "m", percent))
    )


def _mixed(lists: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """The rows of lists that hold several components, with each list's largest one and the members' bitmaps."""
    held = lists.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "component", F.coalesce("component", "id")
    )
    parts = held.groupBy("value", "component").agg(F.count("*").alias("part"))
    largest = parts.groupBy("value").agg(
        F.count("*").alias("parts"), F.max_by("component", F.struct("part", "component")).alias("largest")
    ).filter("parts > 1").drop("parts")
    bits = sets.select(F.col("doc_id").alias("id"), *PARITY)
    return written(held.join(largest, "value").join(bits, "id"), "mixed")


def _possible(percent: int):
    """Sizes and bitmaps that allow the similarity, for (n, p..) and (m, xp..).

    A shingle that one set of a pair alone has flips one bit of the other's
    parity bitmap, so the sets differ in at least as many shingles as their
    bitmaps differ in bits.
    """
    differ = reduce(add, (F.bit_count(F.col(p).bitwiseXOR(F.col(f"x{p}"))) for p in PARITY))
    return _alike("n", "m", percent) & (differ * (100 + percent) <= (F.col("n") + F.col("m")) * (100 - percent))


def _round_pairs(mixed: DataFrame, tested: DataFrame, percent: int) -> DataFrame:
    """Members outside a list's largest component with one member of it, another for every list."""
    heads = (
        mixed.filter("component = largest")
        .groupBy("value")
        .agg(F.min_by(F.struct("id", "n", *PARITY), F.xxhash64("id", "value")).alias("h"))
        .select("value", F.col("h.id").alias("x"), F.col("h.n").alias("m"), *(F.col(f"h.{p}").alias(f"x{p}") for p in PARITY))
    )
    pairs = mixed.filter("component != largest").join(heads, "value").filter(_possible(percent)).withColumnRenamed("id", "y")
    return _ordered(pairs).join(tested, ["a", "b"], "left_anti")


def _rest_pairs(mixed: DataFrame, tested: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of one list that lie in different components, can be similar and are not tested yet."""
    outside = mixed.filter("component != largest")
    apart = outside.groupBy("value").agg(F.count("*").alias("apart"))
    few = mixed.join(apart.filter(F.col("apart") <= FEW_APART).select("value"), "value", "left_semi")
    other = few.filter("component != largest").select("value", *_other())
    near = (
        few.join(other, "value")
        .filter((F.col("component") != F.col("xcomponent")) & _possible(percent))
        # a pair outside the largest component is met from both ends; one is enough
        .filter((F.col("component") == F.col("largest")) | (F.col("id") < F.col("x")))
    )
    pairs = near.select("x", F.col("id").alias("y"))
    crowded = apart.filter(F.col("apart") > FEW_APART).select("value")
    if crowded.take(1):
        met = _met_by_rarest(mixed.join(crowded, "value", "left_semi"), sets, percent)
        met = met.filter((F.col("component") != F.col("xcomponent")) & _possible(percent))
        pairs = pairs.union(met.select("x", F.col("id").alias("y")))
    return _ordered(pairs).join(tested, ["a", "b"], "left_anti")


def _other() -> list:
    """The columns of a pair's other member."""
    renamed = {"id": "x", "n": "m", "component": "xcomponent", **{p: f"x{p}" for p in PARITY}}
    return [F.col(c).alias(d) for c, d in renamed.items()]


def _met_by_rarest(many: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of members, one outside its list's largest component, that share one of their rarest shingles."""
    of_member = ["n", "component", *PARITY]
    # a member is compared once, however many lists hold it
    members = written(
        many.groupBy("id").agg(*(F.first(c).alias(c) for c in of_member), F.max(F.col("component") != F.col("largest")).alias("apart")),
        "members",
    )
    own = written(members.select("id").join(sets.select(F.col("doc_id").alias("id"), "shingles"), "id"), "shingles")
    shingles = own.select(F.explode("shingles").alias("shingle"))
    common = written(shingles.groupBy("shingle").agg(F.count("*").alias("held")).filter("held > 1"), "held")
    # the commonest, fewer than HOT_SHARE, are the last of every set and stay in it; only the others are joined with their counts
    is_hot = F.col("held") * HOT_SHARE > (common.agg(F.sum("held")).first()[0] or 0)
    hot = common.filter(is_hot).agg(F.sort_array(F.collect_list(F.struct("held", "shingle"))).alias("hot")).select(F.col("hot.shingle").alias("hot"))
    own = own.crossJoin(F.broadcast(hot)).select(
        "id", F.array_intersect("hot", "shingles").alias("hot"), F.array_except("shingles", "hot").alias("shingles")
    )
    cold = (
        own.select("id", F.explode("shingles").alias("shingle"))
        .join(common.filter(~is_hot), "shingle")
        .groupBy("id")
        .agg(F.sort_array(F.collect_list(F.struct("held", "shingle"))).alias("cold"))
    )
    rarest = (
        own.select("id", "hot")
        .join(cold, "id", "left")
        .join(members, "id")
        .withColumn("rare", F.concat(F.coalesce(F.col("cold.shingle"), F.array().cast("array<bigint>")), "hot"))
        # shingles that no other member holds are the rarest, and meet nothing
        .withColumn("take", F.size("rare") - F.ceil(F.col("n") * percent / 100) + 1)
        .filter("take > 0")
        .withColumn("shingle", F.explode(F.slice("rare", F.lit(1), F.col("take").cast("int"))))
    )
    rarest = written(rarest.select("shingle", "id", *of_member, "apart"), "rarest")
    other = rarest.filter("apart").select("shingle", *_other())
    # pairs of two members apart are met from both ends; one is enough
    return rarest.join(other, "shingle").filter((F.col("id") != F.col("x")) & (~F.col("apart") | (F.col("id") < F.col("x"))))


def _estimated(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs whose union sketch allows the similarity."""
    t = shared_at_least(SKETCH, percent)
    side = lambda c: reps.select(F.col("id").alias(c), F.col("sketch").alias(f"s{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, SKETCH)
    found = F.size(F.array_intersect(F.array_intersect("sa", "sb"), union))
    return both.filter(found * SKETCH >= F.size(union) * t).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full shingle sets reach the similarity."""
    side = lambda c: sets.select(F.col("doc_id").alias(c), F.col("shingles").alias(f"s{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.filter(common * 100 >= (F.size("sa") + F.size("sb") - common) * percent).select("a", "b")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept (it is its own component's)."""
    docs = text_columns(docs)
    sketches = written(
        docs.mapInArrow(_sketches(words), "doc_id long, n_shingles long, class binary, sketch array<long>"), "sketches"
    )
    some = sketches.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = written(some.groupBy("class").agg(F.min("doc_id").alias("id")), "classes")
    reps = written(
        some.join(classes.select("id"), some["doc_id"] == classes["id"], "left_semi")
        .groupBy(F.col("doc_id").alias("id"))
        .agg(F.min(F.struct("class", F.col("n_shingles").alias("n"), "sketch")).alias("least"))
        .select("id", "least.*"),
        "representatives",
    )
    lists = written(_lists(reps, percent), "lists")

    listed = lists.select("id").distinct().join(reps.select("id", "class"), "id").withColumnRenamed("id", "doc_id")
    sets = written(
        docs.join(listed, "doc_id").mapInArrow(_sets(words), SETS).dropDuplicates(["doc_id"]),
        "sets",
    )
    star = written(_star_pairs(lists, percent), "pairs")
    links = written(_verified(_estimated(star, reps, percent), sets, percent), "found")
    labels = components(links)
    tested = star
    for pairs_of in (_round_pairs, partial(_rest_pairs, sets=sets)):
        mixed = _mixed(lists, labels, sets)
        if not mixed.take(1):  # every pair of a list is joined already
            break
        pairs = written(pairs_of(mixed, tested, percent=percent), "pairs")
        tested = tested.union(pairs)
        found = written(_verified(_estimated(pairs, reps, percent), sets, percent), "found")
        if found.take(1):
            links = links.union(found)
            labels = components(links)

    linked = some.join(classes, "class").join(labels.withColumnRenamed("node", "id"), "id", "left")
    alone = sketches.filter("n_shingles = 0 OR doc_id IS NULL")
    return (
        linked.select("doc_id", "n_shingles", F.coalesce("component", "id").alias("component_id"))
        .union(alone.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
