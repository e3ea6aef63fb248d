"""Filter interaction audit by the Hart-Mas-Colell potential of removal games.

Five filters judge every whole text; a set of filters S, applied in any order,
removes the documents that fail one of S.  ``v(S)``, the number removed, is the
removal game.  Its 32 values per part follow from the counts of documents by the
set of filters they fail, so one aggregate over the documents is all that reads
them; the rest works on 32 numbers a part.

The potential is built recursively over the coalitions:
``P({}) = 0``, ``|S| P(S) = v(S) + sum of P(S without i)``.  The Shapley value of a
filter is ``P(all) - P(all without it)``.  Times 120 every potential is a whole
number, and 120 times the Shapley value is the filter's removals summed over the
120 orders.  Removed at a step is ``v(before + f) - v(before)``; the same
differences in the games of good and of toxic documents give their losses.

Filters (words are maximal runs of ``[^\\x20\\x09-\\x0D]``; a null text is empty):

* A: under 200 words;
* B: 100 * distinct words < 50 * words;
* C: 100 * ``[A-Z]`` characters > 2 * code points;
* D: holds any ``[#$%&*|]``;
* E: identical to the text of a smaller doc_id, removed or not, in the whole table.

E compares digests: the smallest doc_id of a text is an aggregate with map-side
combine, and a row asks for (digest, own doc_id), so that no group of copies
meets in one task.  A row with a null doc_id is no later copy of anything and
has no labels.  Rows that repeat a doc_id count each; those of the smallest
doc_id of a text all pass E.  Labels that repeat a doc_id: one 1 is enough.  A
null source and an empty one are the part "".  A text without words fails A only
(and D never).  An empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.spark_io import written

FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
ORDERS = 120
WORD = r"[^\x20\x09-\x0D]+"
GAMES = ("n", "good", "toxic")


def failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask, digest): which of the filters A to D each row fails (bits 0 to 3)."""
    text = docs.select(
        docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["source"].cast("string"), F.lit("")).alias("part"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("t"),
    ).withColumn("words", F.regexp_extract_all("t", F.lit(WORD), F.lit(0)))
    n_words, capitals = F.size("words"), F.length("t") - F.length(F.translate("t", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    fails = [
        n_words < 200,
        F.size(F.array_distinct("words")).cast("long") * 100 < n_words.cast("long") * 50,
        capitals.cast("long") * 100 > F.length("t").cast("long") * 2,
        F.col("t").rlike(r"[#$%&*|]"),
    ]
    mask = sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(fails)), F.lit(0))
    # rows without a doc_id are compared with nothing: without a digest they fall together
    digest = F.when(F.col("doc_id").isNotNull(), F.unhex(F.sha2("t", 256)))
    return text.select("doc_id", "part", mask.cast("int").alias("mask"), digest.alias("digest"))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by the set of the five filters they fail."""
    rows = written(failures(docs).groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("n")), "failures")
    firsts = rows.filter("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    marks = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    with_id = rows.filter("doc_id IS NOT NULL").join(firsts, ["doc_id", "digest"], "left").join(marks, "doc_id", "left")
    judged = with_id.select(
        "part", (F.col("mask") + F.when(F.col("first"), 0).otherwise(16)).alias("mask"), "n",
        (F.coalesce("good", F.lit(0)) * F.col("n")).alias("good"), (F.coalesce("toxic", F.lit(0)) * F.col("n")).alias("toxic"),
    )
    without = rows.filter("doc_id IS NULL").select("part", "mask", "n", F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("toxic"))
    return judged.unionByName(without).groupBy("part", "mask").agg(*(F.sum(g).cast("long").alias(g) for g in GAMES))


def games(cells: DataFrame) -> DataFrame:
    """Per part the number of documents and, for each game, its 32 values by coalition (bit k: filter k)."""
    def value(game: str, s: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("mask").bitwiseAND(s) != 0, F.col(game))), F.lit(0)).cast("long")

    return cells.groupBy("part").agg(
        F.sum("n").cast("long").alias("documents"), *(F.array(*(value(g, s) for s in range(ALL + 1))).alias(f"v_{g}") for g in GAMES)
    )


def potentials(games: DataFrame) -> DataFrame:
    """With column ``potential``: 120 times the Hart-Mas-Colell potential of the removal game, by coalition."""
    out = games.withColumn("p_0", F.lit(0).cast("long"))
    for size in range(1, len(FILTERS) + 1):  # a level at a time: every smaller coalition is a column already
        level = {}
        for s in range(1, ALL + 1):
            if s.bit_count() == size:
                below = " + ".join(f"p_{s & ~(1 << k)}" for k in range(len(FILTERS)) if s >> k & 1)
                level[f"p_{s}"] = F.expr(f"(v_n[{s}] * {ORDERS} + {below}) div {size}")
        out = out.withColumns(level)
    names = [f"p_{s}" for s in range(ALL + 1)]
    return out.withColumn("potential", F.array(*names)).drop(*names)


def orders() -> list[tuple[str, int, int, int]]:
    """(filter_order, step, number of the step's filter, coalition applied before) of all steps of all orders."""
    out = []
    for order in permutations(range(len(FILTERS))):
        name, before = "".join(FILTERS[k] for k in order), 0
        for step, k in enumerate(order, 1):
            out.append((name, step, k, before))
            before |= 1 << k
    return out


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters, and step."""
    steps = ", ".join(f"struct('{o}', {s}, {k}, {b})" for o, s, k, b in orders())
    parts = potentials(games(cells(docs, labels)))
    step = F.expr(f"inline(array({steps}))").alias("filter_order", "step", "k", "before")
    rows = parts.select("*", step)
    bit = F.call_function("shiftleft", F.lit(1), F.col("k"))
    after = F.col("before").bitwiseOR(bit)

    def of(name: str, coalition: Column) -> Column:
        return F.element_at(name, coalition + 1)

    gain = {g: of(f"v_{g}", after) - of(f"v_{g}", F.col("before")) for g in GAMES}
    return rows.select(
        "part", "filter_order", "step",
        (F.col("documents") - of("v_n", after)).alias("kept"),
        gain["n"].alias("removed"),
        (of("v_n", bit) - gain["n"]).alias("redundant"),
        (of("v_n", F.lit(ALL)) - of("v_n", F.lit(ALL).bitwiseXOR(bit))).alias("unique_fails"),
        gain["good"].alias("good_lost"),
        gain["toxic"].alias("toxic_lost"),
        (of("potential", F.lit(ALL)) - of("potential", F.lit(ALL).bitwiseXOR(bit))).alias("shapley"),
    )
