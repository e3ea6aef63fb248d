"""Rule R3 (operations of one card in different cities within an hour) without
a self-join.

The source joins every operation ``a`` of a card to every later operation
``b`` of the card (``a.ts < b.ts``, ``b.ts - a.ts < W``, different cities).
That is quadratic in a card's operations and Spark can hash only the card,
so one busy card would land in one task.  Here ``b`` is flagged iff some
operation in ``(b.ts - W, b.ts)`` has a non-NULL city other than ``b``'s, and
the time axis is cut into sub-bins of width ``w = W / k``:

* P1 - same sub-bin, strictly earlier: a running (prefix) window frame
  ``RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING`` per (card, sub-bin),
  min/max city.  Prefix frames are evaluated incrementally, O(n).
* P2 - the k-1 sub-bins before, wholly inside the window: per (card, sub-bin)
  min/max city, then a sliding frame over those *summary* rows, partitioned
  by (card, block of k sub-bins) with the previous block as halo: at most 2k
  rows per window partition, however many operations the card has.
* P3 - sub-bin ``s-k``, partly inside the window: per (card, sub-bin) the city
  with the latest operation and the latest time of any other city; ``b`` is
  flagged if the latest operation of a city other than its own is after
  ``b.ts - W``.

Every shuffle is keyed by (card, sub-bin) or (card, block), so a card with a
third of all operations is spread over as many tasks as it has busy sub-bins,
and no pair of operations is ever materialised.  Copies (same card, instant
and city) are collapsed map-side first and the verdicts joined back to the
operations, so a pile of copies never lands in one task either.

Running the same on negated time flags the *earlier* operation of a pair,
which the source's literal rule reports (its ``MAX(a.trans_date)``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch import schemas as S
from cardwatch.functions import epoch_us, from_epoch_us, is_true, window_us
from cardwatch.operators.joins import valid_at


def city_ops(tx: DataFrame, terminals: DataFrame, asof: bool = False) -> DataFrame:
    """(trans_id, card_num, trans_date, city): operations with their terminal city.

    ``asof=False`` joins every version of the terminal (as the source does, so
    a terminal that moved contributes both cities); ``asof=True`` takes the
    version valid at the operation time.
    """
    t = terminals.select(
        F.col("terminal_id").alias("_tid"), F.col("terminal_city").alias("city"),
        "effective_from", "effective_to", "deleted_flg",
    )
    cond = F.col("terminal") == F.col("_tid")
    if asof:
        cond = cond & valid_at(F.col("trans_date"))
    return tx.join(t, cond, "inner").select("trans_id", "card_num", "trans_date", "city")


def floor_div(name: str, d: int) -> Column:
    """Exact floor division of a long column (``div`` truncates toward zero,
    so subtract the positive remainder first; negated times stay exact)."""
    return F.expr(f"({name} - pmod({name}, {int(d)})) div {int(d)}")


def velocity_flags(ops: DataFrame, window: _dt.timedelta = S.CITY_WINDOW, sub_bins: int = 60,
                   reverse: bool = False, points_only: bool = False) -> DataFrame:
    """Rows of ``ops`` (trans_id, card_num, trans_date) that have an operation of
    the same card in another city strictly before them and less than
    ``window`` earlier (``reverse=True``: strictly after, less than ``window`` later).

    May repeat a ``trans_id`` (one row per terminal version); callers distinct.
    ``points_only=True`` returns the flagged (card_num, _t, city) points
    instead (``_t`` negated when ``reverse``), without the join back to ids.
    """
    big_w = window_us(window)
    if big_w <= 0 or big_w % sub_bins:
        raise ValueError("window must be a positive multiple of sub_bins microseconds")
    w = big_w // sub_bins
    k = sub_bins

    t = epoch_us("trans_date")
    rows_in = (
        ops.filter(F.col("city").isNotNull() & F.col("card_num").isNotNull() & F.col("trans_date").isNotNull())
        .select("trans_id", "card_num", "trans_date", "city", (-t if reverse else t).alias("_t"))
    )
    # Copies (same card, instant and city) decide the same way, so the rule runs
    # on distinct points; the partial aggregation collapses copies map-side,
    # before any shuffle, and a pile of copies never reaches one task.
    base = (
        rows_in.select("card_num", "_t", "city").distinct()
        .withColumn("_s", floor_div("_t", w))
        .repartition("card_num", "_s")
    )

    # Earlier operations in the same sub-bin
    prefix = Window.partitionBy("card_num", "_s").orderBy("_t").rangeBetween(Window.unboundedPreceding, -1)
    rows = base.withColumn("_p1min", F.min("city").over(prefix)).withColumn("_p1max", F.max("city").over(prefix))

    # per (card, sub-bin, city) latest time -> per (card, sub-bin) summary
    g = base.groupBy("card_num", "_s", "city").agg(F.max("_t").alias("_lt"))
    g = g.withColumn(
        "_rn", F.row_number().over(Window.partitionBy("card_num", "_s").orderBy(F.desc("_lt"), F.desc("city")))
    )
    summary = g.groupBy("card_num", "_s").agg(
        F.min("city").alias("_mn"),
        F.max("city").alias("_mx"),
        F.max(F.when(F.col("_rn") == 1, F.col("city"))).alias("_c1"),
        F.max(F.when(F.col("_rn") == 1, F.col("_lt"))).alias("_t1"),
        F.max(F.when(F.col("_rn") == 2, F.col("_lt"))).alias("_t2"),
    )

    hit = F.lit(False)
    for c in ("_p1min", "_p1max"):
        hit = hit | is_true(F.col(c) != F.col("city"))

    if k > 1:
        # The k-1 whole sub-bins before.  Summary rows are grouped in blocks
        # of k sub-bins and each block also receives the previous block (halo),
        # which holds every sub-bin the frame of its own rows can reach: a
        # window partition holds at most 2k summary rows, however long the
        # card's history.
        shift = F.explode(F.array(F.lit(0), F.lit(1))).alias("_halo")
        blocks = summary.select("*", shift).withColumn("_blk", floor_div("_s", k) + F.col("_halo"))
        slide = Window.partitionBy("card_num", "_blk").orderBy("_s").rangeBetween(-(k - 1), -1)
        p2 = blocks.select(
            "card_num", "_s", "_halo",
            F.min("_mn").over(slide).alias("_p2min"), F.max("_mx").over(slide).alias("_p2max"),
        ).filter(F.col("_halo") == 0).drop("_halo")
        rows = rows.join(p2, ["card_num", "_s"], "left")
        for c in ("_p2min", "_p2max"):
            hit = hit | is_true(F.col(c) != F.col("city"))

    # Sub-bin s-k, the part after t - W (summary shifted forward by k sub-bins)
    p3 = summary.select("card_num", (F.col("_s") + k).alias("_s"), "_c1", "_t1", "_t2")
    rows = rows.join(p3, ["card_num", "_s"], "left")
    latest_other = F.when(F.col("_c1") != F.col("city"), F.col("_t1")).otherwise(F.col("_t2"))
    hit = hit | is_true(latest_other > F.col("_t") - F.lit(big_w))

    flagged = rows.filter(hit).select("card_num", "_t", "city")
    if points_only:
        return flagged
    return rows_in.join(flagged, ["card_num", "_t", "city"], "left_semi").select("trans_id", "card_num", "trans_date")


def velocity_ids(ops: DataFrame, window: _dt.timedelta = S.CITY_WINDOW, sub_bins: int = 60) -> DataFrame:
    """R3 per card: ids of operations preceded, within the window, by an
    operation of the same card in another city (the later one of the pair)."""
    return velocity_flags(ops, window, sub_bins).select("trans_id").distinct()


def velocity_anchor(ops: DataFrame, window: _dt.timedelta = S.CITY_WINDOW, sub_bins: int = 60) -> DataFrame:
    """R3 literal: one row, the latest *earlier* operation of any such pair
    (``MAX(a.trans_date)`` over the whole fact; NULL when there is none)."""
    points = velocity_flags(ops, window, sub_bins, reverse=True, points_only=True)
    return points.agg(from_epoch_us(-F.min("_t")).alias("anchor_dt"))
