"""Rule R4 (guessing an amount by falling tries) without a triple self-join.

A SUCCESS operation ``c`` completes the pattern when there are REJECTs ``a``
and ``b`` of the same card with ``a.ts < b.ts < c.ts``,
``a.amt > b.amt > c.amt`` and ``c.ts - a.ts < W`` (they need not be adjacent).
Two quantities decide it, both "maximum over strictly earlier rows with a
larger amount":

* ``A(b)`` = latest REJECT ``a`` before ``b`` with ``a.amt > b.amt``;
* ``M(c)`` = max ``A(b)`` over REJECTs ``b`` before ``c`` with ``b.amt > c.amt``.

``c`` is flagged iff ``M(c) > c.ts - W``, and ``M(c)`` is then the latest
``a`` of any of its triples (the source's literal rule reports the maximum of
those).  One sweep in time order with two prefix-max Fenwick trees over the
amount ranks computes both, so no pair or triple is ever built.

Spark does the distribution: rows are keyed by (card, time bin of width W);
bin ``f`` also receives the REJECTs of bin ``f-1`` (a halo), which holds every
``a`` and ``b`` any ``c`` in bin ``f`` can use.  A busy card is thereby split
into one group per bin, each holding at most two windows of that card.  One
exchange deals the rows by (card, bin); groups without two REJECTs and an own
SUCCESS are dropped behind it by a window count, and the sweep is a
``mapInArrow`` helper that streams the sorted rows and holds one group at a time.
Copies (same card, instant, amount and result) are collapsed map-side before
any shuffle and the verdicts joined back to the operations, so a pile of
copies never lands in one task either.

A bin with more than ``SPLIT_OVER`` points and more than one ``HOT_SHARE``-th of
all points does not go to one task (``_dominance``).  Its points are cut into
blocks by time and into blocks by amount, at quantiles; a value that is a
quantile is a block of its own.  The points ``p`` before and above a query ``q`` then lie

* in an earlier time block and a higher amount block: the best value of every
  pair of blocks, a table of bounded size, answers by prefix maxima;
* in the time block of ``q``, or in its amount block: each block is one group of
  the same sweep, with a small share of the bin's points.  In a block of one
  instant or one amount nothing is before or above, so it needs no group.

``A`` of all REJECTs is found in this way first, then ``M`` of the SUCCESSes.
There are at most ``HOT_SHARE`` such bins, which bounds the list of their keys; it is read
before the plan is built, so that a plan without such bins has one pass only.
"""

from __future__ import annotations

import datetime as _dt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardwatch import schemas as S
from cardwatch.functions import epoch_us, from_epoch_us, window_us
from cardwatch.session import ship_package
from cardwatch.operators.velocity import floor_div

_OUT = pa.schema([("card_num", pa.string()), ("c_us", pa.int64()), ("c_cents", pa.int64()), ("m_us", pa.int64())])
_OUT_SCHEMA = "card_num string, c_us long, c_cents long, m_us long"
_NONE = np.iinfo(np.int64).min
_GROUP = ["card_num", "_bin"]
_COLS = ("card_num", "_bin", "_t", "_cents", "_rej", "_halo")
SPLIT_OVER = 20_000
HOT_SHARE = 10_000
#: Quantiles that cut a hot bin, in time and in amount.
BLOCKS = 64


def _sweep_group(t, amt, rej, query_c, window):
    """M(c) for the rows of one (card, bin) group, sorted by time."""
    uniq = np.unique(amt)
    size = len(uniq)
    # position 1 is the largest amount: "amount greater than x" is the prefix 1 .. pos(x) - 1
    pos = (size - np.searchsorted(uniq, amt)).tolist()
    fen_a = [_NONE] * (size + 1)   # max REJECT time per amount position
    fen_m = [_NONE] * (size + 1)   # max A(b) per amount position
    a_of = [_NONE] * len(t)
    m_of = [_NONE] * len(t)
    tl = t.tolist()
    rl = rej.tolist()
    ql = query_c.tolist()
    n = len(tl)
    i = 0
    while i < n:
        j = i
        while j < n and tl[j] == tl[i]:
            j += 1
        # answer the whole equal-time run first: only strictly earlier rows count
        for r in range(i, j):
            if not (rl[r] or ql[r]):
                continue
            q = pos[r] - 1
            best = _NONE
            fen = fen_a if rl[r] else fen_m
            while q > 0:
                if fen[q] > best:
                    best = fen[q]
                q -= q & -q
            if rl[r]:
                a_of[r] = best
            else:
                m_of[r] = best
        for r in range(i, j):
            if rl[r]:
                p, v = pos[r], tl[r]
                while p <= size:
                    if fen_a[p] < v:
                        fen_a[p] = v
                    p += p & -p
                v = a_of[r]
                if v != _NONE:
                    p = pos[r]
                    while p <= size:
                        if fen_m[p] < v:
                            fen_m[p] = v
                        p += p & -p
        i = j
    m = np.asarray(m_of, dtype=np.int64)
    return query_c & (m != _NONE) & (m > t - window), m


def _groups_of(batches, keys, columns):
    """The groups of a partition sorted by ``keys``, each as a dict of arrays; one group is held at a time.

    The open group is a list of slices, joined once when its end is seen; only
    a new batch is searched for group ends, so the work is linear in the rows."""
    held: list = []
    for b in batches:
        cols = {c: b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in columns}
        n = b.num_rows
        if not n:
            continue
        new = np.zeros(n, dtype=bool)
        for k in keys:
            new[1:] |= cols[k][1:] != cols[k][:-1]
            new[0] |= bool(held) and held[-1][k][-1] != cols[k][0]
        at = np.flatnonzero(new)
        for lo, hi in zip(np.concatenate(([0], at)), at):
            held += [{c: v[lo:hi] for c, v in cols.items()}] if hi > lo else []
            yield _joined(held)
            held = []
        last = at[-1] if len(at) else 0
        held.append({c: v[last:] for c, v in cols.items()})
    if held:
        yield _joined(held)


def _joined(parts: list) -> dict:
    return parts[0] if len(parts) == 1 else {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}


def _in_batches(found, schema: pa.Schema, rows: int = 10_000):
    """Lists of column values gathered into batches."""
    held, n = [[] for _ in schema], 0
    for columns in found:
        for h, c in zip(held, columns):
            h.append(c)
        n += len(columns[0])
        if n >= rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(h), f.type) for h, f in zip(held, schema)], schema=schema)
            held, n = [[] for _ in schema], 0
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(h), f.type) for h, f in zip(held, schema)], schema=schema)


def _sweep(window: int):
    """Streams a partition sorted by (card, bin, time)."""

    def hits(batches):
        for g in _groups_of(batches, _GROUP, _COLS):
            hit, m = _sweep_group(g["_t"], g["_cents"], g["_rej"], ~g["_rej"] & ~g["_halo"], window)
            if hit.any():
                yield g["card_num"][hit], g["_t"][hit], g["_cents"][hit], m[hit]

    return lambda batches: _in_batches(hits(batches), _OUT)


def _points(tx: DataFrame, big_w: int) -> tuple[DataFrame, DataFrame]:
    """(rows, points): the usable rows, and their distinct (card, time, amount,
    result) points.  Copies decide the same way (a repeated REJECT adds
    nothing to a max-tree, repeated SUCCESS rows get the same answer), so the
    sweep runs on points; ``distinct`` aggregates map-side, before any shuffle,
    so a pile of copies never reaches one task."""
    scale = getattr(tx.schema["amt"].dataType, "scale", 2)
    rows = (
        tx.filter(
            F.col("oper_result").isin(S.RESULT_REJECT, S.RESULT_SUCCESS)
            & F.col("amt").isNotNull() & F.col("trans_date").isNotNull() & F.col("card_num").isNotNull()
        )
        .select(
            "trans_id", "card_num",
            epoch_us("trans_date").alias("_t"),
            (F.col("amt") * F.lit(10 ** scale)).cast("long").alias("_cents"),
            (F.col("oper_result") == S.RESULT_REJECT).alias("_rej"),
        )
    )
    points = rows.select("card_num", "_t", "_cents", "_rej").distinct().withColumn("_bin", floor_div("_t", big_w))
    return rows, points


def _sweep_points(rows: DataFrame, points: DataFrame, big_w: int) -> DataFrame:
    """(card_num, c_us, c_cents, m_us) of every SUCCESS point that completes a pattern."""
    spark = points.sparkSession
    ship_package(spark)
    # a REJECT is also emitted into the next bin as halo
    shift = F.explode(F.when(F.col("_rej"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    groups = (
        points.select("*", shift.alias("_shift"))
        .withColumn("_bin", F.col("_bin") + F.col("_shift"))
        .withColumn("_halo", F.col("_shift") == 1)
        .select(*_COLS)
    )
    hot = hot_bins(rows, big_w)
    if not hot:
        return _sweep_groups(groups, big_w)
    keys = F.broadcast(spark.createDataFrame(hot, "card_num string, _bin long"))
    cold = _sweep_groups(groups.join(keys, _GROUP, "left_anti"), big_w)
    return cold.unionByName(_split_groups(groups.join(keys, _GROUP), big_w))


def _sweep_groups(groups: DataFrame, big_w: int) -> DataFrame:
    # one exchange, sized by AQE from the measured shuffle output; the sweep uses the window's order
    whole = Window.partitionBy(*_GROUP).orderBy("_t").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    own, tries = F.count(F.when(~F.col("_rej") & ~F.col("_halo"), 1)), F.count(F.when(F.col("_rej"), 1))
    live = (
        groups.withColumns({"_own": own.over(whole), "_tries": tries.over(whole)})
        .filter("_own > 0 AND _tries > 1")  # a pattern takes two REJECTs and an own SUCCESS
        .select(*_COLS)
        .sortWithinPartitions(*_GROUP, "_t")
    )
    return live.mapInArrow(_sweep(big_w), _OUT_SCHEMA)


def hot_bins(rows: DataFrame, big_w: int) -> list[tuple[str, int]]:
    """(card, bin) of the bins that are too large for one task, and the bins their REJECTs reach as halo.

    One aggregate with map-side combine; at most 2 * HOT_SHARE keys reach the driver, usually none.
    """
    sizes = rows.groupBy("card_num", floor_div("_t", big_w).alias("_bin")).agg(F.count("*").alias("_n"))
    total = rows.agg(F.count("*")).scalar()
    large = sizes.filter(F.col("_n") > SPLIT_OVER).filter(F.col("_n") * HOT_SHARE > total).select("card_num", "_bin").collect()
    return sorted({(r["card_num"], r["_bin"] + k) for r in large for k in (0, 1)})


# --- one bin over many tasks -------------------------------------------------------------

_BEST_SCHEMA = "card_num string, _bin long, _t long, _cents long, _best long"
_BEST = pa.schema([("card_num", pa.string()), ("_bin", pa.int64()), ("_t", pa.int64()), ("_cents", pa.int64()), ("_best", pa.int64())])
_CELL_SCHEMA = "card_num string, _bin long, _tb int, _ab int, _best long"
_CELL = pa.schema([("card_num", pa.string()), ("_bin", pa.int64()), ("_tb", pa.int32()), ("_ab", pa.int32()), ("_best", pa.int64())])


def _block(value: str, cuts: str) -> Column:
    """Number of the block of a value: odd for a value that is a cut, even between two cuts; ascending."""
    return F.expr(f"size(filter({cuts}, x -> x < {value})) * 2 + int(array_contains({cuts}, {value}))")


def _with_blocks(rows: DataFrame) -> DataFrame:
    """Rows of hot bins with the numbers of their time and amount blocks."""
    share = [F.lit(k / BLOCKS) for k in range(1, BLOCKS)]
    cuts = rows.groupBy(*_GROUP).agg(*(
        F.array_sort(F.array_distinct(F.percentile_approx(c, F.array(*share), 10 * BLOCKS))).alias(f"{c}s") for c in ("_t", "_cents")
    ))
    return rows.join(F.broadcast(cuts), _GROUP).select(*_COLS, _block("_t", "_ts").alias("_tb"), _block("_cents", "_centss").alias("_ab"))


def _split_groups(rows: DataFrame, big_w: int) -> DataFrame:
    """What the sweep finds in the (hot) bins of ``rows``, without one group per bin."""
    rows = _with_blocks(rows)
    place = [*_GROUP, "_tb", "_ab", "_t", "_cents"]
    tries = rows.filter("_rej").select(*place)
    before = _dominance(tries.select(*place, F.col("_t").alias("_v"), F.lit(True).alias("_q")))
    second = tries.join(before, [*_GROUP, "_t", "_cents"]).select(*place, F.col("_best").alias("_v"), F.lit(False).alias("_q"))
    asked = rows.filter("NOT _rej AND NOT _halo").select(*place, F.lit(None).cast("long").alias("_v"), F.lit(True).alias("_q"))
    found = _dominance(second.unionByName(asked))
    return found.filter(F.col("_best") > F.col("_t") - big_w).select(
        "card_num", F.col("_t").alias("c_us"), F.col("_cents").alias("c_cents"), F.col("_best").alias("m_us"))


def _dominance(rows: DataFrame) -> DataFrame:
    """(card_num, _bin, _t, _cents, _best) of the queries (``_q``) that have an answer: the largest ``_v`` at a
    strictly earlier time and a strictly larger amount of the bin."""
    # earlier time block, higher amount block: a table of at most (2 BLOCKS)^2 cells a bin
    cells = rows.groupBy(*_GROUP, "_tb", "_ab").agg(F.coalesce(F.max("_v"), F.lit(int(_NONE))).alias("_v"))
    far = cells.repartition(*_GROUP).sortWithinPartitions(*_GROUP).mapInArrow(_prefix_maxima, _CELL_SCHEMA)
    far = rows.filter("_q").join(far, [*_GROUP, "_tb", "_ab"]).select(*_GROUP, "_t", "_cents", "_best")
    # same time block, same amount block: groups of their own
    near = (
        _by_block(rows)
        .select(*_GROUP, "side", "block", "_t", "_cents", F.coalesce("_v", F.lit(int(_NONE))).alias("_v"), "_q")
        .repartition(*_GROUP, "side", "block")
        .sortWithinPartitions(*_GROUP, "side", "block", "_t")
        .mapInArrow(_block_sweep, _BEST_SCHEMA)
    )
    return far.unionByName(near).groupBy(*_GROUP, "_t", "_cents").agg(F.max("_best").alias("_best"))


def _by_block(rows: DataFrame) -> DataFrame:
    """The rows once for their time block (side 0) and once for their amount block (side 1), where these have more than one value."""
    sides = F.array(F.struct(F.lit(0).alias("side"), F.col("_tb").alias("block")), F.struct(F.lit(1).alias("side"), F.col("_ab").alias("block")))
    return rows.select("*", F.inline(F.filter(sides, lambda x: x["block"] % 2 == 0)))


def _prefix_maxima(batches):
    """Per bin, the largest value over earlier time blocks and higher amount blocks, by cell."""

    def cells():
        for g in _groups_of(batches, _GROUP, ("card_num", "_bin", "_tb", "_ab", "_v")):
            tb, ab = g["_tb"].astype(np.int64), g["_ab"].astype(np.int64)
            grid = np.full((tb.max() + 2, ab.max() + 2), _NONE, dtype=np.int64)
            grid[tb + 1, ab] = g["_v"]
            grid = np.maximum.accumulate(grid, axis=0)
            grid = np.maximum.accumulate(grid[:, ::-1], axis=1)[:, ::-1]
            best = grid[tb, ab + 1]
            has = best != _NONE
            if has.any():
                yield g["card_num"][has], g["_bin"][has], tb[has], ab[has], best[has]

    return _in_batches(cells(), _CELL)


def _block_sweep(batches):
    """Per block, the best earlier and larger point of each query: one pass in time with a prefix-max Fenwick tree."""

    def answers():
        for g in _groups_of(batches, [*_GROUP, "side", "block"], (*_GROUP, "side", "block", "_t", "_cents", "_v", "_q")):
            best = _earlier_and_larger(g["_t"], g["_cents"], g["_v"], g["_q"])
            has = best != _NONE
            if has.any():
                yield g["card_num"][has], g["_bin"][has], g["_t"][has], g["_cents"][has], best[has]

    return _in_batches(answers(), _BEST)


def _earlier_and_larger(t, amt, v, q):
    """For the queries of a group sorted by time: the largest v at a strictly smaller t and a strictly larger amt."""
    uniq = np.unique(amt)
    size = len(uniq)
    pos = (size - np.searchsorted(uniq, amt)).tolist()
    tl, vl, ql = t.tolist(), v.tolist(), q.tolist()
    fen, out, none = [int(_NONE)] * (size + 1), [int(_NONE)] * len(tl), int(_NONE)
    i, n = 0, len(tl)
    while i < n:
        j = i
        while j < n and tl[j] == tl[i]:
            if ql[j]:
                k, best = pos[j] - 1, none
                while k > 0:
                    best = max(best, fen[k])
                    k -= k & -k
                out[j] = best
            j += 1
        for r in range(i, j):  # only now: points of one instant do not see each other
            k, value = pos[r], vl[r]
            while value != none and k <= size:
                fen[k] = max(fen[k], value)
                k += k & -k
        i = j
    return np.asarray(out, dtype=np.int64)


def probing_points(tx: DataFrame, window: _dt.timedelta = S.PROBE_WINDOW) -> DataFrame:
    """(card_num, c_us, c_cents, m_us): the SUCCESS points (card, instant,
    amount in cents) that complete a pattern; no join back to operation ids."""
    big_w = window_us(window)
    return _sweep_points(*_points(tx, big_w), big_w)


def probing_hits(tx: DataFrame, window: _dt.timedelta = S.PROBE_WINDOW) -> DataFrame:
    """(trans_id, card_num, c_us, m_us) for every SUCCESS operation that
    completes a falling REJECT, REJECT, SUCCESS pattern within ``window``."""
    big_w = window_us(window)
    rows, points = _points(tx, big_w)
    hits = _sweep_points(rows, points, big_w)
    success = rows.filter(~F.col("_rej")).select(
        "trans_id", "card_num", F.col("_t").alias("c_us"), F.col("_cents").alias("c_cents"))
    # each SUCCESS point is reported once, so the join back to its rows does not fan out
    return success.join(hits, ["card_num", "c_us", "c_cents"], "inner").select("trans_id", "card_num", "c_us", "m_us")


def probing_ids(tx: DataFrame, window: _dt.timedelta = S.PROBE_WINDOW) -> DataFrame:
    """R4 per card: ids of the SUCCESS operations that complete a pattern."""
    return probing_hits(tx, window).select("trans_id").distinct()


def probing_anchor(tx: DataFrame, window: _dt.timedelta = S.PROBE_WINDOW) -> DataFrame:
    """R4 literal: one row, the latest first try ``a`` of any pattern
    (``MAX(a.trans_date)`` over the whole fact; NULL when there is none).
    Needs no operation ids, so it is read off the points directly."""
    big_w = window_us(window)
    return _sweep_points(*_points(tx, big_w), big_w).agg(from_epoch_us(F.max("m_us")).alias("anchor_dt"))
