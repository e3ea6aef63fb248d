"""Keys gone from the source, found by digests of key groups.

Few keys go on a day, yet an anti join moves every key of both sides.  Here both
sides are first reduced to one digest per group of keys (keys are grouped by
hash): the number of keys, the sums of both halves of their hash and the xor of
a second one.  Tasks fold their rows before the shuffle, so at most ``groups``
rows a task move.  Only keys of groups whose digests differ go into the join.

* Equal digests of unequal key sets have a chance of about 2^-64 a group.
* A key that the source lists twice makes its group differ; the join then decides,
  so repeats cost time and change nothing.
* A NULL key is in no group; it is never "in" a key list, as in the anti join.

Digests add up (``merged``) and subtract (``negated``): a stored digest of the
history follows a load from the keys that came and went, without a scan.

The groups that differ are broadcast: at most ``groups`` numbers, and ``groups``
is at most ``MOST_GROUPS`` (8 MB).  A good number of groups is a thousandth of the
keys; with fewer, more unchanged keys are compared.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch.operators.scd2 import DimSpec, is_live_open, scd2_delete

GROUPS = 1 << 16
MOST_GROUPS = 1 << 20
_SUMS = ("keys", "low", "high")


def group_of(key: str | Column, groups: int = GROUPS) -> Column:
    """The group of a key; NULL for a NULL key."""
    if not 0 < groups <= MOST_GROUPS:
        raise ValueError(f"groups must be from 1 to {MOST_GROUPS}")
    c = F.col(key) if isinstance(key, str) else key
    return F.when(c.isNotNull(), F.pmod(F.xxhash64(c), F.lit(groups)))


def key_digests(df: DataFrame, key: str, groups: int = GROUPS) -> DataFrame:
    """(grp, keys, low, high, mixed): the digest of every group of keys that ``df`` holds."""
    h = F.xxhash64(key)
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(group_of(key, groups).alias("grp"))
        .agg(
            F.count("*").alias("keys"),
            F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"),
            F.sum(F.shiftrightunsigned(h, 32)).alias("high"),
            F.bit_xor(F.xxhash64(F.lit("second"), key)).alias("mixed"),
        )
    )


def negated(digests: DataFrame) -> DataFrame:
    """The digests that take these keys away."""
    return digests.select("grp", *[(-F.col(c)).alias(c) for c in _SUMS], "mixed")


def merged(*digests: DataFrame) -> DataFrame:
    """The digests of all these keys together."""
    rows = digests[0]
    for d in digests[1:]:
        rows = rows.unionByName(d)
    return rows.groupBy("grp").agg(*[F.sum(c).alias(c) for c in _SUMS], F.bit_xor("mixed").alias("mixed"))


def differing_groups(a: DataFrame, b: DataFrame) -> DataFrame:
    """(grp): groups whose keys are not the same on both sides."""
    some = F.lit(False)
    for c in (*_SUMS, "mixed"):
        some = some | (F.col(c) != 0)
    return merged(a, negated(b)).filter(some).select("grp")


def _split(hist: DataFrame, keys: DataFrame, key: str, groups: int, digests: DataFrame | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Open live rows that the join has to decide, all other rows of the history, and the source keys that it needs."""
    source = keys.select(F.col(keys.columns[0]).alias(key))
    own = key_digests(hist.filter(is_live_open()), key, groups) if digests is None else digests
    differ = F.broadcast(differing_groups(own, key_digests(source, key, groups)).withColumn("_differs", F.lit(True)))
    marked = hist.join(differ, group_of(key, groups) == differ["grp"], "left").drop("grp")
    asked = F.coalesce(is_live_open() & (F.col("_differs").isNotNull() | F.col(key).isNull()), F.lit(False))
    needed = source.join(differ, group_of(key, groups) == differ["grp"], "left_semi")
    return marked.filter(asked).drop("_differs"), marked.filter(~asked).drop("_differs"), needed


def missing_keys_by_digest(hist: DataFrame, keys: DataFrame, key: str, groups: int = GROUPS, digests: DataFrame | None = None) -> DataFrame:
    """J2 as :func:`joins.missing_keys`: open live versions whose key is gone from the source.

    ``digests``: those of the history's open live keys, where they are stored.
    """
    asked, _, needed = _split(hist.filter(is_live_open()), keys, key, groups, digests)
    return asked.join(needed.distinct(), key, "left_anti")


def scd2_delete_by_digest(hist: DataFrame, keys: DataFrame, load_dt: _dt.datetime, spec: DimSpec, corrected: bool = False,
                          groups: int = GROUPS, digests: DataFrame | None = None) -> DataFrame:
    """C5 / C5c as :func:`scd2.scd2_delete`; rows of groups that agree pass through without a shuffle."""
    asked, rest, needed = _split(hist, keys, spec.key, groups, digests)
    return rest.unionByName(scd2_delete(asked, needed, load_dt, spec, corrected=corrected))
