"""Deletes found by digests of key groups: equal to the anti join, and what is compared follows the changes."""

import datetime as dt
import random

import pytest

from cardwatch import schemas as S
from cardwatch.operators.digests import differing_groups, key_digests, merged, missing_keys_by_digest, negated, scd2_delete_by_digest
from cardwatch.operators.joins import missing_keys
from cardwatch.operators.scd2 import CLIENTS, scd2_delete
from tests.test_plans import plan

LOAD = dt.datetime(2024, 3, 1)


def history(spark, keys, closed=()):
    """One open live version a key, some closed ones, one tombstone, one NULL key."""
    row = {f.name: None for f in S.DIM_CLIENTS_HIST.fields}
    start = dt.datetime(2023, 1, 1)
    rows = [row | {"client_id": k, "effective_from": start, "effective_to": S.OPEN_END, "deleted_flg": "N"} for k in keys]
    rows += [row | {"client_id": k, "effective_from": start, "effective_to": LOAD, "deleted_flg": "N"} for k in closed]
    rows.append(row | {"client_id": "gone", "effective_from": start, "effective_to": S.OPEN_END, "deleted_flg": "Y"})
    rows.append(row | {"client_id": None, "effective_from": start, "effective_to": S.OPEN_END, "deleted_flg": "N"})
    return spark.createDataFrame([tuple(r.values()) for r in rows], S.DIM_CLIENTS_HIST)


def source(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "client_id string")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


CASES = {
    "one gone": (range(300), [k for k in range(300) if k != 7]),
    "gone and new": (range(300), range(5, 310)),
    "none gone": (range(300), range(300)),
    "all gone": (range(40), []),
    "no history": ([], range(40)),
    "repeats": (range(300), [*range(1, 300), *[3] * 200, None, None]),
    "another key in its place": (range(50), [*range(49), 999]),
}


@pytest.mark.parametrize("groups", [1, 16, 1 << 16])
@pytest.mark.parametrize("case", sorted(CASES))
def test_equal_to_the_anti_join(spark, case, groups):
    name = lambda k: None if k is None else f"C{k}"
    old, new = ([name(k) for k in side] for side in CASES[case])
    hist, keys = history(spark, old, closed=old[:5]), source(spark, new)
    assert rows(missing_keys_by_digest(hist, keys, "client_id", groups)) == rows(missing_keys(hist, keys, "client_id").select(*hist.columns))
    if groups == 16:
        for corrected in (False, True):
            got = scd2_delete_by_digest(hist, keys, LOAD, CLIENTS, corrected, groups)
            assert rows(got.select(*hist.columns)) == rows(scd2_delete(hist, keys, LOAD, CLIENTS, corrected).select(*hist.columns))


def test_only_groups_that_differ_are_compared(spark):
    """20,000 keys, 10 gone, 10 new, 1,000 groups: at most 20 groups, and stored digests follow the load."""
    rnd = random.Random(1)
    old = [f"C{k}" for k in range(20000)]
    gone = set(rnd.sample(old, 10))
    new = [k for k in old if k not in gone] + [f"N{k}" for k in range(10)]
    a, b = source(spark, old), source(spark, new)
    da, db = key_digests(a, "client_id", 1000), key_digests(b, "client_id", 1000)
    assert 10 <= differing_groups(da, db).count() <= 20
    assert differing_groups(da, da).count() == 0
    came, went = source(spark, [f"N{k}" for k in range(10)]), source(spark, sorted(gone))
    stored = merged(da, key_digests(came, "client_id", 1000), negated(key_digests(went, "client_id", 1000)))
    assert differing_groups(stored, db).count() == 0
    hist = history(spark, old)
    got = missing_keys_by_digest(hist, b, "client_id", 1000, digests=da)
    assert {r.client_id for r in got.collect()} == gone | {None}


def test_unchanged_keys_are_not_shuffled(spark, tmp_path):
    """With stored digests the history meets the groups that differ by a broadcast, before any exchange by key."""
    history(spark, [f"C{k}" for k in range(500)]).write.parquet(str(tmp_path / "h"))
    source(spark, [f"C{k}" for k in range(499)]).write.parquet(str(tmp_path / "k"))
    h, k = spark.read.parquet(str(tmp_path / "h")), spark.read.parquet(str(tmp_path / "k"))
    txt = plan(missing_keys_by_digest(h, k, "client_id", digests=key_digests(h, "client_id")))
    tree = txt.split("\n\n\n")[0]
    assert tree.count("BroadcastHashJoin") >= 2 and "CartesianProduct" not in tree and "NestedLoop" not in tree, tree


def test_number_of_groups_is_bounded(spark):
    with pytest.raises(ValueError, match="groups"):
        key_digests(source(spark, ["a"]), "client_id", (1 << 20) + 1)
