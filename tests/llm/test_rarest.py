"""Members that meet by their rarest shingles: the commonest shingles stay in the sets and are not joined with their counts."""

import collections
import random

import pytest

from cardwatch.llm import neardup as N


@pytest.mark.parametrize("share", [1, 8, 2000])
def test_members_meet_by_their_rarest_shingles(spark, monkeypatch, share):
    monkeypatch.setattr(N, "HOT_SHARE", share, raising=False)
    rnd, percent = random.Random(share), 80
    passage = list(range(1000, 1030))
    sets = {i: sorted({*passage[: rnd.randint(20, 30)], *rnd.sample(range(40), 5), 2000 + i}) for i in range(60)}
    many = spark.createDataFrame(
        [(7, i, len(s), i if i % 4 else 0, 0, *[0] * len(N.PARITY)) for i, s in sets.items()],
        "value long, id long, n long, component long, largest long, " + ", ".join(f"{p} long" for p in N.PARITY),
    )
    rows = {}
    plain = N.written

    def spied(df, name):
        got = plain(df, name)
        rows[name] = got.count()
        return got

    monkeypatch.setattr(N, "written", spied)
    got = N._met_by_rarest(many, spark.createDataFrame(list(sets.items()), "doc_id long, shingles array<long>"), percent)
    got = sorted((r.id, r.x, r.shingle) for r in got.collect())

    held = collections.Counter(x for s in sets.values() for x in s)
    prefix = {}
    for i, s in sets.items():
        rare = sorted((held[x], x) for x in s if held[x] > 1)
        prefix[i] = {x for _, x in rare[: max(0, len(rare) - -(-len(s) * percent // 100) + 1)]}
    want = [(i, x, k) for i in sets for x in sets if x % 4 > 0 and i != x and (i % 4 == 0 or i < x) for k in prefix[i] & prefix[x]]
    assert got == sorted(want) and want
    # one row a member, not one a member and shingle
    assert rows["shingles"] == len(sets)
