"""Property tests: the binned R3/R4 equal a brute-force reading of the rules on
small generated cases (ties, NULL cities, repeated amounts, exact boundaries)."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cardwatch.operators.probing import probing_ids
from cardwatch.operators.velocity import velocity_ids

T0 = dt.datetime(2024, 1, 10)
W3 = dt.timedelta(minutes=60)
W4 = dt.timedelta(minutes=20)

op = st.tuples(
    st.sampled_from(["A", "B"]),
    st.integers(0, 150).map(lambda m: T0 + dt.timedelta(minutes=m)),     # minute grid: ties and exact gaps
    st.sampled_from(["X", "Y", None]),
    st.sampled_from([100, 200, 300]),
    st.sampled_from(["REJECT", "SUCCESS"]),
)
cases = st.lists(op, min_size=0, max_size=25)
cfg = settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, c, t, city, Decimal(a), r) for i, (c, t, city, a, r) in enumerate(rows)],
        "trans_id long, card_num string, trans_date timestamp_ntz, city string, amt decimal(10,2), "
        "oper_result string")


def brute_velocity(rows):
    out = set()
    for j, (cb, tb, xb, _, _) in enumerate(rows):
        for ca, ta, xa, _, _ in rows:
            if ca == cb and ta < tb and tb - ta < W3 and xa is not None and xb is not None and xa != xb:
                out.add(j)
    return sorted(out)


def brute_probing(rows):
    out = set()
    for k, (cc, tc, _, ac, rc) in enumerate(rows):
        if rc != "SUCCESS":
            continue
        for cb, tb, _, ab, rb in rows:
            if cb != cc or rb != "REJECT" or not (tb < tc and ab > ac):
                continue
            for ca, ta, _, aa, ra in rows:
                if ca == cc and ra == "REJECT" and ta < tb and aa > ab and tc - ta < W4:
                    out.add(k)
    return sorted(out)


@cfg
@given(rows=cases, k=st.sampled_from([1, 3, 12, 60]))
def test_velocity_property(spark, rows, k):
    got = sorted(r[0] for r in velocity_ids(frame(spark, rows), W3, k).collect())
    assert got == brute_velocity(rows)


@cfg
@given(rows=cases)
def test_probing_property(spark, rows):
    got = sorted(r[0] for r in probing_ids(frame(spark, rows), W4).collect())
    assert got == brute_probing(rows)
