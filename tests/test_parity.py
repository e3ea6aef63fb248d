"""Every registered query against its SQL in DuckDB (the driver's gate), at sf0.001,
plus the expected counts of SURVEY §7.3."""

from collections import Counter

import pytest

import __spark_entry__ as E
from cardwatch.plans.catalog import QUERIES
from cardwatch.plans.sql_checks import SQL
from tests.parity import compare, duck


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL) and set(QUERIES) <= set(E.queries())
    assert len(QUERIES) == 46


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_small, con, name):
    r = compare(spark, sf_small, name, E.queries()[name], E.oracle_sql()[name], con)
    assert r["columns_match"], (r["spark_columns"], r["duck_columns"])
    assert r["rows"][0] == r["rows"][1]
    assert r["values_match"]


def _count(spark, sf, name):
    return E.queries()[name](spark, sf).count()


def test_expected_counts(spark, sf_small):
    q = E.queries()
    assert _count(spark, sf_small, "rule_city_velocity_per_card") == 94
    assert _count(spark, sf_small, "rule_amount_probing_per_card") == 12
    lit = Counter(r[0] for r in q["classify"](spark, sf_small).select("event_type").collect())
    assert lit == {"PASSPORT_INVALID": 201, "CONTRACT_EXPIRED": 206, "OK": 99}
    card = Counter(r[0] for r in q["classify_per_card"](spark, sf_small).select("event_type").collect())
    assert card == {"PASSPORT_INVALID": 201, "CONTRACT_EXPIRED": 206, "CITY_VELOCITY": 9, "OK": 90}
    full = q["scd2_full"](spark, sf_small)
    rows = full.collect()
    open_end = max(r["effective_to"] for r in rows)
    assert sum(r["effective_to"] == open_end and r["deleted_flg"] == "N" for r in rows) == 138
    assert sum(r["effective_to"] != open_end and r["deleted_flg"] == "N" for r in rows) == 28   # 18 + 10
    assert sum(r["effective_to"] == open_end and r["deleted_flg"] == "Y" for r in rows) == 10


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["event_dt", "passport", "fio", "phone", "event_type", "report_dt"]
    assert df.count() >= 0
