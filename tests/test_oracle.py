"""Every registered query against its DuckDB oracle (as the round's gate does)."""

from __future__ import annotations

import os
import sys

import pytest
from core_shared import SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import duck, rows  # noqa: E402

NAMES = sorted(E.queries())
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SMALL).toPandas()
    if name not in ORACLE:
        assert len(got) > 0
        return
    want = con.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert rows(got) == rows(want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "qc_score" in df.columns


def test_non_utc_session_gives_same_results(spark, con):
    """A caller's session in another zone must not shift windows or times."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        for name in ("hourly_temperature", "ndbc_station_feed", "data_quality_classes"):
            got = E.queries()[name](spark, SMALL).toPandas()
            assert rows(got) == rows(con.execute(ORACLE[name]).df()), name
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
