from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from thermocline.session import local_session

    s = local_session("*", 8, app="thermocline-tests")
    yield s
    s.stop()


@pytest.fixture
def make_readings(spark):
    from core_shared import READING_DDL

    def build(rows, with_id=True):
        df = spark.createDataFrame(rows, READING_DDL)
        if with_id:
            from pyspark.sql import functions as F

            df = df.withColumn("event_id", F.monotonically_increasing_id())
        return df

    return build
