"""Tolerant posting-date parsing."""
from __future__ import annotations

import datetime as dt

import pytest

from postings_lake.functions import dates

D = dt.date(2026, 6, 1)


@pytest.mark.parametrize("raw,expected", [
    ("2026-06-01T09:00:00Z", D), ("2026-06-01T23:30:00-05:00", D), ("2026", dt.date(2026, 1, 1)),
    ("2026-06", D), ("2026-6-1", D), (" 2026-06-01 ", D), ("2026-06-01 garbage", D),
    ("2026-06-01Tjunk", D), ("06/01/2026", None), ("2026-02-30", None), ("", None), ("now", None),
    (None, None),
])
def test_posted_date(spark, raw, expected):
    df = spark.createDataFrame([(raw,)], "c string")
    assert df.select(dates.posted_date("c").alias("d")).first()["d"] == expected


def test_posted_date_ansi_off(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = spark.createDataFrame([("06/01/2026",), ("2026-06-01T09:00:00Z",)], "c string")
        assert [r["d"] for r in df.select(dates.posted_date("c").alias("d")).collect()] == [None, D]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
