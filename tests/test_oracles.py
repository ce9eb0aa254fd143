"""Every registered query against its DuckDB oracle at the smallest scale
(the round driver runs the same comparison at sf0.01)."""
from __future__ import annotations

import os

import pytest

from tools.check_oracles import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_all_queries_match_oracles(spark):
    from postings_lake.plans.registry import QUERIES

    results = list(compare(spark, SF, list(QUERIES)))
    assert len(results) == len(QUERIES)
    bad = [(k, n, on, d) for k, ok, n, on, d in results if ok is False]
    assert not bad
    missing = [k for k, ok, *_ in results if ok is None]
    assert not missing, f"queries without an oracle: {missing}"


def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.columns == ["posted_date", "jobs_posted"]
    assert df.count() > 0
