"""Property tests: operators against brute-force Python on random inputs."""
from __future__ import annotations

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from postings_lake.operators.newest import newest_per_key
from postings_lake.sources import landing

SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

rows_st = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", None]),          # source
        st.sampled_from(["1", "2", "3"]),           # id
        st.sampled_from(["2026-06-01", "2026-06-02", None]),  # ingested_at
        st.sampled_from(["x", "y", None]),          # payload
        st.integers(0, 3),                          # payload
    ),
    max_size=25,
)


@SETTINGS
@given(rows_st)
def test_newest_per_key_keeps_one_greatest_row(spark, rows):
    df = spark.createDataFrame(rows, "source string, id string, at string, p string, q int")
    got = [tuple(r) for r in newest_per_key(df, ["id", "source"], "at").collect()]
    assert sorted(((r[0], r[1]) for r in got), key=repr) == sorted({(r[0], r[1]) for r in rows}, key=repr)
    for r in got:
        best = max((x[2] or "") for x in rows if x[:2] == r[:2])
        assert r in rows and (r[2] or "") == best
    assert sorted(map(tuple, newest_per_key(df.repartition(3), ["id", "source"], "at").collect()), key=repr) == sorted(got, key=repr)


# A country's run, page number, results (-1: a body that is not JSON), list absent.
pages_st = st.lists(
    st.tuples(st.sampled_from(["de", None]), st.sampled_from(["r1", "r2"]), st.integers(0, 6), st.integers(-1, 2), st.booleans()),
    max_size=20,
)


def _body(n, absent):
    if n < 0:
        return "{"
    return json.dumps({"count": 0} if n == 0 and absent else {"results": [{"id": i} for i in range(n)]})


@SETTINGS
@given(pages_st, st.one_of(st.none(), st.integers(1, 5)))
def test_cutoff_matches_paging_loop(spark, pages, max_pages):
    rows = [(c, p, _body(n, a), run) for c, run, p, n, a in pages]
    df = spark.createDataFrame(rows, "country string, page bigint, body string, ingested_at string")
    got = landing.cutoff_pages(df, max_pages=max_pages, mode="PERMISSIVE").collect()
    # The paging loop: pages from 1 in order, stop at the first empty number.
    want = []
    for c, run in {(c, run) for c, run, *_ in pages}:
        mine = [(p, n) for cc, rr, p, n, _ in pages if (cc, rr) == (c, run) and 1 <= p <= (max_pages or 99)]
        first_empty = min((p for p, n in mine if n == 0), default=None)
        want += [(c, run, p) for p, n in mine if first_empty is None or p < first_empty]
    assert sorted(((r["country"], r["ingested_at"], r["page"]) for r in got), key=repr) == sorted(want, key=repr)
