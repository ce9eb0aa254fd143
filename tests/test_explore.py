"""Explorer: facets, date bounds, search spec, metrics, listing, preview."""
from __future__ import annotations

import datetime as dt

import pytest

from postings_lake.operators import explore

SCHEMA = ("source_name string, source_id string, title string, company string, country_code string, "
          "city string, region string, location_display string, seniority string, posted_date date, "
          "skills array<string>, salary_min double, salary_max double, redirect_url string")
D = dt.date


def cur(spark):
    rows = [
        ("a", "1", "Data Engineer", "ACME", "de", "Berlin", "BE", "Berlin, DE", "junior", D(2026, 6, 3), ["Python", "SQL"], 1.0, 2.0, "u1"),
        ("a", "2", "ML Engineer", "Globex", "nl", " ", None, "Amsterdam", "senior", D(2026, 5, 20), [], None, None, "u2"),
        ("a", "3", None, "50% [Off]", "fr", "Paris", "IDF", "Paris", "mid", D(2026, 6, 1), ["Spark"], None, None, "u3"),
        ("a", "4", "Analyst", None, None, None, None, None, "junior", None, ["SQL"], None, None, "u4"),
        ("b", "1", "Data Analyst", "ACME", "de", "Munich", "BY", "Munich", "unspecified", D(2026, 6, 3), [], None, None, "u5"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def ids(df):
    return sorted((r["source_name"], r["source_id"]) for r in df.collect())


ALL = (D(2026, 1, 1), D(2026, 12, 31))


def search(spark, **kw):
    kw.setdefault("posted", ALL)
    return ids(explore.apply_search(cur(spark), explore.SearchSpec(**kw)))


def test_facets(spark):
    got = [tuple(r) for r in explore.facets(cur(spark)).collect()]
    assert got == [
        ("city", "Berlin"), ("city", "Munich"), ("city", "Paris"),
        ("country_code", "de"), ("country_code", "fr"), ("country_code", "nl"),
        ("seniority", "junior"), ("seniority", "mid"), ("seniority", "senior"), ("seniority", "unspecified"),
    ]


def test_date_bounds(spark):
    r = explore.date_bounds(cur(spark)).first()
    assert (r["min_date"], r["max_date"], r["default_start"], r["default_end"]) == (
        D(2026, 5, 20), D(2026, 6, 3), D(2026, 6, 1), D(2026, 6, 3))


def test_date_bounds_start_not_before_min(spark):
    one = cur(spark).where("source_id = '3'")
    r = explore.date_bounds(one).first()
    assert r["default_start"] == D(2026, 6, 1) == r["min_date"]


def test_date_bounds_without_dates(spark):
    r = explore.date_bounds(cur(spark).where("posted_date is null"), today=D(2026, 7, 15)).first()
    assert (r["min_date"], r["default_start"], r["default_end"]) == (None, D(2026, 7, 1), D(2026, 7, 15))


def test_blank_filters_disable(spark):
    assert search(spark, role="  ", location="", keyword=" ") == [("a", "1"), ("a", "2"), ("a", "3"), ("b", "1")]


def test_null_date_never_listed(spark):
    assert ("a", "4") not in search(spark)


def test_membership_and_seniority(spark):
    assert search(spark, countries=("de",), seniority="junior") == [("a", "1")]
    assert search(spark, cities=("Berlin", "Paris")) == [("a", "1"), ("a", "3")]


def test_role_keyword(spark):
    assert search(spark, role=" ENGINEER ") == [("a", "1"), ("a", "2")]


def test_location_keyword_any_field(spark):
    assert search(spark, location="idf") == [("a", "3")]
    assert search(spark, location="nl") == [("a", "2")]


def test_general_keyword_needs_title_and_is_literal(spark):
    assert search(spark, keyword="[off]") == []  # only row 3 has it, and its title is null
    assert search(spark, keyword="sql") == [("a", "1")]
    assert search(spark, keyword="[") == [("a", "1"), ("a", "2"), ("b", "1")]  # skills text starts with '['
    assert search(spark, keyword="python, sql") == [("a", "1")]


def test_single_day_range(spark):
    assert search(spark, posted=D(2026, 6, 3)) == [("a", "1"), ("b", "1")]


def test_default_range(spark):
    assert ids(explore.apply_search(cur(spark), explore.SearchSpec())) == [("a", "1"), ("a", "3"), ("b", "1")]


def test_headline_metrics_count_null_as_value(spark):
    r = explore.headline_metrics(cur(spark)).first()
    assert (r["jobs"], r["companies"], r["countries"], r["seniorities"]) == (5, 4, 4, 4)


def test_listing_order_and_columns(spark):
    out = explore.listing(cur(spark), rows=10)
    assert tuple(out.columns) == explore.LISTING_COLUMNS
    got = [(r["company"], r["posted_date"]) for r in out.collect()]
    assert got == [("ACME", D(2026, 6, 3)), ("ACME", D(2026, 6, 3)), ("50% [Off]", D(2026, 6, 1)),
                   ("Globex", D(2026, 5, 20)), (None, None)]


def test_listing_is_take_ordered(spark):
    plan = explore.listing(cur(spark), rows=10)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_preview_keeps_mart_order(spark):
    from postings_lake.operators import marts

    m = marts.build_mart(cur(spark), marts.TOP_COMPANIES)
    assert [tuple(r) for r in explore.preview(m, 2).collect()] == [("ACME", 2), ("50% [Off]", 1)]


def test_viewer_first_rows_by_key(spark):
    out = explore.viewer(cur(spark), rows=2)
    assert tuple(out.columns) == explore.VIEWER_COLUMNS
    assert [r["company"] for r in out.collect()] == ["ACME", "Globex"]


def test_wildcard_characters_are_literal(spark):
    rows = [
        ("a", "1", "Dev", "50% Off Ltd", "de", "X", None, None, "junior", D(2026, 6, 3), [], None, None, "u"),
        ("a", "2", "Dev", "5000 Off", "de", "X", None, None, "junior", D(2026, 6, 3), [], None, None, "u"),
        ("a", "3", "v1.2 dev", "C", "de", "X", None, None, "junior", D(2026, 6, 3), [], None, None, "u"),
        ("a", "4", "v102 dev", "C", "de", "X", None, None, "junior", D(2026, 6, 3), [], None, None, "u"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)

    def hits(**kw):
        return ids(explore.apply_search(df, explore.SearchSpec(posted=ALL, **kw)))

    assert hits(keyword="50%") == [("a", "1")]  # not a LIKE wildcard
    assert hits(keyword="0_ o") == []
    assert hits(role="1.2") == [("a", "3")]  # not a regex dot


def test_published_statistics_equal_the_table(spark, workdir):
    import json

    from postings_lake.plans import flow
    from postings_lake.plans.explorer import open_explorer
    from postings_lake.sources.tables import Layout

    def pages(ids, at, company):
        body = {"results": [{"id": i, "title": ["Junior Engineer", "Lead", None][i % 3], "company": {"display_name": company} if i % 4 else None,
                             "created": f"2026-0{1 + i % 3}-1{i % 9}T00:00:00Z", "location": {"area": ["DE", "BE", ["Berlin", " ", "Ulm"][i % 3]]}}
                            for i in ids]}
        return spark.createDataFrame([(["de", "nl"][len(ids) % 2], 1, json.dumps(body), at)], "country string, page bigint, body string, ingested_at string")

    lay = Layout(workdir)
    with pytest.raises(ValueError):
        open_explorer(spark, lay)
    for k, ids in enumerate([range(1, 20), range(15, 26)]):
        flow.run(spark, pages(ids, f"2026-06-0{k + 1}T00:00:00Z", f"C{k}"), lay)
        e = open_explorer(spark, lay)
        for got, want in ((e.facets, explore.facets(e.silver)), (e.bounds, explore.date_bounds(e.silver)), (e.metrics, explore.headline_metrics(e.silver))):
            assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()]
        spec = explore.SearchSpec(countries=("de",))
        assert sorted(map(repr, e.search(spec).collect())) == sorted(map(repr, explore.apply_search(e.silver, spec).collect()))
    # A default-range search reads silver once: the range comes from the statistics.
    plan = e.search(explore.SearchSpec())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("/silver/jobs") == 1 and "/gold/jobs_by_day" in plan
    flow.silver_step(spark, lay)  # silver alone: the marts are of before
    assert open_explorer(spark, lay).metrics.collect() == e.metrics.collect()
    assert e.metrics.first()["jobs"] == 25 and isinstance(e.bounds.first()["min_date"], dt.date)


def test_metrics_do_not_multiply_rows(spark):
    df = spark.createDataFrame([("a", "de", None), (None, "de", "junior"), ("a", None, "junior"), ("a", "de", None)], "company string, country_code string, seniority string")
    m = explore.headline_metrics(df)
    assert "Expand" not in m._jdf.queryExecution().executedPlan().toString()
    assert tuple(m.first()) == (4, 2, 2, 2)
    assert tuple(explore.headline_metrics(df.where("false")).first()) == (0, 0, 0, 0)
