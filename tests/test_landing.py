"""Landed pages: decode, cut-off per run, rejects and flatten."""
from __future__ import annotations

import json

import pytest

from postings_lake.operators.curate import BRONZE_SCHEMA
from postings_lake.sources import landing

RUN_A, RUN_B = "2025-03-01T04:00:00Z", "2025-03-08T04:00:00Z"


def pages(spark, *items):
    """``(country, page, body, run)``; dict bodies become JSON, an int that many results."""
    def text(b):
        if isinstance(b, int):
            b = {"results": [{"id": f"p{k}"} for k in range(b)]}
        return json.dumps(b) if isinstance(b, dict) else b

    rows = [(c, p, text(b), run) for c, p, b, run in items]
    return spark.createDataFrame(rows, "country string, page bigint, body string, ingested_at string")


def kept(df, **kw):
    return sorted(((r["country"], r["page"], r["ingested_at"]) for r in landing.cutoff_pages(df, **kw).collect()),
                  key=lambda r: (r[0] or "", r[1], r[2]))


def flat(spark, *postings):
    return landing.pages_to_bronze(pages(spark, ("se", 1, {"results": list(postings)}, RUN_A))).collect()


def test_full_posting_lands_in_its_columns(spark):
    [r] = flat(spark, {
        "id": "q-77", "title": "Harbour pilot", "company": {"display_name": "North Quay"},
        "location": {"display_name": "Malmö, Skåne", "area": ["Sverige", "Skåne", "Malmö"]},
        "category": {"label": "Logistics"}, "contract_time": "part_time", "salary_min": 310, "salary_max": "402.25",
        "created": "2025-02-27T18:30:00Z", "description": "Tugs and tides.", "redirect_url": "https://example.org/q-77"})
    assert tuple(r) == (
        "adzuna", "q-77", "Harbour pilot", "North Quay", "se", "Malmö, Skåne", "Skåne", "Malmö", "Logistics", "part_time",
        310.0, 402.25, "2025-02-27T18:30:00Z", "Tugs and tides.", "https://example.org/q-77", RUN_A)


def test_absent_parts_are_null(spark):
    [r] = flat(spark, {"description": "no more than this"})
    present = {k: v for k, v in r.asDict().items() if v is not None}
    assert present == {"source_name": "adzuna", "country_code": "se", "description": "no more than this", "ingested_at": RUN_A}


@pytest.mark.parametrize("area,region,city", [
    ([], None, None), (["X"], None, "X"), (["X", "Y"], "Y", "Y"), (["X", "Y", "Z", "W"], "Y", "W"), (None, None, None)])
def test_region_is_second_city_is_last(spark, area, region, city):
    [r] = flat(spark, {"location": {"area": area}})
    assert (r.region, r.city) == (region, city)


def test_numbers_keep_their_text_and_bad_salaries_are_null(spark):
    rows = flat(spark, {"id": 90071992547409931, "salary_min": "n/a"}, {"id": 3, "salary_min": 0.5}, {"company": None})
    assert [(r.source_id, r.salary_min, r.company) for r in rows] == [
        ("90071992547409931", None, None), ("3", 0.5, None), (None, None, None)]


def test_output_is_the_bronze_contract(spark):
    got = landing.pages_to_bronze(pages(spark, ("se", 1, 1, RUN_A))).schema
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in BRONZE_SCHEMA]


def test_each_run_has_its_own_cut(spark):
    df = pages(spark, ("se", 1, 2, RUN_A), ("se", 2, 0, RUN_A), ("se", 3, 2, RUN_A),
               ("se", 1, 2, RUN_B), ("se", 2, 2, RUN_B), ("se", 3, 2, RUN_B))
    assert kept(df) == [("se", 1, RUN_A), ("se", 1, RUN_B), ("se", 2, RUN_B), ("se", 3, RUN_B)]


def test_no_page_limit_unless_asked(spark):
    df = pages(spark, *[("se", p, 1, RUN_A) for p in range(0, 9)])
    assert [p for _, p, _ in kept(df)] == list(range(1, 9))  # there is no page 0
    assert [p for _, p, _ in kept(df, max_pages=4)] == [1, 2, 3, 4]


def test_a_page_seen_twice_counts_as_empty_if_one_copy_is(spark):
    assert kept(pages(spark, ("se", 1, 1, RUN_A), ("se", 2, 1, RUN_A), ("se", 2, {"count": 0}, RUN_A))) == [("se", 1, RUN_A)]


def test_null_country_is_cut_too(spark):
    df = pages(spark, (None, 1, 1, RUN_A), (None, 2, {"results": None}, RUN_A), (None, 3, 1, RUN_A))
    assert kept(df) == [(None, 1, RUN_A)]


@pytest.mark.parametrize("bad", ["{oops", None, "[]", '{"results": 5}', '{"results": [{"company": "text"}]}'])
def test_a_reject_is_not_an_empty_page(spark, bad):
    df = pages(spark, ("se", 1, bad, RUN_A), ("se", 2, 2, RUN_A), ("se", 3, 2, RUN_A))
    assert [p for _, p, _ in kept(df, mode="PERMISSIVE")] == [1, 2, 3]
    assert landing.pages_to_bronze(df, mode="PERMISSIVE").count() == 4
    assert [(r["country"], r["page"]) for r in landing.rejects(df).collect()] == [("se", 1)]


def test_failfast_fails_before_the_cut_only(spark):
    beyond = pages(spark, ("se", 1, 1, RUN_A), ("se", 2, 0, RUN_A), ("se", 3, "{oops", RUN_A))
    assert landing.pages_to_bronze(beyond).count() == 1
    with pytest.raises(Exception):
        landing.pages_to_bronze(pages(spark, ("se", 1, "{oops", RUN_A))).collect()


def test_pages_without_a_run_column_are_one_run(spark):
    df = pages(spark, ("se", 1, 1, RUN_A), ("se", 2, 0, RUN_B), ("se", 3, 1, RUN_B)).drop("ingested_at")
    assert [r["page"] for r in landing.cutoff_pages(df).collect()] == [1]
