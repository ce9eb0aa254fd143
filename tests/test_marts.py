"""Aggregate marts from specs."""
from __future__ import annotations

import datetime as dt

from postings_lake.operators import marts

SCHEMA = ("country_code string, seniority string, posted_date date, skills array<string>, "
          "clouds array<string>, company string")
D1, D2 = dt.date(2026, 6, 1), dt.date(2026, 6, 2)


def cur(spark):
    rows = [
        ("de", "junior", D1, ["AWS", "Python"], ["AWS"], "ACME"),
        ("de", "senior", D1, ["Python"], [], "ACME"),
        ("nl", "junior", D2, ["Python", "SQL"], [], ""),
        (None, "mid", None, ["GCP"], ["GCP"], None),
        ("de", "junior", D2, [], [], "Globex"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_skills_by_country(spark):
    got = rows(marts.build_mart(cur(spark), marts.SKILLS_BY_COUNTRY))
    assert got == [(None, "GCP", 1), ("de", "Python", 2), ("de", "AWS", 1), ("nl", "Python", 1), ("nl", "SQL", 1)]


def test_top_tools_only_junior(spark):
    assert rows(marts.build_mart(cur(spark), marts.TOP_TOOLS)) == [("Python", 2), ("AWS", 1), ("SQL", 1)]


def test_cloud_demand(spark):
    assert rows(marts.build_mart(cur(spark), marts.CLOUD_DEMAND)) == [(None, "GCP", 1), ("de", "AWS", 1)]


def test_jobs_by_day_drops_null_dates_and_sorts_by_date(spark):
    assert rows(marts.build_mart(cur(spark), marts.JOBS_BY_DAY)) == [(D1, 2), (D2, 2)]


def test_top_companies_keeps_empty_string(spark):
    assert rows(marts.build_mart(cur(spark), marts.TOP_COMPANIES)) == [("ACME", 2), ("", 1), ("Globex", 1)]


def test_one_pass_build_equals_single_builds(spark):
    c = cur(spark)
    together = marts.build_marts(c)
    for spec in marts.MARTS:
        assert rows(together[spec.name]) == rows(marts.build_mart(c, spec)), spec.name
        assert together[spec.name].columns == list(spec.keys) + [spec.measure]


def test_one_pass_build_has_one_shuffle_before_the_sort(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        agg = marts.build_marts(cur(spark))["__all__"]
        plan = agg._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1
        assert plan.count("Scan") == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_partial_aggregate_before_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = marts.build_mart(cur(spark), marts.TOP_COMPANIES, ordered=False)._jdf.queryExecution().executedPlan().toString()
        assert "partial_count" in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_one_pass_build_with_null_arrays_and_elements(spark):
    rows = [
        ("de", "junior", D1, None, None, "A"),
        ("de", "junior", D1, ["Python", None], [None], "A"),
        ("nl", None, None, [], [], None),
    ]
    c = spark.createDataFrame(rows, SCHEMA).unionByName(cur(spark))
    together = marts.build_marts(c)
    for spec in marts.MARTS:
        assert rows_of(together[spec.name]) == rows_of(marts.build_mart(c, spec)), spec.name


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_hot_company_is_combined_before_the_shuffle(spark):
    from pyspark.sql import functions as F

    from plan_metrics import shuffle_records

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        n_hot, n_other, maps = 10_000, 20_000, 8
        hot = spark.range(n_hot).select(F.lit("BigCo").alias("company"))
        other = spark.range(n_other).select((F.col("id") % 1000).cast("string").alias("company"))
        df = hot.unionByName(other).repartition(maps)
        mart = marts.build_mart(df, marts.TOP_COMPANIES, ordered=False)
        got = {r["company"]: r["openings"] for r in mart.collect()}
        assert got["BigCo"] == n_hot and len(got) == 1001
        records = shuffle_records(mart._jdf.queryExecution().executedPlan())
        # Partial counts: at most one row per (key, map task) crosses the shuffle.
        assert max(r for r in records if r != n_hot + n_other) <= 1001 * maps
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
