"""Plan shape over a stored curated table: pushdown, pruning, shuffles."""
from __future__ import annotations

import datetime as dt
import os

import pytest

from postings_lake.operators import explore, gate, marts
from postings_lake.plans import fixtures
from postings_lake.operators.curate import curate
from postings_lake.sources import tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored_silver(spark, tmp_path_factory):
    if not os.path.isdir(SF):
        pytest.skip("driver test data not present")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # print the scan's filters in full
    path = str(tmp_path_factory.mktemp("silver", numbered=True))
    tables.replace_table(curate(fixtures.load_postings(spark, SF)), path)
    return tables.read_table(spark, path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_search_predicates_reach_the_scan(stored_silver):
    spec = explore.SearchSpec(countries=("de", "nl"), seniority="junior",
                              posted=(dt.date(1994, 1, 1), dt.date(1996, 12, 31)))
    p = plan(explore.apply_search(stored_silver, spec))
    pushed = p[p.index("PushedFilters"):].split("\n")[0].split(", ReadSchema")[0]
    assert "In(country_code" in pushed
    assert "EqualTo(seniority,junior)" in pushed
    assert "GreaterThanOrEqual(posted_date" in pushed and "LessThanOrEqual(posted_date" in pushed


def test_mart_reads_only_its_columns(stored_silver):
    p = plan(marts.build_mart(stored_silver, marts.TOP_COMPANIES))
    assert "ReadSchema: struct<company:string>" in p
    p = plan(marts.build_mart(stored_silver, marts.TOP_TOOLS))
    assert "ReadSchema: struct<seniority:string,skills:array<string>>" in p
    assert "PushedFilters: [IsNotNull(seniority), EqualTo(seniority,junior)]" in p


def test_gate_reads_only_checked_columns(stored_silver):
    p = plan(gate.quality_metrics(stored_silver))
    schema = p[p.index("ReadSchema"):].split("\n")[0]
    for c in ("source_id", "company", "posted_date", "skills"):
        assert c in schema
    assert "title" not in schema and "redirect_url" not in schema


def test_listing_and_viewer_are_top_k(stored_silver):
    assert "TakeOrderedAndProject" in plan(explore.listing(stored_silver))
    assert "TakeOrderedAndProject" in plan(explore.viewer(stored_silver))


def test_one_pass_marts_scan_silver_once(spark, stored_silver):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(marts.build_marts(stored_silver)["__all__"])
        assert p.count("FileScan") == 1 and p.count("Exchange") == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_dedupe_shuffles_only_what_its_caller_uses(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = marts.build_mart(curate(fixtures.load_postings(spark, SF)), marts.JOBS_BY_DAY)
        p = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    below = p[:p.index("FileScan")].rsplit("Exchange hashpartitioning", 1)[1]
    sent = [line for line in below.split("\n") if "Project" in line][0]
    assert "created" in p and "xxhash64" in p
    assert "AS description" not in sent.split("xxhash64")[0] and "AS redirect_url" not in sent.split("xxhash64")[0]


def test_type_clash_between_marts_raises(stored_silver):
    clash = marts.MartSpec("by_size", ("skill",), "n", explode=("sizes", "skill"))
    df = stored_silver.selectExpr("*", "array(skill_count) as sizes")
    with pytest.raises(ValueError, match="skill"):
        marts.build_marts(df, (marts.TOP_TOOLS, clash))


def test_gold_all_is_one_scan_and_one_shuffle(spark, stored_silver):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(marts.gold_all(stored_silver))
        assert p.count("FileScan") == 1 and p.count("Exchange") == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_building_a_query_runs_no_job(spark):
    from postings_lake.plans.registry import QUERIES, STORED

    tracker = spark.sparkContext.statusTracker()
    for key, query in QUERIES.items():
        if key in STORED:  # they write and publish a lake first
            continue
        spark.sparkContext.setJobGroup(f"build-{key}", key)
        query(spark, SF)
        # Reading a parquet footer for its schema is the only job allowed.
        names = len(tracker.getJobIdsForGroup(f"build-{key}"))
        assert names <= 2, key
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_every_query_plan_is_jvm_only_and_join_safe(spark):
    """No Python evaluation and no cartesian or nested-loop joins; joins carry no
    broadcast hint, so the planner's own size threshold decides."""
    from postings_lake.plans.registry import QUERIES

    for key, q in QUERIES.items():
        df = q(spark, SF)
        p = plan(df)
        assert "EvalPython" not in p and "PythonUDF" not in p, key
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, key
        assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString(), key
