"""Skill and seniority tagging (native expressions, no UDF)."""
from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postings_lake.functions import lexicon


def tag(spark, texts, taxonomy=lexicon.SKILL_TAXONOMY):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", lexicon.skills(F.col("t"), taxonomy).alias("s")).orderBy("i").collect()
    return [r["s"] for r in rows]


@pytest.mark.parametrize("text,expected", [
    ("Rust, then terraform; docker-compose and HIVE.", ["Docker", "Hive", "Terraform"]),
    ("moved from postgres to SnowFlake", ["PostgreSQL", "Snowflake"]),
    ("Google Cloud / Synapse / Glue", ["AWS", "Azure", "GCP"]),
    ("scalable, javabeans, hives, s33", []),
    ("scala/java", ["Java", "Scala"]),
    ("GitHub Actions!", ["CI/CD"]), ("github  actions", []),
    ("delta table, delta tables, delta tabless", ["Delta Lake"]),
    ("àkafka", []), ("kafkaß", []), ("kafka_", []), ("kafka³", []), ("kafka\u0301", ["Kafka"]),
    ("ſnowflake", ["Snowflake"]), ("\u212aafka", ["Kafka"]),
])
def test_names_and_boundaries(spark, text, expected):
    assert tag(spark, [text]) == [expected]


def test_empty_and_null(spark):
    assert tag(spark, ["", None]) == [[], []]


def test_sorted_unique_code_point_order(spark):
    [s] = tag(spark, ["python Python SQL sql dbt Airflow"])
    assert s == ["Airflow", "Python", "SQL", "dbt"]


def test_clouds_search_only_their_names(spark):
    df = spark.createDataFrame([("gcp adf kafka s3",)], "t string").select(lexicon.clouds("t").alias("c"))
    assert df.first()["c"] == ["AWS", "Azure", "GCP"]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("RLIKE") == 3


@pytest.mark.parametrize("title,expected", [
    ("Graduate / Senior programme", "junior"),
    ("Mid-Level Analyst", "mid"), ("midlevel developer", "mid"), ("mid level", "mid"), ("Medior", "mid"),
    ("Internship coordinator", "unspecified"), (None, "unspecified"), ("Head of Data", "senior"),
    ("Senior Platform Lead", "senior"), ("JUNIOR dev", "junior"), ("Data Engineer", "unspecified"),
    ("entry-level", "junior"), ("staffing", "unspecified"),
])
def test_seniority(spark, title, expected):
    df = spark.createDataFrame([(title,)], "t string")
    assert df.select(lexicon.seniority("t").alias("s")).first()["s"] == expected


def _py_oracle(text):
    # Python re with IGNORECASE and \b, the behaviour the patterns reproduce.
    found = set()
    for name, aliases in lexicon.SKILL_TAXONOMY.items():
        body = "|".join(a if "?" in a else re.escape(a) for a in aliases)
        if text and re.search(r"\b(?:" + body + r")\b", text, re.IGNORECASE):
            found.add(name)
    return sorted(found)


_WORDS = ["python", "SQL", "spark", "Apache Spark", "aws", "s3", "glue", "ci/cd", "k8s", "delta tables",
          "java", "javascript", "mongo", "é", "_", "-", " ", ".", "\n", "x", "9", "power bi", "dbt"]


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(_WORDS), max_size=8).map("".join), min_size=1, max_size=20))
def test_skills_match_python_re(spark, texts):
    assert tag(spark, texts) == [_py_oracle(t) for t in texts]


def test_patterns_are_valid_re2_and_java(spark):
    import duckdb

    for aliases in lexicon.SKILL_TAXONOMY.values():
        p = lexicon.boundary_pattern(aliases, dialect="re2")
        duckdb.sql(f"select regexp_matches('x', '{p}')").fetchall()
