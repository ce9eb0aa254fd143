"""DuckDB SQL oracles for the registered queries.

Each oracle is ANSI-ish SQL that DuckDB runs over the driver's parquet views.
It starts from the adapter SQL (:mod:`postings_lake.plans.fixtures`) and
re-derives the curated rows with DuckDB's own window, regex (RE2) and cast
machinery, so it checks the Spark plans instead of repeating them. The patterns
are spelled out here, in RE2; nothing of them comes from the code under test.
"""
from __future__ import annotations

from collections.abc import Sequence

from postings_lake.plans.fixtures import POSTINGS_SQL


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# FIXED VALUES: skill names and the text that stands for each, as RE2.
SKILLS_RE2 = {
    "AWS": "aws|redshift|glue|s3",
    "Airflow": "airflow",
    "Azure": "azure|adf|azure data factory|synapse",
    "CI/CD": "ci/cd|ci cd|github actions|gitlab ci",
    "Databricks": "databricks",
    "Delta Lake": "delta lake|delta tables?",
    "Docker": "docker",
    "Flink": "flink",
    "GCP": "gcp|google cloud|bigquery",
    "Hadoop": "hadoop",
    "Hive": "hive",
    "Java": "java",
    "Kafka": "kafka",
    "Kubernetes": "kubernetes|k8s",
    "Microsoft Fabric": "microsoft fabric|ms fabric",
    "MongoDB": "mongodb|mongo",
    "MySQL": "mysql",
    "PostgreSQL": "postgresql|postgres",
    "Power BI": "power bi|powerbi",
    "PySpark": "pyspark",
    "Python": "python",
    "SQL": "sql",
    "Scala": "scala",
    "Snowflake": "snowflake",
    "Spark": "spark|apache spark",
    "Tableau": "tableau",
    "Terraform": "terraform",
    "dbt": "dbt",
}
CLOUDS = ("AWS", "Azure", "GCP")
# Test names for the documents table.
DOCUMENT_RE2 = SKILLS_RE2 | {"Aiaux": "aiaux|ouier", "Anble": "anble|inble", "Ciónmente": "ciónmente", "Enach": "enach"}


def skills_list_sql(text_sql: str, patterns: dict[str, str] = SKILLS_RE2) -> str:
    cases = ",\n      ".join(
        f"case when regexp_matches({text_sql}, "
        + _q(r"(?i)(?:^|[^\p{L}\p{N}_])(?:" + patterns[name] + r")(?:$|[^\p{L}\p{N}_])") + f") then {_q(name)} end"
        for name in sorted(patterns))
    return f"list_filter([\n      {cases}], lambda x: x is not null)"


def seniority_sql(title_sql: str) -> str:
    t = f"lower({title_sql})"
    return rf"""case
      when regexp_matches({t}, '(?:^|[^\p{{L}}\p{{Nd}}_])(?:junior|graduate|entry|trainee|intern)(?:$|[^\p{{L}}\p{{Nd}}_])') then 'junior'
      when regexp_matches({t}, '(?:^|[^\p{{L}}\p{{Nd}}_])(?:senior|lead|principal|staff|head)(?:$|[^\p{{L}}\p{{Nd}}_])') then 'senior'
      when regexp_matches({t}, '(?:^|[^\p{{L}}\p{{Nd}}_])(?:medior|mid level|mid-level|midlevel)(?:$|[^\p{{L}}\p{{Nd}}_])') then 'mid'
      else 'unspecified' end"""


def curated_ctes(key: Sequence[str] = ("source_name", "source_id")) -> str:
    """CTEs ``postings``, ``keyed``, ``newest``, ``norm``, ``cur`` (19 curated
    columns, arrays as DuckDB lists)."""
    clouds = ", ".join(map(_q, CLOUDS))
    return f"""
postings as ({POSTINGS_SQL}),
keyed as (
  select coalesce(source_name, 'adzuna') as source_name, source_id, title, company, country_code,
    location_display, region, city, category, contract_time, salary_min, salary_max, created,
    description, redirect_url, ingested_at
  from postings where source_id is not null
),
newest as (
  select * exclude (rn) from (
    select *, row_number() over (partition by {", ".join(key)} order by ingested_at desc nulls last) as rn
    from keyed
  ) where rn = 1
),
norm as (
  select source_name, source_id, trim(title, ' ') as title, trim(company, ' ') as company,
    lower(trim(country_code, ' ')) as country_code, city, region, location_display, category,
    contract_time, salary_min, salary_max, created, description, redirect_url, ingested_at
  from newest
),
enriched as (
  select *,
    {seniority_sql('title')} as seniority,
    try_cast(substr(created, 1, 10) as date) as posted_date,
    {skills_list_sql("concat_ws(' ', title, description)")} as skills
  from norm
),
cur as (
  select source_name, source_id, title, company, country_code, city, region, location_display,
    category, contract_time, seniority, posted_date, skills,
    list_filter(skills, lambda x: x in ({clouds})) as clouds,
    cast(len(skills) as integer) as skill_count,
    salary_min, salary_max, redirect_url, ingested_at
  from enriched
)"""


def with_cur(select_sql: str) -> str:
    return "with " + curated_ctes() + "\n" + select_sql

