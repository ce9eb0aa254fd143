"""Adapters from the driver's TPC-H-style tables to the shapes this library
consumes: ``postings`` (bronze rows, from ``lineitem``) and ``landed_pages``
(raw search pages, from ``orders``).

The Spark side is written with the DataFrame API; the same rules as SQL text
(:data:`POSTINGS_SQL`; the pages' rules stand with their oracles) feed the DuckDB oracles, so
the two independent spellings cross-check each other on every comparison.
Both only derive column values; no row is dropped or sampled.
"""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

TASK_BYTES = 4 << 20  # of the files; rows of postings take some forty times as much


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """:func:`table`, its rows dealt out evenly over a task for every ``TASK_BYTES``
    (up to that size they stay as they are).

    The adapters make wide rows of narrow ones. A file of one large row group is read by
    one task, which would build and sort all of them alone, and spill; dealt out
    while narrow they cost one small shuffle. The number follows the files' size, as
    adaptive execution would size partitions by their narrow rows.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
    size = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).getContentSummary(path).getLength()
    rows = table(spark, sf_dir, name)
    return rows if size <= TASK_BYTES else rows.repartition(size // TASK_BYTES + 1)


def _case(value: Column, mapping: Mapping[int, object], default: object) -> Column:
    """``case value when k then v ... else default end``."""
    out = None
    for k, v in mapping.items():
        lit = F.lit(v) if not isinstance(v, Column) else v
        out = F.when(value == k, lit) if out is None else out.when(value == k, lit)
    d = default if isinstance(default, Column) else F.lit(default)
    return d if out is None else out.otherwise(d)


def _null_str() -> Column:
    return F.lit(None).cast("string")


def postings(lineitem: DataFrame) -> DataFrame:
    """Bronze-shaped postings, one per ``lineitem`` row (B1 in FIXTURES.md)."""
    pk, sk = F.col("l_partkey"), F.col("l_suppkey")
    ok = F.col("l_orderkey")
    ship = F.col("l_shipdate").cast("date").cast("string")
    flag = F.col("l_returnflag")
    return lineitem.select(
        F.when(flag == "A", _null_str()).when(flag == "N", F.lit("adzuna"))
        .otherwise(F.lit("feed_b")).alias("source_name"),
        F.when(pk % 50 == 0, _null_str()).otherwise(ok.cast("string")).alias("source_id"),
        _case(sk % 8, {
            0: "  Junior Data Engineer ", 1: "Senior Platform Lead", 2: "Mid-Level Analyst",
            3: "midlevel developer", 4: "Graduate / Senior programme",
            5: "Internship coordinator", 6: _null_str(),
        }, "Data Engineer").alias("title"),
        F.when(pk % 11 == 0, _null_str()).when(pk % 13 == 0, F.lit("   "))
        .otherwise(F.concat(F.lit(" Company "), (sk % 40).cast("string"), F.lit(" ")))
        .alias("company"),
        _case(pk % 6, {0: " DE", 1: "de ", 2: "NL", 3: "gb", 4: "FR"}, _null_str()).alias("country_code"),
        _case(sk % 3, {0: "City A, Region A", 1: "City B, Region B"}, _null_str()).alias("location_display"),
        _case(sk % 3, {0: "Region A", 1: "Region B"}, _null_str()).alias("region"),
        _case(sk % 3, {0: "City A", 1: "City B"}, " ").alias("city"),
        F.lit("IT Jobs").alias("category"),
        F.when(F.col("l_linestatus") == "O", F.lit("full_time")).otherwise(_null_str()).alias("contract_time"),
        F.col("l_extendedprice").alias("salary_min"),
        F.when(pk % 7 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("l_extendedprice") + 1000.0).alias("salary_max"),
        F.when(pk % 17 == 0, F.lit("not a date")).when(pk % 19 == 0, _null_str())
        .otherwise(F.concat(ship, F.lit("T09:00:00Z"))).alias("created"),
        _case(pk % 9, {
            0: "Python, SQL and PySpark on Azure Databricks", 1: "javascript mysql only",
            2: "bigquery plus redshift; k8s", 3: "DELTA TABLES with CI/CD, S3",
            4: "éaws awsé aws_x", 5: _null_str(), 6: "ſql via apache spark",
            7: "power bi | adf | gcp",
        }, "").alias("description"),
        F.concat(F.lit("https://example.org/job/"), ok.cast("string")).alias("redirect_url"),
        F.concat(
            ship, F.lit("T0"), F.col("l_linenumber").cast("string"), F.lit(":00:00."),
            (F.lit(100000) + pk).cast("string"), F.lit("Z"),
        ).alias("ingested_at"),
    )


def landed_pages(orders: DataFrame) -> DataFrame:
    """Raw search pages ``(country, page, body, ingested_at)`` (B2 in FIXTURES.md).

    Covers several runs with different empty pages, null countries, bodies that
    are not JSON or have the wrong shape, empty and absent result lists,
    null/absent company, areas of length 0, 1 and 3, salaries as number, numeric
    string and absent, and a null id.
    """
    ok, ck = F.col("o_orderkey"), F.col("o_custkey")
    page = ok % 1000
    run = F.floor(ok / 1000) % 3
    empty = (page >= F.lit(700) + F.lit(50) * (ck % 4) + F.lit(20) * run) & (ok % 7 == 0)
    company = (
        F.when(ck % 5 == 0, F.lit(',"company":null'))
        .when(ck % 5 == 1, F.lit(""))
        .otherwise(F.concat(F.lit(',"company":{"display_name":"C'), ck.cast("string"), F.lit('"}')))
    )
    area = _case(ck % 3, {0: "[]", 1: '["DE"]'}, '["DE","BE","Berlin"]')
    salary = _case(ck % 3, {0: ',"salary_min":45000', 1: ',"salary_min":"45000.5"'}, "")
    full = F.concat(
        F.lit('{"results":[{"id":'), ok.cast("string"),
        F.lit(',"title":"Role '), F.col("o_orderstatus"), F.lit('"'),
        company,
        F.lit(',"location":{"display_name":"L","area":'), area, F.lit("}"),
        salary,
        F.lit('},{"id":null,"title":"no id"}]}'),
    )
    body = (
        F.when(ok % 101 == 0, F.lit("{not json"))
        .when(ok % 103 == 0, F.lit('{"results":[{"id":1,"company":"a text"}]}'))
        .when(empty, F.when(ok % 2 == 0, F.lit('{"results":[]}')).otherwise(F.lit('{"count":0}')))
        .otherwise(full)
    )
    return orders.select(
        F.when(ck % 17 != 0, _case(ck % 4, {0: "gb", 1: "de", 2: "nl"}, "fr")).alias("country"),
        page.cast("bigint").alias("page"),
        body.alias("body"),
        F.concat(F.lit("2026-06-2"), run.cast("string"), F.lit("T00:00:00Z")).alias("ingested_at"),
    )


def load_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings(spread(spark, sf_dir, "lineitem"))


def load_landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed_pages(table(spark, sf_dir, "orders"))


# ----------------------------------------------------------------------------
# The same adapters as SQL text, for the DuckDB oracles (FIXTURES.md B1, B2).
# ----------------------------------------------------------------------------
POSTINGS_SQL = """
select
  case when l_returnflag = 'A' then cast(null as string) when l_returnflag = 'N' then 'adzuna' else 'feed_b' end as source_name,
  case when l_partkey % 50 = 0 then cast(null as string) else cast(l_orderkey as string) end as source_id,
  case l_suppkey % 8 when 0 then '  Junior Data Engineer ' when 1 then 'Senior Platform Lead'
    when 2 then 'Mid-Level Analyst' when 3 then 'midlevel developer' when 4 then 'Graduate / Senior programme'
    when 5 then 'Internship coordinator' when 6 then cast(null as string) else 'Data Engineer' end as title,
  case when l_partkey % 11 = 0 then cast(null as string) when l_partkey % 13 = 0 then '   '
    else ' Company ' || cast(l_suppkey % 40 as string) || ' ' end as company,
  case l_partkey % 6 when 0 then ' DE' when 1 then 'de ' when 2 then 'NL' when 3 then 'gb' when 4 then 'FR'
    else cast(null as string) end as country_code,
  case l_suppkey % 3 when 0 then 'City A, Region A' when 1 then 'City B, Region B' else cast(null as string) end as location_display,
  case l_suppkey % 3 when 0 then 'Region A' when 1 then 'Region B' else cast(null as string) end as region,
  case l_suppkey % 3 when 0 then 'City A' when 1 then 'City B' else ' ' end as city,
  'IT Jobs' as category,
  case when l_linestatus = 'O' then 'full_time' else cast(null as string) end as contract_time,
  l_extendedprice as salary_min,
  case when l_partkey % 7 = 0 then cast(null as double) else l_extendedprice + 1000.0 end as salary_max,
  case when l_partkey % 17 = 0 then 'not a date' when l_partkey % 19 = 0 then cast(null as string)
    else cast(cast(l_shipdate as date) as string) || 'T09:00:00Z' end as created,
  case l_partkey % 9 when 0 then 'Python, SQL and PySpark on Azure Databricks' when 1 then 'javascript mysql only'
    when 2 then 'bigquery plus redshift; k8s' when 3 then 'DELTA TABLES with CI/CD, S3' when 4 then 'éaws awsé aws_x'
    when 5 then cast(null as string) when 6 then 'ſql via apache spark' when 7 then 'power bi | adf | gcp' else '' end as description,
  'https://example.org/job/' || cast(l_orderkey as string) as redirect_url,
  cast(cast(l_shipdate as date) as string) || 'T0' || cast(l_linenumber as string) || ':00:00.' || cast(100000 + l_partkey as string) || 'Z' as ingested_at
from lineitem
"""
