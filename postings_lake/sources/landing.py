"""Landed search pages -> bronze rows.

A landed page is one row ``(country, page, body, ingested_at)`` whose
``body`` is the JSON returned by the search API: ``{"results": [posting,
...]}``. Pages are read with any Spark source (``spark.read.json`` /
``parquet`` / a table); this module decodes, cuts and flattens them. All of it
is per-row expression work except the page cut-off, which needs one small
aggregate.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from postings_lake.operators.curate import BRONZE_SCHEMA, DEFAULT_SOURCE

# Scalars that may arrive as numbers are declared as strings: the JSON reader
# keeps a number's text (12345 -> "12345", long ids keep every digit), and the
# salary strings are cast afterwards so "45000.5" and 45000 both parse.
POSTING_SCHEMA = StructType(
    [
        StructField("id", StringType()),
        StructField("title", StringType()),
        StructField("company", StructType([StructField("display_name", StringType())])),
        StructField(
            "location",
            StructType([
                StructField("display_name", StringType()),
                StructField("area", ArrayType(StringType())),
            ]),
        ),
        StructField("category", StructType([StructField("label", StringType())])),
        StructField("contract_time", StringType()),
        StructField("salary_min", StringType()),
        StructField("salary_max", StringType()),
        StructField("created", StringType()),
        StructField("description", StringType()),
        StructField("redirect_url", StringType()),
    ]
)
PAGE_SCHEMA = StructType([StructField("results", ArrayType(POSTING_SCHEMA))])
# Enough of the page to count its results: same element kind, one field, so
# the parser skips the rest of every posting instead of building it.
SKIM_SCHEMA = StructType(
    [StructField("results", ArrayType(StructType([StructField("id", StringType())])))]
)

# One landed page as stored by the fetch: request country, page number, the
# response body as text, and the run's ingestion time.
LANDED_PAGE_SCHEMA = StructType(
    [
        StructField("country", StringType()),
        StructField("page", LongType()),
        StructField("body", StringType()),
        StructField("ingested_at", StringType()),
    ]
)

# Holds the text of a body that does not fit the schema it is parsed with.
_CORRUPT = "__corrupt"


def read_pages(spark: SparkSession, path: str, file_format: str = "json") -> DataFrame:
    """Landed pages stored as files (JSON lines, parquet, ...), read with the
    explicit page schema: no inference pass over the data."""
    return spark.read.schema(LANDED_PAGE_SCHEMA).format(file_format).load(path)


def stamp_run(pages: DataFrame, ingested_at: str | None = None) -> DataFrame:
    """Give every page of one run the same ``ingested_at``: the given text, or
    the current UTC time in ISO-8601 (``2026-06-24T08:15:00.123456+00:00``)."""
    at = ingested_at or dt.datetime.now(dt.timezone.utc).isoformat()
    return pages.withColumn("ingested_at", F.lit(at))


def _checked(body: Column, schema: StructType) -> Column:
    """``body`` parsed without failing; ``_CORRUPT`` is set where it does not fit."""
    marked = StructType([*schema.fields, StructField(_CORRUPT, StringType())])
    return F.from_json(body, marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})


def _fits(body: Column, parsed: Column) -> Column:
    """A JSON object of the parsed schema (null bodies and lists do not fit)."""
    return F.coalesce(F.ltrim(body).startswith("{") & parsed.getField(_CORRUPT).isNull(), F.lit(False))


def decode(pages: DataFrame, body: str = "body", mode: str = "FAILFAST") -> DataFrame:
    """Add ``results`` (array of posting structs) parsed from ``body``.

    ``mode="FAILFAST"`` fails the job on a body that is not JSON or has the
    wrong shape; ``"PERMISSIVE"`` gives such a page null ``results`` (see
    :func:`rejects`). A null body has null ``results`` in both modes.
    """
    if mode == "FAILFAST":
        results = F.from_json(F.col(body), PAGE_SCHEMA, {"mode": mode}).getField("results")
    else:
        parsed = _checked(F.col(body), PAGE_SCHEMA)
        results = F.when(_fits(F.col(body), parsed), parsed.getField("results"))
    return pages.withColumn("results", results)


def rejects(pages: DataFrame, body: str = "body") -> DataFrame:
    """Pages that ``PERMISSIVE`` does not decode: the body is null, not JSON, or
    JSON of another shape."""
    return pages.where(~_fits(F.col(body), _checked(F.col(body), PAGE_SCHEMA)))


def is_empty_page(results: Column) -> Column:
    """No results: an absent list or an empty one."""
    return results.isNull() | (F.size(results) == 0)


def unnest_results(pages: DataFrame, *keep: str) -> DataFrame:
    """One row per element of ``results`` (``posting``), with ``keep`` columns.

    ``posexplode_outer`` and a non-null position give exactly the rows of a
    plain ``explode`` (null elements included), without the ``size(results) >
    0`` predicate Catalyst infers for ``explode`` and pushes below the
    projection, which would parse every body twice.
    """
    return (
        pages.select(*keep, F.posexplode_outer("results").alias("__pos", "posting"))
        .where(F.col("__pos").isNotNull())
        .drop("__pos")
    )


def landed_postings(pages: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """Every posting of every page, no cut-off: ``country, page, ingested_at,
    posting``."""
    return unnest_results(decode(pages, mode=mode), "country", "page", "ingested_at")


def cutoff_pages(
    pages: DataFrame,
    max_pages: int | None = None,
    mode: str = "FAILFAST",
    run: str = "ingested_at",
) -> DataFrame:
    """Pages a paging fetch would have read, decoded: numbers from 1 (up to
    ``max_pages``, if given), and for each country of each ``run`` nothing at or
    after its first empty page.

    Only a body that decodes can be an empty page; a reject is not one. The
    bodies are counted with a schema that skips every posting's fields; the first
    empty page of each (country, run) is a partial/final ``min``, joined back
    (null-safe) by the strategy the planner finds right. Full decoding comes
    after the cut, so a malformed page beyond it cannot fail the job.
    """
    in_range = pages.where(F.col("page") >= 1)
    if max_pages is not None:
        in_range = in_range.where(F.col("page") <= max_pages)
    of_run = F.col(run) if run in pages.columns else F.lit(None).cast("string")
    skim = _checked(F.col("body"), SKIM_SCHEMA)
    first_empty = (
        in_range.where(_fits(F.col("body"), skim) & is_empty_page(skim.getField("results")))
        .groupBy(F.col("country").alias("__country"), of_run.alias("__run"))
        .agg(F.min("page").alias("__first_empty"))
    )
    same = F.col("country").eqNullSafe(F.col("__country")) & of_run.eqNullSafe(F.col("__run"))
    keep = F.col("__first_empty").isNull() | (F.col("page") < F.col("__first_empty"))
    kept = in_range.join(first_empty, same, "left").where(keep).select(*pages.columns)
    return decode(kept, mode=mode)


def flatten(
    postings: DataFrame,
    source: str = DEFAULT_SOURCE,
    posting: str = "posting",
    country: str = "country",
    ingested_at: str = "ingested_at",
) -> DataFrame:
    """One bronze row per posting struct (:data:`BRONZE_SCHEMA` order).

    ``country_code`` is the page's request country, not a payload field.
    ``region`` is the second area entry when there are at least two;
    ``city`` is the last entry (null for an empty or absent area).
    """
    p = F.col(posting)
    area = p.getField("location").getField("area")
    cols = {
        "source_name": F.lit(source),
        "source_id": p.getField("id"),
        "title": p.getField("title"),
        "company": p.getField("company").getField("display_name"),
        "country_code": F.col(country),
        "location_display": p.getField("location").getField("display_name"),
        "region": F.get(area, 1),
        "city": F.try_element_at(area, F.lit(-1)),
        "category": p.getField("category").getField("label"),
        "contract_time": p.getField("contract_time"),
        "salary_min": p.getField("salary_min").try_cast("double"),
        "salary_max": p.getField("salary_max").try_cast("double"),
        "created": p.getField("created"),
        "description": p.getField("description"),
        "redirect_url": p.getField("redirect_url"),
        "ingested_at": F.col(ingested_at),
    }
    return postings.select(*[cols[f.name].cast(f.dataType).alias(f.name) for f in BRONZE_SCHEMA.fields])


def pages_to_bronze(
    pages: DataFrame,
    max_pages: int | None = None,
    source: str = DEFAULT_SOURCE,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Cut-off, unnest and flatten: the bronze rows of landed runs."""
    kept = cutoff_pages(pages, max_pages, mode=mode)
    exploded = unnest_results(kept, "country", "ingested_at")
    return flatten(exploded, source=source)
