"""Registered queries: key -> ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables through the adapters in
:mod:`postings_lake.plans.fixtures` (or the ``documents`` / ``events`` tables
directly), so its work grows with the data; none runs on fixed input. Array
results are returned joined with ``,`` so they compare with the oracles.
"""
from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postings_lake.functions import dates, lexicon
from postings_lake.operators import curate as cur_ops
from postings_lake.operators import explore, gate, marts, tagging
from postings_lake.operators.newest import newest_per_key
from postings_lake.plans import fixtures, flow
from postings_lake.plans.explorer import open_explorer
from postings_lake.sources import landing, tables
from postings_lake.sources.tables import Layout

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered explorer and landing queries.
ORACLE_MAX_PAGES = 900
FILTER_SPEC = explore.SearchSpec(
    countries=("de", "nl"), cities=("City A", "City B"), seniority="junior",
    posted=(dt.date(1994, 1, 1), dt.date(1996, 12, 31)),
)
# Keyword and listing queries span every posting date (the data runs
# 1995-2001); filter and metrics use a sub-range to exercise the date test.
ALL_DATES = (dt.date(1990, 1, 1), dt.date(2030, 12, 31))
KEYWORD_SPEC = explore.SearchSpec(role="engineer", location="Region A", keyword=" SQL ", posted=ALL_DATES)
METRICS_SPEC = explore.SearchSpec(location="city", posted=(dt.date(1993, 1, 1), dt.date(1997, 6, 30)))
LISTING_SPEC = explore.SearchSpec(countries=("gb", "fr"), posted=ALL_DATES)

# Test names for the documents table: words that occur in its prose, next to
# the default taxonomy (which the invented prose never mentions).
DOCUMENT_TAXONOMY: dict[str, tuple[str, ...]] = {
    **lexicon.SKILL_TAXONOMY,
    "Aiaux": ("aiaux", "ouier"),
    "Anble": ("anble", "inble"),
    "Ciónmente": ("ciónmente",),
    "Enach": ("enach",),
}


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.load_postings(spark, sf_dir)


def deduped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cur_ops.dedupe(postings(spark, sf_dir))


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cur_ops.curate(postings(spark, sf_dir))


def flat(df: DataFrame) -> DataFrame:
    """Arrays joined with ',' (scalars only, for comparison)."""
    return df.select(
        *[
            F.array_join(F.col(f.name), ",").alias(f.name) if f.dataType.typeName() == "array" else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _cols(*names: str) -> Query:
    return lambda spark, sf_dir: flat(curated(spark, sf_dir).select(*names))


def _mart(name: str) -> Query:
    spec = marts.MARTS_BY_NAME[name]
    return lambda spark, sf_dir: marts.build_mart(curated(spark, sf_dir), spec)


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.load_landed_pages(spark, sf_dir)


def q_landed_postings(spark, sf_dir):
    p = landing.landed_postings(_pages(spark, sf_dir), mode="PERMISSIVE")
    return p.select(
        "country", "page", "ingested_at",
        F.col("posting.id").alias("source_id"), F.col("posting.title").alias("title"),
    )


def q_page_cutoff(spark, sf_dir):
    kept = landing.cutoff_pages(_pages(spark, sf_dir), max_pages=ORACLE_MAX_PAGES, mode="PERMISSIVE")
    return kept.select("country", "page", "ingested_at", F.coalesce(F.size("results"), F.lit(0)).alias("n_results"))


def q_page_rejects(spark, sf_dir):
    return landing.rejects(_pages(spark, sf_dir))


def q_flatten_posting(spark, sf_dir):
    return landing.flatten(landing.landed_postings(_pages(spark, sf_dir), mode="PERMISSIVE"))


def q_silver_incremental(spark, sf_dir):
    rows = fixtures.spread(spark, sf_dir, "lineitem")
    old = cur_ops.curate(fixtures.postings(rows.where("l_linenumber % 2 = 0")))
    return flat(cur_ops.merge(old, fixtures.postings(rows.where("l_linenumber % 2 = 1"))))


def q_gold_incremental(spark, sf_dir):
    """Marts of the older half of the postings, brought up to date with the rows that
    the newer half brings and takes away."""
    rows = fixtures.spread(spark, sf_dir, "lineitem")
    old, new = (cur_ops.curate(cur_ops.with_digest(fixtures.postings(rows.where(f"l_linenumber % 2 = {k}")))) for k in (0, 1))
    signed = cur_ops.changes(old, new)
    return marts.named_marts(marts.updated_counts(marts.tagged_counts(old), signed))


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder that the session names; a temporary one only where a local
    session names none (driver and tasks are one process there)."""
    if not (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()) and spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="pl-lake-")
    return flow.shared_checkpoint_dir(spark)


def stored_lake(spark: SparkSession, sf_dir: str) -> Layout:
    """A lake that took in the postings in two batches, each merged and published by a
    run of its own."""
    layout = Layout(f"{scratch_dir(spark).rstrip('/')}/lake-{uuid.uuid4().hex}")
    rows = fixtures.spread(spark, sf_dir, "lineitem")
    for k in (0, 1):
        tables.append_bronze(fixtures.postings(rows.where(f"l_linenumber % 2 = {k}")), layout, f"batch-{k}")
        flow.update(spark, layout, gate_key=("source_name", "source_id"))
    return layout


def q_flow_silver(spark, sf_dir):
    return flat(tables.read_silver(spark, stored_lake(spark, sf_dir)))


def q_flow_gold(spark, sf_dir):
    layout, every = stored_lake(spark, sf_dir), None
    keys = ("country_code", "skill", "cloud", "posted_date", "company")
    for s in marts.MARTS:
        mart = tables.read_mart(spark, layout, s.name)
        typed = [F.col(k) if k in s.keys else F.lit(None).cast("date" if k == "posted_date" else "string").alias(k) for k in keys]
        part = mart.select(F.lit(s.name).alias("mart"), *typed, F.col(s.measure).alias("n"))
        every = part if every is None else every.unionByName(part)
    return every


def q_explore_published(spark, sf_dir):
    return open_explorer(spark, stored_lake(spark, sf_dir)).search(explore.SearchSpec()).select(*_SEARCH_COLS)


def q_metrics_published(spark, sf_dir):
    return open_explorer(spark, stored_lake(spark, sf_dir)).metrics


def q_gold_all(spark, sf_dir):
    return marts.gold_all(curated(spark, sf_dir))


def q_normalize(spark, sf_dir):
    return cur_ops.normalized(deduped(spark, sf_dir)).select(
        "source_name", "source_id", "title", "company", "country_code"
    )


def q_posted_date(spark, sf_dir):
    # ``created`` is not part of the curated contract; read it before the projection.
    return cur_ops.normalized(deduped(spark, sf_dir)).select(
        "source_name", "source_id", "created", dates.posted_date("created").alias("posted_date")
    )


def q_quality_metrics(spark, sf_dir):
    return gate.quality_metrics(curated(spark, sf_dir))


def q_quality_checks(spark, sf_dir):
    return gate.check_frame(gate.quality_metrics(curated(spark, sf_dir)))


def q_quality_checks_source_key(spark, sf_dir):
    return gate.check_frame(gate.quality_metrics(curated(spark, sf_dir), key=("source_name", "source_id")))


def q_facets(spark, sf_dir):
    return explore.facets(curated(spark, sf_dir))


def q_date_bounds(spark, sf_dir):
    return explore.date_bounds(curated(spark, sf_dir))


_SEARCH_COLS = ("source_name", "source_id", "title", "company", "country_code", "city", "seniority", "posted_date")


def q_explore_filter(spark, sf_dir):
    return explore.apply_search(curated(spark, sf_dir), FILTER_SPEC).select(*_SEARCH_COLS)


def q_explore_keyword(spark, sf_dir):
    return explore.apply_search(curated(spark, sf_dir), KEYWORD_SPEC).select(*_SEARCH_COLS)


def q_explore_metrics(spark, sf_dir):
    return explore.headline_metrics(explore.apply_search(curated(spark, sf_dir), METRICS_SPEC))


def q_explore_listing(spark, sf_dir):
    return flat(explore.listing(explore.apply_search(curated(spark, sf_dir), LISTING_SPEC)))


def q_silver_viewer(spark, sf_dir):
    return flat(explore.viewer(curated(spark, sf_dir)))


def q_explore_default_range(spark, sf_dir):
    return explore.apply_search(curated(spark, sf_dir), explore.SearchSpec()).select(*_SEARCH_COLS)


def q_mart_previews(spark, sf_dir):
    return marts.mart_previews(curated(spark, sf_dir), explore.PREVIEW_ROWS)


def q_mart_preview(spark, sf_dir):
    return explore.preview(marts.build_mart(curated(spark, sf_dir), marts.TOP_COMPANIES))


def documents_as_postings(documents: DataFrame) -> DataFrame:
    """Documents in bronze shape: ``source`` as source, ``doc_id`` as id,
    ``lang`` as country, the whole ``text`` as description."""
    return cur_ops.conform_bronze(
        documents.select(
            F.col("source").alias("source_name"),
            F.col("doc_id").cast("string").alias("source_id"),
            F.col("lang").alias("country_code"),
            F.col("text").alias("description"),
        )
    )


def q_document_skills(spark, sf_dir):
    docs = fixtures.table(spark, sf_dir, "documents")
    tags = lexicon.skills(F.col("text"), DOCUMENT_TAXONOMY)
    return docs.select(
        "doc_id", "lang", F.array_join(tags, ",").alias("skills"),
    )


def q_document_skills_joined(spark, sf_dir):
    """The same names found by joining token n-grams to an alias table."""
    docs = fixtures.table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    found = tagging.with_tags(docs, ("doc_id",), F.col("text"), DOCUMENT_TAXONOMY)
    return found.select("doc_id", "lang", F.array_join("skills", ",").alias("skills"))


def q_document_skills_by_lang(spark, sf_dir):
    docs = documents_as_postings(fixtures.table(spark, sf_dir, "documents"))
    spec = cur_ops.CurateSpec(taxonomy=DOCUMENT_TAXONOMY)
    return marts.build_mart(cur_ops.curate(docs, spec), marts.SKILLS_BY_COUNTRY)


def q_newest_events(spark, sf_dir):
    ev = fixtures.table(spark, sf_dir, "events")
    return newest_per_key(ev, ("event_type", "user_id"), "ts", order="timestamp")


# Queries that store a lake before they read it; all others run nothing when built.
STORED = ("flow_silver", "flow_gold", "explore_published", "metrics_published")

QUERIES: dict[str, Query] = {
    # landing (S1-S3)
    "landed_postings": q_landed_postings,
    "page_cutoff": q_page_cutoff,
    "page_rejects": q_page_rejects,
    "flatten_posting": q_flatten_posting,
    # curation (P1-P4, W1, F1-F6)
    "newest_per_key": lambda spark, sf_dir: deduped(spark, sf_dir),
    "normalize": q_normalize,
    "posted_date": q_posted_date,
    "seniority": _cols("source_name", "source_id", "title", "seniority"),
    "skills": _cols("source_name", "source_id", "skills"),
    "skill_count": _cols("source_name", "source_id", "skill_count"),
    "clouds": _cols("source_name", "source_id", "clouds"),
    "silver": lambda spark, sf_dir: flat(curated(spark, sf_dir)),
    "silver_incremental": q_silver_incremental,
    # marts (A1-A5)
    **{m.name: _mart(m.name) for m in marts.MARTS},
    "gold_all": q_gold_all,
    "gold_incremental": q_gold_incremental,
    # the stored flow (S4-S9, C2-C5) in two runs, and the explorer over it
    "flow_silver": q_flow_silver,
    "flow_gold": q_flow_gold,
    "explore_published": q_explore_published,
    "metrics_published": q_metrics_published,
    "mart_previews": q_mart_previews,
    # gate (G1-G6, A7, F10)
    "quality_metrics": q_quality_metrics,
    "quality_checks": q_quality_checks,
    "quality_checks_source_key": q_quality_checks_source_key,
    # explorer (E1-E6)
    "facets": q_facets,
    "date_bounds": q_date_bounds,
    "explore_filter": q_explore_filter,
    "explore_keyword": q_explore_keyword,
    "explore_default_range": q_explore_default_range,
    "explore_metrics": q_explore_metrics,
    "explore_listing": q_explore_listing,
    "mart_preview": q_mart_preview,
    "silver_viewer": q_silver_viewer,
    # the same operators on other tables
    "document_skills": q_document_skills,
    "document_skills_by_lang": q_document_skills_by_lang,
    "document_skills_joined": q_document_skills_joined,
    "newest_events": q_newest_events,
}
