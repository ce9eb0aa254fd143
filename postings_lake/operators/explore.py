"""Search and browse over the curated table.

A :class:`SearchSpec` is the user's filter state; :func:`apply_search` turns
it into one conjunctive ``where``. Equality, membership and the date range are
plain predicates Catalyst pushes to the parquet scan; keyword terms are literal
case-insensitive substring tests (``contains`` on ``lower``), evaluated in the
scan's codegen stage.
"""
from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings_lake.functions import text
from postings_lake.operators.marts import MartSpec

# FIXED VALUES: explorer constants.
ALL_LEVELS = "All levels"
LISTING_COLUMNS: tuple[str, ...] = (
    "title", "company", "country_code", "city", "seniority", "posted_date", "skills",
    "salary_min", "salary_max", "redirect_url",
)
VIEWER_COLUMNS: tuple[str, ...] = (
    "title", "company", "country_code", "city", "seniority", "skills", "salary_min", "salary_max",
)
DEFAULT_ROWS = 50
PREVIEW_ROWS = 20
FACETS: tuple[str, ...] = ("country_code", "seniority", "city")


def facets(curated: DataFrame, names: Sequence[str] = FACETS) -> DataFrame:
    """Distinct values of every facet column, long format ``(facet, value)``,
    ordered by facet then value.

    One scan: each row emits one ``(facet, value)`` pair per facet, and a
    single distinct (partial aggregate before the shuffle) dedupes them all.
    Nulls are dropped; cities that are blank after trimming are dropped too.
    """
    pairs = F.array(*[F.struct(F.lit(n).alias("facet"), F.col(n).cast("string").alias("value")) for n in names])
    out = curated.select(F.inline_outer(pairs)).where(F.col("value").isNotNull())
    out = out.where((F.col("facet") != "city") | (F.trim(F.col("value")) != ""))
    return out.distinct().orderBy("facet", "value")


def date_bounds(curated: DataFrame, today: dt.date | None = None) -> DataFrame:
    """One row ``(min_date, max_date, default_start, default_end)``.

    The default range runs from the later of the first date and the first day
    of the last date's month to the last date. With no dates at all it is the
    current month up to ``today`` (default: the session's current date).
    """
    now = F.lit(today) if today is not None else F.current_date()
    b = curated.where(F.col("posted_date").isNotNull()).agg(
        F.min("posted_date").alias("min_date"), F.max("posted_date").alias("max_date")
    )
    lo = F.coalesce(F.col("min_date"), F.trunc(now, "month"))
    hi = F.coalesce(F.col("max_date"), now)
    return b.select(
        "min_date", "max_date",
        F.greatest(lo, F.trunc(hi, "month")).alias("default_start"),
        hi.alias("default_end"),
    )


@dataclass(frozen=True)
class SearchSpec:
    """Filter state. Empty lists, blank terms and ``ALL_LEVELS`` disable a
    filter. ``posted`` is a ``(start, end)`` pair, inclusive, or a single day;
    ``None`` means the default range of :func:`date_bounds`."""

    countries: tuple[str, ...] = ()
    cities: tuple[str, ...] = ()
    role: str = ""
    location: str = ""
    seniority: str = ALL_LEVELS
    keyword: str = ""
    posted: tuple[dt.date, dt.date] | dt.date | None = None


def _term(s: str) -> str:
    return s.strip().lower()


def search_condition(spec: SearchSpec, start: Column, end: Column) -> Column:
    conds: list[Column] = []
    if spec.countries:
        conds.append(F.col("country_code").isin(list(spec.countries)))
    if spec.cities:
        conds.append(F.col("city").isin(list(spec.cities)))
    if _term(spec.role):
        conds.append(text.contains_term("title", _term(spec.role)))
    if _term(spec.location):
        t = _term(spec.location)
        conds.append(
            text.contains_term("city", t) | text.contains_term("region", t)
            | text.contains_term("location_display", t) | text.contains_term("country_code", t)
        )
    if spec.seniority != ALL_LEVELS:
        conds.append(F.col("seniority") == F.lit(spec.seniority))
    if _term(spec.keyword):
        t = _term(spec.keyword)
        conds.append(
            F.col("title").isNotNull()
            & (
                text.contains_term("title", t) | text.contains_term("company", t)
                | text.contains_term(F.col("skills").cast("string"), t)
            )
        )
    conds.append(F.col("posted_date").between(start, end))
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def resolve_range(curated: DataFrame, posted, bounds: DataFrame | None = None) -> tuple[Column, Column]:
    """The inclusive date range of a spec. ``None`` is the default range, as a
    one-row subquery of the plan itself: nothing runs before the search does.
    It reads ``bounds`` (the row of :func:`date_bounds`, of published statistics)
    or, without them, ``curated`` once more."""
    if posted is None:
        bounds = (date_bounds(curated) if bounds is None else bounds).select(F.struct("default_start", "default_end").alias("bounds")).scalar()
        return bounds.getField("default_start"), bounds.getField("default_end")
    if isinstance(posted, (tuple, list)) and len(posted) == 2:
        return F.lit(posted[0]), F.lit(posted[1])
    return F.lit(posted), F.lit(posted)


def apply_search(curated: DataFrame, spec: SearchSpec, bounds: DataFrame | None = None) -> DataFrame:
    start, end = resolve_range(curated, spec.posted, bounds)
    return curated.where(search_condition(spec, start, end))


def headline_metrics(df: DataFrame) -> DataFrame:
    """One row ``(jobs, companies, countries, seniorities)``; the distinct
    counts include null as a value.

    Rows are counted for each combination of the three values first (map-side), and
    the combinations' values then: no row of the input is multiplied.
    """
    names = ("company", "country_code", "seniority")
    combos = df.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))
    each = F.array(*[F.struct(F.lit(i).alias("which"), F.col(c).cast("string").alias("value"), F.col("n").alias("n")) for i, c in enumerate(names)])
    values = combos.select(F.inline_outer(each)).groupBy("which", "value").agg(F.sum("n").alias("n"))
    return values.agg(
        F.coalesce(F.sum(F.when(F.col("which") == 0, F.col("n"))), F.lit(0)).alias("jobs"),
        *[F.count_if(F.col("which") == i).alias(name) for i, name in enumerate(("companies", "countries", "seniorities"))],
    )


# Statistics that are published with the marts, as a mart of its own: the values that
# the explorer offers and counts. They grow with the values, not the postings, and
# follow a merge by signed counts like any mart.
SEARCH_STATS = MartSpec("search_stats", FACETS, "jobs", order="key")


def published_facets(search_stats: DataFrame, names: Sequence[str] = FACETS) -> DataFrame:
    """:func:`facets` of the whole table, from its statistics."""
    return facets(search_stats, names)


def published_bounds(jobs_by_day: DataFrame, today: dt.date | None = None) -> DataFrame:
    """:func:`date_bounds` of the whole table, from its postings by day."""
    return date_bounds(jobs_by_day, today)


def published_metrics(search_stats: DataFrame, top_companies: DataFrame) -> DataFrame:
    """:func:`headline_metrics` of the whole table, from its statistics. Postings
    without company are those that the mart of companies does not count."""
    jobs = search_stats.agg(
        F.coalesce(F.sum("jobs"), F.lit(0)).alias("jobs"),
        F.size(F.collect_set(F.struct("country_code"))).cast("long").alias("countries"),
        F.size(F.collect_set(F.struct("seniority"))).cast("long").alias("seniorities"))
    named = top_companies.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("openings"), F.lit(0)).alias("openings"))
    row = named.select(F.struct("n", "openings").alias("c")).scalar()
    return jobs.select("jobs", (row.getField("n") + (F.col("jobs") > row.getField("openings")).cast("long")).alias("companies"),
                       "countries", "seniorities")


def listing(df: DataFrame, rows: int = DEFAULT_ROWS) -> DataFrame:
    """Top ``rows`` postings: newest date first (no date last), then country,
    company; source and id make the order total. Planned as
    ``TakeOrderedAndProject``: every task keeps its own top ``rows`` and only
    those reach the final merge."""
    return (
        df.orderBy(
            F.col("posted_date").desc_nulls_last(), F.col("country_code").asc_nulls_first(),
            F.col("company").asc_nulls_first(), F.col("source_name").asc_nulls_first(),
            F.col("source_id").asc_nulls_first(),
        )
        .limit(rows)
        .select(*LISTING_COLUMNS)
    )


def preview(mart: DataFrame, rows: int = PREVIEW_ROWS) -> DataFrame:
    """First ``rows`` rows of an ordered mart (its own order is kept)."""
    return mart.limit(rows)


def viewer(curated: DataFrame, rows: int = PREVIEW_ROWS) -> DataFrame:
    """Short look at the curated table: :data:`VIEWER_COLUMNS` of the first
    ``rows`` postings by key (a fixed order, so every call shows the same rows;
    a ``TakeOrderedAndProject``, not a sort of the table)."""
    return (
        curated.orderBy(F.col("source_name").asc_nulls_first(), F.col("source_id").asc_nulls_first())
        .limit(rows)
        .select(*VIEWER_COLUMNS)
    )
