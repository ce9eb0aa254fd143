"""Oracle SQL text per registered query key (DuckDB dialect).

Order is not compared by the driver, so ``order by`` appears only where it
selects rows (top-k, preview); ordering itself is covered by unit tests.
"""
from __future__ import annotations

import datetime as dt

from postings_lake.operators import explore
from postings_lake.plans import registry as R
from postings_lake.plans.oracles import DOCUMENT_RE2, _q, curated_ctes, skills_list_sql, with_cur

_PAGES = """
pg as (
  select case when o_custkey % 17 = 0 then cast(null as varchar) else
      case o_custkey % 4 when 0 then 'gb' when 1 then 'de' when 2 then 'nl' else 'fr' end end as country,
    cast(o_orderkey % 1000 as bigint) as page,
    '2026-06-2' || cast((o_orderkey // 1000) % 3 as varchar) || 'T00:00:00Z' as run,
    o_orderkey % 1000 >= 700 + 50 * (o_custkey % 4) + 20 * ((o_orderkey // 1000) % 3) and o_orderkey % 7 = 0
      and o_orderkey % 101 <> 0 and o_orderkey % 103 <> 0 as empty,
    o_orderkey % 101 = 0 or o_orderkey % 103 = 0 as reject,
    o_orderkey, o_custkey, o_orderstatus
  from orders
)"""

_KEPT = f"""with {_PAGES},
first_empty as (
  select country, run, min(page) as fe from pg where empty and page between 1 and {R.ORACLE_MAX_PAGES} group by country, run
),
kept as (
  select pg.* from pg left join first_empty f on pg.country is not distinct from f.country and pg.run = f.run
  where page between 1 and {R.ORACLE_MAX_PAGES} and (fe is null or page < fe)
)"""


def _d(x: dt.date) -> str:
    return f"date '{x.isoformat()}'"


def _search_where(spec: explore.SearchSpec) -> str:
    conds = []
    if spec.countries:
        conds.append("country_code in (" + ", ".join(_q(c) for c in spec.countries) + ")")
    if spec.cities:
        conds.append("city in (" + ", ".join(_q(c) for c in spec.cities) + ")")
    like = lambda col, t: f"contains(lower(coalesce({col}, '')), {_q(t)})"
    if spec.role.strip():
        conds.append(like("title", spec.role.strip().lower()))
    if spec.location.strip():
        t = spec.location.strip().lower()
        conds.append("(" + " or ".join(like(c, t) for c in ("city", "region", "location_display", "country_code")) + ")")
    if spec.seniority != explore.ALL_LEVELS:
        conds.append(f"seniority = {_q(spec.seniority)}")
    if spec.keyword.strip():
        t = spec.keyword.strip().lower()
        skills_text = "'[' || array_to_string(skills, ', ') || ']'"
        conds.append(f"title is not null and ({like('title', t)} or {like('company', t)} or {like(skills_text, t)})")
    lo, hi = spec.posted
    conds.append(f"posted_date between {_d(lo)} and {_d(hi)}")
    return " and ".join(conds)


_SEARCH_COLS = ", ".join(R._SEARCH_COLS)

_FLAT19 = (
    "source_name, source_id, title, company, country_code, city, region, location_display, category, "
    "contract_time, seniority, posted_date, array_to_string(skills, ',') as skills, "
    "array_to_string(clouds, ',') as clouds, skill_count, salary_min, salary_max, redirect_url, ingested_at"
)

# Every mart's rows in one form: its keys as text, its order as two values.
_MARTS = {
    "skills_by_country": ("country_code", "skill", "select country_code, unnest(skills) as skill from cur", "skill is not null", "k1 asc nulls first, n desc"),
    "top_tools": ("skill", None, "select unnest(skills) as skill from cur where seniority = 'junior'", "skill is not null", "n desc"),
    "cloud_demand": ("country_code", "cloud", "select country_code, unnest(clouds) as cloud from cur", "cloud is not null", "k1 asc nulls first, n desc"),
    "jobs_by_day": ("posted_date", None, "select posted_date from cur", "posted_date is not null", "k1"),
    "top_companies": ("company", None, "select company from cur", "company is not null", "n desc"),
}
_MART_KEYS = ("country_code", "skill", "cloud", "posted_date", "company")


def _gold_sql() -> str:
    parts = []
    for name, (k1, k2, rows, cond, _) in _MARTS.items():
        cols = ", ".join(k if k in (k1, k2) else f"cast(null as {'date' if k == 'posted_date' else 'varchar'}) as {k}" for k in _MART_KEYS)
        parts.append(f"select '{name}' as mart, {cols}, count(*) as n from ({rows}) where {cond} group by all")
    return "\nunion all\n".join(parts)


def _previews_sql() -> str:
    parts = []
    for name, (k1, k2, rows, cond, order) in _MARTS.items():
        second = f"cast({k2} as varchar)" if k2 else "cast(null as varchar)"
        parts.append(f"""select '{name}' as mart,
  cast(row_number() over (order by {order}, k1 asc nulls first, k2 asc nulls first) as integer) as position,
  k1 as key_1, k2 as key_2, n, count(*) over () as mart_rows
from (select cast({k1} as varchar) as k1, {second} as k2, count(*) as n from ({rows}) where {cond} group by all)
qualify position <= {explore.PREVIEW_ROWS}""")
    return "\nunion all\n".join(parts)


_DOC_CUR = f"""with docs as (
  select source as source_name, cast(doc_id as varchar) as source_id, lower(trim(lang, ' ')) as country_code,
    {skills_list_sql("text", DOCUMENT_RE2)} as skills,
    row_number() over (partition by source, cast(doc_id as varchar) order by text nulls first) as rn
  from documents where doc_id is not null
)"""

ORACLES: dict[str, str] = {
    "landed_postings": f"""with {_PAGES}
select country, page, run as ingested_at, cast(o_orderkey as varchar) as source_id,
  'Role ' || o_orderstatus as title from pg where not empty and not reject
union all
select country, page, run, cast(null as varchar), 'no id' from pg where not empty and not reject""",
    "page_cutoff": _KEPT + "\nselect country, page, run as ingested_at, case when empty or reject then 0 else 2 end as n_results from kept",
    "page_rejects": f"""with {_PAGES}
select country, page, case when o_orderkey % 101 = 0 then '{{not json' else '{{"results":[{{"id":1,"company":"a text"}}]}}' end as body,
  run as ingested_at from pg where reject""",
    "flatten_posting": f"""with {_PAGES}, kept as (select * from pg where not empty and not reject)
select 'adzuna' as source_name, cast(o_orderkey as varchar) as source_id, 'Role ' || o_orderstatus as title,
  case when o_custkey % 5 in (0, 1) then cast(null as varchar) else 'C' || cast(o_custkey as varchar) end as company,
  country as country_code, 'L' as location_display,
  case when o_custkey % 3 = 2 then 'BE' end as region,
  case o_custkey % 3 when 0 then cast(null as varchar) when 1 then 'DE' else 'Berlin' end as city,
  cast(null as varchar) as category, cast(null as varchar) as contract_time,
  case o_custkey % 3 when 0 then 45000.0 when 1 then 45000.5 end::double as salary_min,
  cast(null as double) as salary_max, cast(null as varchar) as created, cast(null as varchar) as description,
  cast(null as varchar) as redirect_url, run as ingested_at
from kept
union all
select 'adzuna', cast(null as varchar), 'no id', null, country, null, null, null, null, null,
  cast(null as double), cast(null as double), null, null, null, run
from kept""",
    "newest_per_key": "with " + curated_ctes() + "\nselect * from newest",
    "normalize": "with " + curated_ctes() + "\nselect source_name, source_id, title, company, country_code from norm",
    "posted_date": "with " + curated_ctes() + "\nselect source_name, source_id, created, posted_date from enriched",
    "seniority": with_cur("select source_name, source_id, title, seniority from cur"),
    "skills": with_cur("select source_name, source_id, array_to_string(skills, ',') as skills from cur"),
    "skill_count": with_cur("select source_name, source_id, skill_count from cur"),
    "clouds": with_cur("select source_name, source_id, array_to_string(clouds, ',') as clouds from cur"),
    "silver": with_cur(f"select {_FLAT19} from cur"),
    "silver_incremental": with_cur(f"select {_FLAT19} from cur"),
    "gold_all": with_cur(_gold_sql()),
    "gold_incremental": with_cur(_gold_sql()),
    "mart_previews": with_cur(_previews_sql()),
    "skills_by_country": with_cur(
        "select country_code, skill, count(*) as mentions from (select country_code, unnest(skills) as skill from cur) "
        "where skill is not null group by country_code, skill"
    ),
    "top_tools": with_cur(
        "select skill, count(*) as junior_mentions from (select unnest(skills) as skill from cur where seniority = 'junior') "
        "where skill is not null group by skill"
    ),
    "cloud_demand": with_cur(
        "select country_code, cloud, count(*) as mentions from (select country_code, unnest(clouds) as cloud from cur) "
        "where cloud is not null group by country_code, cloud"
    ),
    "jobs_by_day": with_cur(
        "select posted_date, count(*) as jobs_posted from cur where posted_date is not null group by posted_date"
    ),
    "top_companies": with_cur(
        "select company, count(*) as openings from cur where company is not null group by company"
    ),
    "quality_metrics": with_cur("""select total, null_ids, distinct_ids, total - distinct_ids as duplicate_ids,
  missing_companies, null_dates, empty_skills,
  case when total > 0 then null_dates / total end as null_date_ratio,
  case when total > 0 then empty_skills / total end as empty_skill_ratio
from (select count(*) as total,
  count(*) filter (where source_id is null) as null_ids,
  (select count(*) from (select distinct source_id from cur)) as distinct_ids,
  count(*) filter (where company is null or trim(company, ' ') = '') as missing_companies,
  count(*) filter (where posted_date is null) as null_dates,
  count(*) filter (where len(skills) = 0) as empty_skills
  from cur)"""),
}


def _checks_sql(distinct_sql: str, null_sql: str) -> str:
    return with_cur(f"""
, m as (
  select count(*) as total,
    count(*) filter (where {null_sql}) as null_ids,
    ({distinct_sql}) as distinct_ids,
    count(*) filter (where company is null or trim(company, ' ') = '') as missing_companies,
    count(*) filter (where posted_date is null) as null_dates,
    count(*) filter (where len(skills) = 0) as empty_skills
  from cur
)
select 'non_empty' as name, 'error' as severity, total > 0 as passed from m
union all select 'source_id_not_null', 'error', null_ids = 0 from m where total > 0
union all select 'source_id_unique', 'error', total - distinct_ids = 0 from m where total > 0
union all select 'company_present', 'warn', missing_companies = 0 from m where total > 0
union all select 'posted_date_parseable', 'error', null_dates / total <= 0.20 from m where total > 0
union all select 'skills_extracted', 'warn', empty_skills / total <= 0.50 from m where total > 0""").replace(
        ")\n\n, m as", "),\nm as"
    )


ORACLES.update({
    "quality_checks": _checks_sql("select count(*) from (select distinct source_id from cur)", "source_id is null"),
    "quality_checks_source_key": _checks_sql(
        "select count(*) from (select distinct source_name, source_id from cur)",
        "source_name is null or source_id is null",
    ),
    "facets": with_cur("""select 'country_code' as facet, country_code as value from cur where country_code is not null
union select 'seniority', seniority from cur where seniority is not null
union select 'city', city from cur where city is not null and trim(city, ' ') <> ''"""),
    "date_bounds": with_cur("""select min_date, max_date,
  greatest(min_date, cast(date_trunc('month', max_date) as date)) as default_start, max_date as default_end
from (select min(posted_date) as min_date, max(posted_date) as max_date from cur where posted_date is not null)"""),
    "explore_filter": with_cur(f"select {_SEARCH_COLS} from cur where {_search_where(R.FILTER_SPEC)}"),
    "explore_keyword": with_cur(f"select {_SEARCH_COLS} from cur where {_search_where(R.KEYWORD_SPEC)}"),
    "explore_default_range": with_cur(f"""select {_SEARCH_COLS} from cur, (
  select greatest(min(posted_date), cast(date_trunc('month', max(posted_date)) as date)) as lo, max(posted_date) as hi from cur)
where posted_date between lo and hi"""),
    "explore_metrics": with_cur(f""", f as (select * from cur where {_search_where(R.METRICS_SPEC)})
select (select count(*) from f) as jobs,
  (select count(*) from (select distinct company from f)) as companies,
  (select count(*) from (select distinct country_code from f)) as countries,
  (select count(*) from (select distinct seniority from f)) as seniorities""").replace(")\n, f as", "),\nf as"),
    "explore_listing": with_cur(f"""select title, company, country_code, city, seniority, posted_date,
  array_to_string(skills, ',') as skills, salary_min, salary_max, redirect_url
from cur where {_search_where(R.LISTING_SPEC)}
order by posted_date desc nulls last, country_code asc nulls first, company asc nulls first,
  source_name asc nulls first, source_id asc nulls first
limit {explore.DEFAULT_ROWS}"""),
    "mart_preview": with_cur(f"""select company, count(*) as openings from cur where company is not null
group by company order by openings desc, company asc nulls first limit {explore.PREVIEW_ROWS}"""),
    "silver_viewer": with_cur(f"""select title, company, country_code, city, seniority,
  array_to_string(skills, ',') as skills, salary_min, salary_max
from cur order by source_name asc nulls first, source_id asc nulls first limit {explore.PREVIEW_ROWS}"""),
    "document_skills": f"""select doc_id, lang,
  array_to_string({skills_list_sql("text", DOCUMENT_RE2)}, ',') as skills from documents""",
    "document_skills_by_lang": _DOC_CUR + """
select country_code, skill, count(*) as mentions
from (select country_code, unnest(skills) as skill from docs where rn = 1)
where skill is not null group by country_code, skill""",
    "newest_events": """select event_id, ts, user_id, event_type, value, props from (
  select *, row_number() over (partition by event_type, user_id
    order by ts desc nulls last, event_id asc nulls first, value asc nulls first, props asc nulls first) as rn
  from events) where rn = 1""",
})

ORACLES.update({
    "flow_silver": ORACLES["silver"],
    "flow_gold": ORACLES["gold_all"],
    "explore_published": ORACLES["explore_default_range"],
    "metrics_published": with_cur("""select (select count(*) from cur) as jobs,
  (select count(*) from (select distinct company from cur)) as companies,
  (select count(*) from (select distinct country_code from cur)) as countries,
  (select count(*) from (select distinct seniority from cur)) as seniorities"""),
    "document_skills_joined": ORACLES["document_skills"],
})
