"""DuckDB twins of the queries that SQL can express; the others are tested
against brute force in ``tests/llm``."""

_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATE = f"""
with dw as (select doc_id, coalesce({_WORDS}, []) as w from documents),
iw as (select cast(item_id as varchar) as item, {_WORDS} as w from benchmark where text is not null),
wins as (
  select distinct item, n, array_to_string(w[i:i + n - 1], ' ') as g
  from (select item, w, least(13, len(w)) as n, unnest(range(1, len(w) - least(13, len(w)) + 2)) as i from iw where len(w) > 0)
),
sizes as (select distinct n from wins),
dg as (
  select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as g
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from dw, sizes where len(w) >= n)
),
hit as (select doc_id, i, dg.n as n, item from dg join wins on dg.g = wins.g and dg.n = wins.n),
words as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hit) group by doc_id),
items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, item from hit) group by doc_id
)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from dw left join words using (doc_id) left join items using (doc_id)"""

_ESCAPED = "replace(replace(replace({0}, '~', '~0'), '<', '~1'), '|', '~2')"

CHAT = f"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
f as (
  select *, length({_ESCAPED.format('role')}) + 4 + 4 + length(
    case when contains(text, '</s>') or regexp_matches(text, '~[012]') then {_ESCAPED.format('text')} else text end) as n
  from t
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(n) as bigint) as formatted_chars
from f group by conv_id"""

_DRAW = "cast('0x' || substr(d, {0}, 8) as bigint)"

FILL_MIDDLE = f"""
with t as (
  select doc_id, coalesce(text, '') as x, length(coalesce(text, '')) as n, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as d
  from documents
),
h as (select *, {_DRAW.format(1)} % (n + 1) as c1, {_DRAW.format(9)} % (n + 1) as c2, {_DRAW.format(17)} as h3, {_DRAW.format(25)} as h4 from t),
f as (
  select *, least(c1, c2) as a, greatest(c1, c2) as b,
    case when x = '' or contains(x, '<P>') or contains(x, '<S>') or contains(x, '<M>') or h3 % 100 >= 90 then 'plain'
      when h4 % 100 < 20 then 'spm' else 'psm' end as form
  from h
),
p as (select *, substr(x, 1, a) as pre, substr(x, a + 1, b - a) as mid, substr(x, b + 1) as suf from f)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
  sha256(case form when 'plain' then x when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
    else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
  sha256(x) as restored_sha256
from p"""

HARD_NEGATIVES = """
with u as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    [floor(256 * cast(x as double)) for x in embedding] as q
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len([1 for x in embedding if x is null or not isfinite(x)]) = 0
),
r as (select vec_id, label, q from u qualify row_number() over (partition by vec_id order by label, q) = 1),
s as (
  select a.vec_id as anchor_id, a.label as own, r.vec_id, r.label, cast(list_inner_product(a.q, r.q) as bigint) as score
  from r as a join r on a.vec_id % 100 = 0 and a.vec_id <> r.vec_id and len(a.q) = len(r.q)
),
p as (
  select anchor_id, own, vec_id as positive_id, score as positive_score from s where label = own
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
),
n as (
  select p.anchor_id, positive_id, positive_score, vec_id as negative_id, score as negative_score,
    row_number() over (partition by p.anchor_id, positive_id order by score desc, vec_id) as rank
  from p join s on s.anchor_id = p.anchor_id and s.label <> p.own
    and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from n where rank <= 5"""

ORACLES: dict[str, str] = {"op3_decontaminate": DECONTAMINATE, "op7_chat": CHAT, "op11_hardneg": HARD_NEGATIVES, "op12_fillmiddle": FILL_MIDDLE}
