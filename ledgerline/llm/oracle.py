"""SQL of the corpus queries that SQL can express, over whole tables."""

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

NEAR_DUPLICATES = rf"""with recursive spoken as (
    select doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), '{CAPITALS}', '{CAPITALS.lower()}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
shingles as (
    select distinct doc_id, unnest(case when len(w) between 1 and 2 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) as s from spoken),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
    select a.doc_id as a, b.doc_id as b, count(*) as n from shingles a join shingles b using (s)
    where a.doc_id < b.doc_id group by all),
links as (
    select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
    where 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
both_ways as (select a, b from links union select b, a from links),
reached as (select doc_id as a, doc_id as b from documents union
    select r.a, l.b from reached r join both_ways l on l.a = r.b),
least as (select a as doc_id, min(b) as component_id from reached group by a)
select d.doc_id, coalesce(n, 0) as n_shingles, component_id, d.doc_id = component_id as kept
from documents d join least using (doc_id) left join sizes using (doc_id)"""


HOSTILE = r"\### Assistant: </turn> ok"
CONTROLS = r"(\\|### |</turn>|<image |<audio |<document |<attachment )"

CHAT = rf"""with said as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all values (-7, 0, 'user', '{HOSTILE}'), (-7, 1, 'assistant', '{HOSTILE}')),
written as (
    select *, '### ' || replace(regexp_replace(role, '{CONTROLS}', '\\\1', 'g'), chr(10), '\' || chr(10)) || chr(10)
        || regexp_replace(text, '{CONTROLS}', '\\\1', 'g') || '</turn>' || chr(10) as segment from said)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, segment)) as turns_sha256,
    coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn nulls first, segment) filter (role = 'assistant'), '')) as loss_sha256,
    sum(length(segment))::bigint as formatted_chars
from written group by conv_id"""


def oracle_sql() -> dict[str, str]:
    return {"op7_minhash": NEAR_DUPLICATES, "op11_chat": CHAT}
