"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from cityweave.llm import line_dedup, mixing, topk, url_filter, warc
from cityweave.llm.rows import ASCII_UPPER

_LOWER = f"translate({{}}, '{ASCII_UPPER}', '{ASCII_UPPER.lower()}')"
_WORD = r"[^\x20\x09-\x0D]+"


def _url_filter() -> str:
    order = sorted(url_filter.RULES, key=lambda r: -(len(r[0]) + len(r[1])))
    fits = [
        (f"(host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}')", h + p, verdict) for h, p, verdict in order
    ]
    rule = " ".join(f"when {c} then '{r}'" for c, r, _ in fits)
    verdict = " ".join(f"when {c} then '{v}'" for c, _, v in fits)

    def hits(strict: bool, weighted: bool = False) -> str:
        terms = [(t, w if weighted else 1) for t, w in url_filter.VOCABULARY.items() if (w >= url_filter.LIMIT) == strict]
        return " + ".join(f"{n} * regexp_matches(low, '(^|[^a-z0-9]){t}($|[^a-z0-9])')::int" for t, n in terms)

    return f"""
with parts as (
  select page_id, {_LOWER.format("coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path,
    {_LOWER.format("coalesce(url, '')")} as low
  from pages),
counted as (select *, {hits(True)} as strict_hits, {hits(False)} as soft_hits,
  {hits(True, True)} + {hits(False, True)} as weight from parts)
select page_id, host, path, case {rule} end as rule, strict_hits, soft_hits, weight,
  case {verdict} when weight >= {url_filter.LIMIT} then 'block' else 'allow' end as verdict
from counted"""


def _mixing() -> str:
    weight = f"[{', '.join(map(str, mixing.WEIGHTS))}][1 + (row_number() over (order by source nulls last) - 1) % {len(mixing.WEIGHTS)}]"
    return rf"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::bigint as size from documents),
sources as (select source, sum(size)::bigint as source_size from sized group by source),
weighed as (select *, {weight} as weight, source_size * {mixing.CAP}::double as full_size,
  (sum(source_size) over ())::double * {mixing.BUDGET}::double as to_share from sources),
levels as (select *, row_number() over o as place,
  (to_share - coalesce(sum(full_size) over (o rows between unbounded preceding and 1 preceding), 0))
    / (sum(weight) over (o rows between current row and unbounded following))::double as level
  from weighed window o as (order by full_size / weight, source nulls last)),
opened as (select *, min(case when level * weight < full_size then place end) over () as first_open from levels),
leveled as (select *, max(case when place = first_open then level end) over () as water from opened),
targets as (select source, source_size,
  case when place >= first_open then least(water * weight, full_size) else full_size end as target,
  ('0x' || substr(md5('{mixing.SEED}:' || coalesce('s' || source, 'n')), 1, 4))::int / 65536.0::double as u from leveled),
placed as (select d.doc_id, d.size, t.source_size, t.target, t.u,
  case when t.source_size > 0 then t.target / t.source_size else 0 end as rate,
  row_number() over (partition by d.source order by d.size desc, d.doc_id) as place
  from sized d join targets t on d.source is not distinct from t.source)
select doc_id, size, source_size, target,
  ((floor(rate * place + u) - floor(rate * (place - 1) + u))::bigint * size)::bigint as taken from placed"""


def _topk() -> str:
    return f"""
with whole as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = len(embedding)),
scored as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
  from whole q, whole c where q.vec_id % {topk.EVERY} = 0 and q.vec_id <> c.vec_id)
select query_id, rank::int as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
where rank <= {topk.K}"""


def _line_dedup() -> str:
    bare = r"trim({}, ' ' || chr(9) || chr(13) || chr(11) || chr(12))"
    return f"""
with lined as (
  select doc_id, source, text, string_split(text, chr(10)) as lines from documents),
totals as (select source, count(distinct text) as pages from documents group by source),
held as (
  select distinct source, text, line from (select source, text, unnest(list_transform(lines, lambda x: {bare.format("x")})) as line from lined)
  where line <> ''),
listed as (
  select h.source, list(h.line) as boilerplate from (
    select source, line, count(*) as n from held group by source, line having count(*) >= {line_dedup.LEAST_PAGES}) h
  join totals t on h.source is not distinct from t.source
  where h.n > t.pages * {line_dedup.RATIO}::double group by h.source),
kept as (
  select l.*, case when b.boilerplate is null then lines
    else list_filter(lines, lambda x: {bare.format("x")} = '' or not list_contains(b.boilerplate, {bare.format("x")})) end as stays
  from lined l left join listed b on l.source is not distinct from b.source)
select doc_id, coalesce(len(lines), 0)::bigint as n_lines, coalesce(len(lines) - len(stays), 0)::bigint as n_dropped,
  case when text is null then null else array_to_string(stays, chr(10)) end as text from kept"""


def _warc() -> str:
    path = f"{_LOWER.format("regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1)")}"
    host = f"{_LOWER.format("regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)")}"
    return f"""
with hashed as (
  select page_id, url, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes, sha256(coalesce(html, '')) as payload_digest
  from pages),
first as (select *, case when payload_bytes >= {warc.LEAST_SHARED} then min(page_id) over (partition by payload_digest) end as f from hashed)
select page_id, payload_bytes, payload_digest,
  case when f is not null and page_id is distinct from f then 'revisit' else 'response' end as record_type,
  case when page_id is distinct from f then f end as refers_to,
  coalesce(array_to_string(list_reverse(string_split({host}, '.')), ',') || ')' || {path}, '') as url_key,
  strftime(timestamp '2024-01-01' + to_seconds(coalesce(page_id, 0) % 31536000), '%Y-%m-%dT%H:%M:%SZ') as captured
from first"""


def _exact_dedup() -> str:
    return """
with ranked as (
  select doc_id, coalesce(text, '') as whole, max(doc_id) over g as keep_id, count(*) over g as group_size,
    row_number() over (partition by coalesce(text, ''), doc_id) as place
  from documents window g as (partition by coalesce(text, '')))
select doc_id, keep_id, group_size::bigint as group_size, doc_id is not distinct from keep_id and place = 1 as kept,
  sha256(whole) as text_sha256
from ranked"""


LLM_ORACLES = {
    "op1_url_filter": _url_filter(),
    "op2_mixing": _mixing(),
    "op3_topk": _topk(),
    "op4_line_dedup": _line_dedup(),
    "op5_warc": _warc(),
    "op13_exact_dedup": _exact_dedup(),
}
