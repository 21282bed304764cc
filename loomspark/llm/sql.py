"""DuckDB SQL for the queries that SQL can express on whole tables.

It can't express models (op3), merges (op4, op8), components (op7), nor the patterns that look behind
them that the added spans of op9 need; those are tested against brute force.
"""

from __future__ import annotations

from loomspark.llm import mixing, quality, urls

WORDS = r"'[^\x20\x09-\x0D]+'"
_DROPPED = "'" + quality.DROPPED.replace("'", "''") + "'"

OP1 = rf"""
with d as (select row_number() over () as rid, doc_id, source, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), {WORDS}) as ws from documents),
win as (select rid, i, count(*) over (partition by rid, list_slice(ws, i, i + 7)) as c from (select rid, ws, unnest(range(1, len(ws) - 6)) as i from d)),
cov as (select rid, count(distinct i + k) as n from win, range(8) r(k) where c > 1 group by rid),
l as (select rid, doc_id, source, text, unnest(string_split(text, chr(10))) as line from d),
lw as (select *, translate(lower(line), {_DROPPED}, '') as norm, len(regexp_extract_all(line, {WORDS})) as n from l where regexp_matches(line, {WORDS})),
dup as (select rid, count(*) - count(distinct line) as n from lw group by rid),
hosts as (select source, count(distinct text) as docs from lw group by source),
freq as (select lw.source, norm, count(distinct text) as n, min(doc_id) as first_id from lw group by all),
over as (select f.source, norm, first_id from freq f join hosts h on f.source is not distinct from h.source where n > {quality.MAX_DOCS} and n > least({quality.MAX_DOC_SHARE} * docs, {quality.ENOUGH_DOCS})),
gone as (select rid, sum(n) as n from lw join over o on lw.source is not distinct from o.source and lw.norm = o.norm where lw.doc_id is distinct from o.first_id group by rid),
x as (select d.*, len(ws) as n_words, coalesce(cov.n, 0) as n_repeat_words, coalesce(dup.n, 0) as n_dup_lines, cast(coalesce(gone.n, 0) as bigint) as removed,
      len(ws) < 20 or 100 * coalesce(cov.n, 0) > 30 * len(ws) as base_failed from d left join cov using (rid) left join dup using (rid) left join gone using (rid))
select doc_id, n_words, length(array_to_string(ws, '')) as word_chars, length(text) - length(translate(text, '#*$%&|<>', '')) as n_symbols, n_dup_lines, n_repeat_words, base_failed,
not base_failed and not (removed > 0 and (n_words - removed < {quality.MIN_WORDS} or n_words - removed < {quality.MIN_SHARE} * n_words)) as kept, removed as n_removed_words from x
"""

_SAYS = "'</s>[INST] ok [/INST]'"
_MARKED = r"length(regexp_replace({0}, '([<\[\\])', '\1|', 'g'))"
OP2 = rf"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations union all select -7, 0, 'user', {_SAYS} union all select -7, 1, 'assistant', {_SAYS}),
f as (select *, 8 + {_MARKED.format("role")} + length(role) - length(replace(role, chr(10), '')) + 1 + {_MARKED.format("text")} + 8 as size from c)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars, sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
cast(sum(size) as bigint) as formatted_chars from f group by conv_id
"""

OP5 = rf"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), {WORDS})) as size from documents),
s as (select source, cast(sum(size) as bigint) as source_size from d group by source),
w as (select *, [{", ".join(map(str, mixing.WEIGHTS))}][(row_number() over (order by source nulls last) - 1) % {len(mixing.WEIGHTS)} + 1] as w, source_size * {mixing.CAP} as cap from s),
o as (select *, cast((sum(source_size) over ()) - coalesce(sum(cap) over (order by cap / w, source nulls last rows between unbounded preceding and 1 preceding), 0) as double) as room,
      cast(sum(w) over (order by cap / w, source nulls last rows between current row and unbounded following) as double) as rest from w),
lev as (select arg_min(room / rest, struct_pack(a := cap / w, b := -rest)) filter (cap * rest >= room * w) as level from o),
g as (select source, source_size, least(cast(cap as double), coalesce(level, 0) * w) as target, cast(('0x' || left(md5(coalesce('{mixing.SEED}:' || source, '{mixing.SEED}')), 12)) as bigint) / {float(1 << 48)}::double as u from o, lev),
r as (select d.*, g.source_size, g.target, u, case when g.source_size = 0 then 0 else g.target / g.source_size end as e, row_number() over (partition by d.source order by size, doc_id nulls last) as k
      from d join g on d.source is not distinct from g.source)
select doc_id, size, source_size, target, cast(least(floor(k::double * e + u) - floor((k - 1)::double * e + u), {mixing.CAP}) * size as bigint) as taken from r
"""


#: Rounds that the SQL unrolls: 0.85**72 leaves eight millionths of all rank to move.
ROUNDS = 72


def _op6() -> str:
    fits = lambda r: f"(host = '{r.partition('/')[0]}' or ends_with(host, '.{r.partition('/')[0]}'))"
    longest = sorted(urls.RULES, key=lambda x: -len(x[1]))
    rule = lambda value: "case " + " ".join(
        f"when {fits(r)} and starts_with(path, '/{r.partition('/')[2]}') then '{r if value == 'rule' else k}'" for k, r in longest
    ) + " end"
    # What rules say of all urls of a host: rules from short to long; one for some paths takes away a verdict that it contradicts.
    every, n = "select *, cast(null as varchar) as v0 from targets", 0
    for kind, r in reversed(longest):
        some = f"when {fits(r)} and v{n} <> '{kind}' then null" if r.partition("/")[2] else f"when {fits(r)} then '{kind}'"
        every, n = f"select *, case {some} else v{n} end as v{n + 1} from ({every}) q{n}", n + 1
    link = urls.LINK.replace("'", "''")
    ranks = [f"r0 as (select kind, host, seed * {1 - urls.DAMPING} as rank from seeds)"]
    for k in range(1, ROUNDS + 1):
        ranks.append(f"""r{k} as (select kind, host, sum(rank) as rank from (select kind, host, seed * {1 - urls.DAMPING} as rank from seeds union all
        select e.kind, e.dst, r.rank * e.part * {urls.DAMPING} from edges e join r{k - 1} r on r.kind = e.kind and r.host = e.src) group by all)""")
    return rf"""
with p as materialized (select page_id, html, translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
  coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') as path from pages),
j as materialized (select *, {rule("rule")} as rule, {rule("verdict")} as verdict from p),
links as materialized (select src, dst, count(*) as n from (select host as src, translate(unnest(regexp_extract_all(html, '{link}', 1)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as dst from j) where src <> dst and src <> '' group by all),
both_ways as (select 'trust' as kind, src, dst, n from links union all select 'distrust', dst, src, n from links),
edges as materialized (select kind, src, dst, n / sum(n) over (partition by kind, src) as part from both_ways),
counted as (select host, case when count(*) filter (verdict = 'allow') > count(*) filter (verdict = 'block') then 'trust' when 2 * count(*) filter (verdict = 'block') > count(*) then 'distrust' end as kind from j where host <> '' group by host),
targets as (select distinct dst as host from links where dst not in (select host from counted)),
unseen as (select host, case v{n} when 'allow' then 'trust' when 'block' then 'distrust' end as kind from ({every}) t),
seeds as materialized (select kind, host, 1.0::double as seed from (select kind, host from counted union all select kind, host from unseen) where kind is not null),
{", ".join(ranks)},
final as materialized (select * from r{ROUNDS}),
totals as (select kind, n, mass from (select kind, count(*) as n from seeds group by kind) join (select kind, sum(rank) as mass from final group by kind) using (kind)),
bad as (select host from final join totals using (kind) group by host having coalesce(sum(rank / mass * n) filter (kind = 'distrust'), 0) >= {urls.MIN_SCORE}
  and coalesce(sum(rank / mass) filter (kind = 'distrust'), 0) > coalesce(sum(rank / mass) filter (kind = 'trust'), 0))
select page_id, j.host, path, rule, coalesce(verdict, case when bad.host is not null then 'block' end, 'allow') as verdict from j left join bad on bad.host = j.host
"""


OP10 = r"""
with d as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents),
g as (select doc_id, min(doc_id) over (partition by norm) as keep_id, count(*) over (partition by norm) as group_size, sha256(norm) as text_sha256 from d)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, text_sha256 from g
"""

ORACLE: dict[str, str] = {"op1_quality": OP1, "op2_chat": OP2, "op5_mixing": OP5, "op6_urls": _op6(), "op10_dedup": OP10}
