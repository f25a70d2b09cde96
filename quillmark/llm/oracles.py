"""DuckDB SQL for the queries that SQL can express, over the same tables."""

from __future__ import annotations

#: The walks as the sums of their damped steps, 120 of them; every edge of the given tables is one between a host and its domain.
OP2 = r"""
with recursive urls as (
  select page_id, coalesce(lower(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's')), '') as host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path
  from pages),
rules(rule, verdict, domain, start) as (values
  ('com/en/', 'block', 'com', '/en/'), ('example.com/en/7', 'allow', 'example.com', '/en/7'),
  ('net/de/', 'block', 'net', '/de/'), ('example.net/de/8', 'block', 'example.net', '/de/8'),
  ('org/es/', 'block', 'org', '/es/')),
judged as (
  select u.*, r.rule, r.verdict,
         row_number() over (partition by u.page_id, u.host, u.path order by length(r.rule) desc, r.rule) as nth
  from urls u left join rules r on (u.host = r.domain or u.host like '%.' || r.domain) and starts_with(u.path, r.start)),
one as (select * from judged where nth = 1),
seeds as (
  select host, avg((verdict is not distinct from 'allow')::int) as trust, avg((verdict is not distinct from 'block')::int) as distrust
  from one where host <> '' group by host),
links as (
  select u.host as from_host, lower(regexp_extract(t, '//([^/?#]*)', 1)) as to_host
  from (select coalesce(lower(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's')), '') as host,
               unnest(regexp_extract_all(html, '(?i)\bhref\s*=\s*["'']?\s*((?:[a-z][a-z0-9+.\-]*:)?//[^"''\s>]*)', 1)) as t from pages) u),
parents as (
  select distinct host, parent from (select host, regexp_extract(host, '^[^.:@\[\]]+\.([^.:@\[\]]+\.[^:@\[\]]+)$', 1) as parent from seeds)
  where not regexp_matches(parent, '^(ac|co|com|edu|gob|gouv|gov|go|gv|id|info|mil|ne|net|nom|or|org|sch)\.[a-z]{2}$') and not regexp_matches(host, '^[0-9.]+$')
    and parent not in ('appspot.com', 'azurewebsites.net', 'blogspot.com', 'cloudfront.net', 'github.io', 'gitlab.io', 'herokuapp.com', 'netlify.app', 'pages.dev', 's3.amazonaws.com', 'tumblr.com', 'vercel.app', 'web.app', 'weebly.com', 'wixsite.com', 'wordpress.com')),
edges as (
  select from_host, to_host, sum(n) as n from (
    select from_host, to_host, count(*) as n from links where from_host <> '' and to_host <> '' and from_host <> to_host group by all
    union all select host, parent, 1 from parents where parent <> ''
    union all select parent, host, 1 from parents where parent <> '') group by all),
walks as (
  select walk, host, next, n / sum(n) over (partition by walk, host) as share from (
    select 'trust' as walk, from_host as host, to_host as next, n from edges
    union all select 'distrust', to_host, from_host, n from edges)),
steps as (
  select 0 as i, 'trust' as walk, host, 0.15 * trust / sum(trust) over () as score from seeds where trust > 0
  union all select 0, 'distrust', host, 0.15 * distrust / sum(distrust) over () from seeds where distrust > 0
  union all
  select s.i + 1, s.walk, w.next, sum(s.score * w.share * 0.85) from steps s join walks w using (walk, host) where s.i < 120 group by s.i, s.walk, w.next),
scores as (
  select host, coalesce(sum(score) filter (walk = 'trust') / any_value(t), 0) as trust, coalesce(sum(score) filter (walk = 'distrust') / any_value(d), 0) as distrust
  from steps, (select sum(score) filter (walk = 'trust') as t, sum(score) filter (walk = 'distrust') as d from steps) group by host),
hosts as (select host, distrust * (select count(*) from seeds) > 1 and distrust > trust as suspect from scores)
select o.page_id, o.host, o.path, o.rule, coalesce(o.verdict, case when h.suspect then 'block' else 'allow' end) as verdict
from one o left join hosts h using (host)
"""

#: Every turn of the given tables is plain, so each user turn is the call and the turn after it the result.
OP1 = r"""
with t as (select conv_id, turn, role, coalesce(text, '') as text from conversations),
calls as (select conv_id, turn, 'turn-' || turn as call_id, text from t where role = 'user'),
results as (select conv_id, 'turn-' || (turn - 1) as call_id, turn as t, text as c, count(*) as copies from t where role <> 'user' and turn is not null group by all),
firsts as (select conv_id, call_id, min({'t': t, 'c': c}) as r, sum(copies)::bigint as n from results group by all),
linked as (select distinct conv_id, call_id from calls),
made as (
  select c.conv_id, c.turn, c.call_id, 'respond' as name, coalesce(f.n, 0) as n_results, f.r.t as result_turn,
         case when not regexp_matches(c.text, '[^ \t\n\x0B\f\r]') then 'invalid text' else '' end as faults,
         '{"arguments":{"text":' || to_json(c.text) || '},"id":' || to_json(c.call_id) || ',"name":"respond"' || case when f.r is null then '' else ',"result":' || to_json(f.r.c) end || '}' as canonical
  from calls c left join firsts f using (conv_id, call_id)),
rest as (
  select r.conv_id, r.t as turn, r.call_id, null as name, f.n as n_results, r.t as result_turn,
         case when l.call_id is null then 'no call' else 'surplus result' end as faults,
         '{"id":' || to_json(r.call_id) || ',"result":' || to_json(r.c) || '}' as canonical,
         r.copies - (case when l.call_id is not null and r.t = f.r.t and r.c = f.r.c then 1 else 0 end) as copies
  from results r join firsts f using (conv_id, call_id) left join linked l using (conv_id, call_id)),
other as (
  select conv_id, turn, null as call_id, null as name, 0 as n_results, null as result_turn, 'neither call nor result' as faults,
         '{"content":' || to_json(text) || case when role is null then '' else ',"role":' || to_json(role) end || '}' as canonical
  from t where role is null or (role <> 'user' and turn is null))
select conv_id, 0 as level, turn, 0 as ordinal, call_id, name, n_results, result_turn, faults, canonical from (
  select * from made union all select conv_id, turn, call_id, name, n_results, result_turn, faults, canonical from rest, unnest(generate_series(1, copies))
  union all select * from other)
"""

OP3 = r"""
with recursive w as (
  select row_number() over () as rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (
  select distinct rid, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as sh from w),
sets as (select rid, count(*) as n, md5(string_agg(sh, '|' order by sh)) as node from s group by rid),
nodes as (select node, any_value(n) as n, min(doc_id) as rep, min(rid) as rid from sets join w using (rid) group by node),
own as (select node, sh from s join nodes using (rid)),
pairs as (
  select x, y from (select a.node as x, b.node as y, count(*) as c from own a join own b on a.sh = b.sh and a.node < b.node group by all) p
  join nodes a on a.node = x join nodes b on b.node = y where 100 * c >= 80 * (a.n + b.n - c)),
edges as (select x, y from pairs union all select y, x from pairs),
reach as (select distinct x, x as y from edges union select r.x, e.y from reach r join edges e on r.y = e.x),
least as (select x as node, min(rep) as component_id from reach join nodes on y = node group by x),
degree as (select x as node, count(*) as n_links from edges group by x)
select w.doc_id, coalesce(t.n, 0) as n_shingles, coalesce(l.component_id, k.rep, w.doc_id) as component_id, coalesce(d.n_links, 0) as n_links
from w left join sets t using (rid) left join nodes k using (node) left join least l using (node) left join degree d using (node)
"""


def _divergence() -> str:
    classes = {"low": r"\p{Ll}", "space": r"[\x20\x09-\x0D]", "up": r"\p{Lu}", "digit": r"\p{Nd}", "mark": r"[.,;:!?''\"()\-]", "other": r"\p{Lo}", "joined": r"\p{M}"}
    size = lambda p: f"length(t) - length(regexp_replace(t, '{p}+', '', 'g'))"
    shares = lambda h: f"list_transform({h}, lambda x: case when list_sum({h}) > 0 then x / list_sum({h})::double else 0.0 end)"
    part = lambda x, m: f"case when {x} > 0 and {m} > 0 then {x} * log2({x} / {m}) else 0.0 end"
    js = lambda p, q: f"sqrt(greatest(0.0, list_sum(list_transform(list_zip({p}, {q}), lambda z: {part('z[1]', '((z[1] + z[2]) / 2)')} + {part('z[2]', '((z[1] + z[2]) / 2)')})) / 2))"
    return rf"""
with known as (select lang from documents where lang is not null group by lang having count(*) >= 20 order by count(*) desc, lang limit 1000),
counted as (
  select lang, word, count(*) as n from (
    select lang, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')) as word from documents semi join known using (lang)) group by all),
lists as (select lang, list(word order by n desc, word) as list from (select *, row_number() over (partition by lang order by n desc, word) as r from counted) where r <= 16 group by lang),
w as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as t, l.lang as ref, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w, list
  from documents left join lists l using (lang)),
lines as (
  select rid, count(*) - count(distinct line) as n_dup_lines from (select rid, unnest(string_split(t, chr(10))) as line from w) where regexp_matches(line, '[^\x20\x09-\x0D]') group by rid),
windows as (
  select rid, i, count(*) over (partition by rid, win) as times from (select rid, i, array_to_string(w[i:i + 7], ' ') as win from w, unnest(range(1, len(w) - 6)) as u(i))),
repeats as (select rid, count(distinct i + j) as n_repeat_words from windows, unnest(range(0, 8)) as u(j) where times > 1 group by rid),
s as (
  select w.rid, doc_id, ref, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
         {", ".join(f"{size(p)} as {c}" for c, p in classes.items())}, length(t) as n_chars,
         list_transform(coalesce(list, []), lambda x: len(list_filter(w, lambda y: y = x or (x[1] between 'a' and 'z' and y = upper(x[1]) || x[2:])))) as listed
  from w left join lines using (rid) left join repeats using (rid)),
h as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
         {shares("[low, space, up, digit, mark, other, joined, n_chars - low - space - up - digit - mark - other - joined]")} as chars,
         {shares("list_append(listed, n_words - coalesce(list_sum(listed), 0))")} as words from s),
sums as (
  select ref, kind, i, sum(v) as v from (
    select ref, 'chars' as kind, i, chars[i] as v from h, unnest(range(1, 9)) as u(i) where n_words >= 20 and ref is not null
    union all select ref, 'words', i, coalesce(words[i], 0) from h, unnest(range(1, 18)) as u(i) where n_words >= 20 and ref is not null) group by all),
refs as (select ref, list(v order by i) filter (kind = 'chars') as rc, list(v order by i) filter (kind = 'words') as rw from sums where ref in (select ref from h where n_words >= 20 group by ref having count(*) >= 20) group by ref),
padded as (
  select h.*, {shares("rc")} as rc, {shares("rw")} as rw, list_concat(words, list_transform(range(0, 17 - len(words)), lambda x: 0.0)) as longer
  from h left join refs using (ref)),
d as (
  select *, case when n_words >= 20 and rc is not null then {js("chars", "rc")} end as dc, case when n_words >= 50 and rw is not null then {js("longer", "rw")} end as dw from padded)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and coalesce(dc <= 0.2 + 0.6 / sqrt(n_words), true) and coalesce(dw <= 0.25 + 0.6 / sqrt(n_words), true) as kept
from d
"""


OP11 = r"""
with u as (
  select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as u, sha256('42:' || coalesce(doc_id::varchar, '')) as h from documents),
d as (
  select doc_id, t, u, len(u)::bigint as n, [('0x' || substr(h, 1, 8))::bigint, ('0x' || substr(h, 9, 8))::bigint, ('0x' || substr(h, 17, 8))::bigint, ('0x' || substr(h, 25, 8))::bigint] as h from u),
c as (
  select doc_id, t, u, n, least(h[1] % (n + 1), h[2] % (n + 1)) as a, greatest(h[1] % (n + 1), h[2] % (n + 1)) as b,
         case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h[3] % 100 >= 50 then 'plain' when h[4] % 100 < 80 then 'spm' else 'psm' end as form from d),
p as (
  select doc_id, t, n, form, array_to_string(u[1:a], '') as prefix, array_to_string(u[a + 1:b], '') as middle, array_to_string(u[b + 1:], '') as suffix from c)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars, case when form <> 'plain' then length(middle) end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(t) as restored_sha256
from p
"""

OP12 = r"""
with w as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents)
select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
       row_number() over (partition by t order by doc_id desc nulls last) = 1 as kept, sha256(t) as text_sha256
from w
"""


ORACLES: dict[str, str] = {"op1_chat_formatting": OP1, "op2_url_filters": OP2, "op3_ngram_jaccard": OP3, "op8_distribution_divergence": _divergence(), "op11_fill_middle": OP11, "op12_exact_dedup": OP12}
