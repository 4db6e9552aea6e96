"""SQL for the queries that SQL can express, for DuckDB.

Operators with hashes, merges or models of their own have none; tests compare them with plain versions.
"""

from __future__ import annotations

_SPACE = r"[^\x20\x09-\x0D]+"

URL_FILTER = r"""
with parts as (
  select page_id, url,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path,
         regexp_extract(url, '(?s)^[^?#]*\?([^#]*)', 1) as query
  from pages),
cleaned as (
  select *, regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '')
            || regexp_replace(path, '(\.html?|/+)$', '') as place,
         regexp_replace(regexp_replace(coalesce(query, ''), '(^|&)(utm_[^&]*|ref=[^&]*)', '', 'g'), '^&', '') as asked
  from parts),
canon as (
  select *, case when host <> '' then place || case when asked <> '' then '?' || asked else '' end end as canonical from cleaned),
listed as (
  select distinct canonical from canon
  where regexp_matches(host, '(^|\.)(cheap-pills|spam-farm|casino-win|ads-track|adult-x|free-bets)\.')),
rules(rule_host, rule_path, rule_verdict) as (
  values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
         ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits as (
  select page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule,
         arg_max(rule_verdict, length(rule_host || rule_path)) as rule_verdict
  from canon join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
  group by page_id)
select c.page_id, c.host, c.path, f.rule,
       coalesce(f.rule_verdict, case when l.canonical is not null then 'block' else 'allow' end) as verdict
from canon c left join fits f on f.page_id = c.page_id left join listed l on l.canonical = c.canonical
"""

CHAT_FORMAT = r"""
with given as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -1, n, role, '<|im_end|><|im_start|>assistant ok' from (values (0, 'user'), (1, 'assistant')) as x(n, role)),
turns as (
  select *, case when conv_id is null then row_number() over () else 0 end as lone,
         length(role) + len(regexp_extract_all(role, '[\\\n]')) + len(regexp_extract_all(role, '<\\*\|')) as role_length,
         length(text) + len(regexp_extract_all(text, '<\\*\|')) as text_length
  from given),
said as (
  select conv_id, count(*) as n_turns,
         string_agg(role || chr(10) || text || chr(10), '' order by turn nulls last, role, text) as turns,
         coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn nulls last, role, text), '') as learned,
         sum(length('<|im_start|>') + role_length + 1 + text_length + length('<|im_end|>') + 1) as formatted_chars
  from turns group by conv_id, lone)
select conv_id, cast(n_turns as bigint) as n_turns, sha256(turns) as turns_sha256, cast(length(learned) as bigint) as loss_chars,
       sha256(learned) as loss_sha256, cast(formatted_chars as bigint) as formatted_chars
from said
"""

FILTER_AUDIT = r"""
with texts as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
         min(doc_id) over (partition by coalesce(text, '')) as least
  from documents),
masks as (
  select doc_id, part,
         case when len(words) < 50 then 1 else 0 end
         + case when 100 * len(list_distinct(words)) < 65 * len(words) then 2 else 0 end
         + case when 100 * len(regexp_extract_all(text, '[A-Z]')) > 5 * length(text) then 4 else 0 end
         + case when regexp_matches(text, '[#$%&*|]') then 8 else 0 end
         + case when least < doc_id or (doc_id is null and least is not null) then 16 else 0 end as mask
  from texts),
known as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels group by doc_id),
counts as (
  select part, mask, count(*) as n, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic
  from masks left join known on known.doc_id = masks.doc_id group by part, mask),
bits(b, letter) as (values (1, 'A'), (2, 'B'), (4, 'C'), (8, 'D'), (16, 'E')),
orders as (  -- five powers of two up to 16 add up to 31 only if they all differ
  select a.letter || b.letter || c.letter || d.letter || e.letter as filter_order, [a.b, b.b, c.b, d.b, e.b] as bs
  from bits a, bits b, bits c, bits d, bits e where a.b + b.b + c.b + d.b + e.b = 31),
steps as (
  select filter_order, step, bs[step] as own, coalesce(list_sum(bs[1:step - 1]), 0) as before
  from orders, (values (1), (2), (3), (4), (5)) as s(step))
select part, filter_order, cast(step as integer) as step,
       cast(sum(case when mask & cast(before + own as integer) = 0 then n else 0 end) as bigint) as kept,
       cast(sum(case when mask & cast(before as integer) = 0 and mask & own <> 0 then n else 0 end) as bigint) as removed,
       cast(sum(case when mask & cast(before as integer) <> 0 and mask & own <> 0 then n else 0 end) as bigint) as redundant,
       cast(sum(case when mask = own then n else 0 end) as bigint) as unique_fails,
       cast(sum(case when mask & cast(before as integer) = 0 and mask & own <> 0 then good else 0 end) as bigint) as good_lost,
       cast(sum(case when mask & cast(before as integer) = 0 and mask & own <> 0 then toxic else 0 end) as bigint) as toxic_lost,
       cast(sum(case when mask & own <> 0 then n * 120 // bit_count(mask) else 0 end) as bigint) as shapley
from counts, steps group by part, filter_order, step
"""

ORACLE = {"op10_url_filter": URL_FILTER, "op11_chat_format": CHAT_FORMAT, "op12_filter_audit": FILTER_AUDIT}
