"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import bpe, decontaminate, langid, lm, secrets, shards, simhash, spotsigs, warc, wrapper

QUERIES = {
    "op1_spotsigs": spotsigs.query,
    "op2_language": langid.query,
    "op3_simhash": simhash.query,
    "op4_decontaminate": decontaminate.query,
    "op5_bpe": bpe.query,
    "op6_warc": warc.query,
    "op7_wrapper": wrapper.query,
    "op8_logbilinear": lm.query,
    "op9_secrets": secrets.query,
    "op10_shards": shards.query,
}

#: Only what SQL can express of a contract's rows in full; the others are held
#: against brute force in tests/llm.
SQL = {
    "op4_decontaminate": r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
i as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
n as (select item_id, w, least(13, len(w)) as k from i where len(w) > 0),
win as (
  select item_id, k, array_to_string(w[p : p + k - 1], ' ') as s
  from (select item_id, w, k, unnest(range(1, len(w) - k + 2)) as p from n)),
sizes as (select distinct k from win),
dw as (
  select doc_id, p, k, array_to_string(w[p : p + k - 1], ' ') as s
  from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as p from d, sizes where len(w) >= k)),
m as (select dw.doc_id, dw.p, dw.k, win.item_id from dw join win on dw.k = win.k and dw.s = win.s),
h as (select doc_id, count(distinct q) as n_hit from (select doc_id, unnest(range(p, p + k)) as q from m) group by 1),
t as (
  select doc_id, count(*) as n_items, sha256(string_agg(cast(item_id as varchar), ',' order by cast(item_id as varchar))) as s
  from (select distinct doc_id, item_id from m) group by 1)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(h.n_hit, 0) as bigint) as n_hit,
  cast(coalesce(t.n_items, 0) as bigint) as n_items, coalesce(t.s, sha256('')) as items_sha256,
  coalesce(h.n_hit, 0) > 0 and 20 * coalesce(h.n_hit, 0) >= len(d.w) as contaminated
from d left join h using (doc_id) left join t using (doc_id)
""",
    "op6_warc": r"""
with p as (select cast(page_id as bigint) as page_id, octet_length(encode(coalesce(html, ''))) as n, sha1(coalesce(html, '')) as s from pages),
m as (select s, max(page_id) as first from p where n >= 1000 group by s)
select p.page_id, cast(p.n as bigint) as payload_bytes, p.s as payload_digest,
  case when p.page_id <> m.first then 'revisit' else 'response' end as record_type,
  case when p.page_id <> m.first then m.first end as refers_to
from p left join m on p.s = m.s
""",
}
