"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op6_warc"] = """
with base as (
  select page_id, coalesce(html, '') as html from pages
), sized as (
  select page_id, sha256(html) as payload_digest, cast(octet_length(encode(html)) as bigint) as payload_bytes from base
), firsts as (
  select *, min(page_id) over (partition by payload_digest) as first_id from sized
)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 100 and page_id <> first_id then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and page_id <> first_id then first_id end as refers_to
from firsts
"""

ORACLE["op12_mixing"] = r"""
with sized as (
  select doc_id, source, md5(concat_ws(':', 'mix', doc_id)) as h,
    cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size
  from documents
), sources as (
  select source, cast(sum(size) as bigint) as source_size from sized group by source
), weighed as (
  select *, row_number() over (order by source nulls last) as nr from sources
), capped as (
  select *, 3 * source_size as cap, 1e0 + (nr - 1) % 3 as weight from weighed
), summed as (
  select *, coalesce(sum(cap) over before, 0) as caps, coalesce(sum(weight) over before, 0) as weights from capped
  window before as (order by cap / weight, nr rows between unbounded preceding and 1 preceding)
), leveled as (
  select max(((select sum(source_size) from sources) * 1e0 - caps) / ((select sum(weight) from capped) - weights)) as water
  from summed
), goals as (
  select source, source_size, least(cast(cap as double), weight * water) as target from capped cross join leveled
), queued as (
  select s.*, coalesce(sum(size) over (partition by source order by h, doc_id, size
    rows between unbounded preceding and 1 preceding), 0) as start from sized s
), served as (
  select q.doc_id, q.size, g.source_size, g.target, cast(floor(g.target) as bigint) - q.start as left_over
  from queued q join goals g on q.source is not distinct from g.source
)
select doc_id, size, source_size, target,
  cast(greatest(0, least(size, left_over)) + greatest(0, least(size, left_over - source_size))
    + greatest(0, least(size, left_over - 2 * source_size)) as bigint) as taken
from served
"""

ORACLE["op13_divergence"] = r"""
with docs as (
  select row_number() over () as nr, coalesce(text, '') as text, coalesce(lang, '') as lang, coalesce(source, '') as source
  from documents
), found as (
  select nr, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term
  from docs
), kept as (
  select lang, term, count(*) as n from found group by lang, term having count(distinct nr) >= 30
), langs as (
  select lang, count(*) as v, sum(n) as total from kept group by lang
), groups as (
  select distinct lang, source from docs
), counted as (
  select lang, source, term, count(*) as n from found semi join kept using (lang, term) group by lang, source, term
), totals as (
  select lang, source, sum(n) as total from counted group by lang, source
), cells as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
    cast(1 + 1000000000::hugeint * (coalesce(c.n, 0) + 5) // (coalesce(t.total, 0) + 5 * l.v) as bigint) as p,
    cast(1 + 1000000000::hugeint * (k.n + 5) // (l.total + 5 * l.v) as bigint) as q
  from groups g join kept k using (lang) join langs l using (lang)
  left join counted c on c.lang = g.lang and c.source = g.source and c.term = k.term
  left join totals t on t.lang = g.lang and t.source = g.source
), apart as (
  select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
  from cells a join cells b on a.lang = b.lang and a.term = b.term and a.source <> b.source
  group by a.lang, a.source, b.source
), both_parts as (
  select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(x.value, 0) as bigint) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join apart x on x.lang = a.lang and x.source = a.source and x.item = b.source
  union all
  select lang, source, 'term', term, p - q from cells where n > 0 and p > q
), ranked as (
  select *, cast(row_number() over (partition by lang, source, part order by value desc, item) as int) as rank
  from both_parts
)
select lang, source, part, item, value, rank from ranked where part = 'pair' or rank <= 50
"""
