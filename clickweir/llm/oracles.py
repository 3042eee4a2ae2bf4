"""SQL that the queries of ``queries`` must agree with, where SQL can say it."""

from __future__ import annotations

from clickweir.llm.quality import COMMON
from clickweir.llm.secrets import BASE_RULES, RULES, RUN_START, Rule

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORD = r"[^\x20\x09-\x0D]+"

_LISTED = ", ".join(
    f"('{lang}', {place}, '{word}')"
    for lang, words in COMMON.items()
    for place, word in enumerate(words)
)
_LANGS = ", ".join(f"'{lang}'" for lang in COMMON)

QUALITY = rf"""
with listed(lang, place, word) as (values {_LISTED}),
d as (
  select doc_id, coalesce(text, '') as t,
    case when lang in ({_LANGS}) then lang else 'other' end as lang,
    regexp_extract_all(coalesce(text, ''), '{_WORD}') as w
  from documents),
pos as (select doc_id, w, unnest(range(1, len(w) - 1)) as k from d),
tri as (select doc_id, k, w[k] || ' ' || w[k + 1] || ' ' || w[k + 2] as x from pos),
twice as (select doc_id, k from (
  select doc_id, k, count(*) over (partition by doc_id, x) as n from tri) where n > 1),
rep as (select doc_id, count(distinct p) as n
  from (select doc_id, unnest([k, k + 1, k + 2]) as p from twice) group by doc_id),
ln as (select doc_id, count(*) - count(distinct x) as n
  from (select doc_id, unnest(string_split(t, chr(10))) as x from d)
  where regexp_matches(x, '{_WORD}') group by doc_id),
b as (
  select d.doc_id, lang, w, len(w) as n_words,
    length(array_to_string(w, '')) as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) as n_symbols,
    coalesce(ln.n, 0) as n_dup_lines, coalesce(rep.n, 0) as n_repeat_words,
    length(t) as n_chars,
    length(regexp_replace(t, '\P{{Lu}}+', '', 'g')) as upper,
    length(regexp_replace(t, '[^0-9]+', '', 'g')) as digit,
    length(regexp_replace(t, '[^.,;:!?]+', '', 'g')) as stop
  from d left join rep on rep.doc_id = d.doc_id left join ln on ln.doc_id = d.doc_id),
f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  n_chars - word_chars as space from b),
chars as (
  select doc_id, lang, base_failed, 'chars' as kind, unnest(range(6)) as bin,
    unnest([upper, digit, stop, n_symbols, space,
            n_chars - upper - digit - stop - n_symbols - space]) as n
  from f),
tokens as (select doc_id, lang, unnest(w) as word from f),
seen as (
  select t.doc_id, l.place, count(*) as n from tokens t
  join listed l on l.lang = t.lang
    and (t.word = l.word or t.word = upper(l.word[1]) || l.word[2:])
  group by all),
common as (
  select f.doc_id, f.lang, base_failed, 'common' as kind, l.place as bin, coalesce(s.n, 0) as n
  from f join listed l on l.lang = f.lang
  left join seen s on s.doc_id = f.doc_id and s.place = l.place),
rest as (
  select c.doc_id, c.lang, c.base_failed, 'common' as kind, 1000 as bin,
    any_value(f.n_words) - sum(c.n) as n
  from common c join f on f.doc_id = c.doc_id group by all),
h as (select * from chars union all select * from common union all select * from rest),
ref as (select lang, kind, bin, sum(n) as n from h where not base_failed group by all),
share as (
  select h.doc_id, h.kind,
    h.n / nullif(sum(h.n) over (partition by h.doc_id, h.kind), 0) as p,
    r.n / nullif(sum(r.n) over (partition by h.doc_id, h.kind), 0) as q
  from h join ref r on r.lang = h.lang and r.kind = h.kind and r.bin = h.bin),
js as (
  select doc_id, kind, sqrt(greatest(sum(
    case when p > 0 then p * log2(p / ((p + q) / 2)) else 0 end
    + case when q > 0 then q * log2(q / ((p + q) / 2)) else 0 end) / 2, 0)) as dist
  from share group by doc_id, kind),
far as (
  select f.doc_id from f join js on js.doc_id = f.doc_id
  where (kind = 'chars' and n_chars >= 300 and dist > 0.3)
     or (kind = 'common' and n_words >= 150 and dist > 0.25))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and doc_id not in (select doc_id from far) as kept
from f
"""

CONTAMINATION = rf"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
i as (
  select cast(item_id as varchar) as item,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
cut as (
  select item, w, least(len(w), 13) as n, unnest(range(1, len(w) - least(len(w), 13) + 2)) as k
  from i where len(w) > 0),
win as (select distinct item, n, array_to_string(w[k:k + n - 1], ' ') as x from cut),
spot as (
  select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as k
  from d, (select distinct n from win)),
occ as (
  select s.doc_id, s.k, s.n, win.item from spot s
  join win on win.n = s.n and win.x = array_to_string(s.w[s.k:s.k + s.n - 1], ' ')),
hit as (
  select doc_id, count(distinct p) as n
  from (select doc_id, unnest(range(k, k + n)) as p from occ) group by doc_id),
its as (
  select doc_id, count(*) as n, string_agg(item, ',' order by item) as x
  from (select distinct doc_id, item from occ where item is not null) group by doc_id)
select d.doc_id, len(w) as n_words, coalesce(hit.n, 0) as n_hit, coalesce(its.n, 0) as n_items,
  sha256(coalesce(its.x, '')) as items_sha256,
  coalesce(hit.n, 0) > 0 and 20 * coalesce(hit.n, 0) >= len(w) as contaminated
from d left join hit on hit.doc_id = d.doc_id left join its on its.doc_id = d.doc_id
"""

MIXING = rf"""
with d as (
  select doc_id, source, coalesce('=' || source, '') as src,
    len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) as size,
    md5(coalesce(cast(doc_id as varchar), 'null') || ':' || coalesce(md5(text), 'null')) as key
  from documents),
ranked as (select *, row_number() over (partition by src order by key) as rank from d),
s as (select source, src, sum(size)::bigint as source_size from d group by all),
weighed as (
  select *, [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight,
    source_size * 2.0::double as most
  from s),
leveled as (
  select *,
    ((sum(source_size) over ())::bigint * 1.5::double
      - coalesce(sum(most) over (order by most / weight, source nulls last
          rows between unbounded preceding and 1 preceding), 0))
      / (sum(weight) over (order by most / weight, source nulls last
          rows between current row and unbounded following))::bigint as level,
    row_number() over (order by most / weight, source nulls last) as place
  from weighed),
cut as (select *, most / weight < level as cut from leveled),
t as (
  select src, source_size, case when cut then most else weight * rest end as target
  from cut, (select min_by(level, place) as rest from cut where not cut)),
rated as (
  select *, case when source_size > 0 then target / source_size else 0.0::double end as rate from t),
drawn as (
  select *, ('0x' || substr(md5(src || '/7/' || cast(i as varchar)), 1, 8))::bigint
      / 4294967296.0::double as off
  from rated, (select unnest(range(1, 65)) as i)),
tried as (
  select r.src, off, any_value(target) as target,
    sum(size * (floor(off + rate * rank) - floor(off + rate * (rank - 1)))) as taken
  from ranked r join drawn on drawn.src = r.src group by r.src, off),
best as (select src, min_by(off, (abs(taken - target), off)) as off from tried group by src)
select doc_id, size::bigint as size, source_size, target,
  (size * (floor(off + rate * rank) - floor(off + rate * (rank - 1))))::bigint as taken
from ranked r join rated on rated.src = r.src join best on best.src = r.src
"""

WARC = """
with p as (
  select page_id, coalesce(html, '') as h, sha1(coalesce(html, '')) as x from pages),
bits as (
  select *, array_to_string(list_transform(range(1, 41), lambda i:
    lpad(bin(('0x' || x[i])::integer), 4, '0')), '') as b from p),
coded as (
  select page_id, strlen(h) as payload_bytes, h,
    array_to_string(list_transform(range(0, 32), lambda j:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + 16 * b[5 * j + 1]::integer + 8 * b[5 * j + 2]::integer + 4 * b[5 * j + 3]::integer
          + 2 * b[5 * j + 4]::integer + b[5 * j + 5]::integer, 1)), '') as payload_digest
  from bits),
firsts as (select *, min(page_id) over (partition by h) as first from coded)
select page_id, payload_bytes, payload_digest,
  case when first = page_id then 'response' else 'revisit' end as record_type,
  case when first <> page_id then first end as refers_to
from firsts
"""


def _matches(rank: int, rule: Rule) -> str:
    # The leftmost match starts its run by itself, and DuckDB has no look-behind.
    pattern = rule.pattern.removeprefix(RUN_START).replace("'", "''")
    return f"""
  select doc_id, {rank} as rank, '{rule.kind}' as kind, {rule.at_least} as least,
    unnest(range(1, len(f) + 1)) as i, f, g, pieces
  from (
    select doc_id, regexp_extract_all(t, '{pattern}') as f,
      regexp_extract_all(t, '{pattern}', {rule.group}) as g,
      string_split_regex(t, '{pattern}') as pieces
    from d where regexp_matches(t, '{pattern}'))"""


SECRETS = f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
m as ({" union all ".join(_matches(i, r) for i, r in enumerate(RULES))}),
s as (
  select doc_id, rank, kind, length(f[i]) as n,
    (list_sum(list_transform(pieces[:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(f[:i - 1], lambda x: length(x))), 0))::bigint as start
  from m where length(g[i]) >= least),
a as (
  select doc_id, count(*) filter (where kind = 'assign') as n_assign,
    count(*) filter (where kind = 'access') as n_access,
    count(*) filter (where kind = 'hex') as n_hex,
    string_agg(concat_ws(':', kind, start, start + n), ',' order by start, rank) as spans,
    string_agg(concat_ws(':', kind, start, start + n), ',' order by start, rank)
      filter (where rank < {len(BASE_RULES)}) as base
  from s group by doc_id)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access,
  coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256,
  coalesce(spans, '') as spans
from d left join a on a.doc_id = d.doc_id
"""


def _crc32(name: str, source: str) -> str:
    """SQL for ``name`` (x, crc): the unsigned CRC-32 of every distinct ``x`` of ``source``."""
    return f"""
crc_bits(i, k, v) as (
  select i, 0, i from range(256) r(i)
  union all
  select i, k + 1, case when v % 2 = 1 then xor(v >> 1, {0xEDB88320}) else v >> 1 end
  from crc_bits where k < 8),
crc_table as (select list(v order by i) as t from crc_bits where k = 8),
crc_bytes as (
  select x, list_transform(regexp_extract_all(hex(encode(x)), '..'),
    lambda z: cast('0x' || z as bigint)) as l
  from (select distinct x from {source})),
{name} as (
  select x, xor(4294967295, list_reduce(list_prepend(4294967295, l),
    lambda a, z: xor(a >> 8, t[1 + (xor(a, z) & 255)]))) as crc
  from crc_bytes, crc_table)"""


SHARDING = f"""
with recursive texts as (select coalesce(text, '') as x from documents),
{_crc32("crcs", "texts")},
d as (
  select doc_id, coalesce(text, '') as x, strlen(coalesce(text, ''))::bigint + 16 as size,
    cast('0x' || substr(md5(coalesce(text, '')), 1, 15) as bigint) as k
  from documents),
r as (select k, doc_id, size, x, count(*) as n from d group by all),
t as (select coalesce(sum(size * n), 0)::bigint as total,
    greatest(1, coalesce(sum(size * n), 0)::bigint // 2000) as unit from r),
g as (select k from r group by k having sum(size * n) > (select unit from t)),
p as (
  select r.*, unnest(range(0, n, greatest(1, unit // size))) as piece,
    greatest(1, unit // size) as step, k in (select k from g) as big
  from r, t),
q as (
  select k, doc_id, size, x, piece, least(step, n - piece) as m,
    case when big then cast('0x' || substr(md5(coalesce(doc_id::varchar, 'null') || ':' || piece), 1, 15)
      as bigint) else -1 end as k2
  from p),
s as (
  select *, sum(size * m) over (order by k, k2) as ends,
    sum(size * m) over (partition by k, k2) as unit_bytes,
    sum(m) over (order by k, k2, doc_id nulls first, size, piece rows unbounded preceding) - m
      as place
  from q),
a as (select s.*, ((2 * ends - unit_bytes)::bigint * 40) // (2 * total) as shard from s, t)
select doc_id, size, crc::bigint as text_crc32, 'bytes' as law, shard::integer as shard,
  (place - first + unnest(range(0, m)))::bigint as slot, null::integer as grown_shard
from (select *, min(place) over (partition by shard) as first from a) join crcs using (x)
"""

TRIE = rf"""
with recursive ids as (select distinct conv_id::varchar as x from conversations where conv_id is not null),
{_crc32("crcs", "ids")},
own as (
  select conv_id as c, list((coalesce(role, ''), coalesce(text, ''))
    order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as turns
  from conversations where conv_id is not null group by conv_id),
built as (
  select own.c, list_concat(coalesce(donor.turns, [])[:crc % 4], own.turns[crc % 4 + 1:]) as turns
  from own join crcs on x = own.c::varchar left join own donor on donor.c = own.c - own.c % 20),
member as (
  select c, unnest(range(0, len(turns) + 1)) as depth, turns from built),
pre as (select c, depth, turns[:depth] as p, depth = len(turns) as ended,
  case when depth > 0 then len(regexp_extract_all(turns[depth][2], '{_WORD}')) else 0 end as tokens
  from member),
node as (
  select p, depth, min(c) as conv_id, count(*) as n_convs, any_value(tokens) as tokens,
    sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (where ended), '')) as ends_sha256
  from pre group by p, depth),
kids as (select p[:depth - 1] as p, count(*) as n from node where depth > 0 group by all),
full_node as (
  select node.*, coalesce(kids.n, 0) as n_children from node left join kids on node.p = kids.p),
above as (
  select p[:unnest(range(0, depth + 1))] as p, (n_children = 0)::int as leaf,
    (n_convs - 1) * tokens as saved
  from full_node),
sums as (select p, sum(leaf) as n_leaves, sum(saved) as saved_tokens from above group by p)
select f.conv_id, f.depth, parent.conv_id as parent_conv_id, f.n_convs, f.n_children,
  sums.n_leaves::bigint as n_leaves, sums.saved_tokens::bigint as saved_tokens, f.ends_sha256
from full_node f join sums on sums.p = f.p
left join node parent on f.depth > 0 and parent.p = f.p[:f.depth - 1]
"""

RESAMPLING = rf"""
with recursive texts as (
  select 'd' as kind, row_number() over () as r, doc_id, text from documents
  union all select 'b', row_number() over (), null, text from benchmark),
w as (
  select kind, r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}',
    '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as l from texts),
f as (
  select kind, r, unnest(list_concat(l, list_transform(range(1, len(l)),
    lambda i: l[i] || ' ' || l[i + 1]))) as x from w),
{_crc32("crcs", "f")},
fb as (select kind, r, (crc % 10000)::integer as bucket, count(*) as n from f join crcs using (x) group by all),
c as (
  select range::integer as bucket, coalesce(sum(n) filter (where kind = 'd'), 0) as s,
    coalesce(sum(n) filter (where kind = 'b'), 0) as t
  from range(10000) left join fb on fb.bucket = range group by all),
z as (select sum(s) as ss, sum(t) as tt from c),
gain as (
  select bucket, floor(1000 * ln((t + 1)::double * (ss + 10000)::double
    / ((s + 1)::double * (tt + 10000)::double)))::bigint as gain from c, z),
sums as (
  select r, sum(n)::bigint as n_features, floor(sum(n * gain)::double / sum(n))::bigint as weight
  from fb join gain using (bucket) where kind = 'd' group by r),
scored as (
  select w.doc_id, w.r, len(l) as n_words, coalesce(n_features, 0) as n_features,
    coalesce(weight, 0) as weight,
    (cast('0x' || substr(sha256('7:' || coalesce(w.doc_id::varchar, 'null')), 1, 8) as bigint) + 0.5::double)
      / 4294967296 as u
  from w left join sums using (r) where kind = 'd'),
noisy as (
  select *, weight + floor(-1000 * ln(-ln(u)))::bigint as score, n_words >= 20 as long_enough
  from scored),
placed as (
  select *, row_number() over (partition by long_enough
      order by score desc, doc_id nulls last, n_features, n_words) as place,
    floor(25 * count(*) over (partition by long_enough) / 100) as drawn
  from noisy)
select doc_id, n_features, weight, score,
  case when long_enough and place <= drawn then place end as rank
from placed
"""
