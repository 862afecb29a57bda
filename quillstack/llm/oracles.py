"""The corpus queries in SQL, where SQL can say them: plain forms without the operators' methods."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
TERMS = r"regexp_extract_all(" + LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP1 = f"""
with w as (select doc_id, {WORDS} as ws from documents),
n as (select doc_id, unnest(range(1, len(ws) - 18)) as i from w where len(ws) >= 20),
k as (select n.doc_id, i, row_number() over (partition by array_to_string(ws[i:i + 19], ' ') order by n.doc_id, i) as r from n join w on n.doc_id = w.doc_id),
gone as (select distinct doc_id, unnest(range(i, i + 20)) as i from k where r > 1),
word as (select doc_id, unnest(ws) as x, generate_subscripts(ws, 1) as i from w),
kept as (select word.doc_id, string_agg(x, ' ' order by word.i) as t, count(*) as n from word left join gone on word.doc_id = gone.doc_id and word.i = gone.i where gone.i is null group by word.doc_id)
select w.doc_id, cast(len(ws) as bigint) as n_words, cast(len(ws) - coalesce(n, 0) as bigint) as n_removed, sha256(coalesce(t, '')) as kept_sha256 from w left join kept on w.doc_id = kept.doc_id
"""

OP3 = f"""
with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as x, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i from documents),
k as (select *, {LOWER.format(f"trim(x, {BLANK})")} as key from l),
hot as (select key from k where key <> '' group by key having count(distinct doc_id) >= 10)
select k.doc_id, count(*) as n_lines, count(hot.key) as n_dropped, sha256(coalesce(string_agg(x, chr(10) order by i) filter (where hot.key is null), '')) as kept_sha256
from k left join hot on k.key = hot.key group by k.doc_id
"""

OP6 = rf"""
with r as (select doc_id, source, cast(len({WORDS}) as bigint) as size, (cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || '/0/' || md5(coalesce(text, ''))), 1, 12) as bigint) + 0.5::double) / 281474976710656::double as u from documents),
d as (select *, cast(64 * len(bin(size)) as bigint) as x from r),
s as (select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) as r from d group by source),
w as (select *, case (r - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as w, source_size * 2 as cap from s),
v as (select *, (sum(source_size) over () * 1.5::double - coalesce(sum(cap) over up, 0)) / (sum(w) over () - coalesce(sum(w) over up, 0)) as level from w window up as (order by cap / w::double, source nulls last rows between unbounded preceding and 1 preceding)),
t as (select source, source_size, case when cap / w::double > level then w * max(case when cap / w::double > level then level end) over () else cap::double end as target from v),
k as (select source, x, cast(sum(size) as bigint) as s from d group by source, x),
l as (select k.*, source_size, target, (target - cast(coalesce(sum(s) over (partition by k.source order by x desc rows between unbounded preceding and 1 preceding), 0) as bigint) * 2) / cast(sum(x * s) over (partition by k.source order by x desc rows between current row and unbounded following) as bigint) as level
      from k join t on k.source is not distinct from t.source),
m as (select *, coalesce(level * x < 2, false) as free from l),
n as (select *, max_by(level, x) filter (where free) over (partition by source) as top from m),
c as (select *, case when target <= 0 then 0::double when free then top * x else 2::double end as copies from n),
h as (select *, cast(floor(copies) as bigint) as whole, copies - floor(copies) as f from c),
e as (select *, target - cast(sum(whole * s) over (partition by source) as bigint) as need from h),
p as (select d.doc_id, d.source, size, u, source_size, target, whole, f, need, least(greatest(f, 1e-12::double), 1 - 1e-12::double) as p from d join e on d.source is not distinct from e.source and d.x = e.x),
q as (select *, (u / (1 - u)) / (p / (1 - p)) as q from p),
z as (select *, q / (1 + q) as z, case when f > 0 then size else 0 end as own from q),
a as (select *, cast(sum(own) over (partition by source order by z) as bigint) as upto, cast(sum(own) over (partition by source, z) as bigint) as tie from z),
b as (select *, min(case when f > 0 and upto >= need then z end) over (partition by source) as cut from a),
y as (select *, z < cut or cut is null or (z = cut and abs(upto - need) <= abs(upto - tie - need)) as in_sample from b)
select doc_id, size, source_size, target, (whole + case when f > 0 and in_sample then 1 else 0 end) * size as taken from y
"""

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""  # as it stands in a SQL string
SECRETS = {0: (ASSIGN, 2, "length(v) >= 12"), 1: ("AKIA[A-Z0-9]{14,}", 0, "true"), 2: ("[0-9a-f]{16,}", 0, "true"), 3: ("[A-Za-z0-9+/_=-]{20,}", 0, "regexp_matches(v, '[0-9]') and regexp_matches(v, '[a-z]') and regexp_matches(v, '[A-Z]')")}
MATCHES = " union all ".join(
    f"""select doc_id, source, {kind} as kind, unnest(string_split_regex(t, '{p}')) as gap, unnest(regexp_extract_all(t, '{p}', 0)) as x, unnest(regexp_extract_all(t, '{p}', {group})) as v, unnest(range(len(string_split_regex(t, '{p}')))) as i from d"""
    for kind, (p, group, keep) in SECRETS.items()
)
KEEP = " ".join(f"when kind = {kind} then {keep}" for kind, (_, _, keep) in SECRETS.items())

OP7 = f"""
with d as (select doc_id, source, coalesce(text, '') as t from documents),
m as ({MATCHES}),
e as (select *, sum(length(gap) + length(x)) over (partition by doc_id, kind order by i) as e from m where x is not null),
k as (select doc_id, source, kind, cast(e - length(x) as bigint) as s, cast(e as bigint) as e, sha256(v) as h from e where case {KEEP} end),
c as (select * from k where kind < 3 or not exists (select 1 from k as b where b.doc_id = k.doc_id and b.kind < 3 and b.s < k.e and k.s < b.e)),
o as (select h, sum(n) as n_repos, count(*) as n_owners from (select h, source, count(distinct doc_id) as n from c group by h, source) group by h),
j as (select c.*, n_owners >= 3 or n_repos >= 20 as copied, n_owners = 1 and n_repos < 20 as live from c join o on c.h = o.h),
f as (select doc_id, count(*) filter (where kind = 0) as n_assign, count(*) filter (where kind = 1) as n_access, count(*) filter (where kind = 2) as n_hex,
      coalesce(string_agg(['assign', 'access', 'hex', 'owned'][kind + 1] || ':' || s || ':' || e, ',' order by s, kind) filter (where kind < 3), '') as base,
      coalesce(string_agg(['assign', 'access', 'hex', 'owned'][kind + 1] || ':' || s || ':' || e, ',' order by s, kind) filter (where kind < 3 or live), '') as spans,
      count(distinct h) filter (where live) as n_live, count(distinct h) filter (where copied) as n_example from j group by doc_id)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans,
       coalesce(n_live, 0) as n_live, coalesce(n_example, 0) as n_example from d left join f on d.doc_id = f.doc_id
"""

OP9 = f"""
with i as (select item_id, {TERMS} as w from benchmark),
v as (select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as k from i where len(w) > 0),
win as (select distinct cast(item_id as varchar) as item, array_to_string(w[k:k + 12], ' ') as t, w[k:k + 12] as ws, len(w[k:k + 12]) as n from v),
d as (select doc_id, {TERMS} as w from documents),
size as (select distinct n from win),
spot as (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as k from d, size where len(w) >= n),
hit as (select doc_id, k, win.n, item from spot join win on spot.n = win.n and array_to_string(w[k:k + spot.n - 1], ' ') = t),
word as (select doc_id, count(*) as n_hit from (select distinct doc_id, unnest(range(k, k + n)) as p from hit) group by doc_id),
item as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, item from hit) group by doc_id),
place as (select doc_id, unnest(w) as x, generate_subscripts(w, 1) as p from d),
freq as (select x, count(*) as n from place group by x),
tw as (select distinct t, ws, list_distinct(ws) as kinds from win),
term as (select t, unnest(ws) as x, generate_subscripts(ws, 1) as p from tw),
rarest as (select t, list({{'n': freq.n, 'x': term.x, 'p': p}} order by freq.n, term.x, p) as l from term join freq on term.x = freq.x group by t),
pair as (select rarest.t, kinds, l[1].x as a, list_filter(l, lambda z: z.x <> l[1].x)[1].x as b from rarest join tw on rarest.t = tw.t),
spread as (select distinct place.doc_id, t from pair join place on place.x = pair.a join d on place.doc_id = d.doc_id
          where b is not null and len(kinds) >= 5 and list_contains(w[greatest(p - 12, 1):p + 12], b) and len(list_intersect(w[greatest(p - 12, 1):p + 12], kinds)) >= ceil(len(kinds) * 0.8::double)),
close as (select doc_id, count(*) as n_near from (select distinct s.doc_id, item from spread s join win on s.t = win.t where not exists (select 1 from hit where hit.doc_id = s.doc_id and hit.item = win.item)) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated, coalesce(n_near, 0) as n_near
from d left join word on d.doc_id = word.doc_id left join item on d.doc_id = item.doc_id left join close on d.doc_id = close.doc_id
"""

OP10 = """
with p as (select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as n from pages),
f as (select *, min(page_id) over (partition by html) as first from p)
select page_id, cast(n as bigint) as payload_bytes, sha256(html) as payload_digest, case when n >= 100 and page_id <> first then 'revisit' else 'response' end as record_type,
       case when n >= 100 and page_id <> first then first end as refers_to from f
"""
