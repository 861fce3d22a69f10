"""DuckDB SQL for the operators' queries, by brute force over the tables."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(column: str, pattern: str) -> str:
    return f"regexp_extract_all({_LOWER.format(f"coalesce({column}, '')")}, '{pattern}')"


_BLANK = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Which nodes reach which, from ``nodes`` (n) and both directions of ``links`` (x, y).
_REACH = "reach(x, y) as (select n, n from nodes union select r.x, l.y from reach r join links l on r.y = l.x)"

_URLS = """, numbered as (select kind, pattern, max(action) as action, listed_on as since from listed group by kind, pattern, listed_on),
intervals as (select *, lead(since) over (partition by kind, pattern order by since) as until from numbered),
captures as (select page_id, url, date '2024-01-01' + cast(page_id * 37 % 365 as int) as fetched_on,
  lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]+)', 1)) as host, regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1) as path from pages),
active as (select c.*, i.pattern, i.since, i.action, i.kind,
  case kind when 'domain' then len(string_split(i.pattern, '.')) when 'host' then 1000 else 2000 + len(string_split(i.pattern, '/')) end as rank
  from captures c join intervals i on c.fetched_on >= i.since and (i.until is null or c.fetched_on < i.until) and (
    (kind = 'host' and host = i.pattern) or (kind = 'domain' and (host = i.pattern or host like '%.' || i.pattern))
    or (kind = 'prefix' and starts_with(host || path || '/', i.pattern || '/')))),
best as (select page_id, count(*) as n_active, arg_max(struct_pack(pattern := pattern, since := since, action := action), rank) as top from active group by page_id)
select c.page_id, c.url, c.fetched_on, coalesce(top.action, 'allow') as decision, coalesce(n_active, 0) as n_active, top.pattern as pattern,
  top.since as since from captures c left join best b on b.page_id = c.page_id"""

_MIX = f"""with sized as (select doc_id, source, len({_words("text", _BLANK)}) as size from documents),
sources as (select source, cast(sum(size) as bigint) as source_size, row_number() over (order by source nulls last) - 1 as place from sized group by source),
weighted as (select *, cast([3, 1, 2][place % 3 + 1] as double) as weight, 2.0::double * source_size as cap from sources),
opened as (select *, cap / weight as most, (1.5::double * (select sum(source_size) from sources)
    - coalesce(sum(cap) over (order by cap / weight, place rows between unbounded preceding and 1 preceding), 0))
  / sum(weight) over (order by cap / weight, place rows between current row and unbounded following) as level from weighted),
chosen as (select arg_min(level, most) as level from opened where level <= most),
targets as (select source, source_size, least(cap, weight * chosen.level) as target from weighted, chosen),
rated as (select s.doc_id, s.size, t.source_size, t.target, case when t.source_size > 0 then t.target / t.source_size else 0.0::double end as rate
  from sized s join targets t on s.source is not distinct from t.source),
drawn as (select *, floor(rate) + case when cast(('0x' || substr(md5('17:' || cast(doc_id as varchar)), 1, 8)) as ubigint)::double / 4294967296
  < rate - floor(rate) then 1 else 0 end as copies from rated)
select doc_id, cast(size as bigint) as size, source_size, target, cast(size * copies as bigint) as taken, rate, cast(copies as int) as copies from drawn"""

_VECTORS = f"""with recursive usable as (select vec_id, label, cast(embedding as double[]) as e from embeddings where label is not null and embedding is not null
  and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0 and len(list_filter(embedding, lambda v: v <> 0)) > 0),
links as (select a.vec_id as x, b.vec_id as y from usable a join usable b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.93),
nodes as (select vec_id as n from embeddings), {_REACH},
component as (select x, min(y) as c from reach group by x)
select n as vec_id, (select count(*) from links where x = n) as n_links, c as component_id, n = c as kept from nodes join component on x = n"""

_TEXTS = f"""with recursive worded as (select doc_id, {_words("text", _BLANK)} as w from documents),
shingled as (select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
  else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) end as s from worded),
each as (select doc_id, hash(unnest(s)) as h from shingled),
sizes as (select doc_id, len(s) as n from shingled),
common as (select a.doc_id as x, b.doc_id as y, count(*) as shared from each a join each b on a.h = b.h and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id),
links as (select x, y from common join sizes a on a.doc_id = x join sizes b on b.doc_id = y where 100 * shared >= 85 * (a.n + b.n - shared)),
nodes as (select doc_id as n from documents), {_REACH},
component as (select x, min(y) as c from reach group by x)
select doc_id, cast(n as bigint) as n_shingles, c as component_id, doc_id = c as kept from sizes join component on x = doc_id"""

_PASSAGES = f"""with worded as (select doc_id, {_words("text", _ALNUM)} as w from documents),
items as (select cast(item_id as varchar) as item, {_words("text", _ALNUM)} as w from benchmark),
cut as (select item, w, least(13, len(w)) as wide from items where len(w) > 0),
windows as (select distinct item, wide, w[i:i + wide - 1] as run from (select *, unnest(range(1, len(w) - wide + 2)) as i from cut)),
runs as (select d.doc_id, l.wide, i, d.w[i:i + l.wide - 1] as run from worded d, (select distinct wide from windows) l,
  lateral (select unnest(range(1, len(d.w) - l.wide + 2)) as i)),
found as (select r.doc_id, r.i, r.wide, x.item from runs r join windows x on r.wide = x.wide and r.run = x.run),
hits as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + wide)) as p from found) group by doc_id),
named as (select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as names from found group by doc_id),
placed as (select doc_id, w, unnest(range(1, len(w) + 1)) as p, unnest(w) as word from worded),
often as (select word, count(*) as n from placed group by word),
rarest as (select x.item, x.run, arg_min(o.word, o.n) as word from (select item, run, unnest(run) as word from windows) x join often o on o.word = x.word
  group by x.item, x.run having count(*) = len(x.run)),
starts as (select p.doc_id, p.w, x.item, x.run, unnest(range(greatest(1, p.p - 26), least(len(p.w), p.p + 26) + 1)) as q
  from placed p join rarest x on x.word = p.word),
near as (select doc_id, count(distinct item) as n from starts where w[q] = run[1] and list_has_all(w[greatest(1, q - 26):q + 26], run) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated,
  coalesce(near.n, 0) as n_near_items
from worded d left join hits h on h.doc_id = d.doc_id left join named m on m.doc_id = d.doc_id left join near on near.doc_id = d.doc_id"""


_RANKED = f"""with docs as (select doc_id, {_words("text", _ALNUM)} as w from documents),
counted as (select doc_id, term, count(*) as tf from (select doc_id, unnest(w) as term from docs) group by doc_id, term),
whole as (select count(*) as n, cast(sum(len(w)) as bigint) as l from docs where len(w) > 0),
held as (select term, count(*) as df from counted group by term),
weighed as (select term, cast(floor(1000 * ln((2 * n + 2) / (2 * df + 1))) as bigint) as weight from held, whole),
long as (select doc_id, 25 + (75 * len(w) * n) // l as m from docs, whole where len(w) > 0),
asked as (select item_id, unnest({_words("text", _ALNUM)}) as term from benchmark),
scored as (select item_id, c.doc_id, cast(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
  from asked a join counted c on c.term = a.term join weighed w on w.term = a.term join long on long.doc_id = c.doc_id group by item_id, c.doc_id),
ranked as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from scored where score > 0)
select item_id, cast(rank as int) as rank, doc_id, score from ranked where rank <= 10"""

# the 256 remainders of CRC-32 by shifting, then one byte of each distinct word a step
_DRAWN = f"""with recursive docs as (select doc_id, {_words("text", _ALNUM)} as w from documents),
listed as (select doc_id, unnest(w) as word from docs), aimed as (select unnest({_words("text", _ALNUM)}) as word from benchmark),
shifted(b, k, c) as (select i, 0, i from range(256) t(i) union all select b, k + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from shifted where k < 8),
remainder as (select b, c from shifted where k = 8),
spelled as (select word, hex(encode(word)) as x from (select distinct word from (select word from listed union all select word from aimed))),
state(word, x, p, c) as (select word, x, 0, 4294967295 from spelled union all
  select word, x, p + 1, xor(s.c >> 8, r.c) from state s join remainder r on r.b = xor(s.c, cast('0x' || substr(s.x, 2 * s.p + 1, 2) as bigint)) & 255 where 2 * s.p < length(s.x)),
coded as (select word, xor(c, 4294967295) % 10000 as bucket from state where 2 * p = length(x)),
s as (select bucket, count(*) as n from listed join coded using (word) group by bucket), t as (select bucket, count(*) as n from aimed join coded using (word) group by bucket),
gained as (select bucket, cast(floor(1000 * ln((coalesce(t.n, 0) + 1)::double * ((select count(*) from listed) + 10000)::double
  / ((s.n + 1)::double * ((select count(*) from aimed) + 10000)::double))) as bigint) as gain from s left join t using (bucket)),
weighed as (select doc_id, cast(sum(gain) as bigint) as weight from listed join coded using (word) join gained using (bucket) group by doc_id),
scored as (select doc_id, cast(len(w) as bigint) as n_features, coalesce(weight, 0) as weight, coalesce(weight, 0) + cast(floor(-1000 * ln(-ln(
  (cast('0x' || substr(sha256('2024:' || cast(doc_id as varchar)), 1, 8) as bigint) + 0.5::double) / 4294967296))) as bigint) as score from docs left join weighed using (doc_id)),
placed as (select *, row_number() over (order by n_features < 20, score desc, doc_id) as place from scored)
select doc_id, n_features, weight, score, case when place <= (select count(*) * 10 // 100 from scored where n_features >= 20) then place end as rank from placed"""

_CUT = f"""with docs as (select doc_id, regexp_extract_all(coalesce(text, ''), '{_BLANK}') as w from documents),
listed as (select doc_id, unnest(w) as word, unnest(range(len(w))) as p, len(w) as n from docs),
runs as (select doc_id, p, n, string_agg(word, ' ') over (partition by doc_id order by p rows between current row and 12 following) as run from listed qualify p <= n - 13),
first as (select run, min(doc_id) as d from runs group by run),
gone as (select distinct doc_id, unnest(range(p, p + 13)) as p from runs join first using (run) where d < doc_id),
marked as (select l.*, g.p is not null as out from listed l left join gone g on g.doc_id = l.doc_id and g.p = l.p),
spanned as (select doc_id, count(distinct island) as n_spans from (select doc_id, p - row_number() over (partition by doc_id order by p) as island from marked where out) group by doc_id),
kept as (select doc_id, count(*) filter (where out) as n_removed, string_agg(word, ' ' order by p) filter (where not out) as kept from marked group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256, coalesce(n_spans, 0) as n_spans
from docs d left join kept k on k.doc_id = d.doc_id left join spanned s on s.doc_id = d.doc_id"""


def oracle_sql(listed: str) -> dict[str, str]:
    listed = listed.strip()
    at = listed.rindex("select distinct kind")
    return {
        "op2_temporal_url_lists": f"{listed[:at].rstrip()}, listed as ({listed[at:]}){_URLS}",
        "op3_mix_sources": _MIX,
        "op7_grid_order_near_vectors": _VECTORS,
        "op8_chosen_path_near_duplicates": _TEXTS,
        "op9_positional_decontamination": _PASSAGES,
        "op11_lexical_product": _RANKED,
        "op12_importance_resample": _DRAWN,
        "op13_repeated_windows": _CUT,
    }
