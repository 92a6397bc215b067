"""DuckDB counterparts of the queries that SQL can express."""

from __future__ import annotations

QUALITY_RULES = r"""
with lines as materialized (
  select doc_id, source, text, unnest(lines) as line, generate_subscripts(lines, 1) as pos
  from (select doc_id, source, coalesce(text, '') as text, string_split(coalesce(text, ''), chr(10)) as lines from documents)
),
parts as materialized (
  select *, len(found) as n, lower(array_to_string(found, ' ')) as folded
  from (select *, regexp_extract_all(line, '[^ \t-\r]+') as found from lines)
),
documents_measured as (
  select doc_id, source, any_value(text) as text, sum(n)::bigint as n_words,
    coalesce(sum(list_sum(list_transform(found, lambda w: length(w)))), 0)::bigint as word_chars,
    (count(*) filter (n > 0) - count(distinct line) filter (n > 0))::bigint as n_dup_lines
  from parts group by doc_id, source
),
word_rows as materialized (
  select doc_id, unnest(found) as word, generate_subscripts(found, 1) as pos
  from (select doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+') as found from documents)
),
windows as (
  select * from (
    select doc_id, pos, count(*) over ahead as n, string_agg(word, chr(1)) over ahead as window_text
    from word_rows window ahead as (partition by doc_id order by pos rows between current row and 7 following)
  ) where n = 8
),
repeats as (
  select doc_id, pos from (select doc_id, pos, count(*) over (partition by doc_id, window_text) as n from windows) where n > 1
),
covered as (
  select doc_id, sum(least(8, next - pos))::bigint as n_repeat_words
  from (select doc_id, pos, coalesce(lead(pos) over (partition by doc_id order by pos), pos + 8) as next from repeats) group by doc_id
),
counts as (select source, folded, count(distinct text) as n from parts where n > 0 group by source, folded),
hosts as (select source, count(distinct coalesce(text, '')) as n from documents group by source),
above as (
  select c.source, c.folded from counts c join hosts h on c.source is not distinct from h.source
  where c.n > 5 and 100 * c.n > 8 * h.n or c.n > 1000
),
spread as (select folded from parts where n >= 8 group by folded having count(distinct text) > 100),
removed as (
  select p.doc_id, count(*) as n_lines_removed, sum(p.n)::bigint as n_words_removed
  from parts p left join above a on p.source is not distinct from a.source and p.folded = a.folded
    left join spread s on p.folded = s.folded and p.n >= 8
  where p.n > 0 and (a.folded is not null or s.folded is not null) group by p.doc_id
),
judged as (
  select m.doc_id, m.n_words, m.word_chars,
    length(m.text) - length(translate(m.text, '#*$%&|<>', '')) as n_symbols,
    m.n_dup_lines, coalesce(c.n_repeat_words, 0) as n_repeat_words,
    coalesce(r.n_lines_removed, 0) as n_lines_removed, coalesce(r.n_words_removed, 0) as n_words_removed
  from documents_measured m left join covered c using (doc_id) left join removed r using (doc_id)
)
select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
  not (n_words < 20 or 100 * n_repeat_words > 30 * n_words) and 100 * (n_words - n_words_removed) >= 30 * n_words as kept
from judged
"""

URL_FILTERS = r"""
with parsed as (
  select page_id, url,
    case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest
  from pages
),
split as (
  select page_id, url,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path,
    list_distinct(regexp_extract_all(lower(url_decode(coalesce(url, ''))), '[\p{L}\p{N}]+')) as terms
  from parsed
),
rules(domain, start, decision) as (
  values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
),
ruled as (
  select page_id, domain || start as rule, decision from split join rules
    on (host = domain or ends_with(host, '.' || domain)) and starts_with(path, start)
  qualify row_number() over (partition by page_id order by length(domain || start) desc) = 1
),
counted as (
  select *,
    len(list_intersect(terms, ['adult', 'camgirls', 'casino', 'crackz', 'hentai', 'nudes', 'porn', 'porno', 'pornstar', 'sexcams', 'spam',
      'warez', 'xxx'])) as n_strict,
    len(list_intersect(terms, ['ads', 'banner', 'bet', 'bets', 'bonus', 'cheap', 'click', 'crack', 'dating', 'escort', 'farm', 'free',
      'gambling', 'hot', 'jackpot', 'keygen', 'loan', 'loans', 'lottery', 'naked', 'nude', 'pills', 'poker', 'popup', 'prize', 'replica',
      'serial', 'sex', 'sexy', 'slots', 'torrent', 'track', 'tracker', 'tracking', 'viagra', 'win', 'winner'])) as n_soft,
    len(list_intersect(terms, ['ads', 'bet', 'bets', 'dating', 'escort', 'gambling', 'jackpot', 'keygen', 'loans', 'lottery', 'naked',
      'nude', 'pills', 'poker', 'popup', 'replica', 'sex', 'sexy', 'slots', 'torrent', 'tracker', 'viagra'])) as n_clear
  from split
)
select page_id, host, path, rule, coalesce(decision, case when n_strict > 0 or n_soft >= 2 and n_soft + n_clear >= 3 then 'block' else 'allow' end) as verdict,
  n_strict, n_soft, n_soft + n_clear as soft_weight
from counted left join ruled using (page_id)
"""

DOCUMENT_FINGERPRINTS = r"""
with ordered as (
  select doc_id, coalesce(text, '') as own, length(coalesce(text, ''))::bigint as n_chars,
    coalesce(lead(coalesce(text, '')) over (order by doc_id), first_value(coalesce(text, '')) over (order by doc_id)) as after,
    coalesce(lead(doc_id) over (order by doc_id), first_value(doc_id) over (order by doc_id)) as after_id
  from documents
),
edited as (
  select *, substr(own, 1, n_chars - n_chars // 2) || substr(after, 1, n_chars // 2) as changed from ordered
),
texts as (select doc_id, 0 as side, own as text from edited union all select doc_id, 1, changed from edited),
paragraphs as (
  select doc_id, side, sha256(p) || sha256('#' || p) as digits
  from (select doc_id, side, trim(unnest(string_split(regexp_replace(text, '([.!?]) ', '\1' || chr(10), 'g'), chr(10))), ' ') as p from texts) where p <> ''
),
entries as (
  select doc_id, side, i, sum(2 * instr('0123456789abcdef', substr(digits, i, 1)) - 17) as total
  from paragraphs, range(1, 129) as r(i) group by doc_id, side, i
),
vectors as materialized (
  select doc_id, side, i, ((coalesce(total, 0) + 32768) % 65536 + 65536) % 65536 - 32768 as x
  from (select doc_id, side, i from texts, range(1, 129) as r(i)) left join entries using (doc_id, side, i)
),
prints as (
  select doc_id, side, string_agg(lpad(lower(hex(((x + 65536) % 65536)::bigint)), 4, '0'), '' order by i) as shown from vectors group by doc_id, side
),
pairs as (
  select e.doc_id, 1 as kind, a.x as a, b.x as b from edited e
    join vectors a on a.doc_id = e.doc_id and a.side = 0 join vectors b on b.doc_id = e.doc_id and b.side = 1 and b.i = a.i
  union all
  select e.doc_id, 2, a.x, b.x from edited e
    join vectors a on a.doc_id = e.doc_id and a.side = 0 join vectors b on b.doc_id = e.after_id and b.side = 0 and b.i = a.i
),
near as (
  select doc_id, kind, greatest(0.0::double, 1.0::double - sum(power(((a - b + 32768) % 65536 + 65536) % 65536 - 32768, 2))::double
    / greatest(sum(a * a) + sum(b * b), 1)::double) as likeness
  from pairs group by doc_id, kind
)
select e.doc_id, e.n_chars, sha256(e.changed) as edited_sha256, f.shown as fingerprint, g.shown as edited_fingerprint,
  n.likeness as near_edited, m.likeness as near_next
from edited e join prints f on f.doc_id = e.doc_id and f.side = 0 join prints g on g.doc_id = e.doc_id and g.side = 1
  join near n on n.doc_id = e.doc_id and n.kind = 1 join near m on m.doc_id = e.doc_id and m.kind = 2
"""

#: Each round of clustering by all distances; a centroid's components are rows (cluster, i, x).
_CLUSTER_ROUND = """
near{r} as (
  select v, arg_min(cluster, (distance, cluster)) as cluster, min(distance) as distance
  from (select e.v, c.cluster, sum((e.x - c.x) * (e.x - c.x))::bigint as distance from entries e join centre{r} c using (i) group by e.v, c.cluster)
  group by v
),
centre{n} as (
  select c.cluster, c.i, coalesce(m.x, c.x) as x from centre{r} c
  left join (
    select n.cluster, e.i, ((sum(e.x) - (sum(e.x) % count(*) + count(*)) % count(*)) // count(*))::bigint as x
    from entries e join near{r} n using (v) group by n.cluster, e.i
  ) m using (cluster, i)
),
"""

CENTROID_CLUSTERING = (
    r"""
with kept as materialized (
  select row_number() over () as v, vec_id, list_transform(embedding, lambda c: floor(64 * c::double)::bigint) as xs
  from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda c: c is not null and isfinite(c))) = 64
),
entries as materialized (select v, i, xs[i] as x from kept, range(1, 65) as r(i)),
first as (
  select v, row_number() over (order by sha256('1:' || vec_id::varchar), xs) - 1 as cluster
  from kept where vec_id is not null order by cluster limit 16
),
centre0 as (select f.cluster, e.i, e.x from entries e join first f using (v)),
"""
    + "".join(_CLUSTER_ROUND.format(r=r, n=r + 1) for r in range(3))
    + r"""
near as (
  select v, arg_min(cluster, (distance, cluster)) as cluster, min(distance) as distance
  from (select e.v, c.cluster, sum((e.x - c.x) * (e.x - c.x))::bigint as distance from entries e join centre3 c using (i) group by e.v, c.cluster)
  group by v
),
digests as (select cluster, sha256(string_agg(x::varchar, ',' order by i)) as centroid_sha256 from centre3 group by cluster)
select k.vec_id, n.cluster::integer as cluster, n.distance, sum(n.distance) over (partition by n.cluster)::bigint as cluster_inertia,
  sum(n.distance) over ()::bigint as inertia, d.centroid_sha256
from kept k join near n using (v) join digests d using (cluster)
"""
)

SQL = {
    "op1_quality_rules": QUALITY_RULES,
    "op4_url_filters": URL_FILTERS,
    "op9_document_fingerprints": DOCUMENT_FINGERPRINTS,
    "op12_centroid_clustering": CENTROID_CLUSTERING,
}
