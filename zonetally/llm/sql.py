"""SQL for the queries that SQL can express, for another engine on the same tables."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def near_duplicates() -> str:
    return f"""
with recursive d as (select doc_id, {_WORDS.replace("text,", f"{_LOWER},")} as w from documents),
s as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by 1),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
r(doc_id, c) as (select doc_id, doc_id from documents union select l.b, r.c from r join l on l.a = r.doc_id),
m as (select doc_id, min(c) as component_id from r group by 1)
select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept from m left join n using (doc_id)"""


def _repeated(size: int, out: str) -> str:
    """CTEs: starts of windows of `size` words that occur twice in their document, and words they cover."""
    return f"""{out}_w as (select doc_id, i, md5(array_to_string(w[i:i + {size - 1}], ' ')) as h
  from (select doc_id, w, unnest(range(1, len(w) - {size - 2})) as i from d where len(w) > {size})),
{out}_t as (select doc_id, i from {out}_w join (select doc_id, h from {out}_w group by all having count(*) > 1) using (doc_id, h)),
{out} as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + {size})) as p from {out}_t) group by 1)"""


def repetition(least: int, most_covered: int, longest: int) -> str:
    return f"""
with d as (select doc_id, coalesce(text, '') as text, {_WORDS} as w from documents),
{_repeated(3, 'three')}, {_repeated(least, 'long')}, {_repeated(longest + 1, 'longest')},
m as (select doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines from d)
select doc_id, n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(three.n, 0) as n_repeat_words,
  n_words < 50 or 100 * coalesce(three.n, 0) > 50 * n_words as base_failed, coalesce(long.n, 0) as covered_words,
  not (n_words < 50 or 100 * coalesce(three.n, 0) > 50 * n_words) and 100 * coalesce(long.n, 0) <= {most_covered} * n_words and longest.n is null as kept
from m left join three using (doc_id) left join long using (doc_id) left join longest using (doc_id)"""


def substring_dedup(width: int) -> str:
    return f"""
with d as (select doc_id, {_WORDS} as w from documents),
v as (select doc_id, i, md5(array_to_string(w[i:i + {width - 1}], ' ')) as h
  from (select doc_id, w, unnest(range(1, len(w) - {width - 2})) as i from d where len(w) >= {width})),
f as (select h, min(doc_id) as least from v group by 1),
g as (select distinct doc_id, unnest(range(i, i + {width})) as p from v join f using (h) where doc_id > least),
t as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from d where len(w) > 0),
k as (select t.doc_id, string_agg(word, ' ' order by t.p) filter (where g.p is null) as kept, count(g.p) as n_removed
  from t left join g on g.doc_id = t.doc_id and g.p = t.p group by 1)
select d.doc_id, len(w) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join k using (doc_id)"""


def hard_negatives() -> str:
    return """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as q
  from embeddings where label is not null and vec_id is not null and list_count(embedding) = len(embedding) and len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
s as (select a.vec_id as a, b.vec_id as b, a.label = b.label as same, list_dot_product(a.q::double[], b.q::double[])::bigint as s
  from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
p as (select a, b as p, s as ps from s where same qualify row_number() over (partition by a order by s desc, b) <= 5),
n as (select p.a, p, ps, b, s, row_number() over (partition by p.a, p order by s desc, b) as r
  from p join s on s.a = p.a and not same and 50 * ps <= 100 * s and 100 * s <= 95 * ps)
select a as anchor_id, p as positive_id, r::int as rank, b as negative_id, ps as positive_score, s as negative_score from n where r <= 3"""


def lexical_search() -> str:
    terms = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')".format(_LOWER)
    return f"""
with d as (select doc_id, {terms} as t from documents where text is not null),
s as (select count(*)::bigint as docs, sum(len(t))::bigint as terms from d where len(t) > 0),
f as (select doc_id, len(t) as n, unnest(t) as t from d),
g as (select doc_id, n, t, count(*) as tf from f group by all),
w as (select t, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w from g, s group by t, docs),
i as (select distinct item_id, t from (select item_id, unnest({terms}) as t from benchmark)),
r as (select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::bigint as score
  from i join w using (t) join g using (t), s group by 1, 2)
select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score from r where score > 0
qualify rank <= 10"""


def mixing(block: int, shards: int = 16, seed: int = 1) -> str:
    return f"""
with recursive d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size,
    md5('{seed}:' || coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')) as turn from documents),
s as (select *, 2.0::double * source_size as cap, [5, 2, 1][nth % 3 + 1] as weight from (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as nth from d group by 1)),
l(level, capped) as (
  select 0.0::double, -1 union all
  select case when l.capped < 0 then (select 1.5 * sum(source_size) / sum(weight) from s) else
    ((select 1.5 * sum(source_size) from s) - (select coalesce(sum(cap) filter (weight * l.level >= cap), 0) from s)) / (select sum(weight) filter (weight * l.level < cap) from s) end,
    case when l.capped < 0 then 0 else (select count(*) filter (weight * l.level >= cap) from s) end
  from l where l.capped < 0 or l.capped <> (select count(*) filter (weight * l.level >= cap) from s)),
t as (select *, least(cap, weight * (select max(level) from l))::double as target, ceil(source_size / {block})::bigint as n_blocks from s),
q as (select nth, target / (2 * k + 1) as quotient from (select nth, target, unnest(range(0, 2 * n_blocks)) as k from t)),
u as (select nth, count(*) as blocks from (select nth from q qualify row_number() over (order by quotient desc, nth) <= (select round(sum(target) / {block}) from t)) group by 1),
a as (select t.*, coalesce(blocks, 0) as blocks, (select min(a) from range(greatest(1, floor(n_blocks * 0.6180339887498949)::bigint), 2 * n_blocks + 2) r(a) where gcd(a, n_blocks) = 1) as a,
  case when n_blocks > 0 then ({seed} * 7919) % n_blocks else 0 end as b from t left join u using (nth)),
p as (select *, coalesce(sum(size) over (partition by source order by turn, doc_id, size rows between unbounded preceding and 1 preceding), 0)::bigint as start from d),
x as (select row_number() over () as r, p.*, a.source_size, a.target, a.blocks, a.n_blocks, a.a, a.b from p join a on p.source is not distinct from a.source),
y as (select r, start, size, blocks, n_blocks, (a * k + b) % n_blocks as turn, k from (select *, unnest(range(start // {block}, (start + size - 1) // {block} + 1)) as k from x where size > 0)),
z as (select r, sum((least((k + 1) * {block}, start + size) - greatest(k * {block}, start)) * (case when turn < blocks then 1 else 0 end + case when turn + n_blocks < blocks then 1 else 0 end))::bigint as taken from y group by 1)
select doc_id, size, source_size, target, coalesce(taken, 0) as taken from x left join z using (r)"""
