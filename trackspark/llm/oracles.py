"""DuckDB SQL for the queries that SQL can express. The others are tested against brute force."""

from __future__ import annotations

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATE = rf"""
with d as (select doc_id, regexp_extract_all({_LOWER}, '{_WORD}') as w from documents),
b as (select item_id, regexp_extract_all({_LOWER}, '{_WORD}') as w from benchmark where item_id is not null),
bw as (select item_id, least(len(w), 10) as n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as win
       from (select item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) as i from b where len(w) > 0)),
sizes as (select distinct n from bw),
dw as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as win
       from (select doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) as i from d, sizes where len(w) >= n)),
h as (select doc_id, i, dw.n, item_id from dw join bw on dw.win = bw.win and dw.n = bw.n),
hw as (select doc_id, count(distinct k) as n_hit from (select doc_id, unnest(generate_series(i, i + n - 1)) as k from h) group by 1),
hi as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
       from (select distinct doc_id, cast(item_id as varchar) as item from h) group by 1)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hw using (doc_id) left join hi using (doc_id)"""

WARC = """
with p as (select page_id, coalesce(html, '') as payload from pages),
q as (select *, max(page_id) over (partition by payload) as latest, strlen(payload) as n from p)
select page_id, n as payload_bytes, sha1(payload) as payload_digest,
       case when n >= 1000 and page_id <> latest then 'revisit' else 'response' end as record_type,
       case when n >= 1000 and page_id <> latest then latest end as refers_to from q"""

NGRAM_JOIN = rf"""
with recursive d as (select doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, g from (
      select doc_id, unnest(case when len(w) >= 3 then [array_to_string(w[i:i + 2], ' ') for i in generate_series(1, len(w) - 2)]
                                   else [array_to_string(w, ' ')] end) as g from d where len(w) > 0)),
z as (select doc_id, count(*) as n from s group by 1),
o as (select a.doc_id as a, b.doc_id as b, count(*) as o from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
l as (select a, b from o join z x on x.doc_id = a join z y on y.doc_id = b where 100 * o >= 90 * (x.n + y.n - o)),
r as (select doc_id as a, doc_id as b from z union select r.a, l.b from r join l on r.b = l.a)
select d.doc_id, coalesce(n, 0) as n_shingles, coalesce(c, d.doc_id) as component_id
from d left join z on z.doc_id = d.doc_id left join (select a, min(b) as c from r group by 1) on a = d.doc_id"""

TOP_K = """
with v as (select vec_id, [cast(floor(cast(x as double) * 256) as double) for x in embedding] as x from embeddings
           where vec_id is not null and embedding is not null
             and len([x for x in embedding if x is not null and isfinite(x)]) = len(embedding)),
p as (select q.vec_id as query_id, v.vec_id, cast(list_dot_product(q.x, v.x) as bigint) as score
      from v q join v on q.vec_id <> v.vec_id and len(q.x) = len(v.x) where q.vec_id % 50 = 0)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank, vec_id, score
from p qualify rank <= 5"""

LINES = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^.!?\n]+[.!?\n]*[ \t\n]*|[.!?\n]+[ \t\n]*') as p from documents),
u as (select doc_id, unnest(p) as piece, unnest(generate_series(1, len(p))) as i from d),
v as (select *, length(piece) as n, trim(regexp_replace(translate(piece, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), ' ') as plain from u),
w as (select *, len(string_split(plain, ' ')) >= 5
             and row_number() over (partition by plain order by doc_id, i) > 1 as gone,
             sum(n) over (partition by doc_id order by i) as upto from v),
g as (select doc_id, count(*) filter (where gone) as n_removed,
             string_agg((upto - n)::varchar || '-' || upto::varchar, ',' order by i) filter (where gone) as spans,
             string_agg(piece, '' order by i) filter (where not gone) as kept from w group by 1)
select d.doc_id, len(p) as n_units, coalesce(n_removed, 0) as n_removed, coalesce(spans, '') as removed_spans,
       length(coalesce(kept, '')) as kept_chars, md5(coalesce(kept, '')) as kept_md5
from d left join g using (doc_id)"""

MIXING = r"""
with recursive d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
                  md5('mix:' || coalesce(cast(doc_id as varchar), 'null')) as shuffle from documents),
s as (select source, cast(sum(size) as bigint) as source_size from d group by 1),
n as (select *, [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight from s),
c as (select *, 3 * source_size / weight as room,
             sum(source_size) over () - 3 * coalesce(sum(source_size) over before, 0) as rest,
             sum(weight) over () - coalesce(sum(weight) over before, 0) as weights
      from n window before as (order by 3 * source_size / weight, source nulls last rows between unbounded preceding and 1 preceding)),
l as (select *, (select rest / weights from c where room >= rest / weights order by room, source nulls last limit 1) as level from c),
t as (select source, source_size, case when room <= level then cast(3 * source_size as double) else level * weight end as target from l),
q as (select doc_id, d.source, size, source_size, target, shuffle,
             sum(size) over (partition by d.source order by shuffle rows unbounded preceding) as upto
      from d join t on d.source is not distinct from t.source),
a as (select *, unnest([0, 1, 2]) as epoch from q),
f as (select *, case when target > 0 then (epoch * source_size + upto) / target else 0 end as finish from a),
m as (select *, sum(size) over (order by finish, source nulls last, epoch, shuffle rows unbounded preceding) as total from f)
select doc_id, size, source_size, target,
       cast(size * count(*) filter (where total <= (select sum(source_size) from s)) as bigint) as taken
from m group by doc_id, size, source_size, target"""

# a regular language has finitely many states, so SQL can carry the best script to each of them along the turns
CONVERSATIONS = r"""
with recursive crc_table as (
  select list(c order by n) as t from (
    select n, list_reduce(list_prepend(n, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c
    from (select unnest(range(256)) as n))),
k as (select *, row_number() over () as id, hex(encode(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '))) as h
      from conversations),
f as (select k.*, xor(list_reduce(list_prepend(4294967295, [('0x' || h[i:i + 1])::bigint for i in range(1, len(h), 2)]),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 as fault from k, crc_table),
d as (select conv_id, turn, case when fault = 4 then 'user' else coalesce(role, ' ') end as role,
             case fault when 1 then '' when 2 then translate(coalesce(text, ' '), '.!?', '') else coalesce(text, ' ') end as text,
             unnest(range(case fault when 3 then 2 else 1 end)) as copy
      from f where fault <> 0),
o as (select *, row_number() over w as i, lag(role[1:1]) over w as before from d
      window w as (partition by conv_id order by turn nulls first, role, sha256(text), copy)),
g as (select *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as seen,
             row_number() over (partition by conv_id, role, text order by i) > 1 as again from o),
c as (select *, case when seen = '' then 'blank' when again then 'duplicate' when seen[-1:] not in ('.', '!', '?') then 'truncated' end as bad from g),
s as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
             count(*) filter (where bad = 'blank') as blank, count(*) filter (where bad = 'duplicate') as duplicate,
             count(*) filter (where bad = 'truncated') as truncated,
             count(*) filter (where i > 1 and before || role[1:1] not in ('su', 'ua', 'au')) as illegal, count(*) as n from c group by 1),
-- the best script to every state of the grammar after i turns: cost, audit, repaired turns
r as (select conv_id, 0::bigint as i, {'c': 0, 'a': '', 't': ''} as b, {'c': 1000000000, 'a': '', 't': ''} as s,
             {'c': 1000000000, 'a': '', 't': ''} as u, {'c': 1000000000, 'a': '', 't': ''} as a from (select distinct conv_id from conversations)
      union all
      select r.conv_id, c.i,
        {'c': r.b.c + 4, 'a': r.b.a || 'D', 't': r.b.t},
        least({'c': r.s.c + 4, 'a': r.s.a || 'D', 't': r.s.t},
              {'c': case when x and role[1:1] = 's' then r.b.c + z else 1000000000 end, 'a': r.b.a || 'K', 't': r.b.t || chr(10) || role || ':' || text}),
        least({'c': u1.c + 4, 'a': u1.a || 'D', 't': u1.t},
              {'c': case when x then o1.c + z + case when role[1:1] = 'u' then 0 else 3 end else 1000000000 end,
               'a': o1.a || case when role[1:1] = 'u' then 'K' else 'R' end,
               't': o1.t || chr(10) || case when role[1:1] = 'u' then role else 'user' end || ':' || text}),
        least({'c': a1.c + 4, 'a': a1.a || 'D', 't': a1.t},
              {'c': case when x then u1.c + z + case when role[1:1] = 'a' then 0 else 3 end else 1000000000 end,
               'a': u1.a || case when role[1:1] = 'a' then 'K' else 'R' end,
               't': u1.t || chr(10) || case when role[1:1] = 'a' then role else 'assistant' end || ':' || text})
      from (select *, least(a, {'c': u1.c + 3, 'a': u1.a || 'I', 't': u1.t || chr(10) || 'assistant:'}) as a1,
                   least(b, s, a, {'c': u.c + 3, 'a': u.a || 'I', 't': u.t || chr(10) || 'assistant:'}) as o1
            from (select *, least(u, {'c': least(b, s, a).c + 3, 'a': least(b, s, a).a || 'I', 't': least(b, s, a).t || chr(10) || 'user:'}) as u1
                  from r)) r
      join (select *, coalesce(bad, '') not in ('blank', 'duplicate') as x, case when bad = 'truncated' then 3 else 0 end as z from c) c
        on c.conv_id is not distinct from r.conv_id and c.i = r.i + 1),
e as (select r.conv_id, least(b, a, {'c': u1.c + 3, 'a': u1.a || 'I', 't': u1.t || chr(10) || 'assistant:'}) as best, r.i
      from (select *, least(u, {'c': least(b, s, a).c + 3, 'a': least(b, s, a).a || 'I', 't': least(b, s, a).t || chr(10) || 'user:'}) as u1 from r) r)
select e.conv_id, coalesce(s.gaps, 0) as gaps, coalesce(s.blank, 0) as blank, coalesce(s.duplicate, 0) as duplicate,
       coalesce(s.truncated, 0) as truncated, coalesce(s.illegal, 0) as illegal, cast(best.c as bigint) as cost, best.a as audit,
       sha256(best.t[2:]) as repaired_sha256
from e left join s on s.conv_id is not distinct from e.conv_id where e.i = coalesce(s.n, 0)"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

LEXICAL = rf"""
with d as (select row_number() over () as row, doc_id, regexp_extract_all({_LOWER}, '{_TERM}') as w from documents),
s as (select count(*) as docs, cast(sum(len(w)) as bigint) as total from d where len(w) > 0),
i as (select item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) as term from (select distinct item_id, text from benchmark)),
q as (select item_id, term, count(*) as times from i group by 1, 2),
t as (select row, doc_id, len(w) as n, unnest(w) as term from d),
f as (select row, doc_id, n, term, count(*) as tf from t where term in (select term from q) group by 1, 2, 3, 4),
g as (select term, count(*) as df from f group by 1),
v as (select row, doc_id, f.term, cast(floor(1000 * ln(cast(2 * docs + 2 as double) / cast(2 * df + 1 as double))) as bigint)
             * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total))) as x
      from f join g on f.term = g.term, s),
r as (select item_id, row, doc_id, cast(sum(times * x) as bigint) as score from q join v on q.term = v.term group by 1, 2, 3)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id nulls first) as int) as rank, doc_id, score
from r where score > 0 qualify rank <= 10"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontaminate": DECONTAMINATE,
        "op2_warc": WARC,
        "op4_ngram_join": NGRAM_JOIN,
        "op5_top_k": TOP_K,
        "op7_lines": LINES,
        "op8_mixing": MIXING,
        "op12_conversations": CONVERSATIONS,
        "op13_lexical": LEXICAL,
    }
