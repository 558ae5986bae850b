"""DuckDB SQL for the queries that SQL can express."""

#: op2: words and windows of documents and benchmark, matched by equality of whole windows.
OP2 = """
with bw as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from benchmark where text is not null),
bwin as (
  select distinct item_id, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') as win, least(13, len(w)) as size
  from bw, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as t(i) where len(w) > 0),
dw as (
  select row_number() over () as rid, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) as w
  from documents),
dwin as (
  select rid, i, size, array_to_string(w[i:i + size - 1], ' ') as win
  from dw, (select distinct size from bwin), unnest(range(1, len(w) - size + 2)) as t(i)),
occ as (select rid, i, dwin.size, item_id from dwin join bwin on dwin.win = bwin.win and dwin.size = bwin.size),
hit as (select rid, count(distinct p) as n_hit from (select rid, unnest(range(i, i + size)) as p from (select distinct rid, i, size from occ)) group by rid),
items as (select rid, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct rid, cast(item_id as varchar) as item from occ) group by rid)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from dw left join hit using (rid) left join items using (rid)
"""

#: op7: all pairs of distinct sets that share a shingle, then reachability.
OP7 = """
with recursive
dw as (
  select row_number() over () as rid, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), []) as w
  from documents),
sh as (
  select distinct rid, array_to_string(w[i:i + 4], ' ') as s from dw, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as t(i) where len(w) > 0),
n as (select rid, count(*) as n from sh group by rid),
sets as (select rid, md5(string_agg(s, chr(10) order by s)) as sig from sh group by rid),
cls as (select sig, min(rid) as rep from sets group by sig),
rs as (select sh.rid, s from sh where rid in (select rep from cls)),
common as (select a.rid as a, b.rid as b, count(*) as k from rs a join rs b on a.s = b.s and a.rid < b.rid group by 1, 2),
link as (select a, b from common join n na on na.rid = a join n nb on nb.rid = b where 100 * k >= 80 * (na.n + nb.n - k)),
both_ways as (select a, b from link union select b, a from link),
reach(a, b) as (select rep, rep from cls union select reach.a, both_ways.b from reach join both_ways on reach.b = both_ways.a),
ids as (select cls.rep, min(doc_id) as least from sets join cls using (sig) join dw on dw.rid = sets.rid group by cls.rep),
comp as (select reach.a as rep, min(least) as component_id from reach join ids on ids.rep = reach.b group by reach.a)
select dw.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, coalesce(component_id, dw.doc_id) as component_id
from dw left join n using (rid) left join sets using (rid) left join cls using (sig) left join comp using (rep)
"""

OP11 = r"""
with pieces as (
  select row_number() over () as pid, lang, piece from (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents)),
w as (
  select lang, pid, unnest(w) as w1, unnest(range(len(w))) as pos
  from (select lang, pid, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces)),
n as (select lang, count(*) as n from w group by lang),
l as (
  select lang, w1, lead(w1, 1) over p as w2, lead(w1, 2) over p as w3, lead(w1, 3) over p as w4, lead(w1, 4) over p as w5
  from w window p as (partition by pid order by pos)),
g as (
  select lang, 1 as k, w1 as phrase, count(*) as f from l group by lang, phrase having f >= 100
  union all select lang, 2, w1 || ' ' || w2 as phrase, count(*) as f from l where w2 is not null group by lang, phrase having f >= 100
  union all select lang, 3, w1 || ' ' || w2 || ' ' || w3 as phrase, count(*) as f from l where w3 is not null group by lang, phrase having f >= 100
  union all select lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 as phrase, count(*) as f from l where w4 is not null group by lang, phrase having f >= 100
  union all select lang, 5, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5 as phrase, count(*) as f from l where w5 is not null group by lang, phrase having f >= 100),
c as (select lang, k, phrase, string_split(phrase, ' ') as w, f as a from g where k >= 2),
halves as (
  select lang, phrase, a, k, j, array_to_string(w[1:j], ' ') as head, array_to_string(w[j + 1:], ' ') as tail
  from (select *, unnest(range(1, k)) as j from c)),
cuts as (
  select h.lang, h.phrase, h.a, h.k, j, x.f as l, y.f as r, n.n, cast(1000 as hugeint) * h.a * n.n // (cast(x.f as hugeint) * y.f) as score
  from halves h join g x on x.lang = h.lang and x.phrase = h.head join g y on y.lang = h.lang and y.phrase = h.tail join n on n.lang = h.lang),
weakest as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, j) = 1),
inside as (  -- every shorter run of words of each candidate
  select distinct lang, a, array_to_string(w[i:i + m - 1], ' ') as part
  from (select *, unnest(range(1, k - m + 2)) as i from (select *, unnest(range(2, k)) as m from c))),
most as (select lang, part, max(a) as most from inside group by lang, part),
kept as (select s.* from weakest s left join most m on m.lang = s.lang and m.part = s.phrase where m.most is null or 100 * m.most < 100 * s.a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, cast(score as bigint) as score
from kept qualify rank <= 2000
"""

SQL = {"op2_decontamination": OP2, "op7_jaccard_join": OP7, "op11_phrase_collocations": OP11}
