"""DuckDB SQL of the corpus queries that SQL can express.

Written from the contracts and the documented parameters, not from the plans:
repeated windows by grouping words, quantiles by ordering buckets.
"""

from __future__ import annotations

WS = r"[\x20\x09-\x0D]"

QUALITY = rf"""
with d as (
  select row_number() over () rid, doc_id, coalesce(text, '') as text, lang, source from documents),
w as (
  select rid, word, row_number() over (partition by rid order by i) pos from (
    select rid, unnest(string_split_regex(text, '{WS}+')) word, generate_subscripts(string_split_regex(text, '{WS}+'), 1) i
    from d) where word != ''),
tri as (
  select rid, pos, word w1, lead(word) over o w2, lead(word, 2) over o w3 from w window o as (partition by rid order by pos)),
again as (
  select rid, pos from (select rid, pos, count(*) over (partition by rid, w1, w2, w3) c from tri where w3 is not null) where c > 1),
covered as (
  select rid, count(distinct p) n from (select rid, unnest([pos, pos + 1, pos + 2]) p from again) group by rid),
words as (select rid, count(*) n, sum(length(word)) chars from w group by rid),
lines as (
  select rid, count(*) n, count(*) - count(distinct line) dup from (
    select rid, unnest(string_split(text, chr(10))) line from d) where regexp_matches(line, '[^\x20\x09-\x0D]') group by rid),
b as (
  select d.rid, doc_id, lang, source, coalesce(words.n, 0)::bigint n_words, coalesce(words.chars, 0)::bigint word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint n_symbols,
    coalesce(lines.n, 0)::bigint n_lines, coalesce(lines.dup, 0)::bigint n_dup_lines, coalesce(covered.n, 0)::bigint n_repeat_words
  from d left join words using (rid) left join lines using (rid) left join covered using (rid)),
f as (select *, (n_words < 50 or 100 * n_repeat_words > 50 * n_words) base_failed from b),
m as (
  select lang, source, measure, x from (
    select lang, source, unnest(['symbols', 'dup_lines', 'repeats', 'word_length']) measure,
      unnest([n_symbols / n_words, n_dup_lines / n_lines, n_repeat_words / n_words, word_chars / n_words]) x
    from f where not base_failed)),
k as (
  select lang, source, measure, case when x < 0.001 then 0 else 1 + floor(ln(x / 0.001) / 0.040005334613699) end::int bucket
  from m),
levels as (
  select 1 as lv, lang, source, measure, bucket from k union all select 2, lang, null, measure, bucket from k
  union all select 3, null, null, measure, bucket from k),
ordered as (
  select *, row_number() over (partition by lv, lang, source, measure order by bucket) r,
    count(*) over (partition by lv, lang, source, measure) n from levels),
q as (
  select lv, lang, source, measure, max(n) n,
    min(case when r >= ceil(0.25 * n) then bucket end) b1, min(case when r >= ceil(0.75 * n) then bucket end) b3
  from ordered group by all),
v as (
  select *, case when b1 = 0 then 0 else 0.001 * exp((b1 - 0.5) * 0.040005334613699) end q1,
    case when b3 = 0 then 0 else 0.001 * exp((b3 - 0.5) * 0.040005334613699) end q3,
    case measure when 'symbols' then 0.1 when 'dup_lines' then 0.4 when 'repeats' then 0.3 else 1.0 end margin from q),
fence as (
  select lv, lang, source, measure, n, q3 + greatest(3 * (q3 - q1), margin) high, q1 - greatest(3 * (q3 - q1), margin) low
  from v),
limits as (
  select f.rid, f.lang, f.source, f.base_failed, fence.*
  from f join fence on (lv = 3 or (lv = 2 and fence.lang is not distinct from f.lang)
    or (lv = 1 and fence.lang is not distinct from f.lang and fence.source is not distinct from f.source))),
own as (select rid, measure, high, low from (
  select rid, measure, high, low, row_number() over (
    partition by rid, measure order by case when lv = 3 or n >= 200 then lv else 9 end) o,
    bool_or(lv = 1) over (partition by rid) judged from limits)
  where o = 1 and judged),
verdict as (
  select rid, bool_and(case measure
    when 'symbols' then n_symbols / n_words <= high when 'dup_lines' then n_dup_lines / n_lines <= high
    when 'repeats' then n_repeat_words / n_words <= high
    else word_chars / n_words <= high and word_chars / n_words >= low end) inside
  from own join f using (rid) where not base_failed group by rid)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  case when base_failed then false else coalesce(inside, true) end kept
from f left join verdict using (rid)
"""


def _escaped(c: str) -> str:
    return f"replace(replace(replace({c}, '&', '&amp;'), '<|', '&lt;|'), '|>', '|&gt;')"


CHAT = f"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
p as (
  select *, (strlen(text) + 3) // 4 + 4 as n, row_number() over (partition by conv_id order by turn, role, text) - 1 as pos,
    18 + length({_escaped('role')}) + length({_escaped('text')}) as chars from t),
s as (select *, sum(n) over (partition by conv_id order by pos rows unbounded preceding) - n as s from p),
y as (
  select s.*, coalesce(z.n, 0) as y, coalesce(z.chars, 0) as ychars
  from s left join (select conv_id, n, chars from p where pos = 0 and role = 'system') z
    on z.conv_id is not distinct from s.conv_id),
l as (select *, greatest(4, 832 - y) as room from y),
c as (select *, (n > room // 4)::int as long, (s // (room - room // 4))::bigint as cell from l),
k as (select *, sum(long) over (partition by conv_id, cell order by pos rows unbounded preceding) as k from c),
w as (
  select *, min(s) over g as first, max(s + n) over g as past from k window g as (partition by conv_id, cell, k, long)),
made as (
  select conv_id, first, max(ychars) as ychars from w group by all),
again as (
  select w.conv_id, sum(w.chars) as chars from w join made on made.conv_id is not distinct from w.conv_id
    and made.first = w.past
  where w.s >= w.past - 192 and not (w.pos = 0 and w.role = 'system') group by all),
heads as (select conv_id, sum(ychars) as chars from made where first > 0 group by all),
base as (
  select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by pos)) as turns_sha256,
    coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by pos) filter (where role = 'assistant'), '')) as loss_sha256,
    sum(chars) as chars from p group by all)
select base.conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
  (base.chars + coalesce(again.chars, 0) + coalesce(heads.chars, 0))::bigint as formatted_chars
from base left join again on again.conv_id is not distinct from base.conv_id
  left join heads on heads.conv_id is not distinct from base.conv_id
"""

_PLACE = "('0x' || substr(md5('42:' || {epoch}::varchar || ':' || coalesce(doc_id::varchar, '') || ':' || digest), 1, 15))::bigint"

MIXING = f"""
with recursive r as (
  select doc_id, source, md5(coalesce(text, '')) as digest, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as t from documents),
s as (select source, sum(t)::bigint as t from r where t > 0 group by source),
p as (select source, t, t / (sum(t) over ())::double as p, count(*) over () as n from s),
bisect(k, lo, hi, lo2, hi2) as (
  select 0, 0::double, 1::double, 0::double, 1::double
  union all
  select k + 1, if(h >= goal, m, lo), if(h >= goal, hi, m), if(most <= 4, lo2, m2), if(most <= 4, m2, hi2) from (
    select k, lo, hi, lo2, hi2, (lo + hi) / 2 as m, (lo2 + hi2) / 2 as m2,
      (select ln(sum(p ^ ((lo + hi) / 2))) - sum(p ^ ((lo + hi) / 2) * ((lo + hi) / 2) * ln(p)) / sum(p ^ ((lo + hi) / 2)) from p) as h,
      (select max(p ^ ((lo2 + hi2) / 2) / p) / sum(p ^ ((lo2 + hi2) / 2)) from p) as most,
      (select 0.98 * ln(max(n)) from p) as goal
    from bisect where k < 45)),
a as (select case when (select count(*) from s) < 2 then 1.0 else round(greatest(hi, case when (
    select max(1 / p) / count(*) from p) <= 4 then 0 else hi2 end), 6) end as a from bisect where k = 45),
w as (
  select source, t, p ^ a / sum(p ^ a) over () as weight, sum(t) over () as whole from p, a),
b as (
  select source, t, least(floor(weight * whole), floor(t * 4.0))::bigint as budget from w),
q as (select source as src, budget // t as passes, budget - (budget // t) * t as rest from b),
l as (
  select doc_id, digest, source, t, passes, rest, {_PLACE.format(epoch="passes")} as place
  from r join q on source is not distinct from src where t > 0),
u as (
  select *, sum(t) over (partition by source order by place range unbounded preceding) - sum(t) over (partition by source, place) < rest as more from l)
select doc_id, source, t as n_tokens, epoch, {_PLACE.format(epoch="epoch")} as place
from (select doc_id, digest, source, t, unnest(range(passes + more::int)) as epoch from u)
"""

FIXITY = r"""
with p as (
  select coalesce(floor(page_id / 256), -1)::bigint as file, page_id, coalesce(url, '') as uri, coalesce(html, '') as html from pages),
r as (
  select file, page_id, uri, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Target-URI: '
    || uri || chr(13) || chr(10) || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10) || html
    || chr(13) || chr(10) || chr(13) || chr(10) as content from p),
h as (select *, strlen(content)::bigint as length, sha256(content) as sha256, sha256('#' || substr(content, 2)) as other from r),
o as (
  select *, (sum(length) over (partition by file order by page_id nulls first, uri, sha256 rows unbounded preceding)
    - length)::bigint as offset_ from h)
select file, offset_ as "offset", uri, length, sha256, case when page_id % 89 = 7 then null else other end as found_sha256,
  case when page_id % 89 = 7 then 'missing' else 'changed' end as status
from o where page_id % 97 = 13 or page_id % 89 = 7
"""

#: The unsigned CRC-32 of an ASCII string s, bit by bit.
CRC = ("xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split({s}, ''), lambda ch: ascii(ch)::bigint)), "
       "lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda r, z: xor(r >> 1, 3988292384 * (r & 1)))), 4294967295)")

#: Runs as islands of equal groups of six words at one distance.
RUNS = rf"""
with d as (
  select row_number() over () rid, doc_id, coalesce(text, '') as text, {CRC.format(s="doc_id::varchar")} h from documents),
said as (
  select rid, h, list_filter(string_split_regex(text, '{WS}+'), lambda x: x != '') ws from d),
planted as (
  select *, len(ws) n, case when h % 10 = 0 and len(ws) > 0 then (h // 10) % len(ws) end a from said),
w as (
  select rid, i, case when a is null or i < a then ws[i + 1] else ws[a + (i - a) % p + 1] end word from (
    select *, unnest(range(n)) i, 1 + (n - a) // (3 + (h // 10) % 8) p from planted)),
six as (
  select rid, i, hash(word, lead(word) over o, lead(word, 2) over o, lead(word, 3) over o, lead(word, 4) over o, lead(word, 5) over o) k,
    lead(word, 5) over o is not null whole
  from w window o as (partition by rid order by i)),
pairs as (
  select x.rid, x.i, x.i - y.i q from six x join six y on x.rid = y.rid and x.k = y.k and y.i < x.i where x.whole and y.whole),
spans as (
  select rid, q, min(i) - q s, max(i) - min(i) + 6 + q size
  from (select rid, q, i, i - row_number() over (partition by rid, q order by i) island from pairs) group by rid, q, island),
long as (select * from spans where size >= greatest(12, 2 * q)),
runs as (
  select * from long x where not exists (
    select 1 from long y where y.rid = x.rid and y.q < x.q and y.s <= x.s and y.s + y.size >= x.s + x.size)),
told as (
  select rid, count(*) n_runs, sha256(string_agg(s || ',' || size || ',' || q || chr(10), '' order by s, q)) runs_sha256,
    min(struct_pack(less := -size, s := s, q := q)) best from runs group by rid),
kept as (
  select rid, sha256(coalesce(string_agg(word, ' ' order by i), '')) collapsed_sha256 from w
  where not exists (select 1 from runs r where r.rid = w.rid and i >= r.s + r.q and i < r.s + r.size) group by rid)
select doc_id, coalesce(n_runs, 0) n_runs, best.s as start, -best.less as length, best.q period,
  (1000 * -best.less) // best.q exponent_milli, coalesce(runs_sha256, sha256('')) runs_sha256, coalesce(collapsed_sha256, sha256('')) collapsed_sha256
from d left join told using (rid) left join kept using (rid)
"""

#: Links by comparing all pairs of a label, components by walking them.
VECTORS = r"""
with recursive v as (
  select row_number() over () rid, vec_id, label, embedding::double[] e from embeddings),
u as (
  select rid, vec_id, label, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) e from v
  where label is not null and len(e) > 0 and len(list_filter(e, lambda x: coalesce(isfinite(x), false))) = len(e)
    and len(list_filter(e, lambda x: x <> 0)) > 0),
links as (
  select a.rid a, b.rid b, b.vec_id from u a join u b on a.label = b.label and a.rid <> b.rid and len(a.e) = len(b.e)
    and list_dot_product(a.e, b.e) >= 0.98),
reach as (
  select rid first, rid other from v union select first, b from reach join links on a = other),
least as (
  select first rid, min(vec_id) component_id from reach join v on v.rid = other group by first),
direct as (
  select a rid, count(*) n_links from links group by a)
select vec_id, coalesce(n_links, 0)::bigint n_links, component_id, vec_id is not distinct from component_id kept
from v join least using (rid) left join direct using (rid)
"""

#: The states of every turn one after the other; best alternatives by (cost, audit).
REPAIR = rf"""
with recursive t as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    {CRC.format(s="(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '))")} % 20 h from conversations),
hurt as (
  select conv_id, turn, case h when 4 then 'user' else role end as role,
    case h when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(range(case h when 3 then 2 else 1 end)) from t where h <> 0),
seen as (
  select conv_id, turn, role, text, left(role, 1) head, not regexp_matches(text, '[^\x20\x09-\x0D]') blank,
    not regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') broken,
    row_number() over (partition by conv_id order by turn nulls first, role, text) i from hurt),
told_before as (
  select *, row_number() over (partition by conv_id, role, text order by i) > 1 again from seen),
r as (
  select *, not blank and again dup, not blank and not again and broken cut,
    lead(head) over (partition by conv_id order by i) after from told_before),
more(f, t, cost, say) as (
  values (0, 0, 0, ''), (0, 2, 3, 'I'), (0, 3, 6, 'II'), (1, 1, 0, ''), (1, 2, 3, 'I'), (1, 3, 6, 'II'), (2, 2, 0, ''), (2, 3, 3, 'I'),
    (3, 3, 0, ''), (3, 2, 3, 'I')),
act(f, t, cost, say, need) as (
  values (0, 0, 4, 'D', ''), (1, 1, 4, 'D', ''), (2, 2, 4, 'D', ''), (3, 3, 4, 'D', ''), (0, 1, 0, 'K', 's'), (0, 2, 0, 'K', 'u'),
    (1, 2, 0, 'K', 'u'), (3, 2, 0, 'K', 'u'), (2, 3, 0, 'K', 'a'), (0, 2, 3, 'R', ''), (1, 2, 3, 'R', ''), (3, 2, 3, 'R', ''), (2, 3, 3, 'R', '')),
way as (
  select distinct conv_id, 0::bigint i, 0 s, struct_pack(c := 0, a := '') best from r
  union all
  select way.conv_id, r.i, act.t, min(struct_pack(
    c := best.c + more.cost + act.cost + case when cut and act.say <> 'D' then 3 else 0 end, a := best.a || more.say || act.say))
  from way join r on r.conv_id is not distinct from way.conv_id and r.i = way.i + 1 join more on more.f = s join act on act.f = more.t
    and (act.say = 'D' or not blank and not dup and (act.say = 'R' or need = head))
  group by way.conv_id, r.i, act.t),
best as (
  select way.conv_id, min(struct_pack(c := best.c + cost, a := best.a || say)) best from way join more on f = s and t in (0, 3)
    join (select conv_id, max(i) i from r group by conv_id) n on n.conv_id is not distinct from way.conv_id and n.i = way.i
  group by way.conv_id),
say as (
  select conv_id, j, letter, count(*) filter (letter <> 'I') over o i, count(*) filter (letter <> 'D') over o k from (
    select conv_id, unnest(string_split(best.a, '')) letter, generate_subscripts(string_split(best.a, ''), 1) j from best where best.a <> '')
  window o as (partition by conv_id order by j)),
put as (
  select say.conv_id, j, letter, k, r.role, r.text, r.head from say left join r
    on letter <> 'I' and r.conv_id is not distinct from say.conv_id and r.i = say.i where letter <> 'D'),
led as (
  select conv_id, bool_or(k = 1 and letter = 'K' and head = 's') led from put group by conv_id),
told as (
  select put.conv_id, sha256(string_agg(case when letter = 'K' then role when (k - led::int) % 2 = 1 then 'user' else 'assistant' end
    || ':' || coalesce(text, ''), chr(10) order by j)) sha from put join led on led.conv_id is not distinct from put.conv_id
  group by put.conv_id),
sums as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps, count(*) filter (blank) blank,
    count(*) filter (dup) duplicate, count(*) filter (cut) truncated,
    count(*) filter (after is not null and head || after not in ('su', 'ua', 'au')) illegal from r group by conv_id)
select c.conv_id, coalesce(gaps, 0)::bigint gaps, coalesce(blank, 0)::bigint blank, coalesce(duplicate, 0)::bigint duplicate,
  coalesce(truncated, 0)::bigint truncated, coalesce(illegal, 0)::bigint illegal, coalesce(best.c, 0)::bigint cost,
  coalesce(best.a, '') audit, coalesce(sha, sha256('')) repaired_sha256
from (select distinct conv_id from conversations) c left join sums on sums.conv_id is not distinct from c.conv_id
  left join best on best.conv_id is not distinct from c.conv_id left join told on told.conv_id is not distinct from c.conv_id
"""
