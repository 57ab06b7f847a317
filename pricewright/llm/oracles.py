"""DuckDB SQL for the queries that SQL can express."""

MIXING = r"""
with sized as (
  select doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, 'null') || ':' || md5(coalesce(text, ''))), 1, 13))
           ::bigint::double / 4503599627370496::double as draw
  from documents
), totals as (
  select source, sum(size)::bigint as n from sized group by source
), weighed as (
  select source, n, case (row_number() over (order by source nulls last) - 1) % 3
                      when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end as w
  from totals
), ordered as (  -- those that reach twice their size come first
  select *, row_number() over (order by n / w, source nulls last) as k from weighed
), stops as (    -- the first k - 1 are full
  select k, (1.5::double * (select sum(n) from totals)
             - coalesce(sum(2 * n) over (order by k rows between unbounded preceding and 1 preceding), 0))::double as left_,
         sum(w) over (order by k rows between current row and unbounded following) as weight, n, w
  from ordered
), stop as (
  select * from stops where left_ * w / weight <= 2 * n order by k limit 1
), planned as (
  select o.source, o.n, case when o.k < s.k then (2 * o.n)::double else s.left_ * o.w / s.weight end as target
  from ordered o, stop s
), rated as (
  select *, case when n = 0 then 0 else target / n end as rate from planned
)
select s.doc_id, s.size, r.n as source_size, r.target,
       (s.size * (floor(r.rate)::bigint + case when s.draw < r.rate - floor(r.rate) then 1 else 0 end))::bigint as taken
from sized s join rated r on s.source is not distinct from r.source
"""

# crc32 of the UTF-8 bytes: the table is derived from the polynomial, then one step a byte.
SHARDING = r"""
with steps as (
  select i, list_reduce([i::bigint, 1, 2, 3, 4, 5, 6, 7, 8],
                        lambda c, x: case when c & 1 = 1 then xor(3988292384::bigint, c >> 1) else c >> 1 end) as c
  from range(256) t(i)
), crc_table as (
  select list(c order by i) as t from steps
), hexed as (
  select doc_id, hex(encode(coalesce(text, ''))) as h, strlen(coalesce(text, ''))::bigint + 1 as size,
         md5(coalesce(text, '')) as k
  from documents
), crcs as (
  select k, xor(4294967295::bigint, list_reduce(
           list_prepend(4294967295::bigint,
             list_transform(range(length(h) // 2), lambda j: ('0x' || substr(h, (2 * j + 1)::bigint, 2))::bigint)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) as crc
  from (select distinct k, h from hexed), crc_table
), run as (
  select doc_id, k, size,
         sum(size) over (order by k, doc_id nulls first rows between unbounded preceding and current row) as upto,
         row_number() over (order by k, doc_id nulls first) - 1 as n,
         sum(size) over () as total
  from hexed
), placed as (
  select *, least(7, ((2 * upto - size) * 8) // (2 * total))::int as shard from run
)
select doc_id, size, crc as text_crc32, 'bytes' as law, shard,
       (n - min(n) over (partition by shard))::bigint as slot, null::int as grown_shard
from placed join crcs using (k)
"""

DECONTAMINATION = r"""
with doc_words as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), item_words as (
  select coalesce(item_id::varchar, '') as item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark
), item_windows as (
  select distinct item, m, array_to_string(w[i:i + m - 1], ' ') as win
  from (select item, w, least(13, len(w)) as m, unnest(range(1, len(w) - least(13, len(w)) + 2)) as i
        from item_words where len(w) > 0)
), doc_windows as (
  select r, m, s, array_to_string(w[s:s + m - 1], ' ') as win
  from (select r, w, m, unnest(range(1, len(w) - m + 2)) as s
        from doc_words, (select distinct m from item_windows) where len(w) >= m)
), hits as (
  select r, s, m, item from doc_windows join item_windows using (m, win)
), hit_words as (
  select r, count(distinct p) as n from (select r, unnest(range(s, s + m)) as p from (select distinct r, s, m from hits))
  group by r
), hit_items as (
  select r, list_sort(list(distinct item)) as items from hits group by r
)
select doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_hit,
       coalesce(len(items), 0)::bigint as n_items, sha256(coalesce(array_to_string(items, ','), '')) as items_sha256,
       coalesce(n, 0) > 0 and 20 * coalesce(n, 0) >= len(w) as contaminated
from doc_words left join hit_words using (r) left join hit_items using (r)
"""

CHAT = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select * from (values (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))
), written as (
  select *, '### ' || replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\t'), ':', '\c') || ': '
            || replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\t') || '</turn>' || chr(10) as out
  from rows
)
select conv_id, count(*)::bigint as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(case when role = 'assistant' then length(text) end), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn, role, text), '')) as loss_sha256,
       sum(length(out))::bigint as formatted_chars,
       regexp_full_match(string_agg(case role when 'system' then 's' when 'user' then 'u' when 'assistant' then 'a' else '?' end, ''
                                    order by turn, role, text), 's?(ua)+') as valid
from written group by conv_id
"""

# The crc of a feature: one table step a byte, as in SHARDING, over distinct features.
RESAMPLING = r"""
with steps as (
  select i, list_reduce([i::bigint, 1, 2, 3, 4, 5, 6, 7, 8],
                        lambda c, x: case when c & 1 = 1 then xor(3988292384::bigint, c >> 1) else c >> 1 end) as c
  from range(256) t(i)
), crc_table as (
  select list(c order by i) as t from steps
), texts as (
  select 'd' as side, row_number() over () as r, doc_id, text from documents
  union all
  select 'b', row_number() over (), null, text from benchmark
), listed as (
  select side, r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from texts
), runs as (
  select side, r, array_to_string(w[i:i + k - 1], ' ') as f
  from (select side, r, w, k, unnest(range(1, len(w) - k + 2)) as i
        from listed, (values (1), (2), (3)) n(k) where len(w) >= k)
), counted as (
  select side, r, f, count(*)::bigint as n from runs group by all
), hexed as (
  select f, hex(encode(f)) as h from (select distinct f from counted)
), hashed as (
  select f, (xor(4294967295::bigint, list_reduce(
           list_prepend(4294967295::bigint,
             list_transform(range(length(h) // 2), lambda j: ('0x' || substr(h, (2 * j + 1)::bigint, 2))::bigint)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % 10000)::int as bucket
  from hexed, crc_table
), held as (
  select side, bucket, sum(n)::bigint as n from counted join hashed using (f) group by all
), totals as (
  select coalesce(sum(n) filter (side = 'd'), 0)::bigint as big_s, coalesce(sum(n) filter (side = 'b'), 0)::bigint as big_t from held
), gained as (
  select x.i as bucket, floor(1000 * ln(((coalesce(b.n, 0) + 1) * (big_s + 10000))::double
                                        / ((coalesce(d.n, 0) + 1) * (big_t + 10000))::double))::bigint as gain
  from range(10000) x(i) left join held d on d.bucket = x.i and d.side = 'd'
       left join held b on b.bucket = x.i and b.side = 'b', totals
), weighed as (
  select r, sum(n)::bigint as n_features, sum(n * gain)::bigint as weight
  from counted join hashed using (f) join gained using (bucket) where side = 'd' group by r
), scored as (
  select doc_id, len(w) as n_words, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::varchar, 'null')), 1, 8))::bigint
                                                      + 0.5::double) / 4294967296::double))))::bigint as score
  from listed left join weighed using (r) where side = 'd'
), placed as (
  select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id nulls last, n_features)::bigint as place,
         sum(case when n_words >= 20 then 1 else 0 end) over () as eligible
  from scored
)
select doc_id, n_features, weight, score,
       case when n_words >= 20 and place <= (5 * eligible) // 100 then place end as rank
from placed
"""
