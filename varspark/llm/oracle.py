"""DuckDB SQL of the queries that SQL can express on whole tables."""

from __future__ import annotations

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACED = r"[^\x20\x09-\x0D]+"

OP5 = f"""
with item_words as (
    select item_id, regexp_extract_all({_LOWER.format('text')}, '{_PLAIN}') as w from benchmark
), item_windows as (
    select distinct item_id, least(len(w), 13) as n, array_to_string(w[i + 1 : i + least(len(w), 13)], ' ') as words
    from (select item_id, w, unnest(range(0, len(w) - least(len(w), 13) + 1)) as i from item_words where len(w) > 0)
), docs as (
    select row_number() over () as r, doc_id, regexp_extract_all({_LOWER.format('text')}, '{_PLAIN}') as w from documents
), lengths as (select distinct n from item_windows),
runs as (
    select r, i, n, array_to_string(w[i + 1 : i + n], ' ') as words
    from (select r, w, n, unnest(range(0, len(w) - n + 1)) as i from docs, lengths where len(w) >= n)
), hits as (select r, i, runs.n, item_id from runs join item_windows using (n, words)),
covered as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from hits) group by r),
items as (
    select r, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as ids
    from (select distinct r, item_id from hits) group by r
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
    sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from docs left join covered using (r) left join items using (r)
"""

OP6 = f"""
with docs as (
    select row_number() over () as r, doc_id, source, md5(coalesce(text, '')) as h, len(regexp_extract_all(coalesce(text, ''), '{_SPACED}'))::bigint as size,
        (('0x' || substr(sha256('17|' || coalesce(doc_id::varchar, '') || '|' || md5(coalesce(text, ''))), 1, 13))::bigint::double + 0.5) / 4503599627370496.0 as u
    from documents
), wishes as (
    select *, (1000 * size) // (size + 500) as wish, count(*) over (partition by doc_id, source, h) as ties from docs
), sources as (
    select *, 2.0::double * source_size as cap, [3.0::double, 1.0, 2.0][((n - 1) % 3 + 1)::int] as weight from (
        select source, sum(size)::bigint as source_size, sum(size * wish)::bigint as wished, row_number() over (order by source nulls last) as n from wishes group by source)
), levels as (
    select *, 1.5::double * sum(source_size) over ()::bigint as total, sum(cap) over a as caps, sum(weight) over b as rest
    from sources window a as (order by cap / weight, n rows unbounded preceding),
        b as (order by cap / weight, n rows between current row and unbounded following)
), filled as (select *, weight * ((total - (caps - cap)) / rest) >= cap as is_full from levels),
plan as (
    select source, source_size, wished, case when is_full then cap else weight * ((total - sum(case when is_full then cap else 0 end) over ())
        / sum(case when is_full then 0 else weight end) over ()) end as target from filled
), shares as (
    select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as whole,
        case when source_size > 0 then target / source_size - floor(target / source_size) else 0 end as p from plan
), chances as (
    select d.*, source_size, target, whole, p, target - whole * source_size as room,
        case when p > 0 then p + least(p, 1 - p) / 2 * ((wish - wished::double / source_size::double) / 1000) end as chance
    from wishes d join shares s on d.source is not distinct from s.source
), ranked as (
    select *, (u / (1.0::double - u)) / (chance / (1.0::double - chance)) as rank from chances
), placed as (
    select *, p > 0 and sum(size) over (partition by source order by rank, doc_id, size, h) <= room as in_order from ranked
), remaining as (
    select *, room - sum(case when in_order then size else 0 end) over (partition by source) as open from placed
), closing as (
    select *, p > 0 and not in_order and abs(size * ties - open) < open and rank() over (
        partition by source order by p > 0 and not in_order and abs(size * ties - open) < open desc, abs(size * ties - open), rank, doc_id, size, h) = 1 as closes
    from remaining
)
select doc_id, size, source_size::bigint as source_size, target, ((whole + in_order::bigint + closes::bigint) * size)::bigint as taken from closing
"""

OP10 = r"""
with parts as (
    select page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) as path
    from pages
), judged as (
    select *, case
        when (host = 'example.net' or host like '%.example.net') and starts_with(path, '/en/') then 'example.net/en/'
        when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/de/') then 'example.com/de/'
        when (host = 'org' or host like '%.org') and starts_with(path, '/fr/') then 'org/fr/'
        when (host = 'net' or host like '%.net') and starts_with(path, '/') then 'net/' end as rule
    from parts
)
select page_id, host, path, rule, case
    when rule in ('net/', 'example.com/de/') then 'block' when rule is not null then 'allow'
    when regexp_matches(host, '(^|\.)(ads-track|adult-x|casino-win|cheap-pills)\.') then 'block' else 'allow' end as verdict
from judged
"""

OP1 = f"""
with docs as (
    select row_number() over () as r, doc_id, text, string_split(text, chr(10)) as l,
        list_transform(string_split(text, chr(10)), lambda x: len(regexp_extract_all(x, '{_SPACED}'))) as c from documents
), runs as (
    select r, doc_id, i, m, l[i + 1 : i + m] as w, m as kind from (select *, unnest(range(0, len(l) - m + 1)) as i from docs, (select unnest([1, 2, 3]) as m) where len(l) >= m)
    where m = 3 or list_sum(c[i + 1 : i + m]) >= 50
    union all select r, doc_id, 0, len(l), l, 0 from docs where len(l) < 3 and list_sum(c) between 1 and 49
), firsts as (select kind, w, min((coalesce(doc_id, -9223372036854775808), i)) as f from runs group by kind, w),
gone as (
    select distinct r, unnest(range(i, i + m)) as line from runs join firsts using (kind, w)
    where (coalesce(doc_id, -9223372036854775808), i) > f
), lines as (select r, unnest(l) as line_text, unnest(range(0, len(l))) as line from docs),
kept as (
    select r, count(*) filter (where gone.line is not null) as n_removed,
        string_agg(line_text, chr(10) order by lines.line) filter (where gone.line is null) as t
    from lines left join gone using (r, line) group by r
)
select doc_id, coalesce(len(l), 0)::bigint as n_lines, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from docs left join kept using (r)
"""

_SIGN = "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(d, {at}, 10))::bigint >> {shift}) & 31) + 1)::int, 1)"
_BASE32 = " || ".join(_SIGN.format(at=at, shift=shift) for at in (1, 11, 21, 31) for shift in range(35, -1, -5))

OP3 = f"""
with payloads as (select page_id, coalesce(html, '') as p, sha1(coalesce(html, '')) as d from pages),
firsts as (select p, min(page_id) as f from payloads group by p)
select page_id, strlen(p)::bigint as payload_bytes, {_BASE32} as payload_digest,
    case when page_id = f then 'response' else 'revisit' end as record_type, case when page_id <> f then f end as refers_to
from payloads join firsts using (p)
"""

OP4 = f"""
with recursive docs as (
    select doc_id, regexp_extract_all({_LOWER.format('text')}, '{_SPACED}') as w from documents
), shingles as (
    select distinct doc_id, array_to_string(w[i + 1 : i + 5], ' ') as s
    from (select doc_id, w, unnest(range(0, greatest(len(w) - 4, 1))) as i from docs where len(w) > 0)
), sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
    select a.doc_id as a, b.doc_id as b, count(*) as c from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by all
), links as (
    select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)
), reach as (select a, b from links union select reach.a, links.b from reach join links on reach.b = links.a)
select doc_id, coalesce(n, 0)::bigint as n_shingles, least(doc_id, coalesce(low, doc_id)) as component_id
from docs left join sizes using (doc_id) left join (select a as doc_id, min(b) as low from reach group by a) using (doc_id)
"""


OP11 = f"""
with recursive words as (
    select row_number() over () as r, doc_id, coalesce(lang, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '{_SPACED}') as w from documents
), firsts as (select t, min(doc_id) as first from words group by t),
marks as (select doc_id, max(coalesce((quality = 1)::int, 0)) as good, max(coalesce((toxic = 1)::int, 0)) as toxic from labels group by doc_id),
failed as (
    select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic, map {{
        'A': len(w) < 200, 'B': 100 * len(list_distinct(w)) < 50 * len(w),
        'C': 100 * (strlen(t) - strlen(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t),
        'D': regexp_matches(t, '[#$%&*|]'), 'E': coalesce(words.doc_id > first, false)}} as f
    from words join firsts using (t) left join marks on marks.doc_id = words.doc_id
), kinds as (
    select part, f, count(*) as n, sum(good) as good, sum(toxic) as toxic, len(list_filter(map_values(f), lambda x: x)) as fails from failed group by part, f
), orders as (
    select '' as o union all select o || x from orders, (select unnest(['A', 'B', 'C', 'D', 'E']) as x) where not contains(o, x)
), steps as (select o, i::int as step, o[i] as own, o[1 : i - 1] as earlier from orders, (select unnest(range(1, 6)) as i) where len(o) = 5),
counted as (
    select part, o, step, own, sum(case when gone or hit then 0 else n end) as kept, sum(case when hit and not gone then n else 0 end) as removed,
        sum(case when hit and gone then n else 0 end) as redundant, sum(case when hit and fails = 1 then n else 0 end) as unique_fails,
        sum(case when hit and not gone then good else 0 end) as good_lost, sum(case when hit and not gone then toxic else 0 end) as toxic_lost
    from (select *, f[own] as hit, len(list_filter(string_split(earlier, ''), lambda x: x <> '' and f[x])) > 0 as gone from kinds, steps)
    group by part, o, step, own
)
select part, o as filter_order, step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant, unique_fails::bigint as unique_fails,
    good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost, (sum(removed) over (partition by part, own))::bigint as shapley
from counted
"""

# The curve of three dimensions of 8 bits each, level by level; the crc of a text byte by byte from the table of its polynomial.
OP12 = """
with recursive polynomial as (
    select list_transform(range(0, 256), lambda b: list_reduce([b] || range(0, 8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as table_of
), docs as (
    select row_number() over () as r, doc_id, source, lang, coalesce(strlen(text), 0)::bigint as bytes, hex(encode(coalesce(text, ''))) as h, count(*) over () as n from documents
), sums as (
    select r, xor(list_reduce([4294967295] || list_transform(range(0, bytes), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::bigint),
        lambda c, x: xor(c >> 8, table_of[(xor(c, x) & 255) + 1])), 4294967295) as text_crc32 from docs, polynomial
), cells as (
    select *, case when source is null then 0 else (256 * (rank() over (order by source nulls first) - 1)) // n end as a,
        case when lang is null then 0 else (256 * (rank() over (order by lang nulls first) - 1)) // n end as b, (256 * (rank() over (order by bytes) - 1)) // n as c
    from docs
), turned as (
    select r, 7 as level, a::bigint as x, b::bigint as y, c::bigint as z from cells
    union all
    select r, level - 1, case when z >> level & 1 = 1 then xor(x, m) else xor(x, xor(x, z) & m) end, y, case when z >> level & 1 = 1 then z else xor(z, xor(x, z) & m) end
    from (
        select r, level, m, z, case when y >> level & 1 = 1 then xor(x, m) else xor(x, xor(x, y) & m) end as x, case when y >> level & 1 = 1 then y else xor(y, xor(x, y) & m) end as y
        from (select r, level, m, y, z, case when x >> level & 1 = 1 then xor(x, m) else x end as x from (select *, ((1 << level) - 1)::bigint as m from turned where level > 0))
    )
), gray as (select r, x, xor(x, y) as y, xor(xor(x, y), z) as z from turned where level = 0),
points as (
    select r, xor(x, g) as x, xor(y, g) as y, xor(z, g) as z from (
        select *, list_reduce([0::bigint] || list_transform(range(1, 8), lambda k: case when z >> k & 1 = 1 then (1 << k) - 1 else 0 end::bigint), lambda p, q: xor(p, q)) as g from gray)
), placed as (
    select *, list_sum(list_transform(range(0, 8), lambda k: ((x >> k & 1) << (3 * k + 2)) + ((y >> k & 1) << (3 * k + 1)) + ((z >> k & 1) << (3 * k))))::bigint as curve
    from cells join points using (r) join sums using (r)
), ranked as (select *, row_number() over (order by curve, doc_id nulls first) - 1 as rank from placed),
dealt as (select *, ((rank + 1) * 24 - 1) // n as shard from ranked)
select doc_id, bytes + 8 as size, text_crc32::bigint as text_crc32, 'rows' as law, shard::int as shard,
    (rank - min(rank) over (partition by shard))::bigint as slot, null::int as grown_shard
from dealt
"""

OP13 = f"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({_LOWER.format('text')}, '[.,;:!?\x0A-\x0D]')) as piece from documents
), words as (select row_number() over () as r, lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
totals as (select lang, sum(len(w))::bigint as n from words group by lang),
counts as (
    select lang, k, array_to_string(w[i + 1 : i + k], ' ') as phrase, count(*)::hugeint as f,
        count(*) filter (where i > 0) as before, count(*) filter (where i + k < len(w)) as after
    from (select lang, w, k, unnest(range(0, len(w) - k + 1)) as i from words, (select unnest([1, 2, 3, 4]) as k) where len(w) >= k)
    group by all having count(*) >= 30
), candidates as (select *, string_split(phrase, ' ') as w from counts where k > 1),
cuts as (
    select c.lang, c.phrase, x.f as l, y.f as r, j, 2000000 * c.f // (x.f + y.f) as score
    from (select *, unnest(range(1, k)) as j from candidates) c
    join counts x on x.lang = c.lang and x.phrase = array_to_string(c.w[1 : j], ' ') join counts y on y.lang = c.lang and y.phrase = array_to_string(c.w[j + 1 :], ' ')
), lowest as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, j) = 1),
inner_parts as (
    select lang, array_to_string(w[i + 1 : i + m], ' ') as phrase, max(f) as longer from (
        select *, unnest(range(0, k - m + 1)) as i from (select *, unnest(range(2, k)) as m from candidates)) group by all
), kept as (
    select c.lang, c.phrase, c.f, l, r, score, c.before, c.after from candidates c join lowest using (lang, phrase) left join inner_parts using (lang, phrase)
    where longer is null or 100 * longer < 80 * c.f
)
select lang, rank, phrase, f::bigint as a, l::bigint as l, r::bigint as r, n, score::bigint as score, before, after
from (select *, row_number() over (partition by lang order by score desc, f desc, phrase) as rank from kept) join totals using (lang) where rank <= 2000
"""

SQL = {
    "op3_warc": OP3, "op4_jaccard_join": OP4, "op1_line_dedup": OP1, "op5_decontaminate": OP5, "op6_mix_sources": OP6, "op10_url_filter": OP10,
    "op11_filter_audit": OP11, "op12_hilbert_shards": OP12, "op13_collocations": OP13,
}
