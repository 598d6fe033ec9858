"""DuckDB equivalents of the queries that SQL can express, on whole tables."""

from __future__ import annotations

from almacen.llm.chat_format import END, START
from almacen.llm.license_texts import KNOWN, SPELLINGS, WHOLE_DIGESTS
from almacen.llm.licenses import (
    BEGINS_OPEN,
    BODY_LINE,
    BROKEN_HYPHEN,
    DATED_LINE,
    FROM_OPENING,
    HOLDER_LINE,
    LOWER,
    NOT_WORD,
    NOTICE_BEFORE,
    NOTICE_TO_END,
    PARAGRAPHS,
    SIGNS,
    UPPER,
)

_WORDS = r"'[^\x20\x09-\x0D]+'"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


MIXING = f"""
with sized as (
    select doc_id, source, coalesce(len(regexp_extract_all(text, {_WORDS})), 0)::bigint as size,
        (('0x' || substr(md5(coalesce(doc_id::varchar, 'no key ' || md5(text), 'none') || ':mix'), 1, 13))
            ::bigint::double + 0.5) / 4503599627370496.0::double as u
    from documents
), sources as (
    select source, sum(size)::bigint as source_size from sized group by source
), weighted as (
    select *, [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight
    from sources
), summed as (
    select *, sum(source_size) over ()::double as total, sum(weight) over ()::double as weights
    from weighted
), levels as (
    select *, (1.5::double * total - coalesce(sum(source_size * 2) over w, 0)::double)
            / (weights - coalesce(sum(weight) over w, 0)::double) as level
    from summed
    window w as (
        order by (source_size * 2)::double / weight, source nulls last
        rows between unbounded preceding and 1 preceding
    )
), targets as (
    select source, source_size,
        case when (source_size * 2)::double / weight <= level then (source_size * 2)::double
        else max(case when (source_size * 2)::double / weight > level then level end) over ()
            * weight end as target
    from levels
), merits as (
    select source, length(bin(size + 1)) as merit, sum(size)::bigint as words
    from sized where size > 0 group by all
), slopes as (
    select m.source, merit,
        (target - coalesce(sum(words * 2) over (partition by m.source order by merit desc
            rows between unbounded preceding and 1 preceding), 0)::double)
        / sum(words * merit) over (partition by m.source order by merit desc
            rows between current row and unbounded following)::double as each
    from merits m join targets t on m.source is not distinct from t.source
), slope as (
    select source, coalesce(max(case when each * merit < 2 then each end), 2.0::double) as each
    from slopes group by source
), expected as (
    select d.*, t.source_size, t.target,
        case when size > 0 then least(each * length(bin(size + 1)), 2.0::double)
            else 0.0::double end as copies_wanted
    from sized d
    join targets t on d.source is not distinct from t.source
    left join slope s on d.source is not distinct from s.source
), ranked as (
    select *, floor(copies_wanted)::bigint as certain, copies_wanted - floor(copies_wanted) as part
    from expected
), drawn as (
    select *, case when part > 0 then ln(u / (1 - u)) - ln(part / (1 - part)) end as rank
    from ranked
), cumulated as (
    select *, target - sum(certain * size) over (partition by source)::double as wanted,
        sum(case when rank is not null then size else 0 end) over (partition by source
            order by rank nulls last, doc_id nulls first, size rows unbounded preceding) as reached
    from drawn
), copied as (
    select *, certain + case when rank is not null and reached - size / 2.0::double <= wanted
        then 1 else 0 end as copies
    from cumulated
)
select doc_id, source, size, source_size, target, copies, copies * size as taken from copied
"""

EXACT_DEDUP = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
    doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents
window same as (partition by coalesce(text, ''))
"""

_LOWER = f"translate(text, '{UPPER}', '{LOWER}')"

_REACH = """
), reached as (
    select a as node, b as other from linked union select b, a from linked
    union
    select r.node, case when l.a = r.other then l.b else l.a end
    from reached r join linked l on l.a = r.other or l.b = r.other
"""

JACCARD_JOIN = rf"""
with recursive worded as (
    select doc_id, regexp_extract_all({_LOWER}, {_WORDS}) as w from documents
), shingles as (
    select doc_id, unnest(list_distinct(case when len(w) = 0 then []
        when len(w) < 5 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
        end)) as s
    from worded
), sizes as (
    select doc_id, count(s) as n from shingles group by doc_id
), met as (
    select a.doc_id as a, b.doc_id as b, count(*) as both_have
    from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all
), linked as (
    select a, b from met join sizes x on x.doc_id = a join sizes y on y.doc_id = b
    where 100 * both_have >= 80 * (x.n + y.n - both_have)
{_REACH}
)
select d.doc_id, coalesce(any_value(n), 0)::bigint as n_shingles,
    least(d.doc_id, coalesce(min(other), d.doc_id)) as component_id
from documents d left join sizes s using (doc_id) left join reached r on r.node = d.doc_id
group by d.doc_id
"""

EMBEDDING_DEDUP = f"""
with recursive usable as (
    select vec_id, embedding::double[] as v from embeddings
    where embedding is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(embedding, lambda x: x != 0)) > 0
), linked as (
    select x.vec_id as a, y.vec_id as b from usable x join usable y
        on x.vec_id < y.vec_id and len(x.v) = len(y.v)
    where list_cosine_similarity(x.v, y.v) >= 0.9
{_REACH}
), counted as (
    select node, count(*) as n from (select a as node from linked union all select b from linked)
    group by node
), labelled as (
    select e.vec_id, coalesce(any_value(n), 0)::bigint as n_links,
        least(e.vec_id, coalesce(min(other), e.vec_id)) as component_id
    from embeddings e left join counted c on c.node = e.vec_id
    left join reached r on r.node = e.vec_id
    group by e.vec_id
)
select *, vec_id = component_id as kept from labelled
"""

def _spelled(text: str) -> str:
    for variant, usual in SPELLINGS:
        text = f"replace({text}, {_quoted(variant)}, {_quoted(usual)})"
    return text


_PARTS = f"regexp_split_to_array(lowered, {_quoted(PARAGRAPHS)})"
_CLEARED = rf"""
    select *, case when contains(lowered, '{SIGNS[0]}') or contains(lowered, '{SIGNS[1]}')
            or contains(lowered, '{SIGNS[2]}')
        then array_to_string(list_transform(string_split(array_to_string(list_transform(
            paragraphs, lambda p, i: case
                when regexp_matches(p, {_quoted(NOTICE_BEFORE)})
                    then regexp_replace(p, {_quoted(NOTICE_BEFORE)}, '\1 \3')
                when regexp_matches(paragraphs[i + 1], {_quoted(BEGINS_OPEN)})
                    then regexp_replace(p, {_quoted(NOTICE_TO_END)}, '\1')
                else p end), chr(10) || chr(10)), chr(10)),
            lambda x: case when regexp_matches(x, {_quoted(DATED_LINE)})
                    or (regexp_matches(x, {_quoted(HOLDER_LINE)}) and not regexp_matches(x, {_quoted(BODY_LINE)}))
                then regexp_extract(x, {_quoted(FROM_OPENING)}, 1) else x end), chr(10))
        else lowered end as cleared
"""


def _digest(text: str) -> str:
    return f"sha256(trim(regexp_replace({text}, {_quoted(NOT_WORD)}, ' ', 'g')))"


_spaced = r"regexp_replace(cleared, '\s+', ' ', 'g')"
_WHOLE = _digest(_spelled(rf"regexp_replace({_spaced}, '{BROKEN_HYPHEN}', '\1-\2', 'g')"))

LICENSES = rf"""
with texts(license, text) as (
    values {", ".join(f"({_quoted(name)}, {_quoted(text)})" for name, text in KNOWN)}
), known as (
    select {_WHOLE} as digest, min(license) as license
    from ({_CLEARED} from (select *, {_PARTS} as paragraphs from (
        select license, translate(text, '{UPPER}', '{LOWER}') as lowered from texts)))
    group by 1
), wholes as (
    select * from known union all values {", ".join(f"('{d}', '{name}')" for name, d in WHOLE_DIGESTS)}
), given as (
    {_CLEARED} from (select *, {_PARTS} as paragraphs from (
        select row_number() over () as row, doc_id,
            translate(coalesce(text, ''), '{UPPER}', '{LOWER}') as lowered from documents))
), lines as (
    select row, unnest(string_split({_spelled("cleared")}, chr(10))) as line from given
), named as (
    select row, string_agg(distinct license, ', ' order by license) as notices,
        count(*) as n_notices
    from lines join known on {_digest("line")} = digest group by row
)
select g.doc_id, {_WHOLE} as text_digest, k.license,
    coalesce(notices, '') as notices, coalesce(n_notices, 0) as n_notices
from given g left join wholes k on k.digest = {_WHOLE}
left join named n on n.row = g.row
"""

CHAT_FORMAT = rf"""
with said as (
    select conv_id, turn::bigint as turn, coalesce(role, 'unknown') as speaker,
        replace(coalesce(text, ''), '<|', '< |') as text
    from conversations
), sides as (
    select distinct conv_id, speaker as perspective from said where speaker != 'system'
), labelled as (
    select s.conv_id, perspective, turn, speaker, text, speaker = perspective as mask,
        case when speaker = 'system' then 'system' when speaker = perspective then 'assistant'
        else 'user name=' || regexp_replace(speaker, '[\x00-\x20<>|]', '_', 'g') end as label
    from said s join sides p on s.conv_id is not distinct from p.conv_id
), rendered as (
    select *, '{START}' || label || chr(10) as head,
        '{START}' || label || chr(10) || text || {_quoted(END.strip())} || chr(10) as segment
    from labelled
), placed as (
    select *, row_number() over told as position,
        (sum(length(segment)) over (told rows unbounded preceding))::bigint as ends_at
    from rendered
    window told as (partition by conv_id, perspective order by turn nulls last, speaker, text)
)
select conv_id, perspective, turn, position, label, segment, ends_at - length(segment) as starts_at,
    ends_at, case when mask then ends_at - length(segment) + length(head) end as learns_from, mask
from placed
"""

SOURCE_AUDIT = rf"""
with given as (
    select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source,
        translate(coalesce(text, ''), '{UPPER}', '{LOWER}') as text
    from documents
), found as (
    select row, lang, source,
        unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from given
), kept as (
    select lang, term from found group by all having count(distinct row) >= 30
), counted as (
    select lang, source, term, count(*) as n from found join kept using (lang, term) group by all
), groups as (
    select distinct lang, source from given
), sizes as (
    select lang, source, coalesce(sum(n), 0)::hugeint as total,
        (select count(*) from kept k where k.lang = g.lang) as v
    from groups g left join counted using (lang, source) group by lang, source
), shares as (
    select s.lang, s.source, k.term, coalesce(c.n, 0) as n,
        (1 + (1000000000::hugeint * (coalesce(c.n, 0) + 5)) // (s.total + 5 * s.v))::bigint as p
    from sizes s join kept k on k.lang = s.lang
    left join counted c on c.lang = s.lang and c.source = s.source and c.term = k.term
), usual as (
    select k.lang, k.term, (1 + (1000000000::hugeint * (sum(c.n) + 5)) // (t.total + 5 * t.v))::bigint as q
    from kept k join counted c using (lang, term)
    join (select lang, sum(total) as total, max(v) as v from sizes group by lang) t on t.lang = k.lang
    group by k.lang, k.term, t.total, t.v
), pairs as (
    select a.lang, a.source, b.source as item, coalesce(any_value(d.value), 0)::bigint as value
    from groups a join groups b on a.lang = b.lang and a.source != b.source
    left join (
        select x.lang, x.source, y.source as item, sum(abs(x.p - y.p)) as value
        from shares x join shares y on x.lang = y.lang and x.term = y.term group by all
    ) d on d.lang = a.lang and d.source = a.source and d.item = b.source
    group by a.lang, a.source, b.source
), terms as (
    select s.lang, s.source, s.term as item, s.p - u.q as value
    from shares s join usual u on u.lang = s.lang and u.term = s.term where s.n > 0 and s.p > u.q
), every_part as (
    select lang, source, 'pair' as part, item, value from pairs
    union all select lang, source, 'term', item, value from terms
), ranked as (
    select *, (row_number() over (partition by lang, source, part order by value desc, item))::int as rank
    from every_part
)
select * from ranked where part = 'pair' or rank <= 50
"""

#: Bytes as two hexadecimal digits; windows are cut from pieces, as long strings are slow to cut.
SUFFIX_DEDUP = """
with given as (
    select row_number() over () as row, doc_id, hex(encode(coalesce(text, ''))) as h from documents
), pieces as (
    select row, c * 1000 as first, substr(h, c * 2000 + 1, 2398) as piece
    from (select row, h, unnest(range((len(h) + 1999) // 2000)) as c from given)
), windows as (
    select row, first + i as place, md5_number(substr(piece, 2 * i + 1, 400)) as w
    from (select *, unnest(range(least(1000, len(piece) // 2 - 199))) as i from pieces
        where len(piece) >= 400)
), twice as (
    select w from windows group by w having count(*) > 1
), hit as (
    select row, place, place - lag(place) over (partition by row order by place) > 200 as gap
    from windows semi join twice using (w)
), numbered as (
    select row, place, count_if(coalesce(gap, true)) over (partition by row order by place) as span from hit
), spans as (
    select row, span, min(place) as low, max(place) + 200 as high from numbered group by all
), edges as (
    select row, low, high, coalesce(lag(high) over (partition by row order by low), 0) as before,
        lead(low) over (partition by row order by low) is null as is_last
    from spans
), kept as (
    select e.row, count(*) as n_spans, sum(high - low)::bigint as n_removed,
        string_agg(substr(h, 2 * before + 1, 2 * (low - before)), '' order by low)
            || any_value(substr(h, 2 * high + 1)) filter (is_last) as h
    from edges e join given g on g.row = e.row group by e.row
)
select doc_id, (len(g.h) // 2)::bigint as n_bytes, coalesce(n_removed, 0) as n_removed,
    coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(k.h, g.h))) as kept_sha256
from given g left join kept k using (row)
"""

RANKED_SEARCH = rf"""
with given as (
    select row_number() over () as row, doc_id,
        translate(text, '{UPPER}', '{LOWER}') as text from documents
), found as (
    select row, doc_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from given
), sizes as (
    select row, count(*) as n from found group by row
), totals as (
    select count(*)::bigint as documents, sum(n)::bigint as total from sizes
), postings as (
    select row, any_value(doc_id) as doc_id, term, count(*) as tf from found group by row, term
), items as (
    select item_id, any_value(text) as text from benchmark group by item_id, text
), asked as (
    select item_id, text, term, count(*) as times from (
        select item_id, text, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from items)
    group by all
), weights as (
    select term, floor(1000 * ln((2 * documents + 2)::double / (2 * count(*) + 1)::double))::bigint as w
    from postings, totals group by term, documents
), scored as (
    select a.item_id, a.text, p.row, any_value(p.doc_id) as doc_id,
        sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * documents) // total))))::bigint
            as score
    from asked a join postings p using (term) join weights using (term) join sizes s on s.row = p.row, totals
    group by a.item_id, a.text, p.row
), ranked as (
    select item_id, (row_number() over (partition by item_id, text
        order by score desc, doc_id nulls last))::int as rank, doc_id, score
    from scored where score > 0
)
select * from ranked where rank <= 20
"""
