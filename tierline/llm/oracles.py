"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from tierline.llm.license_scan import DIGESTS, EQUIVALENT, KNOWN, TITLES

_OP3 = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -1, i, case when i = 0 then 'user' else 'assistant' end, '<|im_end|><|im_start|>assistant ok' from range(2) r(i)
), ordered as (
  select *, lag(role, 1, 'start') over (partition by conv_id order by turn, role, text) as before,
         row_number() over (partition by conv_id order by turn desc, role desc, text desc) as from_end
  from turns
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
       sum(length('<|im_start|>' || replace(replace(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'), '%', '%25'), chr(10), '%0A')
                  || chr(10) || regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '<|im_end|>' || chr(10)))::bigint as formatted_chars,
       bool_and(case before when 'start' then role in ('system', 'user') when 'system' then role = 'user'
                when 'user' then role = 'assistant' when 'assistant' then role in ('user', 'tool')
                when 'tool' then role = 'assistant' else false end)
         and max(role) filter (from_end = 1) = 'assistant' as valid
from ordered group by conv_id
"""


_OP1 = r"""
with captures as (
  select page_id, url, date '2024-01-01' + (page_id * 7 % 366)::int as fetched_on,
         rtrim(regexp_extract(lower(url), '^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]*)', 1), '.') as host,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1)) as path
  from pages
), hosts as (
  select distinct host, ('0x' || substr(md5(host), 1, 6))::int as x from captures where host <> ''
), intervals as (
  select 'spam' as list, 'domain' as kind, host as entry, date '2024-01-01' + x % 200 as valid_from, null::date as valid_to
  from hosts where regexp_matches(host, 'pills|casino|bets|spam|adult')
  union all select 'reported', 'domain', host, date '2024-01-01' + x % 200, date '2024-01-01' + (x % 200 + 40) from hosts where x % 5 = 0
  union all select 'reported', 'domain', host, date '2024-01-01' + (x % 200 + 90), null from hosts where x % 10 = 0
  union all select 'sections', 'prefix', host || '/fr', date '2024-01-01' + x % 300, null from hosts where x % 3 = 0
), held as (
  select page_id, list, valid_from, kind, entry
  from captures join intervals on valid_from <= fetched_on and (valid_to is null or valid_to > fetched_on)
   and case kind when 'domain' then host = entry or ends_with(host, '.' || entry)
       else starts_with(host || path || '/', entry || '/') end
), found as (
  select page_id, array_to_string(list_sort(list_distinct(list(list))), ',') as lists,
         min({'a': valid_from, 'b': kind, 'c': entry, 'd': list}) as first_entry
  from held group by page_id
)
select page_id, url, strftime(fetched_on, '%Y-%m-%d') as fetched_on, found.lists is not null as blocked, coalesce(lists, '') as lists,
       strftime(first_entry.a, '%Y-%m-%d') as listed_since, first_entry.c as entry
from captures left join found using (page_id)
"""

_OP4 = r"""
with shingled as (
  select kind, id, case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
                        when len(w) > 0 then [array_to_string(w, ' ')] else [] end as shingles
  from (select 'doc' as kind, doc_id as id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as w from documents
        union all select 'item', item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') from benchmark)
), items as (select distinct id, unnest(shingles) as s from shingled where kind = 'item'),
docs as (select distinct id, unnest(shingles) as s from shingled where kind = 'doc'),
sizes as (select id, count(*) as n from items group by id)
select docs.id as doc_id, items.id as item_id, any_value(n) as n_shingles, count(*) as matched, count(*) / any_value(n) as containment
from docs join items using (s) join sizes on sizes.id = items.id
group by docs.id, items.id having count(*) * 100 >= any_value(n) * 75
"""


def _canonical(text: str) -> str:
    """Single words are spelled by a look-up, pairs of words in text whose words stand two
    blanks apart."""
    bare = rf"regexp_replace(lower({text}), '(?m)^[^\p{{L}}\p{{N}}\n(©]*(?:copyright[ \t]*(?:\(c\)|©|:|[0-9]{{4}}|by )|\(c\)|©|all rights reserved)[^\n]*$', '', 'g')"
    words = rf"string_split(trim(regexp_replace({bare}, '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ')"
    single = ", ".join(f"{_quoted(x)}: {_quoted(y)}" for x, y in EQUIVALENT if " " not in x)
    out = f"'  ' || array_to_string(list_transform({words}, lambda w: coalesce(map {{{single}}}[w], w)), '  ') || '  '"
    for x, y in EQUIVALENT:
        if " " in x:
            out = f"replace({out}, {_quoted('  ' + x.replace(' ', '  ') + '  ')}, {_quoted('  ' + y.replace(' ', '  ') + '  ')})"
    return f"trim(replace({out}, '  ', ' '))"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_TITLED = [(a, f"{title}\n{t}") for a, title in TITLES for of, t in KNOWN if a == of and "\n" in t]

_OP5 = rf"""
with plain as materialized (
  select distinct license, {_canonical("t")} as c from (values {", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in KNOWN)}) k(license, t)
), known as materialized (
  select * from plain union
  select license, {_canonical("t")} as c from (values {", ".join(f"({_quoted(a)}, {_quoted(b)})" for a, b in _TITLED)}) k(license, t)
), units as (
  select doc_id, 'text' as unit, text as u from documents
  union all select doc_id, 'paragraph', p from (
    select doc_id, unnest(regexp_split_to_array(text, '\n[ \t\r]*\n')) as p from documents where regexp_matches(text, '\n[ \t\r]*\n')) where contains(p, chr(10))
  union all select doc_id, 'line', unnest(string_split(text, chr(10))) from documents where contains(text, chr(10))
), digests(license, head, chars, digest) as (
  values {", ".join(f"({_quoted(a)}, {_quoted(h)}, {n}, {_quoted(d)})" for a, h, n, d in DIGESTS)}
), canonical as materialized (
  select doc_id, unit, {_canonical("u")} as c from units
), parted as (
  select doc_id, list_filter(list_transform(regexp_split_to_array(text, '\n[ \t\r]*\n'), lambda p: {_canonical("p")}), lambda p: p <> '') as parts
  from documents where regexp_matches(text, '\n[ \t\r]*\n')
), begun as (
  select doc_id, parts[i:] as parts, array_to_string(parts[i:], ' ') || ' ' as rest from parted, lateral (select unnest(range(1, len(parts))) as i) where len(parts) > 1
), rows_found as (
  select doc_id, license, 'paragraphs' as unit from begun join plain on starts_with(rest, c || ' ') and len(string_split(c, ' ')) > 4
  where list_contains(list_transform(range(2, len(parts) + 1), lambda j: length(array_to_string(parts[1:j], ' '))), length(c))
  union all select doc_id, license, 'paragraphs' from begun join digests on starts_with(rest, head || ' ') and sha256(rest[:chars]) = digest
  where list_contains(list_transform(range(2, len(parts) + 1), lambda j: length(array_to_string(parts[1:j], ' '))), chars)
  union all select doc_id, license, unit from canonical join known using (c)
  union all select doc_id, license, unit from canonical join digests on length(c) = chars and sha256(c) = digest
)
select doc_id, license, unit, count(*) as n from rows_found group by all
"""

_OP6 = r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 15))::bigint as o
  from documents
), sources as (
  select *, 2 * words as cap from (
    select source, sum(size)::bigint as words, [5.0, 2.0, 1.0][((row_number() over (order by source nulls last) - 1) % 3) + 1]::double as weight from sized group by source)
), levels as (
  select *, (sum(words) over () * 1.5::double - coalesce(sum(cap) over (order by cap / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))
            / sum(weight) over (order by cap / weight, source nulls last rows between current row and unbounded following) as level
  from sources
), aims as (
  select source, words, least(cap::double, max(case when level * weight <= cap then level end) over () * weight) as target from levels
), queued as (
  select s.*, words, target, sum(size) over (partition by s.source order by o, doc_id::varchar, size rows unbounded preceding) as up_to
  from sized s join aims a on s.source is not distinct from a.source
), copies as (
  select *, (up_to + copy * words)::double / target as finish from queued, (select unnest([0, 1]) as copy) where size > 0 and target > 0
), served as (
  select *, sum(size) over (order by finish, source nulls last, o, doc_id::varchar, size, copy rows unbounded preceding) as spent,
         (select sum(target) from aims) as budget
  from copies
), takes as (
  select doc_id, o, size, source, up_to, sum(size) as taken from served where spent - size / 2 < budget group by all
)
select q.doc_id, q.source, q.size, q.words as source_size, round(q.target, 6) as target, coalesce(t.taken, 0)::bigint as taken
from queued q left join takes t on q.doc_id = t.doc_id and q.up_to = t.up_to and q.source is not distinct from t.source
"""


_OP9 = r"""with recursive words as materialized (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), shingled as materialized (
  select distinct doc_id, unnest(case when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
                                 when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from words
), sizes as materialized (select doc_id, count(*) as n from shingled group by doc_id),
links as materialized (
  select x.doc_id as a, y.doc_id as b from shingled x join shingled y using (s) join sizes p on p.doc_id = x.doc_id join sizes q on q.doc_id = y.doc_id
  group by x.doc_id, y.doc_id having 100 * count(*) >= 75 * (any_value(p.n) + any_value(q.n) - count(*))
), reach(a, b) as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a)
select doc_id, coalesce(n, 0) as n_shingles, coalesce(least(doc_id, c), doc_id) as component_id
from documents left join sizes using (doc_id) left join (select a as doc_id, min(b) as c from reach group by a) using (doc_id)
"""


def _op11(k: int = 16, rounds: int = 3) -> str:
    """Every round as a nearest centroid by full comparison and a floor of sums."""
    steps = [
        f"""
kept as materialized (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v, row_number() over () as r from embeddings
  where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64
), parts as materialized (
  select r, unnest(range(64)) as i, unnest(v) as x from kept
), centre0 as materialized (
  select c, unnest(range(64)) as i, unnest(v) as y
  from (select v, row_number() over (order by sha256('1:' || coalesce(vec_id::varchar, '')), v) - 1 as c from kept) where c < {k}
)"""
    ]
    for n in range(rounds + 1):
        steps.append(
            f"""near{n} as materialized (
  select r, min((d, c)) as best from (
    select r, c, sum((x - y) * (x - y))::bigint as d from parts join centre{n} using (i) group by r, c) group by r
)"""
        )
        if n < rounds:
            steps.append(
                f"""centre{n + 1} as materialized (
  select c, i, coalesce((s - ((s % n) + n) % n) // n, y)::bigint as y from centre{n} left join (
    select best[2] as c, i, sum(x)::bigint as s, count(*) as n from parts join near{n} using (r) group by all) using (c, i)
)"""
            )
    return (
        "with "
        + ", ".join(steps)
        + f""", named as (
  select c, sha256(string_agg(y::varchar, ',' order by i)) as centroid_sha256 from centre{rounds} group by c
)
select vec_id, best[2]::integer as cluster, best[1] as distance, sum(best[1]) over (partition by best[2])::bigint as cluster_inertia,
       sum(best[1]) over ()::bigint as inertia, centroid_sha256
from kept join near{rounds} using (r) join named on c = best[2]
"""
    )


ORACLES = {
    "op1_url_filter": _OP1,
    "op3_chat_format": _OP3,
    "op4_decontaminate": _OP4,
    "op5_license_scan": _OP5,
    "op6_mixing": _OP6,
    "op9_jaccard_join": _OP9,
    "op11_clustering": _op11(),
}
