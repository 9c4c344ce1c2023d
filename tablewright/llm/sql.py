"""DuckDB SQL that gives the rows of those operator queries that SQL can express."""

from __future__ import annotations

from tablewright.llm import licenses, mixing
from tablewright.llm.common import LOWER, UPPER

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _lower(column: str) -> str:
    return f"translate({column}, '{UPPER}', '{LOWER}')"


OP5 = f"""
with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as parts from documents),
l as (select doc_id, unnest(parts) as line, generate_subscripts(parts, 1) as place from d),
k as (select *, {_lower(f"trim(line, {_SPACES})")} as key from l),
h as (select key, min(doc_id) as keeper, count(distinct doc_id) as n from k where length(key) >= 10 group by key),
m as (select k.*, coalesce(h.n >= 2 and h.keeper <> k.doc_id, false) as gone from k left join h using (key))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped, sha256(coalesce(string_agg(line, chr(10) order by place) filter (not gone), '')) as kept_sha256
from m group by doc_id"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(column: str) -> str:
    out = _lower(f"coalesce({column}, '')")
    for pattern in (licenses.COPYRIGHT_LINE, licenses.TITLE_LINE):
        out = f"regexp_replace({out}, {_quoted(pattern.replace('(?md)', '(?m)'))}, '', 'g')"
    for pattern, replacement in licenses.SPELLINGS:
        out = f"regexp_replace({out}, {_quoted(pattern)}, {_quoted(replacement)}, 'g')"
    return f"trim(regexp_replace({out}, {_quoted(licenses.PUNCTUATION)}, ' ', 'g'))"


#: The four one-sentence notices as they stand in documents, written out here once more.
_NOTICES = [("Apache-2.0", "licensed under the apache license version 2 0"), ("MIT", "released under the mit license"), ("CC-BY-NC-4.0", "licensed under cc by nc 4 0"), ("GPL-3.0", "this work is licensed under the gnu general public license version 3")]
_PLAIN = f"trim(regexp_replace({_lower('line')}, '[^a-z0-9]+', ' ', 'g'))"
OP6 = f"""
with known as (select sha256({_canonical("t")}) as digest, min(id) as license_id from (values {", ".join(f"({_quoted(i)}, {_quoted(t)})" for i, t in licenses.KNOWN)}) as v(id, t) where {_canonical("t")} <> '' group by 1),
notices as (select * from (values {", ".join(f"({_quoted(i)}, {_quoted(t)})" for i, t in _NOTICES)}) as v(id, words)),
lines as (select doc_id, string_agg(distinct id, ',' order by id) as license_lines from (select doc_id, {_PLAIN} as words from (select doc_id, unnest(string_split(text, chr(10))) as line from documents)) join notices using (words) group by 1),
d as (select doc_id, sha256({_canonical("text")}) as digest from documents)
select doc_id, digest, license_id, license_id is not null as is_license, coalesce(license_lines, '') as license_lines from d left join known using (digest) left join lines using (doc_id)"""

_WORDS = f"regexp_extract_all({_lower('text')}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
OP7 = f"""
with i as (select coalesce(cast(item_id as varchar), 'null') as item, {_WORDS} as w from benchmark where text is not null),
p as (select item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) as pos from i where len(w) > 0),
win as (select distinct item, array_to_string(list_slice(w, pos, pos + 9), ' ') as phrase, least(10, len(w)) as n from p),
d as (select doc_id, coalesce({_WORDS}, []) as w from documents),
sizes as (select distinct n from win),
o as (select doc_id, pos, n, array_to_string(list_slice(w, pos, pos + n - 1), ' ') as phrase from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as pos from d, sizes)),
hit as (select o.doc_id, o.pos, o.n, win.item from o join win on o.phrase = win.phrase and o.n = win.n),
words as (select doc_id, count(distinct place) as n_hit from (select doc_id, unnest(range(pos, pos + n)) as place from (select distinct doc_id, pos, n from hit)) group by 1),
found as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, item from hit) group by 1)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (doc_id) left join found using (doc_id)"""

OP2 = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h, len(hex(encode(coalesce(text, '')))) // 2 as n from documents),
w as (select doc_id, unnest(list_transform(range(1, n - 198), lambda p: md5(substr(h, 2 * p - 1, 400)))) as string, unnest(range(1, n - 198)) as pos from d where n >= 200),
s as (select doc_id, pos from w where string in (select string from w group by string having count(*) > 1)),
i as (select *, pos > coalesce(lag(pos) over (partition by doc_id order by pos) + 200, 0) as new from s),
g as (select *, sum(cast(new as int)) over (partition by doc_id order by pos) as run from i),
sp as (select doc_id, run, min(pos) as a, max(pos) + 200 as b from g group by doc_id, run),
f as (select *, coalesce(lag(b) over (partition by doc_id order by a), 1) as start from sp),
p as (select doc_id, a, substr(h, 2 * start - 1, 2 * (a - start)) as piece from f join d using (doc_id) union all select doc_id, e, substr(h, 2 * e - 1) from (select doc_id, max(b) as e from sp group by 1) join d using (doc_id)),
k as (select doc_id, sha256(unhex(string_agg(piece, '' order by a))) as kept from p group by 1),
r as (select doc_id, sum(b - a) as n_removed, count(*) as n_spans from sp group by 1)
select doc_id, cast(n as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans, coalesce(kept, sha256(unhex(h))) as kept_sha256
from d left join k using (doc_id) left join r using (doc_id)"""

_KEY = mixing.DIGITS * mixing.ROUNDS
OP8 = f"""
with d as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as size, md5('{mixing.SEED}:' || coalesce(cast(doc_id as varchar), 'null'))[1:{_KEY}] as key from documents),
s as (select source, sum(size) as source_size, list_element([{", ".join(map(str, mixing.WEIGHTS))}], cast((row_number() over (order by source nulls last) - 1) % {len(mixing.WEIGHTS)} + 1 as int)) as weight from d group by source),
r as (select *, source_size * {float(mixing.MAX_EPOCHS)} as cap, source_size * {float(mixing.MAX_EPOCHS)} / weight as ratio from s),
l as (select *, (sum(source_size) over () - coalesce(sum(cap) over b, 0.0)) / (sum(weight) over () - coalesce(sum(weight) over b, 0.0)) as level from r window b as (order by ratio, source nulls last rows between unbounded preceding and 1 preceding)),
v as (select arg_min(level, (ratio, source is null, source)) filter (level < ratio) as level from l),
t as (select source, source_size, coalesce(least(cap, v.level * weight), cap) as target from l, v),
f as (select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 1 end as whole from t),
g as (select source, key, sum(size) as amount from d group by all),
c as (select g.*, coalesce(sum(amount) over (partition by source order by key rows between unbounded preceding and 1 preceding), 0) as lower from g),
x as (select c.source, c.key, lower + amount <= target - whole * source_size or (lower <= target - whole * source_size and 2 * (target - whole * source_size - lower) >= amount) as extra from c join f on c.source is not distinct from f.source where source_size > 0)
select d.doc_id, cast(d.size as bigint) as size, cast(f.source_size as bigint) as source_size, f.target, cast(d.size * (f.whole + case when x.extra then 1 else 0 end) as bigint) as taken
from d join f on d.source is not distinct from f.source left join x on d.source is not distinct from x.source and d.key = x.key"""

OP9 = """
with v as (select vec_id, row_number() over () as row, list_transform(embedding, lambda x: floor(1024 * cast(x as double))) as e from embeddings where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as (select q.row, q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score from v q join v c on q.row <> c.row and len(q.e) = len(c.e) where q.vec_id % 100 = 0),
r as (select *, cast(row_number() over (partition by row order by score desc, vec_id) as int) as rank from p)
select query_id, rank, vec_id, score from r where rank <= 10"""

_TOKENS = f"coalesce(regexp_extract_all({_lower('text')}, '[^\\x20\\x09-\\x0D]+'), [])"
OP10 = f"""
with recursive d as (select doc_id, {_TOKENS} as w from documents),
s as (select distinct doc_id, array_to_string(list_slice(w, pos, pos + 4), ' ') as shingle from (select doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) as pos from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by 1),
p as (select a.doc_id as a, b.doc_id as b, count(*) as common from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by 1, 2),
e as (select a, b from p join n x on a = x.doc_id join n y on b = y.doc_id where 100 * common >= 75 * (x.n + y.n - common)),
links as (select a, b from e union all select b, a from e),
reach as (select doc_id as a, doc_id as b from documents union select r.a, t.b from reach r join links t on r.b = t.a)
select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept
from d left join n using (doc_id) join (select a as doc_id, min(b) as component_id from reach group by 1) using (doc_id)"""

ORACLE = {"op2_suffix_array": OP2, "op5_line_dedup": OP5, "op6_license_digest": OP6, "op7_decontamination": OP7, "op8_mixing": OP8, "op9_ball_tree": OP9, "op10_minhash": OP10}
