"""DuckDB SQL that states the results of the operators which SQL can express."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_LINES = f"""
numbered as (
  select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as pos
  from (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents)),
keyed as (
  select doc_id, pos, line, translate(trim(line, {BLANKS}), '{UPPER}', '{LOWER}') as key from numbered),
frequent as (
  select key, max(doc_id) as keeper from keyed where length(key) >= 40
  group by key having count(distinct doc_id) >= 5),
marked as (
  select k.doc_id, k.pos, k.line, f.keeper is not null and f.keeper <> k.doc_id as gone
  from keyed k left join frequent f on f.key = k.key)"""

OP3 = f"""
with {_LINES.strip()}
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by doc_id"""

# Base32 of SHA-1: the 160 bits in steps of 5.
OP10 = """
with bodies as (
  select page_id, sha1(coalesce(html, '')) as hex, strlen(coalesce(html, '')) as payload_bytes from pages),
numbers as (
  select hex, list_transform(range(0, 40, 10), lambda i : ('0x' || substr(hex, i + 1, 10))::bigint) as words
  from (select distinct hex from bodies)),
digests as (
  select hex, list_aggregate(list_transform(range(0, 32), lambda j :
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((words[j // 8 + 1] >> ((7 - j % 8) * 5)::int) & 31)::int + 1, 1)), 'string_agg', '') as payload_digest
  from numbers),
keepers as (select hex, max(page_id) as keeper from bodies group by hex)
select page_id, payload_bytes, payload_digest,
       case when page_id = keeper then 'response' else 'revisit' end as record_type,
       case when page_id <> keeper then keeper end as refers_to
from bodies join digests using (hex) join keepers using (hex)"""

_WORDS = f"""
worded as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda w : w <> '') as w
  from documents),
shingled as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 3), lambda i : array_to_string(w[i : i + 4], ' '))) end as s
  from worded)"""

OP2 = f"""
with recursive {_WORDS.strip()},
items as (select doc_id, unnest(s) as item from shingled),
shared as (
  select a.doc_id as x, b.doc_id as y, count(*) as n
  from items a join items b on a.item = b.item and a.doc_id < b.doc_id group by all),
links as (
  select x, y from shared join shingled p on p.doc_id = x join shingled q on q.doc_id = y
  where 100 * n >= 75 * (len(p.s) + len(q.s) - n)),
both_ways as (select x, y from links union all select y, x from links),
reach as (
  select x, y from both_ways
  union
  select r.x, b.y from reach r join both_ways b on b.x = r.y)
select s.doc_id, len(s.s) as n_shingles, least(s.doc_id, coalesce(min(r.y), s.doc_id)) as component_id,
       least(s.doc_id, coalesce(min(r.y), s.doc_id)) = s.doc_id as kept
from shingled s left join reach r on r.x = s.doc_id group by s.doc_id, s.s"""

OP7 = """
with recursive vectors as (
  select vec_id, embedding::double[] as e from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x : x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x : x <> 0)) > 0),
links as (
  select a.vec_id as x, b.vec_id as y from vectors a join vectors b
    on a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.95),
reach as (select x, y from links union select r.x, l.y from reach r join links l on l.x = r.y),
degrees as (select x, count(*) as n from links group by x),
lowest as (select x, min(y) as root from reach group by x)
select vec_id, coalesce(n, 0) as n_links, least(vec_id, coalesce(root, vec_id)) as component_id,
       least(vec_id, coalesce(root, vec_id)) = vec_id as kept
from embeddings left join degrees on degrees.x = vec_id left join lowest on lowest.x = vec_id"""


# CRC-32 of a string: the table of the polynomial by its rule, then one step per byte.
_CRC = """
crc_table as (
  select list(v order by i) as t from (
    select i, list_reduce(list_prepend(i, range(8)), lambda a, k : case when a % 2 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) as v
    from range(256) r(i)))"""


def _crc32(text: str) -> str:
    """The CRC-32 of a string expression, beside the column ``t`` of crc_table."""
    code = f"list_transform(range(0, strlen({text})), lambda j : ('0x' || substr(hex(encode({text})), 2 * j + 1, 2))::bigint)"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295, {code}), lambda a, b : xor(a >> 8, t[xor(a, b) % 256 + 1])))"


_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP12 = f"""
with {_CRC.strip()},
texts as (
  select doc_id, 0 as side, text from documents union all select item_id, 1, text from benchmark),
worded as (
  select row_number() over () as id, doc_id, side,
         list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_SEPARATORS}'), lambda w : w <> '') as w
  from texts),
features as (
  select id, side, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i : w[i] || ' ' || w[i + 1]),
    list_transform(range(1, len(w) - 1), lambda i : w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) as f
  from worded),
kinds as (select f, id, side, count(*) as n from features group by all),
hashed as (select f, {_crc32("f")} % 10000 as bucket from (select distinct f from kinds), crc_table),
buckets as (select bucket, sum(n) filter (where side = 0) as s, sum(n) filter (where side = 1) as t from kinds join hashed using (f) group by bucket),
totals as (select coalesce(sum(s), 0) as s_all, coalesce(sum(t), 0) as t_all from buckets),
gains as (
  select bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::double * (s_all + 10000)) / ((coalesce(s, 0) + 1)::double * (t_all + 10000))))::bigint as gain
  from buckets, totals),
weights as (select id, sum(n) as n_features, sum(n * gain)::bigint as weight from kinds join hashed using (f) join gains using (bucket) where side = 0 group by id),
scored as (
  select w.doc_id, len(w.w) as n_words, coalesce(n_features, 0)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
         coalesce(weight, 0)::bigint + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || w.doc_id), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as score
  from worded w left join weights using (id) where w.side = 0),
places as (
  select *, case when n_words >= 20 and doc_id is not null
    then row_number() over (partition by n_words >= 20 and doc_id is not null order by score desc, doc_id) end as place
  from scored)
select doc_id, n_features, weight, score, case when place <= 5 * (select count(place) from places) // 100 then place end as rank
from places"""

OP11 = f"""
with recursive {_CRC.strip()},
runs as (
  select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[A-Za-zÀ-ÿ]+')) as r from documents),
kinds as (select doc_id, r, count(*) as n, doc_id || ':' || r as label from runs group by doc_id, r),
hashed as (select r, n, coalesce({_crc32("label")}, 1) as h from kinds, crc_table),
edited as (
  select case when h % 97 = 0 then substr(r, 1, (h % length(r))::bigint) || substr(r, (h % length(r))::bigint + 2) else r end as word, n from hashed),
words as (select word, sum(n)::bigint as n from edited where length(word) >= 5 group by word having sum(n) >= 3),
places as (select word, n, unnest(range(1, length(word) + 1)) as i from words),
masked as (select word, n, substr(word, 1, i - 1) || '_' || substr(word, i + 1) as m from places),
shorter as (select distinct word, n, substr(word, 1, i - 1) || substr(word, i + 1) as m from places),
near as (
  select a.word, b.word as other, b.n as other_n from masked a join masked b on a.m = b.m and a.word <> b.word
  union select s.word, w.word, w.n from shorter s join words w on w.word = s.m
  union select w.word, s.word, s.n from shorter s join words w on w.word = s.m),
best as (
  select word, count(*) as n_near, max(other_n) as top_n, arg_min(other, (-other_n, encode(other))) as top from near group by word),
forms as (
  select w.word, w.n, coalesce(n_near, 0) as n_near, case when top_n >= 2 * w.n then top end as form, case when top_n >= 2 * w.n then top_n end as form_n
  from words w left join best using (word)),
chains as (
  select word, word as spot, 0 as step from forms
  union all
  select c.word, f.form, step + 1 from chains c join forms f on f.word = c.spot where f.form is not null)
select word, any_value(form) as form, arg_max(spot, step) as root, any_value(n) as n, any_value(n_near) as n_near, any_value(form_n) as form_n
from forms join chains using (word) group by word"""
