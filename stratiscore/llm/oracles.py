"""SQL of the queries that SQL can express, for DuckDB."""

from __future__ import annotations

from stratiscore.llm import collocations, line_rules, substrings, warc_zip

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_OP1 = f"""
with payloads as (
  select page_id, coalesce(html, '') as payload,
         octet_length(encode(coalesce(html, ''))) as size
  from pages
), keepers as (
  select payload, max(page_id) as keeper from payloads
  where size >= {warc_zip.MIN_REVISIT} group by payload having count(*) > 1
), marked as (
  select p.*, case when keeper is distinct from page_id then keeper end as target
  from payloads p left join keepers k
  on p.payload = k.payload and p.size >= {warc_zip.MIN_REVISIT}
)
select page_id, cast(size as bigint) as payload_bytes, sha1(payload) as payload_digest,
       case when target is null then 'response' else 'revisit' end as record_type,
       target as refers_to
from marked
"""

_W = substrings.WINDOW
_OP8 = f"""
with docs as (
  select doc_id, {_WORDS} as w from documents
), windows as (
  select doc_id, s, array_to_string(w[s:s + {_W - 1}], ' ') as k
  from (select doc_id, w, unnest(range(1, len(w) - {_W - 2})) as s from docs where len(w) >= {_W})
), firsts as (
  select k, min(doc_id) as first_id from windows group by k
), covered as (
  select distinct doc_id, unnest(range(s, s + {_W})) as p
  from windows join firsts using (k) where first_id < doc_id
), words as (
  select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from docs
), kept as (
  select w.doc_id, count(c.p) as n_removed,
         string_agg(word, ' ' order by w.p) filter (where c.p is null) as kept
  from words w left join covered c on w.doc_id = c.doc_id and w.p = c.p group by w.doc_id
)
select d.doc_id, cast(len(w) as bigint) as n_words,
       cast(coalesce(n_removed, 0) as bigint) as n_removed,
       sha256(coalesce(kept, '')) as kept_sha256
from docs d left join kept k on d.doc_id = k.doc_id
"""

_OP10 = rf"""
with docs as (
  select doc_id, coalesce(text, '') as text, source, {_WORDS} as w from documents
), windows as (
  select doc_id, s, w[s] || chr(31) || w[s + 1] || chr(31) || w[s + 2] as k
  from (select doc_id, w, unnest(range(1, len(w) - 1)) as s from docs where len(w) >= 3)
), again as (
  select doc_id, k from windows group by doc_id, k having count(*) > 1
), repeated as (
  select doc_id, count(distinct p) as n
  from (select doc_id, unnest(range(s, s + 3)) as p from windows join again using (doc_id, k))
  group by doc_id
), lines as (
  select doc_id, source, unnest(string_split(text, chr(10))) as line,
         unnest(range(len(string_split(text, chr(10))))) as place
  from docs
), full_lines as (
  select doc_id, source, line, place,
         translate(lower(trim(regexp_replace(line, '[\x20\x09\x0B-\x0D]+', ' ', 'g'))),
                   '0123456789', '0000000000') as plain
  from lines where regexp_matches(line, '[^\x20\x09-\x0D]')
), duplicates as (
  select doc_id, count(*) - count(distinct line) as n from full_lines group by doc_id
), hosts as (
  select source, count(*) as n from docs group by source
), frequent as (
  select f.source, f.plain from full_lines f join hosts h on f.source is not distinct from h.source
  group by f.source, f.plain, h.n
  having count(distinct doc_id) >
    greatest({float(line_rules.LEAST_DOCUMENTS)}::double, h.n * {line_rules.HOST_SHARE}::double)
), gone as (
  select doc_id, place, len(string_split(plain, ' ')) as n
  from full_lines f
  where exists (select 1 from frequent q
                where q.plain = f.plain and q.source is not distinct from f.source)
), lost as (
  select doc_id, sum(n) as n from gone group by doc_id
), remaining as (
  select doc_id, string_agg(line, chr(10) order by place) as text
  from lines anti join gone using (doc_id, place)
  group by doc_id
), counted as (
  select d.doc_id, len(w) as n_words,
         len(regexp_replace(d.text, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
         len(d.text) - len(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')) as n_symbols,
         coalesce(u.n, 0) as n_dup_lines, coalesce(r.n, 0) as n_repeat_words,
         coalesce(l.n, 0) as n_line_words, sha256(coalesce(m.text, '')) as kept_sha256
  from docs d left join duplicates u using (doc_id) left join repeated r using (doc_id)
  left join lost l using (doc_id) left join remaining m using (doc_id)
), judged as (
  select *, n_words < {line_rules.MIN_WORDS}
         or 100 * n_repeat_words > {line_rules.MAX_REPEAT_PERCENT} * n_words as base_failed
  from counted
)
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars,
       cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
       cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
       cast(n_line_words as bigint) as n_line_words,
       not base_failed and 100 * n_line_words <= {line_rules.MAX_REMOVED_PERCENT} * n_words as kept,
       kept_sha256
from judged
"""


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _score(left: str, right: str) -> str:
    return f"(1000000::hugeint * a * a) // ({left}::hugeint * {right})"


_OP12 = rf"""
with texts as (
  select coalesce(lang, 'und') as lang,
         translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') as text from documents
), pieces as (
  select lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) as piece from texts
), words as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), phrases as (
  select lang, k, w[s:s + k - 1] as p, count(*) as f
  from (select lang, k, w, unnest(range(1, len(w) - k + 2)) as s
        from words, (select unnest([1, 2, 3]) as k) where len(w) >= k)
  group by all
), totals as (
  select lang, cast(sum(f) as bigint) as n from phrases where k = 1 group by lang
), candidates as (
  select lang, k, p, f as a from phrases where k > 1 and f >= {collocations.MIN_COUNT}
), cuts as (
  select c.*, cut, x.f as l, y.f as r, {_score("x.f", "y.f")} as score
  from (select *, unnest(range(1, k)) as cut from candidates) c
  join phrases x on x.lang = c.lang and x.p = c.p[:cut]
  join phrases y on y.lang = c.lang and y.p = c.p[cut + 1:]
), lowest as (
  select lang, k, p, a, arg_min(l, (score, cut)) as l, arg_min(r, (score, cut)) as r,
         min(score) as score
  from cuts group by lang, k, p, a
), covered as (
  select lang, p, max(f) as longer
  from (select lang, p[1:2] as p, a as f from candidates where k = 3
        union all select lang, p[2:3], a from candidates where k = 3) group by lang, p
), kept as (
  select w.lang, array_to_string(w.p, ' ') as phrase, a, l, r, score
  from lowest w left join covered v on v.lang = w.lang and v.p = w.p
  where longer is null or 100 * longer < {collocations.COVERED_PERCENT} * a
)
select k.lang, row_number() over (partition by k.lang order by score desc, a desc, phrase) as rank,
       phrase, a, cast(l as bigint) as l, cast(r as bigint) as r, n, cast(score as bigint) as score
from kept k join totals t on t.lang = k.lang
qualify rank <= {collocations.TOP}
"""


def sql() -> dict[str, str]:
    return {
        "op1_warc_zip": _OP1,
        "op8_repeated_windows": _OP8,
        "op10_line_rules": _OP10,
        "op12_collocations": _OP12,
    }
