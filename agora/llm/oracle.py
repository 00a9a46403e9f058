"""DuckDB SQL for the queries that SQL can express, written from their
definition and sharing nothing with the engine."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT_DEDUP = f"""
with n as (select doc_id, {_LOWER} as norm from documents)
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(norm) as text_sha256
from n window same as (partition by norm)
"""

DECONTAMINATE = rf"""
with d as (select doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select cast(item_id as varchar) as item, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
      from benchmark),
test as (select distinct item, least(10, len(w)) as size, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') as win
         from (select *, unnest(range(1, greatest(len(w) - 8, 2))) as i from b where len(w) > 0)),
place as (select doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') as win
          from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i
                from d, (select distinct size from test) where len(w) >= size)),
hit as (select doc_id, i, p.size, item from place p join test t on p.win = t.win and p.size = t.size),
words as (select doc_id, count(distinct pos) as n from (select doc_id, unnest(range(i, i + size)) as pos from hit)
          group by doc_id),
items as (select doc_id, count(*) as n, string_agg(item, ',' order by item) as list
          from (select distinct doc_id, item from hit) group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(words.n, 0) as n_hit, coalesce(items.n, 0) as n_items,
       sha256(coalesce(items.list, '')) as items_sha256, coalesce(words.n, 0) > 0 as contaminated
from d left join words using (doc_id) left join items using (doc_id)
"""

SUBSTRING_DEDUP = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
win as (select doc_id, i, array_to_string(w[i:i + 19], ' ') as words
        from (select *, unnest(range(1, len(w) - 18)) as i from d where len(w) >= 20)),
later as (select doc_id, i from (select doc_id, i, row_number() over (partition by words order by doc_id, i) as n from win)
          where n > 1),
gone as (select doc_id, list(distinct pos) as places from (select doc_id, unnest(range(i, i + 20)) as pos from later)
         group by doc_id),
word as (select d.doc_id, unnest(range(1, len(w) + 1)) as pos, unnest(w) as word from d),
kept as (select word.doc_id, string_agg(word, ' ' order by word.pos) as text, count(*) as n
         from word left join (select doc_id, unnest(places) as pos from gone) g
           on g.doc_id = word.doc_id and g.pos = word.pos
         where g.pos is null group by word.doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(len(d.w) as bigint) - coalesce(kept.n, 0) as n_removed,
       sha256(coalesce(kept.text, '')) as kept_sha256
from d left join kept using (doc_id)
"""

RANKED_SEARCH = rf"""
with d as (select row_number() over () as row, doc_id, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
           from documents),
q as (select item, item_id, term, count(*) as times
      from (select row_number() over () as item, item_id,
                   unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark)
      group by item, item_id, term),
doc as (select row, doc_id, count(*) as n from d group by row, doc_id),
corpus as (select count(*) as docs, cast(sum(n) as bigint) as terms from doc),
tf as (select row, term, count(*) as tf from d semi join q using (term) group by row, term),
weight as (select term, cast(floor(1000 * ln(cast(2 * docs + 2 as double) / (2 * count(*) + 1))) as bigint) as w
           from tf, corpus group by term, docs),
score as (select item, item_id, doc_id, row,
                 cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) as bigint) as score
          from q join weight using (term) join tf using (term) join doc using (row), corpus group by item, item_id, doc_id, row)
select item_id, cast(row_number() over best as integer) as rank, doc_id, score from score where score > 0
window best as (partition by item order by score desc, doc_id) qualify row_number() over best <= 10
"""

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LINE_DEDUP = f"""
with line as (select doc_id, unnest(l) as line, unnest(range(len(l))) as pos
              from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents)),
keyed as (select *, translate(trim(line, {_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from line),
shared as (select key, max(doc_id) as last_doc from keyed where length(key) >= 20 group by key having count(distinct doc_id) >= 3),
judged as (select doc_id, line, pos, last_doc is not null and last_doc <> doc_id as gone from keyed left join shared using (key))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
from judged group by doc_id
"""


def vector_codes(parts: int, entries: int, rounds: int) -> str:
    """Rounds of assignment and averaging, written out one after another."""
    text = f"""
with whole as (select vec_id, label, embedding, len(embedding) // {parts} as width from embeddings
               where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
row as (select *, row_number() over (order by vec_id) as r from whole),
cell as (select r, i // width as part, i % width as pos, cast(floor(256 * cast(x as double)) as bigint) as x
         from (select r, width, unnest(embedding) as x, unnest(range(len(embedding))) as i from row)),
book0 as (select r - 1 as entry, part, pos, x from cell where r <= {entries})"""
    for t in range(rounds + 1):
        text += f""",
far{t} as (select r, part, entry, sum((cell.x - b.x) * (cell.x - b.x)) as d from cell join book{t} b using (part, pos)
           group by r, part, entry),
code{t} as (select r, part, entry, d from far{t} qualify row_number() over (partition by r, part order by d, entry) = 1)"""
        if t < rounds:
            text += f""",
mean{t} as (select entry, part, pos, cast(floor(cast(sum(x) as double) / count(*)) as bigint) as x
            from code{t} join cell using (r, part) group by entry, part, pos),
book{t + 1} as (select entry, part, pos, coalesce(m.x, b.x) as x from book{t} b left join mean{t} m using (entry, part, pos))"""
    return text + f""",
coded as (select vec_id, label, string_agg(lower(lpad(to_hex(entry), 2, '0')), '' order by part) as code, cast(sum(d) as bigint) as error
          from code{rounds} join row using (r) group by r, vec_id, label)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
       (select sha256(string_agg(cast(x as varchar), ',' order by part, entry, pos)) from book{rounds}) as codebooks_sha256
from coded
"""
