"""DuckDB SQL for the queries that SQL can express. The others are held against plain Python in tests/llm."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PLAIN = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_WORD = r"'[^\x20\x09-\x0D]+'"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _plain_words(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), {_PLAIN})"


_DECONTAMINATION = f"""
with d as (select row_number() over () as r, doc_id, {_plain_words("text")} as ws from documents),
b as (select item_id, {_plain_words("text")} as ws from benchmark),
bw as (select item_id, unnest(generate_series(1, greatest(len(ws) - 9, 1))) as k, ws from b where len(ws) > 0),
wins as (select distinct item_id, array_to_string(ws[k:k + 9], ' ') as g, least(len(ws), 10) as n from bw),
starts as (select r, n, unnest(generate_series(1, len(ws) - n + 1)) as k, ws
           from d, (select distinct n from wins) where len(ws) >= n),
found as (select s.r, s.k, s.n, w.item_id from starts s
          join wins w on w.n = s.n and w.g = array_to_string(s.ws[s.k:s.k + s.n - 1], ' ')),
hit as (select r, count(distinct p) as n_hit
        from (select r, unnest(generate_series(k, k + n - 1)) as p from (select distinct r, k, n from found)) group by r),
who as (select r, list_sort(list(distinct cast(item_id as varchar))) as items from found group by r)
select d.doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
       cast(coalesce(len(items), 0) as bigint) as n_items,
       sha256(coalesce(array_to_string(items, ','), '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit using (r) left join who using (r)"""

_QUALITY = f"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as text, source,
                  regexp_extract_all(coalesce(text, ''), {_WORD}) as ws from documents),
wide as (select r, k, count(*) over (partition by r, array_to_string(ws[k:k + 4], ' ')) as c
         from (select r, ws, unnest(generate_series(1, len(ws) - 4)) as k from d where len(ws) >= 5)),
rep as (select r, sum(least(5, coalesce(nk - k, 5))) as n
        from (select r, k, lead(k) over (partition by r order by k) as nk from wide where c > 1) group by r),
ln as (select r, source, text, list_filter(list_transform(string_split(lower(text), chr(10)),
              lambda x: trim(x, {_BLANKS})), lambda x: x <> '') as ls from d),
line as (select r, source, text, unnest(ls) as x from ln),
counts as (select source, x, count(distinct text) as texts from line group by source, x),
hosts as (select source, count(distinct text) as docs from d group by source),
often as (select c.source, c.x, texts from counts c join hosts h on h.source is not distinct from c.source
          where texts > greatest(20.0, 0.05 * docs)),
word as (select source, text, unnest(regexp_extract_all(x, {_WORD})) as w from line
         where not exists (select 1 from often o where o.x = line.x and o.source is not distinct from line.source)),
tops as (select source, text, w from word
         qualify row_number() over (partition by source, text order by length(w) desc, w desc) = 1),
held as (select distinct l.source, l.text, l.x, o.texts from line l
         join often o on o.x = l.x and o.source is not distinct from l.source),
above as (select h.source, h.x from held h left join tops t on t.text = h.text and t.source is not distinct from h.source
          group by h.source, h.x, h.texts
          having count(distinct t.w) + max(case when t.w is null then 1 else 0 end) >= 0.5 * h.texts),
gone as (select l.r, sum(len(regexp_extract_all(l.x, {_WORD}))) as n from line l
         join above a on a.x = l.x and a.source is not distinct from l.source group by l.r),
facts as (select d.doc_id, cast(len(ws) as bigint) as n_words,
                 cast(length(coalesce(array_to_string(ws, ''), '')) as bigint) as word_chars,
                 cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
                 cast(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, {_WORD})))
                    - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, {_WORD}))))
                      as bigint) as n_dup_lines,
                 cast(coalesce(rep.n, 0) as bigint) as n_repeat_words, cast(coalesce(gone.n, 0) as bigint) as gone
          from d left join rep using (r) left join gone using (r))
select * exclude (gone), n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
       not (n_words < 10 or 100 * n_repeat_words > 20 * n_words)
           and (n_words - gone >= 0.2 * n_words or n_words - gone >= 30) as kept
from facts"""

_NEGATIVES = """
with v as (select vec_id, embedding, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label from embeddings
           where label is not null and embedding is not null and len(list_filter(embedding, lambda x: (x is null or not isfinite(x)))) = 0),
w as (select row_number() over () as r, vec_id, label, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as e from v),
s as (select a.r as ar, a.vec_id as anchor_id, b.r as br, b.vec_id, a.label = b.label as same,
             cast(list_inner_product(a.e, b.e) as bigint) as score
      from w a, w b where a.vec_id % 100 = 0 and a.r <> b.r),
p as (select * from s where same qualify row_number() over (partition by ar order by score desc, vec_id) <= 5)
select p.anchor_id, p.vec_id as positive_id,
       cast(row_number() over (partition by p.ar, p.br order by n.score desc, n.vec_id) as integer) as rank,
       n.vec_id as negative_id, p.score as positive_score, n.score as negative_score
from p join s n on n.ar = p.ar and not n.same and 80 * p.score <= 100 * n.score and n.score <= p.score
qualify row_number() over (partition by p.ar, p.br order by n.score desc, n.vec_id) <= 5"""

#: The full comparison: what the search finds too where a table fills no more than two lists.
_NEIGHBOURS = """
with v as (select row_number() over () as r, vec_id, cast(embedding as double[]) as e from embeddings
           where embedding is not null and len(list_filter(embedding, lambda x: (x is null or not isfinite(x)))) = 0
             and len(list_filter(embedding, lambda x: x <> 0)) > 0),
s as (select a.r as ar, a.vec_id as query_id, b.vec_id, list_inner_product(a.e, b.e) as score
      from v a, v b where a.vec_id % 20 = 0 and a.r <> b.r)
select query_id, cast(row_number() over (partition by ar order by score desc, vec_id) as integer) as rank, vec_id, score
from s qualify row_number() over (partition by ar order by score desc, vec_id) <= 20"""

ORACLES: dict[str, str] = {
    "op5_decontamination": _DECONTAMINATION,
    "op10_quality_rules": _QUALITY,
    "op11_hard_negatives": _NEGATIVES,
    "op13_neighbours": _NEIGHBOURS,
}
