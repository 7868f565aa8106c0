"""DuckDB twins of the queries that SQL can express on whole tables.

The others hash by XXH64, merge by a vocabulary, learn weights or align, which
DuckDB does not; their tests compare them with brute force or with libraries.
"""

OP6 = r"""
with rules(host, path, verdict) as (
    values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
           ('net', '/es/', 'block'), ('net', '/fr/', 'block')
),
cut as (
    select row_number() over () as n, page_id,
           case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest
    from pages
),
parts as (
    select n, page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1),
                                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
    from cut
),
fits as (
    select n, arg_max(struct_pack(rule := r.host || r.path, verdict := r.verdict),
                      length(r.host || r.path) * 1000 + length(r.host)) as best
    from parts p join rules r
      on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path)
    group by n
)
select page_id, host, path, best.rule as rule, coalesce(best.verdict, 'allow') as verdict
from parts left join fits using (n)
"""

OP8 = """
with recursive usable as (
    select vec_id, label, embedding::double[] as v,
           sqrt(list_dot_product(embedding::double[], embedding::double[])) as norm
    from embeddings
    where label is not null and embedding is not null
),
links as materialized (
    select a.vec_id as one, b.vec_id as two
    from usable a join usable b on a.label = b.label and a.vec_id <> b.vec_id
    where list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.98
),
reach(vec_id, other) as (
    select vec_id, vec_id from embeddings
    union
    select r.vec_id, l.two from reach r join links l on l.one = r.other
),
parts as (select vec_id, min(other) as component_id from reach group by vec_id),
counts as (select one as vec_id, count(*) as n from links group by one)
select p.vec_id, coalesce(c.n, 0)::bigint as n_links, p.component_id, p.vec_id = p.component_id as kept
from parts p left join counts c using (vec_id)
"""

OP11 = r"""
with pieces as (
    select coalesce(lang, 'und') as lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                  'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents
),
worded as (
    select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') as words from pieces
),
grams as (
    select lang, size, array_to_string(words[i:i + size - 1], ' ') as phrase
    from (select lang, words, size, unnest(range(1, len(words) - size + 2)) as i
          from worded, (select unnest([1, 2, 3, 4]) as size) where len(words) >= size)
),
counts as materialized (
    select lang, size, phrase, count(*)::hugeint as f from grams group by all
),
totals as (select lang, sum(f) as n from counts where size = 1 group by lang),
candidates as materialized (
    select lang, phrase, size, f as a, string_split(phrase, ' ') as words from counts where size > 1 and f >= 30
),
cuts as (
    select lang, phrase, a, k, array_to_string(words[:k], ' ') as one, array_to_string(words[k + 1:], ' ') as two
    from (select *, unnest(range(1, size)) as k from candidates)
),
scored as (
    select c.lang, c.phrase, c.a, x.f as l, y.f as r, (2000000 * c.a) // (x.f + y.f) as score
    from cuts c join counts x on x.lang = c.lang and x.phrase = c.one
                join counts y on y.lang = c.lang and y.phrase = c.two
    qualify row_number() over (partition by c.lang, c.phrase order by (2000000 * c.a) // (x.f + y.f), c.k) = 1
),
kept as (
    select s.* from scored s
    where not exists (
        select 1 from candidates b
        where b.lang = s.lang and len(b.words) > len(string_split(s.phrase, ' '))
          and contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' ') and 100 * b.a >= 80 * s.a
    )
),
ranked as (
    select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept
)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n,
       score::bigint as score
from ranked join totals using (lang) where rank <= 2000
"""

OP12 = """
with numbers as materialized (
    select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v
    from embeddings
    where vec_id is not null and embedding is not null
      and coalesce(list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x))), true)
),
ranked as (
    select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score,
           row_number() over (partition by q.vec_id order by list_dot_product(q.v, c.v) desc, c.vec_id) as rank
    from numbers q join numbers c on q.vec_id <> c.vec_id
    where q.vec_id % 50 = 0
)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= 5
"""

OP13 = r"""
with recursive crc_steps(i, step, c) as (
    select range, 0, range from range(256)
    union all
    select i, step + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from crc_steps where step < 8
),
crc_table as materialized (select list(c order by i) as t from crc_steps where step = 8),
runs as (
    select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                       'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) as run
    from documents where text is not null
),
each as (select doc_id, run, count(*) as n from runs group by all),
bytes as (
    select run, n, t, flatten(list_transform(string_split(concat(doc_id, ':', run), ''), lambda x:
        case when unicode(x) < 128 then [unicode(x)::bigint]
             else [192 | (unicode(x)::bigint >> 6), 128 | (unicode(x)::bigint & 63)] end)) as b
    from each, crc_table
),
hashed as (
    select run, n, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295), 4294967295) as h
    from bytes
),
shortened as (
    select case when h % 97 = 0 then run[:h % length(run)] || run[h % length(run) + 2:] else run end as word, n
    from hashed
),
words as materialized (
    select word, sum(n)::bigint as n, length(word) as size from shortened where length(word) >= 5
    group by word having sum(n) >= 3
),
less as (
    select word, size, n, i, word[:i - 1] || word[i + 1:] as rest from (select *, unnest(range(1, size + 1)) as i from words)
),
near as materialized (
    select a.word, a.n, b.word as other, b.n as other_n from less a join less b on a.i = b.i and a.rest = b.rest
    where a.word <> b.word
    union
    select a.word, a.n, w.word, w.n from less a join words w on w.word = a.rest
    union
    select w.word, w.n, a.word, a.n from less a join words w on w.word = a.rest
),
best as (
    select word, count(*) as n_near, arg_min(other, (-other_n, other)) as form, max(other_n) as form_n, any_value(n) as n
    from near group by word
),
formed as materialized (
    select word, n_near, case when form_n >= 2 * n then form end as form,
           case when form_n >= 2 * n then form_n end as form_n
    from best
),
path(word, reached, steps) as (
    select word, word, 0 from words
    union all
    select p.word, f.form, p.steps + 1 from path p join formed f on f.word = p.reached where f.form is not null
),
roots as (select word, arg_max(reached, steps) as root from path group by word)
select w.word, f.form, r.root, w.n, coalesce(f.n_near, 0)::bigint as n_near, f.form_n
from words w join roots r using (word) left join formed f using (word)
"""

ORACLES: dict[str, str] = {
    "op6_url_filters": OP6,
    "op8_embedding_near_duplicates": OP8,
    "op11_phrase_collocations": OP11,
    "op12_exact_top_k": OP12,
    "op13_spelling_variants": OP13,
}
