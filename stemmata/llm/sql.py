"""The training-data queries in SQL, where SQL can express them; tables as in the registered views."""

from __future__ import annotations

from .fill_in_middle import MIDDLE, PREFIX, SUFFIX, UNIT
from .licenses import _NOTICE, _PARAGRAPH, _SPDX, CUE, FORMS, LEAST, LICENCE_FILE, TERM
from .ngram_join import PERCENT
from .prefix_trie import WORD
from .quality import BOTH_SIDES, COUNTED, GAMMA, PRIOR, REACH, TAIL
from .wu_manber import WINDOW

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLDED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
_SPACED = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def decontamination() -> str:
    """A word is hit if it lies in a window of the document that equals one of an item."""
    return f"""
with d as (select doc_id, regexp_extract_all({_FOLDED}, '{_ALNUM}') as w from documents),
b as (select item_id, regexp_extract_all({_FOLDED}, '{_ALNUM}') as w from benchmark),
p as (select distinct item_id, least({WINDOW}, len(w)) as size, array_to_string(w[i:i + least({WINDOW}, len(w)) - 1], ' ') as x
      from (select item_id, w, unnest(range(1, greatest(1, len(w) - {WINDOW} + 1) + 1)) as i from b where len(w) > 0)),
sizes as (select distinct size from p),
places as (select doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') as x
           from (select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i from d, sizes where len(w) >= size)),
found as (select doc_id, item_id, places.size, i from places join p on p.x = places.x and p.size = places.size),
hit as (select doc_id, count(distinct k) as n_hit from (select doc_id, unnest(range(i, i + size)) as k from found) group by 1),
items as (select doc_id, count(*) as n_items, string_agg(x, ',' order by x) as ids from (select distinct doc_id, cast(item_id as varchar) as x from found) group by 1)
select d.doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join hit on hit.doc_id = d.doc_id left join items on items.doc_id = d.doc_id"""


def ngram_join() -> str:
    return f"""
with recursive d as (select doc_id, regexp_extract_all({_FOLDED}, '{_SPACED}') as w from documents),
s as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') as x from (select doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) as i from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by 1),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as shared from s a join s b on a.x = b.x and a.doc_id < b.doc_id group by all),
links as (select a, b from pairs join n x on x.doc_id = a join n y on y.doc_id = b where 100 * shared >= {PERCENT} * (x.n + y.n - shared)),
sides as (select a, b from links union all select b, a from links),
reach(node, found) as (select a, b from sides union select reach.node, sides.b from reach join sides on sides.a = reach.found)
select d.doc_id, coalesce(n, 0) as n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) as component_id
from d left join n on n.doc_id = d.doc_id left join (select node, min(found) as m from reach group by 1) r on r.node = d.doc_id"""


def quality() -> str:
    measures = [*COUNTED, "word_length"]
    divided = ", ".join(f"cast(greatest({n} - 1, 0) as double) / (cast({rest} as double) + 0.5) as {k}" for k, (n, rest) in COUNTED.items())
    divided += ", coalesce(cast(word_chars as double) / nullif(n_words, 0), 0.0) as word_length"
    fed = {**{k: f"(cast({n} as double) + 0.5) / (cast({rest} as double) + 0.5)" for k, (n, rest) in COUNTED.items()}, "word_length": "word_length"}
    long = " union all ".join(f"select lang, source, '{k}' as measure, {fed[k]} as value from m where not base_failed" for k in measures)
    tail = "case measure " + " ".join(f"when '{k}' then {v}" for k, v in TAIL.items()) + " end"

    def quantiles(by: str) -> str:
        keys = ", ".join(x for x in (by, "measure") if x)
        bins = ", ".join(f"min(case when 100 * upto >= ({q}) * total then bin end) as {c}" for c, q in (("mid", "50"), ("low", f"100 - {tail}"), ("high", tail)))
        return f"""select {keys}, max(total) as n, {bins}
        from (select {keys}, bin, sum(sum(n)) over (partition by {keys} order by bin) as upto, sum(sum(n)) over (partition by {keys}) as total from sketch group by {keys}, bin) group by {keys}"""

    power = f"power(cast({GAMMA} as double), {{b}})"
    shape = {"mid": f"2 * {power} / {1 + GAMMA}", "low": f"{power} / {GAMMA}", "high": power}
    drawn = lambda n, own, to: f"(({n} * {own} + {PRIOR} * {to}) / ({n} + {PRIOR}))"
    pick = lambda c: shape[c].format(b=drawn("fine.n", f"fine.{c}", drawn("lang.n", f"lang.{c}", f"whole.{c}")))
    side = {"lo": f"case when measure = '{BOTH_SIDES}' then low - {REACH} * (mid - low) else 0.0 end", "hi": f"high + {REACH} * (high - mid)"}
    fits = " and ".join(f"coalesce({k} between {k}_lo and {k}_hi, true)" for k in measures)
    return f"""
with d as (select doc_id, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '{_SPACED}') as w from documents),
triples as (select doc_id, i, array_to_string(w[i:i + 2], ' ') as x from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from d where len(w) > 2)),
again as (select doc_id, count(distinct k) as n from (select doc_id, unnest([i, i + 1, i + 2]) as k from (select *, count(*) over (partition by doc_id, x) as c from triples) where c > 1) group by 1),
lines as (select doc_id, count(*) as n_lines, count(*) - count(distinct x) as n_dup from (select doc_id, unnest(string_split(text, chr(10))) as x from d) where regexp_matches(x, '{_SPACED}') group by 1),
c as (select d.doc_id, lang, source, len(w) as n_words, coalesce(cast(list_sum(list_transform(w, lambda x: length(x))) as bigint), 0) as word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols,
      coalesce(n_dup, 0) as n_dup_lines, coalesce(again.n, 0) as n_repeat_words, coalesce(n_lines, 0) as n_lines
      from d left join again on again.doc_id = d.doc_id left join lines on lines.doc_id = d.doc_id),
m as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, {divided} from c),
sketch as (select lang, source, measure, cast(ceil(ln(value) / ln(cast({GAMMA} as double))) as int) as bin, count(*) as n from ({long}) group by all),
limits as (select fine.lang, fine.source, measure, {pick('mid')} as mid, {pick('low')} as low, {pick('high')} as high
  from ({quantiles('lang, source')}) fine join ({quantiles('lang')}) lang using (lang, measure) join ({quantiles('')}) whole using (measure)),
bounds as (select lang, source, {', '.join(f"max(case when measure = '{k}' then {e} end) as {k}_{c}" for k in measures for c, e in side.items())} from limits group by 1, 2)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and {fits} as kept from m left join bounds on bounds.lang = m.lang and bounds.source = m.source"""


def licenses() -> str:
    quoted = lambda x: x.replace("'", "''")
    rows = ", ".join(f"('{k}', {i}, '{quoted(t)}')" for k, texts in sorted(FORMS.items()) for i, t in enumerate(texts))
    cue = CUE.removeprefix("(?i)")
    compared = f"regexp_replace(regexp_replace(x, '{_NOTICE}', 'Copyright \\1', 'g'), '{_SPDX}', '', 'g')"
    idf = lambda df: f"(1 + ln((1.0 + (select count(*) from texts)) / (1.0 + {df})))"
    return f"""
with files as (select doc_id, coalesce(source, '') || '/' || (doc_id // 1000) as dir, coalesce(source, '') || '/' || (doc_id // 1000) || '/' || doc_id || '.txt' as path, coalesce(text, '') as text from documents),
named as (select *, regexp_matches(path, '{LICENCE_FILE}') as named, list_filter(list_transform(case when regexp_matches(path, '{LICENCE_FILE}') then [text]
  else list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '(?i){cue}')) end, lambda x: trim(x)), lambda x: length(x) > 0) as plain,
  case when regexp_matches(text, '(?i){cue}') then list_filter(string_split_regex(text, '{_PARAGRAPH}'), lambda x: regexp_matches(x, '(?i){cue}')) else [] end as blocks from files),
read as (select *, named or (len(plain) > 0 and list_sum(list_transform(plain, lambda x: length(x))) * 2 >= length(text)) as is_file,
  list_filter(list_transform(list_concat(plain, case when named then blocks[1:1] else blocks end), lambda x: trim({compared})), lambda x: length(x) > 0) as passages from named),
each as (select distinct doc_id, path, dir, is_file, passage from (select doc_id, path, dir, is_file, unnest(passages) as passage from read)),
texts as (select distinct passage from each),
terms as (select passage, term, count(*) as tf from (select passage, unnest(regexp_extract_all(lower(passage), '{TERM}')) as term from texts) group by all),
df as (select term, count(*) as df from terms group by 1),
templates as (select licence, k, term, count(*) as tf from (select licence, k, unnest(regexp_extract_all(lower(t), '{TERM}')) as term from (values {rows}) as v(licence, k, t)) group by all),
a as (select passage, term, (1 + ln(tf)) * {idf('df')} as w from terms join df using (term)),
b as (select licence, k, templates.term, (1 + ln(tf)) * {idf('coalesce(df, 0)')} as w from templates left join df on df.term = templates.term),
na as (select passage, sqrt(sum(w * w)) as n from a group by 1), nb as (select licence, k, sqrt(sum(w * w)) as n from b group by 1, 2),
cosine as (select a.passage, b.licence, b.k, round(sum(a.w / na.n * b.w / nb.n), 6) as score from a join b on b.term = a.term join na on na.passage = a.passage join nb on nb.licence = b.licence and nb.k = b.k group by all),
best as (select passage, licence, score from (select *, row_number() over (partition by passage order by score desc, licence) as r from cosine) where r = 1 and score >= {LEAST}),
own as (select doc_id, path, dir, is_file, licence, score from (select e.doc_id, path, dir, is_file, licence, score, row_number() over (partition by e.doc_id, path order by licence = 'Proprietary', score desc, licence) as r from each e join best on best.passage = e.passage) where r = 1),
votes as (select dir, licence from (select dir, licence, row_number() over (partition by dir order by count(*) desc, licence) as r from own where is_file group by dir, licence) where r = 1),
dirs as (select distinct dir from read),
near as (select dirs.dir, votes.dir as up, licence, row_number() over (partition by dirs.dir order by length(votes.dir) desc) as r from dirs join votes on votes.dir = dirs.dir or votes.dir = '' or starts_with(dirs.dir, votes.dir || '/'))
select f.doc_id, f.path, coalesce(own.licence, near.licence) as licence, own.score, case when own.licence is not null then 'own' when near.licence is not null then 'inherited' else 'none' end as source,
  case when own.licence is null then near.up end as found_in
from files f left join own on own.doc_id = f.doc_id and own.path = f.path left join near on near.dir = f.dir and near.r = 1"""


def top_k() -> str:
    whole = "list_transform(embedding, lambda x: floor(1024 * x::double))"
    fine = "vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"
    return f"""
with v as (select vec_id, {whole} as v from embeddings where {fine}),
s as (select q.vec_id as query_id, d.vec_id, cast(list_dot_product(q.v, d.v) as bigint) as score from v q join v d on q.vec_id % 100 = 0 and d.vec_id <> q.vec_id)
select query_id, cast(rank as int) as rank, vec_id, score from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 10"""


def fill_in_middle() -> str:
    digest = "sha256('42:' || coalesce(cast(doc_id as varchar), ''))"
    draw = lambda k: f"cast('0x' || substr({digest}, {8 * k + 1}, 8) as bigint)"
    upto = lambda c: f"cast(coalesce(list_sum(list_transform(u[1:{c}], lambda x: length(x))), 0) as bigint)"
    return f"""
with u as (select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '{UNIT}') as u from documents),
h as (select *, {draw(0)} % (len(u) + 1) as a, {draw(1)} % (len(u) + 1) as b, {draw(2)} % 100 as c, {draw(3)} % 100 as d from u),
f as (select *, case when text = '' or contains(text, '{PREFIX}') or contains(text, '{SUFFIX}') or contains(text, '{MIDDLE}') or c >= 50 then 'plain' when d < 80 then 'spm' else 'psm' end as form,
      least(a, b) as lo, greatest(a, b) as hi from h),
o as (select *, {upto('lo')} as p, {upto('hi')} as m from f),
t as (select *, substr(text, 1, p) as prefix, substr(text, p + 1, m - p) as middle, substr(text, m + 1) as suffix from o)
select doc_id, len(u) as n, form, case when form <> 'plain' then p end as prefix_chars, case when form <> 'plain' then m - p end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '{PREFIX}' || prefix || '{SUFFIX}' || suffix || '{MIDDLE}' || middle else '{SUFFIX}' || suffix || '{PREFIX}' || prefix || '{MIDDLE}' || middle end) as output_sha256,
  sha256(text) as restored_sha256 from t"""


def prefix_trie() -> str:
    """Nodes as lists of turns; each node's subtree is found by comparing lists."""
    bits = "list_prepend(4294967295::bigint, flatten(list_transform(range(1, length(c) + 1), lambda i: [ascii(substr(c, i, 1))::bigint, 0, 0, 0, 0, 0, 0, 0])))"
    # The reflected polynomial of the usual 32-bit check.
    crc = f"xor(list_reduce({bits}, lambda a, x: xor(xor(a, x) >> 1, (xor(a, x) & 1) * 3988292384)), 4294967295)"
    return f"""
with t as (select conv_id, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} as t, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as k from conversations where conv_id is not null),
o as (select conv_id, list(t order by k) as own, cast(conv_id as varchar) as c from t group by conv_id),
h as (select conv_id, own, {crc} % 4 as h from o),
r as (select a.conv_id, list_concat(coalesce(b.own[1:h], []), a.own[h + 1:]) as path from h a left join o b on b.conv_id = a.conv_id - a.conv_id % 20),
m as (select conv_id, path[1:d] as node, d = len(path) as ends from (select conv_id, path, unnest(range(0, len(path) + 1)) as d from r)),
n as (select node, len(node) as depth, min(conv_id) as conv_id, count(*) as n_convs, sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (ends), '')) as ends_sha256 from m group by node),
c as (select node[1:len(node) - 1] as up, count(*) as n_children from n where depth > 0 group by 1),
x as (select n.*, coalesce(n_children, 0) as n_children, case when depth > 0 then (n_convs - 1) * len(regexp_extract_all(node[-1].text, '{WORD}')) else 0 end as own from n left join c on c.up = n.node),
s as (select a.node, cast(count(*) filter (b.n_children = 0) as bigint) as n_leaves, cast(sum(b.own) as bigint) as saved_tokens from x a join x b on b.depth >= a.depth and b.node[1:a.depth] = a.node group by 1)
select x.conv_id, x.depth, u.conv_id as parent_conv_id, x.n_convs, x.n_children, n_leaves, saved_tokens, x.ends_sha256
from x join s on s.node = x.node left join x u on x.depth > 0 and u.node = x.node[1:x.depth - 1]"""


ORACLE_SQL = {
    "op2_quality_rules": quality(), "op3_license_scan": licenses(), "op8_ngram_jaccard": ngram_join(), "op10_wu_manber": decontamination(), "op11_top_k": top_k(), "op12_fill_in_middle": fill_in_middle(),
    "op13_prefix_trie": prefix_trie(),
}
